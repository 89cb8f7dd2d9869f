"""Token ids in a content-addressed store.

A rolling hash over a document's ids cuts them into chunks, wherever its low bits are zero, so equal passages give equal
chunks. A chunk is stored once, under the SHA-256 of its bytes. A document's recipe lists its chunks; its manifest is the
root of a Merkle tree over them. Reading verifies every chunk and every root.

Files, under one folder: store/kind=chunk (digest, ids, little-endian, of `width` bytes each), store/kind=doc (doc_id,
n_tokens, recipe, root) and index (doc_id ascending, start). One pass over the documents makes chunks and recipes, one
shuffle drops copies of chunks. Texts are cut into segments that tokens never cross; each distinct one is encoded once, as long
as a worker remembers it, and its bytes are compared wherever its ids are used again. Tokenizer files whose rules aren't known
to allow such cuts encode whole texts. With `added`, texts have the ids of a plain encode call, which finds the tokenizer file's added
tokens in them; without it, special ones are kept as ordinary text.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import Store
from .textvec import U64, mix, pieces, released, span_hashes

WINDOW = 4
_FACTORS = mix(np.arange(1, WINDOW + 1, dtype=np.uint64)) | U64(1)


@dataclass(frozen=True)
class Format:
    """tokenizer: path of its file. end: the id after each document, or None. width: bytes of an id. A chunk has about
    mean ids, a power of two, and most at most. remembered: encoded segments that a Python worker keeps. added: special added
    tokens are found in texts, as by a plain encode call."""

    tokenizer: str
    end: int | None = 2
    width: int = 2
    mean: int = 512
    most: int = 4096
    remembered: int = 1_000_000
    added: bool = False


_SOLID = np.zeros(256, bool)
_SOLID[0x21:0x7F] = _SOLID[0xC3:0xE0] = _SOLID[0xE4:0xF5] = True
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_POINT = np.zeros(256, bool)
_POINT[[ord(c) for c in ".,;:!?|#$%&*"]] = True


def segment_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bytes at which a token must begin, whatever stands around them.

    These are texts' first bytes; a space or line end before a character that is no white space; and a punctuation mark
    after an ASCII letter. The byte-level pre-tokenizer puts a boundary at each: a single space joins what follows, a line
    end before such a character is a match of its own, and no match goes from letters to other marks than apostrophes.
    """
    cut = np.zeros(len(data) + 1, bool)
    if len(data) > 1:
        blank = (data[:-1] == 0x20) | (data[:-1] == 0x0A)
        cut[: len(data) - 1] = blank & _SOLID[data[1:]]
        cut[1 : len(data)] |= _LETTER[data[:-1]] & _POINT[data[1:]]
        inner = offsets[1:-1]
        # A text's last blank isn't followed by the next text.
        cut[inner[inner > 0] - 1] = False
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    # The byte before a text's end may still be a mark after a letter.
    last = offsets[1:][np.diff(offsets) > 1] - 1
    if len(data) > 1:
        cut[last] |= _LETTER[data[last - 1]] & _POINT[data[last]]
    return np.flatnonzero(cut[:-1])


def allows_cuts(rules: dict) -> bool:
    """Whether segment_starts holds for a tokenizer file: byte-level pairs, split by the usual pattern, and nothing else that
    looks beyond a segment."""
    split = rules.get("pre_tokenizer") or {}
    model = rules.get("model") or {}
    byte_level = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    bare = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk"))
    return bool(byte_level and bare) and not any(rules.get(k) for k in ("normalizer", "truncation", "padding"))


class _Growing:
    """An array that is added to."""

    def __init__(self, kind: type):
        self.values, self.used = np.zeros(1 << 18, kind), 0

    def add(self, more: np.ndarray) -> None:
        while self.used + len(more) > len(self.values):
            self.values = np.concatenate([self.values, np.zeros_like(self.values)])
        self.values[self.used : self.used + len(more)] = more
        self.used += len(more)


class Encoder:
    """Encodes whole texts by the tokenizers library, each distinct segment once as long as it is remembered."""

    def __init__(self, form: Format):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.form, self.tokenizer = form, Tokenizer.from_file(form.tokenizer)
        self.tokenizer.encode_special_tokens = not form.added
        tokens = [t for t in self.tokenizer.get_added_tokens_decoder().values() if t.content and (form.added or not t.special)]
        # The longest of those at one place counts, as in the library.
        self.pattern = re.compile(b"|".join(re.escape(x) for x in sorted((t.content.encode() for t in tokens), key=len, reverse=True))) if tokens else None
        self.literal = len({t.normalized for t in tokens}) <= 1 and not any(t.single_word or t.lstrip or t.rstrip for t in tokens)
        with open(form.tokenizer, encoding="utf-8") as file:
            self.cuts = allows_cuts(json.load(file))
        self._forget()

    def _forget(self) -> None:
        # Hashes of known segments, ascending; where each one's ids and bytes begin, and how many they are.
        self.known, self.begin, self.size = np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.text_begin, self.text_size = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.ids, self.texts = _Growing(np.uint32), _Growing(np.uint8)

    def _encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The texts' ids one after the other, and how many each has."""
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.array([len(x) for x in lists], np.int64)
        return np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum())), sizes

    def _learn(self, hashes: np.ndarray, texts: list[bytes]) -> None:
        """New segments, by ascending hashes."""
        counts = []
        ids_before, bytes_before = self.ids.used, self.texts.used
        for s in range(0, len(texts), 4096):
            flat, sizes = self._encoded([x.decode() for x in texts[s : s + 4096]])
            self.ids.add(flat)
            counts.append(sizes)
        self.texts.add(np.frombuffer(b"".join(texts), np.uint8))
        sizes, lengths = np.concatenate(counts), np.array([len(x) for x in texts], np.int64)
        at = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, at, hashes)
        self.begin = np.insert(self.begin, at, ids_before + np.cumsum(sizes) - sizes)
        self.size = np.insert(self.size, at, sizes)
        self.text_begin = np.insert(self.text_begin, at, bytes_before + np.cumsum(lengths) - lengths)
        self.text_size = np.insert(self.text_size, at, lengths)

    def _others(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Which segments, known as those numbered at, have other bytes than these."""
        sizes = ends - starts
        other = self.text_size[at] != sizes
        where = np.arange(len(data), dtype=np.int64)
        where += np.repeat(np.where(other, 0, self.text_begin[at]) - starts, sizes)
        np.minimum(where, max(0, self.texts.used - 1), out=where)
        wrong = np.flatnonzero(self.texts.values[where] != data)
        if len(wrong):
            other[np.searchsorted(starts, wrong, side="right") - 1] = True
        return np.flatnonzero(other)

    def _starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Segments' starts. An added token is a segment of its own, and texts around it are cut as if they were whole texts.

        Where a token's place depends on what is around it, texts that have one are not cut at all."""
        if not self.cuts:
            return offsets[:-1][np.diff(offsets) > 0]
        raw = data.tobytes()
        if self.pattern is None or self.pattern.search(raw) is None:
            return segment_starts(data, offsets)
        spans = []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            found = [m.span() for m in self.pattern.finditer(raw, a, b)]
            spans += found if self.literal or not found else [(a, b)]
        begin, end = np.array(spans, np.int64).reshape(-1, 2).T
        starts = segment_starts(data, np.sort(np.concatenate([offsets, begin, end])))
        return starts[np.searchsorted(end, starts, side="right") >= np.searchsorted(begin, starts, side="left")]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, texts one after the other, with the end id after each; and how many each text has."""
        n = len(offsets) - 1
        starts = self._starts(data, offsets)
        if len(starts):
            ends = np.append(starts[1:], len(data))
            distinct, where, back = np.unique(span_hashes(data, ends - starts), return_index=True, return_inverse=True)
            if len(self.known) + len(distinct) > self.form.remembered:
                self._forget()
            at = np.minimum(np.searchsorted(self.known, distinct), max(0, len(self.known) - 1))
            new = np.flatnonzero(self.known[at] != distinct) if len(self.known) else np.arange(len(distinct))
            if len(new):
                raw = data.tobytes()
                self._learn(distinct[new], [raw[a:b] for a, b in zip(starts[where[new]].tolist(), ends[where[new]].tolist(), strict=True)])
                at = np.searchsorted(self.known, distinct)
            at = at[back]
            begin, size = self.begin[at], self.size[at].astype(np.int64)
            other = self._others(data, starts, ends, at)
            if len(other):  # equal hashes of different bytes: these are encoded each time
                raw = data.tobytes()
                before = self.ids.used
                flat, size[other] = self._encoded([raw[a:b].decode() for a, b in zip(starts[other].tolist(), ends[other].tolist(), strict=True)])
                begin[other] = before + np.cumsum(size[other]) - size[other]
                self.ids.add(flat)
                self.ids.used = before
        else:
            begin = size = np.zeros(0, np.int64)
        of = np.searchsorted(starts, offsets)  # the first segment of each text
        counts = np.diff(np.concatenate([[0], np.cumsum(size)])[of])
        total = int(size.sum())
        place = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(total)
        ids = self.ids.values[place]
        if self.form.end is not None:
            ids, counts = np.insert(ids, np.cumsum(counts), self.form.end), counts + 1
        return ids, counts.astype(np.int64) if n else np.zeros(0, np.int64)


_KEPT: dict[Format, Encoder] = {}


def encoder_of(form: Format) -> Encoder:
    """This worker's encoder, which remembers segments from one task to the next; one is kept at a time."""
    if form not in _KEPT:
        _KEPT.clear()
        _KEPT[form] = Encoder(form)
    return _KEPT[form]


def chunk_ends(ids: np.ndarray, counts: np.ndarray, form: Format) -> np.ndarray:
    """Where chunks end: at texts' ends, where the rolling hash of the last ids has zeros, and after every most ids."""
    rolling = np.zeros(len(ids), U64)
    values = mix(ids)
    for j in range(min(WINDOW, len(ids))):
        rolling[j:] += values[: len(ids) - j] * _FACTORS[j]
    cut = (mix(rolling) & U64(form.mean - 1)) == 0
    ends = np.cumsum(counts)
    place = np.arange(len(ids)) - np.repeat(ends - counts, counts)
    cut &= place >= WINDOW - 1  # the hash looks back over this text's ids only
    cut[ends[counts > 0] - 1] = True
    out = np.flatnonzero(cut) + 1
    begin = np.concatenate([[0], out[:-1]])
    long = np.flatnonzero(out - begin > form.most)
    if len(long):
        more = [np.arange(begin[k] + form.most, out[k], form.most) for k in long]
        out = np.sort(np.concatenate([out, *more]))
    return out


def merkle_root(leaves: list[bytes]) -> bytes:
    """Root of the binary tree of SHA-256 over leaves; an odd node goes up as it is; of no leaves, the digest of nothing."""
    level = leaves
    while len(level) > 1:
        level = [hashlib.sha256(b"\x01" + level[i] + level[i + 1]).digest() if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0] if level else hashlib.sha256(b"").digest()


STORED = "kind string, route binary, doc_id long, n_tokens long, recipe array<binary>, root binary, ids binary"


def _encode(form: Format) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(form)
        task, number = TaskContext.get().partitionId().to_bytes(4, "big"), 0
        kinds = [pa.string(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.binary()), pa.binary(), pa.binary()]
        names = [x.split(" ")[0] for x in STORED.split(", ")]
        for batch in batches:
            for lo, hi, data, offsets in pieces(batch.column(1)):
                ids, counts = encoder.encode(data, offsets)
                if form.width == 2 and len(ids) and int(ids.max()) > 0xFFFF:
                    raise ValueError("ids need a width of 4")
                stored = ids.astype(f"<u{form.width}").tobytes()
                ends = chunk_ends(ids, counts, form)
                of = np.searchsorted(ends, np.cumsum(counts) - counts, side="right").tolist() + [len(ends)]
                ends = [0, *(ends * form.width).tolist()]
                rows: list[tuple] = []
                for t, doc_id in enumerate(batch.column(0).slice(lo, hi - lo).to_pylist()):
                    recipe = []
                    for k in range(of[t], of[t + 1]):
                        chunk = stored[ends[k] : ends[k + 1]]
                        recipe.append(hashlib.sha256(chunk).digest())
                        rows.append(("chunk", recipe[-1], None, None, None, None, chunk))
                    number += 1
                    rows.append(("doc", task + number.to_bytes(8, "big"), doc_id, int(counts[t]), recipe, merkle_root(recipe), None))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    return run


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the task's number and how many ids came before, in this task."""
    part, total = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = np.asarray(batch.column("n_tokens"))
        before = np.cumsum(n) - n + total
        total += int(n.sum())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(n), part), pa.int32()), pa.array(before, pa.int64())], names=[*batch.schema.names, "part", "before"])


def write_store(docs: DataFrame, store: Store, form: Format) -> None:
    """Write docs (doc_id, text) in ascending doc_id order; rows of one id follow each other by their manifests.

    Null texts are empty: they have the end id only. Null ids come first. Other columns are not looked at.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = rows.mapInArrow(released(_encode(form)), STORED).dropDuplicates(["kind", "route"])
    made.write.option("compression", "zstd").partitionBy("kind").parquet(store.path("store"))
    known = _stored(docs.sparkSession, store).where("kind = 'doc'").select("doc_id", "root", "route", "n_tokens")
    ordered = known.repartitionByRange("doc_id", "root", "route").sortWithinPartitions("doc_id", "root", "route")
    ordered.mapInArrow(_numbered, "doc_id long, root binary, route binary, n_tokens long, part int, before long").write.parquet(store.path("index"))


def _stored(spark: SparkSession, store: Store) -> DataFrame:
    return spark.read.schema(STORED).parquet(store.path("store"))


def _index(spark: SparkSession, store: Store) -> DataFrame:
    """(route, start) of every document: the ids before it in its part of the index, and in all parts before."""
    index = spark.read.schema("doc_id long, route binary, n_tokens long, part int, before long").parquet(store.path("index"))
    sizes = sorted((r.part, r.total) for r in index.groupBy("part").agg(F.sum("n_tokens").alias("total")).collect())  # a row for each part
    bases = [(part, sum(t for _, t in sizes[:i])) for i, (part, _) in enumerate(sizes)]
    parts = spark.createDataFrame(bases, "part int, base long")
    return index.join(F.broadcast(parts), "part").select("route", (F.col("base") + F.col("before")).alias("start"))


def _verified(width: int) -> Callable:
    """Number and crc32 of each chunk's ids as 32-bit integers, once its bytes match its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, sums = [], []
            for digest, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if hashlib.sha256(ids).digest() != digest:
                    raise ValueError(f"chunk {digest.hex()} is damaged")
                counts.append(len(ids) // width)
                sums.append(zlib.crc32(np.frombuffer(ids, f"<u{width}").astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(sums, pa.int64())], names=["digest", "n", "crc"])

    return run


def _shift_tables() -> list[np.ndarray]:
    """What 2**k zero bytes make of each of the 32 bits of a crc32."""
    column = np.array([0xEDB88320, *(1 << i for i in range(31))], np.uint64)  # one zero bit
    tables = []
    for k in range(3 + 48):
        if k >= 3:
            tables.append(column)
        column = _apply(column, column)
    return tables


def _apply(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.zeros_like(values)
    for bit in range(32):
        out ^= np.where((values >> np.uint64(bit)) & np.uint64(1), table[bit], np.uint64(0))
    return out


def joined_crc(crcs: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """crc32 of each row's byte strings one after the other, from theirs; counts strings to a row, at least one."""
    ends = np.cumsum(counts)
    upto = np.cumsum(sizes)
    after = (np.repeat(upto[ends - 1], counts) - upto).astype(np.int64)
    values = crcs.astype(np.uint64)
    for k, table in enumerate(_shift_tables()):
        moved = np.flatnonzero((after >> k) & 1)
        if len(moved):
            values[moved] = _apply(table, values[moved])
    return np.bitwise_xor.reduceat(values, ends - counts).astype(np.int64)


def _rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents' crc32 from their chunks', once the chunks make their root and their number of ids."""
    for batch in batches:
        parts = batch.column("parts").to_pylist()
        crcs = []
        for doc_id, root, n, own in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "root", "n_tokens")), parts, strict=True):
            if merkle_root([p["digest"] for p in own]) != root or sum(p["n"] for p in own) != n:
                raise ValueError(f"document {doc_id} can't be rebuilt")
        counts = np.array([len(p) for p in parts], np.int64)
        flat = [p for own in parts for p in own]
        crcs = np.zeros(len(parts), np.int64)
        if flat:
            crcs[counts > 0] = joined_crc(np.array([p["crc"] for p in flat], np.int64), 4 * np.array([p["n"] for p in flat], np.int64), counts[counts > 0])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(crcs)], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def _recipes(spark: SparkSession, store: Store) -> DataFrame:
    docs = _stored(spark, store).where("kind = 'doc'").select("route", "doc_id", "n_tokens", "recipe", "root")
    return docs.join(_index(spark, store), "route")


def read_summary(spark: SparkSession, store: Store, form: Format) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files. Damaged, missing and swapped chunks, and roots
    that don't belong to their recipes, make the query fail. Rows that repeat, null ids and empty texts come back as written;
    an empty store has none.

    Each chunk is read once; its ids go no further than its crc32, from which documents' are put together."""
    chunks = _stored(spark, store).where("kind = 'chunk'").select(F.col("route").alias("digest"), "ids").mapInArrow(released(_verified(form.width)), "digest binary, n long, crc long")
    docs = _recipes(spark, store)
    used = docs.select("route", F.posexplode_outer("recipe").alias("seq", "digest")).join(chunks, "digest", "left")
    used = used.groupBy("route").agg(F.array_sort(F.collect_list(F.when(F.col("seq").isNotNull(), F.struct("seq", "digest", "n", "crc")))).alias("parts"))
    parts = F.transform("parts", lambda p: F.struct(p.digest.alias("digest"), F.coalesce(p.n, F.lit(0)).alias("n"), F.coalesce(p.crc, F.lit(0)).alias("crc")))
    rows = used.select("route", parts.alias("parts")).join(docs.drop("recipe"), "route").select("doc_id", "start", "n_tokens", "root", "parts")
    return rows.mapInArrow(_rebuilt, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _ids(width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(b"".join(own), f"<u{width}").astype(np.int64) for own in batch.column("parts").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), pa.array(ids, pa.list_(pa.int64()))], names=["doc_id", "start", "ids"])

    return run


def read_documents(spark: SparkSession, store: Store, form: Format) -> DataFrame:
    """(doc_id, start, ids) of every document, rebuilt from its recipe."""
    chunks = _stored(spark, store).where("kind = 'chunk'").select(F.col("route").alias("digest"), "ids")
    docs = _recipes(spark, store)
    used = docs.select("route", F.posexplode("recipe").alias("seq", "digest")).join(chunks, "digest")
    used = used.groupBy("route").agg(F.array_sort(F.collect_list(F.struct("seq", "ids"))).alias("parts"))
    rows = docs.select("route", "doc_id", "start").join(used, "route", "left")
    rows = rows.select("doc_id", "start", F.coalesce(F.transform("parts", lambda p: p.ids), F.array().cast("array<binary>")).alias("parts"))
    return rows.mapInArrow(_ids(form.width), "doc_id long, start long, ids array<long>")


def store_round_trip(docs: DataFrame, form: Format) -> DataFrame:
    """Write docs to a store in a folder of its own and read its summary back: see write_store and read_summary for null and
    repeated ids, null and empty texts and empty tables. Only doc_id and text are looked at."""
    store = Store(docs.sparkSession, "tokens")
    write_store(docs, store, form)
    return read_summary(docs.sparkSession, store, form)
