"""WARC archives whose records are found by boundary-chain verification.

A payload may hold the bytes that begin a record. So tasks only note, for each place where they stand, the place where a
record that begins there would end: its successor. Starting from a file's first byte, pointer jumping over these links
keeps what is reachable; everything else lies inside a payload.

Links are jumped over in two steps, so that no task needs a whole file's. Inside a block, which is what one task reads of a
file, each candidate is led to the first place beyond the block's own candidates. Between blocks, only candidates to which
others lead count, a few for each block; their jumps double from round to round, from table to table. Then each block marks
its chain from where the file's chain enters it.

Archives are written and read by Spark's own text source with the record's first bytes as line separator, which hands out
raw bytes, works in any store that Spark reads, and splits files that aren't compressed.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import Store
from .textvec import released

#: What every record begins with, and how lines and blocks end.
MAGIC, LINE = b"WARC/1.1\r\n", "\r\n"
#: Payloads of fewer bytes are never revisits.
LEAST_BYTES = 100
#: Up to so many digests of repeated payloads may be broadcast; more are joined by a shuffle.
MOST_BROADCAST = 1_000_000
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CANDIDATE = "file string, block long, at long, head int, content long, kind string, page string, refers string, stated string, stated_bytes long, bytes long, digest string"
_HEAD = re.compile(rb"^([A-Za-z0-9-]+): ?(.*?)\r?$", re.M)


def _uuid(c: Column) -> Column:
    """A custom (version 8) UUID of a string, as the URI of a record."""
    h = F.md5(c)
    part = lambda at, n: F.substring(h, at, n)
    return F.concat(F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-8"), part(14, 3), F.lit("-a"), part(18, 3), F.lit("-"), part(21, 12), F.lit(">"))


def write_archives(pages: DataFrame, path: str, compression: str = "none", date: str = "2000-01-01T00:00:00Z") -> None:
    """Write a record for each row of pages (page_id, url, html), all of this date. A null html is empty, a null url too.

    Of equal payloads of LEAST_BYTES or more, rows with the smallest id are responses and all others revisit it; so rows that
    repeat that id are all responses. Rows with a null id revisit like others, and are responses where all ids are null.
    Records' ids follow from page_id and payload, so only rows that repeat both share one. Other columns are not looked at.
    """
    store = Store(pages.sparkSession, "warc-groups")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.select("*", F.octet_length("html").alias("size"), F.sha2("html", 256).alias("digest"))
    groups = rows.where(F.col("size") >= LEAST_BYTES).groupBy("digest").agg(F.min("page_id").alias("refers"), F.count("*").alias("n"))
    several = store.write(groups.where("n > 1 AND refers IS NOT NULL").select("digest", "refers"), "several")
    few = several.count() <= MOST_BROADCAST
    rows = rows.join(F.broadcast(several) if few else several, "digest", "left")
    revisit = F.col("refers").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers"))
    block = F.when(revisit, F.lit(HTTP)).otherwise(F.concat(F.lit(HTTP), "html"))
    number = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    record_id = lambda c: _uuid(F.concat(number(c), F.lit("/"), "digest"))
    url = F.regexp_replace(F.when(F.col("url") == "", F.lit("about:blank")).otherwise(F.col("url")), "[\\r\\n]", "%0A")
    head = F.concat_ws(
        LINE,
        F.concat(F.lit("WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.concat(F.lit("WARC-Record-ID: "), F.when(revisit, _uuid(F.concat(number(F.col("page_id")), F.lit("/revisit/"), "digest"))).otherwise(record_id(F.col("page_id")))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit(f"WARC-Profile: {PROFILE}{LINE}WARC-Refers-To: "), record_id(F.col("refers")), F.lit(f"{LINE}Refers-To-Page: "), number(F.col("refers")))),
        F.concat(F.lit("Page: "), number(F.col("page_id"))),
        F.concat(F.lit("Payload-Length: "), F.col("size").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    )
    # The line separator makes the second of the two line ends that follow a record's block.
    record = F.concat(F.lit(MAGIC.decode()), head, F.lit(LINE * 2), block, F.lit(LINE))
    rows.select(record.alias("value")).write.option("lineSep", LINE).option("compression", compression).text(path)
    store.drop("several")


def _parsed(segment: bytes) -> tuple[int, dict[bytes, bytes]]:
    """Length of a candidate's header with the blank line, and its fields; -1 if that is no header."""
    end = segment.find(b"\r\n\r\n")
    if end < 0:
        return -1, {}
    fields = {k.lower(): v for k, v in _HEAD.findall(segment[:end])}
    return (end + 4, fields) if fields.get(b"content-length", b"").isdigit() else (-1, {})


def _payload(block: bytes) -> bytes:
    return block.partition(b"\r\n\r\n")[2] if block.startswith(b"HTTP/") else block


def _text(value: bytes | None) -> str | None:
    return None if value is None else value.decode("utf-8", "replace")


def _number(value: bytes | None) -> int:
    return int(value) if value is not None and value.isdigit() else -1


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What follows each magic of a block, in order. Out: where it begins in its block, and what its header says.

    bytes and digest are those of the payload, where the segment holds the whole record; else they are null."""
    block, at = None, 0
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.int64(), pa.string()]
    names = [x.split(" ")[0] for x in CANDIDATE.split(", ")]
    for batch in batches:
        out = []
        for file, start, segment in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if (file, start) != block:
                block, at = (file, start), 0
            head, fields = _parsed(segment)
            row = [file, start, at, head, -1, *[None] * 7]
            if head >= 0:
                content = int(fields[b"content-length"])
                row[4:10] = content, _text(fields.get(b"warc-type")), _text(fields.get(b"page")), _text(fields.get(b"refers-to-page")), _text(fields.get(b"warc-payload-digest")), _number(fields.get(b"payload-length"))
                if head + content + 4 == len(segment):
                    payload = _payload(segment[head : head + content])
                    row[10:] = len(payload), hashlib.sha256(payload).hexdigest()
            out.append(row)
            at += len(segment) + len(MAGIC)
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)


def _successors(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The number of the candidate that begins where each one ends, or their count if none does. starts ascend."""
    at = np.searchsorted(starts, ends)
    return np.where((at < len(starts)) & (starts[np.minimum(at, len(starts) - 1)] == ends), at, len(starts))


def exits(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The first place, from each candidate on along its chain, at which no candidate of these begins."""
    n = len(starts)
    after = _successors(starts, ends)
    last = np.where(after < n, after, np.arange(n))
    while len(last) and not np.array_equal(last, last[last]):
        last = last[last]
    return ends[last]


def on_chain(starts: np.ndarray, ends: np.ndarray, entry: int | None) -> np.ndarray:
    """Which candidates lie on the chain that begins at entry; none if there is no entry."""
    n = len(starts)
    jump = np.append(_successors(starts, ends), n)  # n: nowhere
    on = np.zeros(n + 1, bool)
    if entry is not None:
        on[:n] = starts == entry
        for _ in range(max(1, n.bit_length() + 1)):
            on[jump[on]] = True
            jump = jump[jump]
    return on[:n]


def _sorted(group: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    start = np.asarray(group.column("start").combine_chunks()).astype(np.int64)
    order = np.argsort(start, kind="stable")
    return group.take(pa.array(order)), start[order], np.asarray(group.column("end").combine_chunks()).astype(np.int64)[order]


def _led(group: pa.Table) -> pa.Table:
    """A block's candidates, and where each leads to beyond them."""
    group, start, end = _sorted(group)
    return group.select(["file", "block", "start"]).append_column("exit", pa.array(exits(start, end)))


def _marked(group: pa.Table) -> pa.Table:
    """A block's candidates: which lie on the chain from the block's entry, and the last one of those up to each, if any."""
    entry = group.column("entry")[0].as_py()
    group, start, end = _sorted(group)
    on = on_chain(start, end, entry)
    owner = np.maximum.accumulate(np.where(on, start, -1)) if len(start) else start
    return group.select(["file", "block", "start"]).append_column("owner", pa.array(owner)).append_column("on", pa.array(on))


def _entries(led: DataFrame, store: Store) -> DataFrame:
    """(file, start, block, exit): the candidates by which the chain from each file's first byte enters blocks.

    Only candidates that others lead to can be entries besides the first, so a row or a few for each block are jumped over."""
    nodes = led.select("file", F.col("exit").alias("start")).unionByName(led.select("file", F.lit(0).cast("long").alias("start"))).distinct()
    nodes = store.write(led.join(nodes, ["file", "start"], "left_semi"), "nodes")
    most = nodes.groupBy("file").agg(F.countDistinct("block").alias("n")).agg(F.max("n")).first()[0] or 1
    jumps, found = nodes.select("file", "start", F.col("exit").alias("to")), nodes.where("start = 0").select("file", "start")
    for k in range((most - 1).bit_length()):
        found = store.write(found.unionByName(found.join(jumps, ["file", "start"]).select("file", F.col("to").alias("start"))).distinct(), f"found_{k}")
        far = jumps.select("file", F.col("start").alias("to"), F.col("to").alias("further"))
        jumps = store.write(jumps.join(far, ["file", "to"]).select("file", "start", F.col("further").alias("to")), f"jumps_{k}")
        store.drop(f"found_{k - 1}", f"jumps_{k - 1}")
    return store.write(nodes.join(found, ["file", "start"], "left_semi"), "entries")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record in the archives at path.

    What a response says of its payload must be true of the bytes read, or the query fails; so it does where a file's chain
    breaks off. An empty folder has no records. Pages without an id come back without one, repeated ones as often as written.
    """
    store = Store(spark, "warc-read")
    segments = spark.read.schema("value string").option("lineSep", MAGIC.decode()).text(path)
    segments = segments.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("segment"))
    found = segments.select("*", F.octet_length("segment").alias("size"))
    sized = found.select("file", "block", "segment").mapInArrow(released(_candidates), CANDIDATE)
    sized = store.write(sized, "candidates")
    # A block's bytes come to the last candidate's place and size; places in a file follow by adding up its blocks.
    totals = found.groupBy("file", "block").agg(F.sum(F.col("size") + len(MAGIC)).alias("total"))
    before = F.sum("total").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0))
    totals = totals.select("file", "block", (before - F.col("total")).alias("base"), F.sum("total").over(Window.partitionBy("file")).alias("all"))
    totals = store.write(totals.select("file", "block", "base", (F.col("all") - len(MAGIC)).alias("stop")), "totals")
    # What stands before a file's first magic begins below 0, and must be empty.
    few = totals.count() <= MOST_BROADCAST
    placed = sized.join(F.broadcast(totals) if few else totals, ["file", "block"])
    placed = placed.select("*", (F.col("base") + F.col("at") - len(MAGIC)).alias("start")).where("start >= 0")
    end = F.when(F.col("head") >= 0, F.col("start") + len(MAGIC) + F.col("head") + F.col("content") + 4).otherwise(-1)
    links = placed.select("file", "block", "start", end.alias("end"))
    led = store.write(links.groupBy("file", "block").applyInArrow(_led, "file string, block long, start long, exit long"), "led")
    entries = _entries(led, store)
    ended = totals.groupBy("file").agg(F.max("stop").alias("stop")).join(entries.groupBy("file").agg(F.max("exit").alias("exit")), "file", "left")
    if ended.where("stop > 0 AND NOT (exit <=> stop)").limit(1).count():
        raise ValueError("the chain of records breaks off before the end of its file")
    entered = entries.groupBy("file", "block").agg(F.min("start").alias("entry"))
    entered = F.broadcast(entered) if few else entered
    marked = links.join(entered, ["file", "block"], "left").groupBy("file", "block").applyInArrow(_marked, "file string, block long, start long, owner long, on boolean")
    marked = store.write(marked, "marked")
    off = marked.where("NOT on").select("file", "start")
    off = F.broadcast(off) if off.count() <= MOST_BROADCAST else off
    records = placed.join(off, ["file", "start"], "left_anti")
    broken = records.where("bytes IS NULL").select("file", F.col("start").alias("owner"), "head", "content")
    if broken.limit(1).count():  # records with magic in their payloads: join their segments again
        # Where a block begins inside a record, that is the last one of the blocks before.
        last = marked.groupBy("file", "block").agg(F.max("owner").alias("last"))
        earlier = F.max("last").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
        owned = marked.join(last.select("file", "block", earlier.alias("earlier")), ["file", "block"])
        owned = owned.select("file", "start", F.when(F.col("owner") >= 0, F.col("owner")).otherwise(F.col("earlier")).alias("owner"))
        pieces = owned.join(broken, ["file", "owner"])
        texts = segments.withColumn("line", F.monotonically_increasing_id()).select("file", "block", "line", "segment")
        texts = _with_start(texts, totals)
        whole = texts.join(pieces, ["file", "start"]).groupBy("file", "owner", "head", "content").agg(F.array_sort(F.collect_list(F.struct("start", "segment"))).alias("parts"))
        joined = F.array_join(F.transform("parts", lambda p: F.hex(p.segment)), MAGIC.hex().upper())
        body = F.substring(F.unhex(joined), F.col("head") + 1, F.col("content").cast("int"))
        is_http = F.substring(body, 1, 5) == F.lit(b"HTTP/")
        cut = F.when(is_http, F.instr(F.decode(body, "ISO-8859-1"), "\r\n\r\n") + 3).otherwise(0)
        payload = F.substring(body, cut + 1, F.octet_length(body))
        whole = whole.select("file", F.col("owner").alias("start"), F.octet_length(payload).cast("long").alias("whole_bytes"), F.sha2(payload, 256).alias("whole_digest"))
        records = records.join(whole, ["file", "start"], "left").withColumn("bytes", F.coalesce("bytes", "whole_bytes")).withColumn("digest", F.coalesce("digest", "whole_digest"))
    id_of = lambda c: F.when(c.rlike(r"^-?\d+$"), c.cast("long"))
    stated = F.regexp_replace("stated", "^sha256:", "")
    response = F.col("kind") == "response"
    true = ~response | ((F.col("digest") == stated) & (F.col("bytes") == F.col("stated_bytes")))
    checked = F.when(true, F.when(response, F.col("digest")).otherwise(stated)).otherwise(F.raise_error(F.concat(F.lit("payload digest differs in record "), F.col("page"))))
    return records.select(
        id_of(F.col("page")).alias("page_id"), F.when(response, F.col("bytes")).otherwise(F.col("stated_bytes")).alias("payload_bytes"), checked.alias("payload_digest"),
        F.col("kind").alias("record_type"), F.when(~response, id_of(F.col("refers"))).alias("refers_to"),
    )


def _with_start(texts: DataFrame, totals: DataFrame) -> DataFrame:
    """Adds to segments, numbered in order, the place of the magic before each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, at = None, 0
        for batch in batches:
            out = []
            for file, start, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), [len(x) for x in batch.column(3).to_pylist()], strict=True):
                if (file, start) != block:
                    block, at = (file, start), 0
                out.append(at)
                at += size + len(MAGIC)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array(out, pa.int64())], names=["file", "block", "segment", "at"])

    placed = texts.mapInArrow(run, "file string, block long, segment binary, at long").join(totals, ["file", "block"])
    return placed.select("file", "segment", (F.col("base") + F.col("at") - len(MAGIC)).alias("start"))


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write pages to archives in a folder of their own and read them back. See write_archives for nulls and repeated rows; an
    empty table has no records."""
    store = Store(pages.sparkSession, "warc")
    write_archives(pages, store.path("archives"))
    return read_archives(pages.sparkSession, store.path("archives"))
