"""Benchmark decontamination by a generalised suffix automaton of the benchmark's words.

The automaton recognises every run of words of every item and nothing else. A text's words are streamed through it; at each
word it knows the longest run of item words that ends there. Windows of the set number of words, and whole items that are
shorter, occur where that length reaches theirs.

Large benchmarks have several automata, each of a bounded number of words and made of flat arrays. As many as fit into a
bounded broadcast are tried side by side in one pass over a text.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import Store, bounded_batches
from .textvec import ALNUM, Words, give_back, pieces

#: Words of an automaton. It is built on the driver, where it takes about 600 bytes a word until it is made into arrays.
BLOCK_WORDS = 150_000
#: Bytes of the automata that one pass over the texts tries side by side; each Python worker holds them.
PASS_BYTES = 64 << 20


class _Builder:
    """The states of an automaton under construction: transitions, suffix links and lengths. State 0 is the start."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, run: list[int]) -> None:
        last = 0
        for word in run:
            last = self._extend(last, word)

    def _state(self, length: int, link: int, after: dict[int, int]) -> int:
        self.next.append(after)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _extend(self, last: int, word: int) -> int:
        """The state of the current item's words up to and with word."""
        known = self.next[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, word, known)
        state = self._state(self.length[last] + 1, 0, {})
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at >= 0:
            known = self.next[at][word]
            self.link[state] = known if self.length[known] == self.length[at] + 1 else self._split(at, word, known)
        return state

    def _split(self, at: int, word: int, known: int) -> int:
        """A copy of known for the shorter runs that reach it from at."""
        copy = self._state(self.length[at] + 1, self.link[known], dict(self.next[known]))
        self.link[known] = copy
        while at >= 0 and self.next[at].get(word) == known:
            self.next[at][word] = copy
            at = self.link[at]
        return copy


def _lists(owner: np.ndarray, n: int, *values: np.ndarray) -> list[array]:
    """Where each owner's values begin, and the values, which come by ascending owner."""
    begin = np.searchsorted(owner, np.arange(n + 1))
    return [array("i", x.astype(np.int32).tobytes()) for x in (begin, *values)]


class SuffixAutomaton:
    """Of items given as (id, word hashes), as flat arrays. States are numbered; 0 is the start.

    words and to have the transitions of all states, those of state s from begin[s] to begin[s + 1] by ascending word."""

    def __init__(self, items: list[tuple[str, np.ndarray]], window: int):
        self.window = window
        items = [(name, words) for name, words in items if len(words)]
        self.names = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        self.vocabulary = np.unique(np.concatenate([w for _, w in items])) if items else np.zeros(0, np.uint64)
        runs = [(number[name], np.searchsorted(self.vocabulary, w)) for name, w in items]
        built = _Builder()
        for _, run in runs:
            built.add(run.tolist())
        n = len(built.next)
        self.link, self.length = array("i", built.link), array("i", built.length)
        sizes = np.array([len(x) for x in built.next], np.int64)
        word = np.fromiter((w for x in built.next for w in x), np.int64, int(sizes.sum()))
        to = np.fromiter((t for x in built.next for t in x.values()), np.int64, int(sizes.sum()))
        del built
        state = np.repeat(np.arange(n), sizes)
        order = np.lexsort((word, state))
        self.begin, self.words, self.to = _lists(state, n, word[order], to[order])
        pairs = [run[:-1].astype(np.int64) * len(self.vocabulary) + run[1:] for _, run in runs]
        self.pairs = np.unique(np.concatenate([*pairs, np.zeros(0, np.int64)]))
        self.shortest = min([window, *(len(run) for _, run in runs)])
        self._name(runs)

    @property
    def nbytes(self) -> int:
        flat = (self.link, self.length, self.begin, self.words, self.to, self.window_state, self.up_short, *self.items, *self.short)
        return sum(4 * len(x) for x in flat) + self.vocabulary.nbytes + self.pairs.nbytes + sum(50 + len(x) for x in self.names)

    def _after(self, state: int, word: int) -> int:
        """The state to which word leads, or -1."""
        end = self.begin[state + 1]
        at = bisect_left(self.words, word, self.begin[state], end)
        return self.to[at] if at < end and self.words[at] == word else -1

    def _name(self, runs: list[tuple[int, np.ndarray]]) -> None:
        """Items by window state, short items by state, and for each state its next one with short items."""
        n, window = len(self.link), self.window
        by_length = np.argsort(np.array(self.length), kind="stable").tolist()[1:]
        own = array("i", [-1]) * n
        for s in by_length:
            if self.length[s] >= window:
                own[s] = s if self.length[self.link[s]] < window else own[self.link[s]]
        self.window_state = own
        found: list[array] = [array("q"), array("q")]
        short: set[tuple[int, int, int]] = set()
        for name, run in runs:
            state = 0
            for k, word in enumerate(run.tolist(), 1):
                state = self._after(state, word)
                if k >= window:
                    found[0].append(own[state])
                    found[1].append(name)
            if len(run) < window:
                short.add((state, len(run), name))
        both = np.unique(np.array(found, np.int64).T.reshape(-1, 2), axis=0)
        self.items = _lists(both[:, 0], n, both[:, 1])
        several = np.array(sorted(short), np.int64).reshape(-1, 3)
        self.short = _lists(several[:, 0], n, several[:, 1], several[:, 2])
        self.up_short = array("i", [-1]) * n
        if short:
            begin = self.short[0]
            for s in by_length:
                above = self.link[s]
                self.up_short[s] = above if begin[above + 1] > begin[above] else self.up_short[above]

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words, -1 for those that no item has."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def stretches(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """(from, to) of the longest stretches of words in which all neighbours are neighbours in some item: no match
        goes beyond one. Those too short for any match are left out."""
        known = ids >= 0
        joined = known[1:] & known[:-1]
        inner = first[1:-1]
        joined[inner[(inner > 0) & (inner < len(ids))] - 1] = False
        where = np.flatnonzero(joined)
        code = ids[where] * len(self.vocabulary) + ids[where + 1]
        at = np.searchsorted(self.pairs, code)
        ok = at < len(self.pairs)
        ok[ok] = self.pairs[at[ok]] == code[ok]
        joined[where[~ok]] = False
        begins = known & ~np.concatenate([[False], joined])
        ends = known & ~np.concatenate([joined, [False]])
        out = np.stack([np.flatnonzero(begins), np.flatnonzero(ends) + 1], 1)
        return out[out[:, 1] - out[:, 0] >= self.shortest]

    def matches(self, words: list[int], base: int) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans of words, from base on, that windows or short items cover, and the items they are of."""
        step, link, length, window = self._after, self.link, self.length, self.window
        (from_item, item), (from_short, short_size, short_item) = self.items, self.short
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        state = long = 0
        for end, word in enumerate(words, base + 1):
            after = step(state, word)
            while after < 0 and state:
                state = link[state]
                long = length[state]
                after = step(state, word)
            if after < 0:
                long = 0
                continue
            state, long = after, long + 1
            if long >= window:
                own = self.window_state[state]
                items.update(item[from_item[own] : from_item[own + 1]])
                if spans and spans[-1][1] >= end - long:
                    spans[-1] = (min(spans[-1][0], end - long), end)
                else:
                    spans.append((end - long, end))
            if len(short_item):
                at = state if from_short[state + 1] > from_short[state] else self.up_short[state]
                while at > 0:
                    for k in range(from_short[at], from_short[at + 1]):
                        if short_size[k] <= long:
                            items.add(short_item[k])
                            spans.append((end - short_size[k], end))
                    at = self.up_short[at]
        return spans, {self.names[i] for i in items}


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint spans, ascending, that cover the same."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def word_hashes(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return Words(data, np.array([0, len(data)]), ALNUM).hashes


def automata(items: Iterable[tuple[str, str]], window: int) -> Iterator[SuffixAutomaton]:
    """Automata of items (id, text), each of BLOCK_WORDS words at most. A longer item becomes several that overlap by all but
    one word of a window, so each of its windows is in one of them."""
    held: list[tuple[str, np.ndarray]] = []
    size = 0
    for name, text in items:
        hashes = word_hashes(text)
        most = max(BLOCK_WORDS, 2 * window)
        for at in range(0, max(1, len(hashes) - window + 1), most - window + 1):
            part = hashes[at : at + most]
            if held and size + len(part) > BLOCK_WORDS:
                yield SuffixAutomaton(held, window)
                held, size = [], 0
            held.append((name, part))
            size += len(part)
    if held:
        yield SuffixAutomaton(held, window)


def _passes(items: Iterable[tuple[str, str]], window: int) -> Iterator[list[SuffixAutomaton]]:
    """Automata of one pass each: so many as have PASS_BYTES at most, or one."""
    held: list[SuffixAutomaton] = []
    for one in automata(items, window):
        if held and sum(a.nbytes for a in held) + one.nbytes > PASS_BYTES:
            yield held
            held = []
        held.append(one)
    yield held


FOUND = "n_words long, spans array<long>, cuts array<long>, items array<string>"
_FOUND = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.int64())), ("cuts", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])


def _found(texts: pa.Array, before: list, several: list[SuffixAutomaton]) -> pa.Array:
    """What the automata find in each text, besides what is in before: spans of words and of bytes, as from, to, from, to,
    and items."""
    out = []
    for lo, hi, data, offsets in pieces(texts):
        words = Words(data, offsets, ALNUM)
        count = np.diff(words.first)
        spans: dict[int, list[tuple[int, int]]] = {}
        items: dict[int, set[str]] = {}
        for a in several if len(words) else []:
            ids = a.ids(words.hashes)
            stretches = a.stretches(ids, words.first)
            of = np.searchsorted(words.first, stretches[:, 0], side="right") - 1
            for (x, y), t in zip(stretches.tolist(), of.tolist(), strict=True):
                found, names = a.matches(ids[x:y].tolist(), x)
                if found:
                    spans.setdefault(t, []).extend(found)
                    items.setdefault(t, set()).update(names)
        for t in range(hi - lo):
            begin, old = int(words.first[t]), before[lo + t] if before else None
            mine = [(x - begin, y - begin) for x, y in spans.get(t, [])]
            if old:
                mine += list(zip(old["spans"][::2], old["spans"][1::2], strict=True))
                items.setdefault(t, set()).update(old["items"])
            mine = union(mine)
            cuts = [z for x, y in mine for z in (int(words.starts[begin + x] - offsets[t]), int(words.ends[begin + y - 1] - offsets[t]))]
            out.append({"n_words": int(count[t]), "spans": [z for x in mine for z in x], "cuts": cuts, "items": sorted(items.get(t, ()))})
    return pa.array(out, _FOUND)


def _first_scan(shared) -> Callable:  # noqa: ANN001
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for texts in batches:
                yield _found(texts, [], shared.value)
        finally:
            give_back()

    return F.arrow_udf(run, FOUND).asNondeterministic()  # else a filter on what is found would scan again


def _next_scan(shared) -> Callable:  # noqa: ANN001
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        try:
            for texts, before in batches:
                yield _found(texts, before.to_pylist(), shared.value)
        finally:
            give_back()

    return F.arrow_udf(run, FOUND).asNondeterministic()


def _items(spark: SparkSession, benchmark: DataFrame) -> Iterator[tuple[str, str]]:
    """Items by id, a partition at a time."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    for r in items.distinct().toLocalIterator():
        yield r.item_id, r.text


def find_items(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text") -> DataFrame:
    """(row, found) for every row of docs: the row as it came, and the words, spans, byte cuts and items found in its text.

    Null texts have no words. Items without words are left out; items with the same id count as one item with several
    texts; a null item id is the item "". Names of other columns don't matter: they stay inside row, which no Python sees.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    text = F.col("text")
    out = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs[text_col].cast("string").alias("text"))
    store = Store(spark, "decontaminate")
    for k, several in enumerate(_passes(_items(spark, benchmark), window)):
        shared = spark.sparkContext.broadcast(several)
        if k == 0:
            out = out.select("row", "text", _first_scan(shared)(text).alias("found"))
        else:  # one scan a stage
            out = store.write(out, f"to_{k}").select("row", "text", _next_scan(shared)(text, F.col("found")).alias("found"))
            store.drop(f"to_{k - 1}")
    return out.select("row", "found")


def _covered(spans: str) -> Column:
    """How many words spans cover."""
    return F.aggregate(F.transform(spans, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0).cast("long"), lambda a, x: a + x)


def hits(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every row, which may repeat ids and texts.

    Null and empty texts have no words, a null id stays null; an empty benchmark contaminates nothing."""
    found = find_items(docs.select("doc_id", "text"), benchmark, window)
    covered = _covered("found.spans")
    return found.select(
        F.col("row.doc_id").alias("doc_id"), F.col("found.n_words").alias("n_words"), covered.alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"), F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"), (covered > 0).alias("contaminated"),
    )


def _without(text: Column, cuts: Column) -> Column:
    """text without the bytes that cuts name, as from, to, from, to."""
    data = F.encode(text, "utf-8")
    edges = F.concat(F.array(F.lit(0).cast("long")), cuts, F.array(F.octet_length(text).cast("long")))
    kept = F.filter(F.transform(edges, lambda a, i: F.struct(i.alias("i"), a.alias("a"), F.get(edges, i + 1).alias("b"))), lambda s: s.i % 2 == 0)
    joined = F.aggregate(kept, F.lit(b""), lambda out, s: F.concat(out, F.substring(data, (s.a + 1).cast("int"), (s.b - s.a).cast("int"))))
    return F.decode(joined, "utf-8")


def remove_items(docs: DataFrame, benchmark: DataFrame, window: int = 10, longest: int = 0, most_covered: float = 0.5) -> DataFrame:
    """docs without the spans of more than `longest` words that items cover, and without the rows of which items cover
    more than the share `most_covered`. Clean rows stay as they are; n_chars, if there is one, follows the text.

    Null and empty texts are clean, rows that repeat are treated alike, and empty tables change nothing."""
    found = find_items(docs, benchmark, window)
    pairs = F.filter(F.transform("found.spans", lambda x, i: F.struct(i.alias("i"), x.alias("a"), F.get("found.spans", i + 1).alias("b"))), lambda s: s.i % 2 == 0)
    kept = found.where((F.col("found.n_words") == 0) | (_covered("found.spans") <= most_covered * F.col("found.n_words")))
    long = F.filter(pairs, lambda s: s.b - s.a > longest)
    cuts = F.flatten(F.transform(long, lambda s: F.array(F.get("found.cuts", s.i), F.get("found.cuts", s.i + 1))))
    cut = kept.select("row", cuts.alias("cuts"))
    text = F.col("row.text")
    own = {c: F.col(f"row.`{c}`") for c in docs.columns}
    own["text"] = F.when(F.size("cuts") > 0, _without(text.cast("string"), F.col("cuts"))).otherwise(text)
    out = cut.select(*[x.alias(c) for c, x in own.items()])
    if "n_chars" in own:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return out
