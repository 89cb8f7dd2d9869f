"""N-gram Jaccard join by count vectors: group tokens, index group counts, bound overlaps by minima, verify survivors.

The tokens are a text's distinct word shingles. Three facts make the join exact and keep it from comparing all pairs:

1. Texts with equal sets are one class; only classes are compared.
2. Let sizes be a and b and d the most tokens that linked sets can differ in. Hash tokens into runs, and each run's tokens
   into groups. Group counts of at most d runs differ, so among the first d + 1 runs one has equal counts; that run's
   counts, hashed, are a key that linked classes share. Sizes fall into bands, and runs are as many as the band's
   largest size asks for; a class also takes part in the band above if a partner may be there. Runs may be empty in both
   sets. Some runs beyond d + 1 are taken, and a class with more empty runs than that goes on to another layout of runs.
3. Classes that share a key are points whose coordinates are counts in groups over the whole set: about as many as tokens,
   as the bound gets weaker with tokens to a group; groups add up to fewer. The sum of the smaller coordinates bounds the
   overlap of two points. An R-tree over coarse coordinates bounds that of all points in two nodes by their largest ones;
   pairs that survive it are bounded by fine coordinates, which rule out nearly all that aren't linked.

Pairs that survive are verified on the full sets. A key's classes are first tried against its smallest one. Then only classes
of different components are compared, in blocks of bounded size: first the nearest pair of each two components, which joins
most of those that belong together, and at last all that are left. So a key that many share doesn't emit its pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .store import Store
from .textvec import NOT_SPACE, U64, Words, distinct_by_text, mix, pieces, ragged, released, shingle_hashes

#: Groups inside a run: so many that unrelated runs hardly ever have equal counts.
INNER = 1 << 32
#: Layouts of runs, the next for classes that have too many empty runs in all before.
LAYOUTS = 8
#: A key's classes are compared in blocks of about so many.
BLOCK = 2048
#: Least and most coordinates of a point; nodes of a tree have the least.
COARSE, FINEST = 64, 1 << 16
#: Coordinates that are compared at once, and that the points of a key's blocks have together.
AT_ONCE, TOGETHER = 1_000_000, 4_000_000
#: Rounds that try the nearest pair of every two components, before all pairs that are left.
NEAREST = 2
#: Up to so many ids (8 bytes each) may be broadcast.
MOST_BROADCAST = 4_000_000


@dataclass(frozen=True)
class Measure:
    """Sets are linked when den * overlap >= num * union; shingles are of width words."""

    width: int = 3
    num: int = 90
    den: int = 100
    seed: int = 0

    def differ(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The most tokens in which linked sets of these sizes differ."""
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def needed(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The least overlap of linked sets of these sizes."""
        return -(-(a + b) * self.num // (self.den + self.num))

    def edges(self, most: int) -> np.ndarray:
        """Upper sizes of the bands up to one that holds most."""
        out = [4]
        while out[-1] < most:
            out.append(max(out[-1] + 1, out[-1] * 3 // 2))
        return np.array(out, np.int64)


def _sets(column: pa.Array, m: Measure) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows lo to hi, their distinct shingles, the row of each, and the number of each row."""
    for lo, hi, data, offsets in pieces(column):
        words = Words(data, offsets, NOT_SPACE)
        tokens, of = distinct_by_text(*shingle_hashes(words.hashes, words.first, m.width), hi - lo)
        yield lo, hi, tokens, of, np.bincount(of, minlength=hi - lo)


def _sums(tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of hashes by row, modulo 2 to the 64."""
    total = np.concatenate([np.zeros(1, U64), np.cumsum(tokens, dtype=U64)])
    return total[starts[1:]] - total[starts[:-1]]


def class_ids(tokens: np.ndarray, sizes: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that stand for a set: two sums of differently mixed tokens."""
    starts = np.concatenate([[0], np.cumsum(sizes)])
    one = _sums(mix(tokens ^ U64(0x5851F42D4C957F2D + seed)), starts)
    two = _sums(mix(tokens + U64(0x14057B7EF767814F + seed)), starts)
    return mix(one + sizes.astype(U64)).view(np.int64), mix(two ^ (sizes.astype(U64) << U64(32))).view(np.int64)


def node_ids(one: np.ndarray, two: np.ndarray, renamed: dict[tuple[int, int], int]) -> np.ndarray:
    """64 bits for each class: the first half of its id, but for classes that share that half with another."""
    if renamed:
        out = one.copy()
        for i in np.flatnonzero(np.isin(one, [x for x, _ in renamed])).tolist():
            out[i] = renamed[int(one[i]), int(two[i])]
        return out
    return one


def groups_of(sizes: np.ndarray) -> np.ndarray:
    """Coordinates of sets of these sizes: the power of two that is no less, from COARSE to FINEST."""
    return np.clip(1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64), COARSE, FINEST)


def packed(counts: np.ndarray) -> bytes:
    """Counts as a point: the bytes of a count, and the counts in so many bytes each."""
    wide = 1 if counts.max(initial=0) < 256 else 2
    return bytes([wide]) + counts.astype(f"<u{wide}").tobytes()


def coordinates(points: list[bytes]) -> np.ndarray:
    """How many coordinates each point has."""
    return np.array([(len(x) - 1) // x[0] for x in points], np.int64)


def points_matrix(points: list[bytes], groups: int) -> np.ndarray:
    """Points with so many coordinates; those of more are added up."""
    out = np.zeros((len(points), groups), np.int32)
    lengths, wide = coordinates(points), np.array([x[0] for x in points], np.int64)
    for n, w in sorted(set(zip(lengths.tolist(), wide.tolist(), strict=True))):
        at = np.flatnonzero((lengths == n) & (wide == w))
        rows = np.frombuffer(b"".join([points[i][1:] for i in at.tolist()]), f"<u{w}").reshape(len(at), n // groups, groups)
        out[at] = rows.sum(1)
    return out


def coarser(points: np.ndarray, groups: int) -> np.ndarray:
    return points.reshape(len(points), points.shape[1] // groups, groups).sum(1)


def _profile(m: Measure) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, tokens, of, sizes in _sets(batch.column(1), m):
                one, two = class_ids(tokens, sizes, m.seed)
                groups = groups_of(sizes)
                place = np.cumsum(groups) - groups
                at = place[of] + (mix(tokens + U64(77)) % groups[of].astype(U64)).astype(np.int64)
                counts = np.bincount(at, minlength=int(groups.sum()))
                points = pa.array([packed(counts[a : a + n]) for a, n in zip(place.tolist(), groups.tolist(), strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(sizes, pa.int64()), pa.array(one), pa.array(two), points], names=["doc_id", "n", "cid", "cid2", "point"])

    return run


def signatures(tokens: np.ndarray, of: np.ndarray, sizes: np.ndarray, m: Measure) -> tuple[np.ndarray, np.ndarray]:
    """Keys and the row of each: rows that are linked, and differ, share one.

    Of the runs that linked rows take in a band, more than `spare` are equal. If one of the two has no more empty runs than
    that, an equal run is filled, and a key of both. If neither has, both go on to the next layout; only the last one, which
    hardly any row comes to, has keys of empty runs, which don't depend on what rows hold."""
    edges = m.edges(int(sizes.max(initial=1)) * m.den // m.num + 1)
    band, top = np.searchsorted(edges, sizes), np.searchsorted(edges, sizes * m.den // m.num)
    keys, rows = [], []
    for up in range(int((top - band).max(initial=0)) + 1):
        mine = (band + up <= top) & (sizes > 0)
        upper = edges[np.minimum(band + up, len(edges) - 1)]
        differ = m.differ(sizes, np.minimum(upper, sizes * m.den // m.num))
        mine &= differ > 0  # else only equal sets are linked
        most = m.differ(upper, upper)
        spare = 3 + most // 16
        runs, taken = most + 1 + spare, differ + 1 + spare
        for layout in range(LAYOUTS):
            if not mine.any():
                break
            held = np.repeat(mine, sizes)
            who, t = of[held], tokens[held]
            run = (mix(t ^ U64(0xD6E8FEB86659FD93 + layout)) % runs[who].astype(U64)).astype(np.int64)
            used = run < taken[who]
            who, run, t = who[used], run[used], t[used]
            group = mix(t + U64(0xA0761D6478BD642F)) % U64(INNER)
            place = np.cumsum(np.where(mine, taken, 0)) - np.where(mine, taken, 0)
            total = int(np.where(mine, taken, 0).sum())
            at, value = place[who] + run, mix((run.astype(U64) << U64(40)) + group + U64(1))
            low = np.bincount(at, (value & U64(0xFFFFFFFF)).astype(np.float64), total).astype(np.int64)
            high = np.bincount(at, (value >> U64(32)).astype(np.float64), total).astype(np.int64)
            owner = np.repeat(np.flatnonzero(mine), taken[mine])
            number = np.arange(total) - place[owner]
            empty = np.bincount(at, minlength=total) == 0
            none = np.bincount(owner[empty], minlength=len(sizes))
            mine = mine & (none > spare)
            keep = ~empty
            if layout == LAYOUTS - 1:
                keep |= mine[owner]
            label = mix((upper[owner].astype(U64) * U64(LAYOUTS) + U64(layout)) * U64(1 << 24) + number.astype(U64))
            keys.append(mix(mix(low.astype(U64) + label) ^ (high.astype(U64) * U64(0x9E3779B97F4A7C15)))[keep])
            rows.append(owner[keep])
    return (np.concatenate(keys) if keys else np.zeros(0, U64)), (np.concatenate(rows) if rows else np.zeros(0, np.int64))


def _keys(m: Measure, renamed: dict[tuple[int, int], int], remembered: int = 200_000) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies that this task has met before need no keys; their first has them
        for batch in batches:
            for _, _, tokens, of, sizes in _sets(batch.column(0), m):
                one = node_ids(*class_ids(tokens, sizes, m.seed), renamed)
                fresh = np.zeros(len(one), bool)
                for i, c in enumerate(one.tolist()):
                    if c not in seen:
                        fresh[i] = True
                        if len(seen) >= remembered:
                            seen.clear()
                        seen.add(c)
                held = np.repeat(fresh, sizes)
                key, row = signatures(tokens[held], of[held], np.where(fresh, sizes, 0), m)
                for i in range(0, len(key), 200_000):
                    yield pa.RecordBatch.from_arrays([pa.array(key[i : i + 200_000].view(np.int64)), pa.array(one[row[i : i + 200_000]])], names=["key", "cid"])

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and class in; those of keys with two classes or more out, with the key's smallest class."""
    last_key = last_cid = lead = None
    led = False  # whether the last key's smallest class is out already
    for batch in batches:
        key, cid = (np.asarray(batch.column(i)) for i in (0, 1))
        if not len(key):
            continue
        new_key = np.concatenate([[last_key is None or key[0] != last_key], key[1:] != key[:-1]])
        fresh = new_key | np.concatenate([[cid[0] != last_cid], cid[1:] != cid[:-1]])
        key, cid, new_key = key[fresh], cid[fresh], new_key[fresh]
        if not len(key):
            continue
        heads = np.flatnonzero(new_key)
        group = np.cumsum(new_key) - 1  # -1: the last batch's key goes on
        leads = cid[heads][np.maximum(group, 0)] if len(heads) else np.zeros(len(cid), np.int64)
        leads = np.where(group < 0, lead if lead is not None else 0, leads)
        member = ~new_key
        out = [(key[member], cid[member], leads[member])]
        many = np.bincount(group[group >= 0], minlength=len(heads)) > 1
        out.append((key[heads[many]], cid[heads[many]], cid[heads[many]]))
        if group[0] < 0 and not led:
            out.append((key[:1], np.array([lead]), np.array([lead])))
            led = True
        if len(heads):
            last_key, lead, led = key[-1], cid[heads[-1]], bool(many[-1])
        last_cid = cid[-1]
        columns = [np.concatenate(x).astype(np.int64) for x in zip(*out, strict=True)]
        if len(columns[0]):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["key", "cid", "lead"])


def _bounded(m: Measure) -> Callable:
    """Keeps the pairs whose summed minima reach the overlap that their sizes need."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(i).to_pylist() for i in (2, 3))
            groups = np.minimum(coordinates(a), coordinates(b))
            ok = np.zeros(len(groups), bool)
            for n in np.unique(groups).tolist():
                at = np.flatnonzero(groups == n)
                for s in range(0, len(at), 1 + AT_ONCE // n):
                    part = at[s : s + 1 + AT_ONCE // n]
                    x, y = (points_matrix([z[i] for i in part.tolist()], n) for z in (a, b))
                    ok[part] = np.minimum(x, y).sum(1) >= m.needed(x.sum(1), y.sum(1))
            if len(groups):
                yield pa.RecordBatch.from_arrays([x.filter(pa.array(ok)) for x in batch.columns[:2]], names=["a", "b"])

    return run


class CountTree:
    """A packed R-tree over count vectors. Nodes have their largest coordinates, and the ranges of sizes and components.

    Points of one component lie together, so that pairs within it, which needn't be looked at, are left out as whole nodes.
    """

    def __init__(self, points: np.ndarray, comp: np.ndarray, fan: int = 8):
        of = np.unique(comp, return_inverse=True)[1]
        large = np.bincount(of, minlength=1) >= 4 * fan
        groups = [np.flatnonzero(of == c) for c in np.flatnonzero(large)] + [np.flatnonzero(~large[of])]
        self.order = np.concatenate([x for at in groups if len(at) for x in self._pack(points, at, fan)]) if len(points) else np.zeros(0, np.int64)
        self.points, self.comp = points[self.order].astype(np.int32), comp[self.order]
        size = self.points.sum(1)
        self.levels, self.fan = [(self.points, size, size, self.comp, self.comp)], fan
        while len(self.levels[-1][0]) > fan:
            at = np.arange(0, len(self.levels[-1][0]), fan)
            high, *ranges = self.levels[-1]
            ends = [f.reduceat(x, at) for f, x in zip((np.minimum, np.maximum, np.minimum, np.maximum), ranges, strict=True)]
            self.levels.append((np.maximum.reduceat(high, at), *ends))

    @staticmethod
    def _pack(points: np.ndarray, at: np.ndarray, fan: int) -> list[np.ndarray]:
        """Tile by size first, then halve along the coordinate that varies most."""
        out, todo = [], [at]
        while todo:
            part = todo.pop()
            if len(part) <= fan:
                out.append(part)
                continue
            value = points[part].sum(1) if len(part) > 64 * fan else points[part][:, int(points[part].var(0).argmax())]
            part = part[np.argsort(value, kind="stable")]
            half = (len(part) // 2 + fan - 1) // fan * fan
            todo += [part[half:], part[:half]]
        return out

    def join(self, other: CountTree, m: Measure) -> tuple[np.ndarray, np.ndarray]:
        """Indexes of the points, here and there, that are of different components and may be linked."""
        depth, step = max(len(self.levels), len(other.levels)) - 1, 1 + AT_ONCE // self.points.shape[1]
        i, j = (x.ravel() for x in np.meshgrid(*(np.arange(len(t.levels[-1][0])) for t in (self, other)), indexing="ij"))
        for level in range(depth, -1, -1):
            (ha, la, ma, ca, da), (hb, lb, mb, cb, db) = (t.levels[min(level, len(t.levels) - 1)] for t in (self, other))
            found = [(i[:0], j[:0])]
            for s in range(0, len(i), step):
                x, y = i[s : s + step], j[s : s + step]
                near = (ma[x] * m.den >= lb[y] * m.num) & (mb[y] * m.den >= la[x] * m.num)
                near &= (ca[x] != da[x]) | (cb[y] != db[y]) | (ca[x] != cb[y])
                x, y = x[near], y[near]
                ok = np.minimum(ha[x], hb[y]).sum(1) >= m.needed(la[x], lb[y])
                found.append((x[ok], y[ok]))
            i, j = (np.concatenate(z) for z in zip(*found, strict=True))
            if level:
                i, j = self._opened(i, j, level, other)
        return self.order[i], other.order[j]

    def _opened(self, i: np.ndarray, j: np.ndarray, level: int, other: CountTree) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of children of the paired nodes. A tree that doesn't reach up to this level stays at its top."""

        def children(k: np.ndarray, t: CountTree) -> tuple[np.ndarray, np.ndarray]:
            if level >= len(t.levels):
                return k[:, None], np.ones((len(k), 1), bool)
            out = k[:, None] * t.fan + np.arange(t.fan)
            return out, out < len(t.levels[level - 1][0])

        (a, good_a), (b, good_b) = children(i, self), children(j, other)
        good = good_a[:, :, None] & good_b[:, None, :]
        return np.broadcast_to(a[:, :, None], good.shape)[good], np.broadcast_to(b[:, None, :], good.shape)[good]


def _inside(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows i < j of small groups."""
    at = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    rows = np.repeat(starts + sizes, sizes) - at - 1
    i = np.repeat(at, rows)
    return i, i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(rows) - rows, rows)


def _across(m: Measure, nearest: bool, leaf: int = 16) -> Callable:
    """Rows sorted by key and block pair in. Out: pairs of classes of different components that no bound rules out.

    Groups of a leaf's size need no tree. Coarse coordinates come first, then all. nearest: of each two components, only the
    pair with most overlap to spare."""

    def overlaps(points: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        step = 1 + AT_ONCE // points.shape[1]
        return np.concatenate([np.zeros(0, np.int64), *(np.minimum(points[i[s : s + step]], points[j[s : s + step]]).sum(1) for s in range(0, len(i), step))])

    def pairs(cid: np.ndarray, comp: np.ndarray, block: np.ndarray, low: np.ndarray, high: np.ndarray, points: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
        sizes = np.diff(starts)
        small = sizes <= leaf
        i, j = _inside(starts[:-1][small], sizes[small])
        ok = (comp[i] != comp[j]) & ((low[i] == high[i]) | (block[i] != block[j]))
        i, j = i[ok], j[ok]
        total, rough = points.sum(1), coarser(points, COARSE)
        ok = overlaps(rough, i, j) >= m.needed(total[i], total[j])
        found = [(i[ok], j[ok])]
        for g in np.flatnonzero(~small):
            own = np.arange(starts[g], starts[g + 1])
            a, b = own[block[own] == low[own]], own[block[own] == high[own]]
            one = CountTree(rough[a], comp[a])
            x, y = one.join(one if low[own[0]] == high[own[0]] else CountTree(rough[b], comp[b]), m)
            found.append((a[x], b[y]))
        i, j = (np.concatenate(z) for z in zip(*found, strict=True))
        ok = overlaps(points, i, j) >= m.needed(total[i], total[j])
        i, j = i[ok], j[ok]
        swap = comp[i] > comp[j]
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        if nearest and len(i):
            spare = overlaps(points, i, j) - m.needed(total[i], total[j])
            order = np.lexsort((-spare, comp[j], comp[i]))
            i, j = i[order], j[order]
            first = np.concatenate([[True], (comp[i][1:] != comp[i][:-1]) | (comp[j][1:] != comp[j][:-1])])
            i, j = i[first], j[first]
        both = np.unique(np.stack([np.minimum(cid[i], cid[j]), np.maximum(cid[i], cid[j])], 1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

    def by_size(columns: list[np.ndarray], points: list[bytes], starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Groups of rows with as many coordinates as their row with the fewest, all with as many at once. Very many rows have
        fewer, so that they take a bounded room."""
        _, low, high, block, cid, comp = columns
        fewest = np.minimum.reduceat(coordinates(points), starts[:-1])
        room = 1 << np.floor(np.log2(np.maximum(TOGETHER // np.diff(starts), 1))).astype(np.int64)
        fewest = np.maximum(COARSE, np.minimum(fewest, room))
        for n in np.unique(fewest).tolist():
            chosen = fewest == n
            sizes = np.diff(starts)[chosen]
            rows = np.flatnonzero(np.repeat(chosen, np.diff(starts)))
            matrix = points_matrix([points[i] for i in rows.tolist()], n)
            yield pairs(cid[rows], comp[rows], block[rows], low[rows], high[rows], matrix, np.concatenate([[0], np.cumsum(sizes)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # the rows of the last group, which may go on
        held_points: list[bytes] = []
        for batch in batches:
            columns = [np.asarray(batch.column(c)) for c in ("key", "low", "high", "block", "cid", "comp")]
            points = held_points + batch.column("point").to_pylist()
            if held:
                columns = [np.concatenate(x) for x in zip(held, columns, strict=True)]
            key, low, high = columns[:3]
            if not len(key):
                continue
            new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])]))
            if new[-1]:
                yield from by_size([x[: new[-1]] for x in columns], points[: new[-1]], new)
            held, held_points = [x[new[-1] :].copy() for x in columns], points[new[-1] :]
        if held:
            yield from by_size(held, held_points, np.array([0, len(held_points)]))

    return run


def _token_sets(m: Measure, renamed: dict[tuple[int, int], int]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, tokens, _, sizes in _sets(batch.column(0), m):
                one = node_ids(*class_ids(tokens, sizes, m.seed), renamed)
                yield pa.RecordBatch.from_arrays([pa.array(one), ragged(tokens.view(np.int64), sizes, pa.int64())], names=["cid", "tokens"])

    return run


def _verified(pairs: DataFrame, sets: DataFrame, m: Measure) -> DataFrame:
    """The distinct pairs whose sets are linked, by their exact overlap."""
    left = pairs.join(sets.select(F.col("cid").alias("a"), F.col("tokens").alias("ta")), "a")
    both = left.join(sets.select(F.col("cid").alias("b"), F.col("tokens").alias("tb")), "b")
    overlap = F.size(F.array_intersect("ta", "tb"))
    both = both.select("a", "b", overlap.alias("common"), (F.size("ta") + F.size("tb")).alias("total"))
    return both.where(F.col("common") * m.den >= (F.col("total") - F.col("common")) * m.num).select("a", "b").distinct()


class _Join:
    """The tables of one join, and its steps."""

    def __init__(self, docs: DataFrame, classes: DataFrame, m: Measure, store: Store, renamed: dict[tuple[int, int], int] | None = None):
        self.docs, self.classes, self.m, self.store, self.renamed = docs, classes, m, store, renamed or {}

    def find_shared(self) -> None:
        keys = self.docs.where("doc_id IS NOT NULL").select("text").mapInArrow(released(_keys(self.m, self.renamed)), "key long, cid long")
        keys = keys.repartition("key").sortWithinPartitions("key", "cid")
        self.shared = self.store.write(keys.mapInArrow(released(_shared), "key long, cid long, lead long"), "shared")

    def stars(self) -> DataFrame:
        """Each key's smallest class with the others."""
        pairs = self.shared.where("cid <> lead").select(F.col("lead").alias("a"), F.col("cid").alias("b")).distinct()
        points = self.classes.select("cid", "point")
        pairs = pairs.join(points.select(F.col("cid").alias("a"), F.col("point").alias("pa")), "a")
        pairs = pairs.join(points.select(F.col("cid").alias("b"), F.col("point").alias("pb")), "b")
        return pairs.select("a", "b", "pa", "pb").mapInArrow(released(_bounded(self.m)), "a long, b long")

    def across(self, roots: DataFrame, nearest: bool, name: str) -> DataFrame:
        """Pairs of different components that share a key and that the tree can't rule out."""
        comp = self.shared.select("key", "cid").join(roots.select(F.col("node").alias("cid"), "root"), "cid", "left")
        comp = comp.select("key", "cid", F.coalesce("root", "cid").alias("comp"))
        several = comp.groupBy("key").agg(F.min("comp").alias("one"), F.max("comp").alias("two"), F.count("*").alias("members")).where("one <> two")
        # A written table, so that adaptive execution can split the join's large keys.
        several = self.store.write(several.select("key", F.ceil(F.col("members") / BLOCK).alias("blocks")), f"several_{name}")
        left = comp.join(several, "key")
        left = left.withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")))
        left = left.withColumn("beside", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        left = left.select("key", F.least("block", "beside").alias("low"), F.greatest("block", "beside").alias("high"), "block", "cid", "comp")
        left = left.join(self.classes.select("cid", "point"), "cid").repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
        return left.mapInArrow(released(_across(self.m, nearest)), "a long, b long").distinct()

    def verify(self, pairs: DataFrame, name: str) -> DataFrame:
        """The links among pairs. Only the texts that are in them are taken apart again."""
        pairs = self.store.write(pairs, f"pairs_{name}")
        members = self.store.write(pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct(), f"members_{name}")
        wanted = members.join(self.classes.select("cid", "rep"), "cid").select(F.col("rep").alias("doc_id")).distinct()
        few = members.count() <= MOST_BROADCAST
        chosen = self.docs.join(F.broadcast(wanted) if few else wanted, "doc_id", "left_semi")
        sets = chosen.select("text").mapInArrow(released(_token_sets(self.m, self.renamed)), "cid long, tokens array<long>")
        sets = self.store.write(sets.join(F.broadcast(members) if few else members, "cid", "left_semi"), f"sets_{name}")
        links = self.store.write(_verified(pairs, sets, self.m), f"links_{name}")
        self.store.drop(f"pairs_{name}", f"members_{name}", f"sets_{name}")
        return links

    def join(self, roots: DataFrame, links: DataFrame, name: str) -> DataFrame:
        edges = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(links)
        return components(edges, self.store, name)


def _renamed(classes: DataFrame) -> dict[tuple[int, int], int]:
    """Node ids of the classes that share the first half of their id with another class, few even among very many classes:
    about half their number squared, divided by 2 to the 64."""
    clashing = classes.groupBy("cid").count().where("count > 1").select("cid")
    if not clashing.limit(1).count():
        return {}
    found = classes.select("cid", "cid2").join(clashing, "cid").orderBy("cid", "cid2").collect()
    for k in range(1, 100):
        one, two = (np.array([r[i] for r in found], np.int64).view(U64) for i in (0, 1))
        new = mix(one ^ mix(two + U64(k))).view(np.int64).tolist()
        taken = classes.sparkSession.createDataFrame([(x,) for x in new], "cid long")
        if len(set(new)) == len(new) and not classes.join(F.broadcast(taken), "cid", "left_semi").limit(1).count():
            return {(r.cid, r.cid2): x for r, x in zip(found, new, strict=True)}
    raise RuntimeError("class ids can't be told apart")


def near_duplicates(docs: DataFrame, m: Measure, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Component of every row under links of its text's shingle set.

    Returns (doc_id, n_shingles, component_id), a row for each row of docs. component_id is the smallest id reachable by
    links. Null and empty texts have no shingles and link with nothing. Rows that share an id are one document, linked by
    any of its texts. A null id belongs to no component: its component_id is null. Other columns are not looked at.
    """
    spark = docs.sparkSession
    store = Store(spark, "ngram-join")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    profile = store.write(docs.mapInArrow(released(_profile(m)), "doc_id long, n long, cid long, cid2 long, point binary"), "profile")
    known = profile.where("doc_id IS NOT NULL AND n > 0")
    classes = known.groupBy("cid", "cid2").agg(F.min("doc_id").alias("rep"), F.first("point").alias("point"))
    full = store.write(classes, "full")
    renamed = _renamed(full)
    if renamed:
        others = spark.createDataFrame([(*k, v) for k, v in renamed.items()], "cid long, cid2 long, node long")
        both = known.join(F.broadcast(others), ["cid", "cid2"], "left").withColumn("node", F.coalesce("node", "cid"))
        known = both.select("doc_id", "n", "node", "point").withColumnRenamed("node", "cid")
        nodes = full.join(F.broadcast(others), ["cid", "cid2"], "left").select("cid", "cid2", "rep", "point", F.coalesce("node", "cid").alias("node"))
    else:
        nodes = full.withColumn("node", F.col("cid"))
    classes = nodes.select(F.col("node").alias("cid"), "rep", "point")
    work = _Join(docs, classes, m, store, renamed)
    work.find_shared()
    links = work.verify(work.stars(), "star")
    roots = components(links, store, "star")
    for k in range(NEAREST):
        links = work.verify(work.across(roots, True, f"near_{k}"), f"near_{k}")
        if not links.limit(1).count():
            break
        roots = work.join(roots, links, f"near_{k}")
    links = work.verify(work.across(roots, False, "rest"), "rest")
    one_id = known.select("doc_id", "cid").distinct()
    again = one_id.groupBy("doc_id").agg(F.min("cid").alias("a"), F.count("*").alias("texts")).where("texts > 1")
    again = one_id.join(again, "doc_id").where("cid <> a").select("a", F.col("cid").alias("b"))
    by_class = work.join(roots, links.unionByName(again), "last")

    grouped = nodes.select("cid", "cid2", "rep", "node").join(by_class, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = grouped.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = grouped.join(smallest, "root").select("cid", "cid2", "component_id")
    rows = profile.select("doc_id", "n", "cid", "cid2").join(named, ["cid", "cid2"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    result = store.write(rows.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id")), "result")
    store.drop("profile", "full", "shared")
    return result


def keep_one(docs: DataFrame, m: Measure) -> DataFrame:
    """docs with one row of each component: that with the smallest doc_id, and if that repeats, its smallest text.

    Rows without shingles or without an id all stay."""
    found = near_duplicates(docs, m).where("doc_id IS NOT NULL")
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    few = gone.count() <= MOST_BROADCAST
    kept = docs.join(F.broadcast(gone) if few else gone, "doc_id", "left_anti").select(*docs.columns)
    again = found.where("n_shingles > 0").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if not again.limit(1).count():
        return kept
    row = F.struct("text", *[c for c in docs.columns if c != "text"])
    repeats = kept.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(row).alias("row")).select("row.*")
    return kept.join(again, "doc_id", "left_anti").unionByName(repeats.select(*docs.columns))
