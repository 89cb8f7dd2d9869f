import random
import re

import numpy as np
import pyarrow as pa
import pytest
from mergewell.llm.ngram_join import CountTree, Measure, _across, _inside, _sets, groups_of, near_duplicates, packed, points_matrix, signatures


def shingles(text, width):
    words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def brute(rows, m):
    sets = [shingles(t, m.width) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            linked = a and b and m.den * len(a & b) >= m.num * len(a | b)
            if rows[i][0] is not None and rows[j][0] is not None and (linked or (a and b and rows[i][0] == rows[j][0])):
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(least.get(find(i), k), k)
    return sorted(((k, len(s), None if k is None else least[find(i)]) for i, ((k, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def corpus(seed, n=260):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(1, 4)))
    passage = [word() for _ in range(40)]
    texts = []
    for _ in range(n):
        kind = r.random()
        if texts and kind < 0.15:
            texts.append(r.choice(texts))
        elif texts and kind < 0.6:
            words = r.choice(texts).split(" ")
            for _ in range(r.randint(1, max(1, len(words) // r.choice([10, 25, 60, 200])))):
                words[r.randrange(len(words))] = word()
            texts.append(" ".join(words))
        else:
            words = [word() for _ in range(r.choice([1, 2, 3, 5, 6, 8, 12, 20, 40, 100, 300]))]
            texts.append(" ".join(words + passage if r.random() < 0.2 else words))
    return texts


@pytest.mark.parametrize("m", [Measure(), Measure(5, 80, 100)])
def test_against_all_pairs(spark, m):
    texts = corpus(m.width)
    rows = [(i * 3 + 1, t) for i, t in enumerate(texts)] + [(5000, None), (5001, ""), (5002, " \n"), (None, texts[0]), (1, texts[7]), (1, texts[0]), (5003, texts[3].upper())]
    random.Random(1).shuffle(rows)
    got = near_duplicates(spark.createDataFrame([(*x, "z") for x in rows], "doc_id long, text string, component_id string").repartition(5), m)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, m)


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string"), Measure()).count() == 0


def test_a_dense_group_over_many_blocks(spark, monkeypatch):
    import mergewell.llm.ngram_join as module

    monkeypatch.setattr(module, "BLOCK", 7)
    r = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(r.randint(1, 6)):
            words[r.randrange(len(words))] = f"x{r.random()}"
        rows.append((i, " ".join(words)))
    m = Measure()
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), m)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, m)


@pytest.mark.parametrize("m", [Measure(), Measure(5, 80, 100), Measure(1, 50, 100)])
def test_linked_sets_share_a_key(m):
    texts = corpus(9, 400)
    (lo, hi, tokens, of, sizes), = _sets(pa.array(texts), m)
    keys, rows = signatures(tokens, of, sizes, m)
    own = [set(keys[rows == i].tolist()) for i in range(hi - lo)]
    sets = [shingles(t, m.width) for t in texts]
    assert [len(s) for s in sets] == sizes.tolist()
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a != b and m.den * len(a & b) >= m.num * len(a | b):
                assert own[i] & own[j]


@pytest.mark.parametrize("n", [1, 7, 8, 9, 70, 700])
def test_tree_keeps_what_the_bound_keeps(n):
    r, m = np.random.default_rng(n), Measure(3, 70, 100)
    a, b = r.integers(0, 5, (n, 64)), r.integers(0, 5, (max(1, n // 9), 64))
    b[: len(b) // 2] = a[: len(b) // 2]
    comp_a, comp_b = r.integers(0, 3, len(a)), r.integers(0, 3, len(b))
    i, j = CountTree(a, comp_a).join(CountTree(b, comp_b), m)
    best = np.minimum(a[:, None], b[None]).sum(2)
    sizes_a, sizes_b = a.sum(1)[:, None], b.sum(1)[None]
    near = (sizes_a * m.den >= sizes_b * m.num) & (sizes_b * m.den >= sizes_a * m.num) & (comp_a[:, None] != comp_b[None])
    want = {tuple(x) for x in np.argwhere(near & (best >= m.needed(sizes_a, sizes_b)))}
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == want and len(i) == len(want)


def test_pairs_of_small_groups():
    i, j = _inside(np.array([0, 5, 6]), np.array([3, 1, 4]))
    assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == [(0, 1), (0, 2), (1, 2), (6, 7), (6, 8), (6, 9), (7, 8), (7, 9), (8, 9)]


def test_points_of_many_coordinates_add_up():
    assert groups_of(np.array([0, 1, 64, 65, 512, 513, 10**9])).tolist() == [64, 64, 64, 128, 512, 1024, 1 << 16]
    r = np.random.default_rng(1)
    fine, coarse = r.integers(0, 9, 256), r.integers(0, 9, 64)
    fine[7] = 300  # needs two bytes
    got = points_matrix([packed(fine), packed(coarse)], 64)
    assert got[0].tolist() == [int(fine[k::64].sum()) for k in range(64)] and got[1].tolist() == coarse.tolist()
    assert len(packed(fine)) == 513 and len(packed(coarse)) == 65


@pytest.mark.parametrize("together", [4_000_000, 20_000])
def test_pairs_below_the_threshold_are_ruled_out(monkeypatch, together):
    """A key that hundreds of variants share, most of which are less alike than linked ones are: few of those come out, and
    all that are linked."""
    import mergewell.llm.ngram_join as module

    monkeypatch.setattr(module, "TOGETHER", together)
    r, m = random.Random(6), Measure(5, 80, 100)
    base = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(200):
        words = list(base)
        for _ in range(r.randint(1, 14)):
            words[r.randrange(400)] = f"x{r.random()}"
        texts.append(" ".join(words))
    (_, _, tokens, of, sizes), = _sets(pa.array(texts), m)
    (points,) = (b.column("point") for b in module._profile(m)(iter([pa.RecordBatch.from_arrays([pa.array(range(200)), pa.array(texts)], names=["doc_id", "text"])])))
    zero, number = pa.array([0] * 200, pa.int64()), pa.array(range(200), pa.int64())
    batch = pa.RecordBatch.from_arrays([zero, zero, zero, zero, number, number, points], names=["key", "low", "high", "block", "cid", "comp", "point"])
    got = {(a, b) for x in _across(m, False)(iter([batch])) for a, b in zip(x.column(0).to_pylist(), x.column(1).to_pylist(), strict=True)}
    sets = [set(tokens[of == i].tolist()) for i in range(200)]
    alike = {(i, j): len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for j in range(200) for i in range(j)}
    linked = {k for k, v in alike.items() if v >= 0.8}
    assert linked <= got and len(linked) < 0.5 * len(alike)
    if together > 20_000:
        assert all(alike[k] > 0.74 for k in got)


def test_long_texts(spark):
    r = random.Random(8)
    base = [f"w{r.randint(0, 10**6)}" for _ in range(6000)]
    rows = []
    for i, (cut, edits) in enumerate([(6000, 0), (6000, 90), (6000, 700), (4300, 30), (4000, 60), (4000, 0), (500, 0), (530, 9), (515, 40)]):
        words = base[:cut]
        for _ in range(edits):
            words[r.randrange(cut)] = f"x{r.random()}"
        rows.append((i, " ".join(words)))
    for m in (Measure(), Measure(5, 80, 100)):
        got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), m)
        assert sorted(map(tuple, got.collect()), key=str) == brute(rows, m)


@pytest.mark.parametrize("m", [Measure(), Measure(5, 80, 100)])
def test_keys_follow_from_what_sets_hold(m):
    """Unrelated sets share no keys, however many there are: pairs don't grow with the square of the texts."""
    r = random.Random(3)
    for n in (300, 1200):
        texts = [" ".join(f"w{r.randrange(10**9)}" for _ in range(r.randint(1, 150))) for _ in range(n)]
        keys, rows = [], []
        for lo, _, tokens, of, sizes in _sets(pa.array(texts), m):
            key, row = signatures(tokens, of, sizes, m)
            keys.append(key)
            rows.append(row + lo)
        both = np.unique(np.stack([np.concatenate(keys), np.concatenate(rows).astype(np.uint64)]), axis=1)
        assert (np.unique(both[0], return_counts=True)[1] == 1).all()


def test_classes_that_share_half_their_id(spark, monkeypatch):
    """Ids of four bits only in their first half: nearly all classes clash, and the result is the same."""
    import mergewell.llm.ngram_join as module

    m = Measure()
    texts = corpus(21, 60)
    rows = [*enumerate(texts), (3, texts[50]), (None, texts[2])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    real = module.class_ids

    def weak(tokens, sizes, seed):
        one, two = real(tokens, sizes, seed)
        return one & 15, two

    def under(run):
        def wrapped(batches):
            import mergewell.llm.ngram_join as worker

            before, worker.class_ids = worker.class_ids, weak
            try:
                yield from run(batches)
            finally:
                worker.class_ids = before

        return wrapped

    monkeypatch.setattr(module, "released", under)
    got = near_duplicates(frame, m)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, m)
