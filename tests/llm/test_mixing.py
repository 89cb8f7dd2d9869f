import random

import numpy as np
import pytest
from mergewell.llm import mixing
from mergewell.llm.mixing import Targets, mixed, rake, sample


def rows(n=400):
    r = random.Random(6)
    out = [(i, " ".join(["w"] * r.randint(0, 30) + [r.choice(["", " | ", "###", "License", "x"])]), r.choice(["en", "fr", None]), r.choice(["src0", "src0", "src0", "src1", "src2"])) for i in range(n)]
    return [*out, (n, None, "en", None), (n, "", None, "src1"), (None, "a  b\tc", "fr", "src9")]


def frame(spark, data):
    return spark.createDataFrame([(*x, 3) for x in data], "doc_id long, text string, lang string, source string, topic int").repartition(3)


def topic(text):
    text = text or ""
    return "empty" if not text else "table" if " | " in text else "symbols" if "###" in text else "license" if "icense" in text else "prose"


def brute(data, t):
    docs = [(s or "", g or "", topic(x), len((x or "").split())) for _, x, g, s in data]
    order = {"source": 0, "lang": 1, "topic": 2}
    total = sum(d[3] for d in docs)
    factor = {m: {d[order[m]]: 1.0 for d in docs} for m in order}
    want = {}
    for m in order:
        sums = {v: sum(d[3] for d in docs if d[order[m]] == v) for v in factor[m]}
        raw = {v: t.shares[m].get(v, 0.0) if m in t.shares else (s ** t.temper[m] if s else 0.0) for v, s in sums.items()}
        want[m] = {v: x / sum(raw.values()) for v, x in raw.items()}
    weight = lambda d: d[3] / total * np.prod([factor[m][d[order[m]]] for m in order])
    for _ in range(100):
        for m in sorted(order):
            for v in factor[m]:
                now = sum(weight(d) for d in docs if d[order[m]] == v)
                if now > 0:
                    factor[m][v] *= want[m][v] / now
    product = [np.prod([factor[m][d[order[m]]] for m in order]) for d in docs]
    most = max(product)
    return [(*d, p / most) for d, p in zip(docs, product, strict=True)]


@pytest.mark.parametrize("t", [Targets(), Targets(shares={"lang": {"en": 0.5, "fr": 0.3, "": 0.2}}), Targets(shares={"source": {"src0": 1, "src1": 1}})])
@pytest.mark.parametrize("most", [100_000, 0])
def test_against_a_loop(spark, monkeypatch, t, most):
    if most == 0 and t.shares.keys() != {"lang"}:
        pytest.skip("the table path is tried on one")
    monkeypatch.setattr(mixing, "MOST_CELLS", most)
    if most == 0:
        t = Targets(shares=t.shares, rounds=8)
    data = rows()
    got = sample(frame(spark, data), t).select("doc_id", "source", "lang", "topic", "tokens", "probability", "sampled").collect()
    key = lambda x: (str(x[0]), x[1], x[2], x[3], x[4])
    want = sorted([(d[0], *w) for d, w in zip(data, brute(data, t), strict=True)], key=key)
    got = sorted(map(tuple, got), key=key)
    assert [x[:5] for x in got] == [x[:5] for x in want]
    assert np.allclose([x[5] for x in got], [x[5] for x in want], atol=1e-6 if most else 1e-3)
    assert max(x[5] for x in got) == 1.0
    for x in got:
        assert x[6] if x[5] == 1 else True
        assert not x[6] or x[5] > 0


def test_marginals_hold():
    r = np.random.default_rng(1)
    cells = [(a, b, c, int(r.integers(1, 1000))) for a in "xyz" for b in "pq" for c in "uv"]
    t = Targets(shares={"lang": {"x": 0.2, "y": 0.5, "z": 0.3}, "source": {"p": 0.1, "q": 0.9}, "topic": {"u": 0.6, "v": 0.4}})
    f = rake(cells, t)
    weights = [n * f["lang"][a] * f["source"][b] * f["topic"][c] for a, b, c, n in cells]
    for m, margin in enumerate(t.margins):
        for v, share in t.shares[margin].items():
            assert abs(sum(w for c, w in zip(cells, weights, strict=True) if c[m] == v) / sum(weights) - share) < 1e-6


def test_sampled_rates_and_columns(spark):
    data = [(i, "w " * 10, "en", "a" if i % 4 else "b") for i in range(4000)]
    t = Targets(shares={"source": {"a": 0.5, "b": 0.5}})
    out = mixed(frame(spark, data), t)
    assert out.columns == ["doc_id", "text", "lang", "source", "topic"]
    counts = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    assert counts["b"] == 1000 and 900 < counts["a"] < 1100
    assert sample(frame(spark, []), t).count() == 0 and mixed(frame(spark, []), t).count() == 0


def test_given_topics_and_odd_rows(spark):
    """Another topic column, very long texts, repeated rows, nulls, and columns that are called like results."""
    from pyspark.sql import functions as F

    data = [(i, "w " * (200_000 if i == 7 else 10), "en", "a", f"t{i % 2}", 0.5, True, "r") for i in range(40)]
    data += [data[3], (None, None, None, None, None, None, None, None), (None, "x", "en", "a", "t0", 0.1, False, "r")]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, topic string, probability double, sampled boolean, row string")
    t = Targets(shares={"topic": {"short": 0.5, "long": 0.5}}, topic=lambda text: F.when(F.length(text) > 1000, F.lit("long")).otherwise(F.lit("short")))
    got = sample(docs, t).collect()
    assert len(got) == 43 and {r.topic for r in got} == {"short", "long"} and sum(r.tokens for r in got if r.topic == "long") == 200_000
    assert [r.doc_id for r in got if r.sampled and r.probability < 0.1] == [] and max(r.probability for r in got) == 1.0
    assert len({(r.doc_id, r.probability, r.sampled) for r in got if r.doc_id == 3}) == 1
    kept = mixed(docs, t)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.sampled)
