import random
import zlib

import corpus_pipeline
import numpy as np
import pytest
from mergewell.llm import mixing, toxicity
from mergewell.llm.ngram_join import Measure
from mergewell.llm.queries import QUERIES

from .test_ngram_join import brute as components
from .test_suffix_automaton import words
from .test_token_store import plain


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with toxic ones, copies, near copies, benchmark passages, and odd rows."""
    r = random.Random(12)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(k, text(30)) for k in range(6)]
    docs, labels = [], []
    for i in range(240):
        kind, toxic = r.random(), False
        if docs and kind < 0.1:
            body = r.choice(docs)[1]
        elif docs and kind < 0.2:
            parts = r.choice(docs)[1].split(" ")
            parts[r.randrange(len(parts))] = word()
            body = " ".join(parts)
        elif kind < 0.3:
            body = f"{text(60)}. {r.choice(items)[1].title()}! {text(50)}"
        elif kind < 0.5:
            body, toxic = f"{text(20)} grotty {text(30)} vileness", True
        else:
            body = text(r.randint(40, 120))
        docs.append((i, body, r.choice(["en", "de"]), r.choice(["src0", "src0", "src1"]), len(body)))
        labels.append((i, 1, int("grotty" in body)))
    docs += [(900, None, "en", "src1", 0), (901, "", "de", None, 0), (902, items[0][1], "en", "src0", len(items[0][1]))]
    where = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"file://{where}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"file://{where}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"file://{where}/benchmark.parquet")
    return f"file://{where}", docs, items


def by_id(rows):
    return {r[0]: tuple(r) for r in rows}


def without_items(text, items):
    """text without the words of windows of ten item words, and the share of words that those are."""
    import re

    spans = [(m.start(), m.end()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))]
    own = words(text)
    windows = {tuple(w[i : i + 10]) for w in (words(t) for _, t in items) for i in range(len(w) - 9)}
    hit = sorted({i + k for i in range(len(own) - 9) if tuple(own[i : i + 10]) in windows for k in range(10)})
    out, at, k = [], 0, 0
    while k < len(hit):
        end = k
        while end + 1 < len(hit) and hit[end + 1] == hit[end] + 1:
            end += 1
        out.append(text[at : spans[hit[k]][0]])
        at, k = spans[hit[end]][1], end + 1
    return "".join([*out, text[at:]]), len(hit) / max(1, len(own))


def test_stages_against_plain_versions(spark, folder):
    sf_dir, docs, items = folder
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_copies", "benchmark", "mixing", "tokens"]
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)

    clean = stage["toxicity"](spark, table, sf_dir)
    assert clean.columns == table.columns
    scored = toxicity.classify(table, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()
    now = by_id(clean.collect())
    assert set(now) == {r.doc_id for r in scored if not r.predicted}
    assert {d[0] for d in docs if "grotty" not in (d[1] or "")} - set(now) == set() and not any("grotty" in (d[1] or "") for d in now.values())

    clean = clean.cache()
    single = by_id(stage["near_copies"](spark, clean, sf_dir).collect())
    groups = components([d[:2] for d in now.values()], Measure(5, 80, 100))
    assert single == {k: now[k] for k, _, c in groups if k == c} and len(single) < len(now)

    table = spark.createDataFrame(list(single.values()), clean.schema)
    cut = by_id(stage["benchmark"](spark, table, sf_dir).collect())
    want = {}
    for k, (_, text, lang, source, n) in single.items():
        new, share = without_items(text or "", items)
        if share <= 0.5:
            want[k] = (k, None if text is None else new, lang, source, n if text is None else len(new))
    assert cut == want and 902 not in cut and any(cut[k][1] != single[k][1] for k in cut)

    table = spark.createDataFrame(list(cut.values()), clean.schema)
    mixed = by_id(stage["mixing"](spark, table, sf_dir).collect())
    chosen = {r.doc_id for r in mixing.sample(table).where("sampled").collect()}
    assert mixed == {k: cut[k] for k in chosen} and len(mixed) > len(cut) / 3

    table = spark.createDataFrame(list(mixed.values()), clean.schema)
    rows = sorted(stage["tokens"](spark, table, sf_dir).collect())
    at = 0
    for (doc_id, start, n, crc), k in zip(rows, sorted(mixed), strict=True):
        ids = plain(mixed[k][1])
        assert (doc_id, start, n, crc) == (k, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += n

    whole = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, rows))


def test_odd_tables_through_all_stages(spark, tmp_path, folder):
    """Empty tables; and null and repeated rows, a very long text and a column that is called like a result."""
    sf_dir = f"file://{tmp_path}"
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{folder[0]}/{name}.parquet").limit(0).write.parquet(f"{sf_dir}/{name}.parquet")
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, found string"
    rows = [(1, "some words " * 100_000, "en", "a", 5, "x", "y"), (2, "short", "en", "a", 5, "x", "y"), (2, "short", "en", "a", 5, "x", "y"), (None, None, None, None, None, None, None), (3, "", "", "", 0, "", "")]
    spark.createDataFrame(rows, schema).write.parquet(f"{sf_dir}/documents.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and out.count() >= 3
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
    assert corpus_pipeline.run(spark, sf_dir).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert corpus_pipeline.store_tokens(spark, docs.limit(0), sf_dir).count() == 0


def test_all_ten_are_registered():
    assert sorted({int(n[2:].split("_")[0]) for n in QUERIES}) == list(range(1, 11))
