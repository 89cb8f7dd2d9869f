import json

import numpy as np
from mergewell import queries
from mergewell.__main__ import main
from mergewell.plans import lookup, model, pipeline
from mergewell.sources import entities, links, sample
from mergewell.streaming.lookup import match_names, stream_lookup


def records(spark):
    names = ["Starlight", "Starlight Cafe Inc", "Moonbeam", "query"]
    return entities.values_source(spark, [{"id": "query" if n == "query" else str(i), "name": n} for i, n in enumerate(names)], "source1").selectExpr("*", "0 AS load_pos")


def test_lookup(spark):
    hits = lookup.lookup(records(spark), "Starlight", 2).collect()
    assert [(h.business_name, h.score, h.is_match) for h in hits][0] == ("Starlight", 0.6625, True)
    assert hits[1].business_name == "Starlight Cafe Inc" and not hits[1].is_match and len(hits) == 2
    assert lookup.lookup(records(spark), "  ").count() == 0
    assert "MATCH" in lookup.report(hits) and lookup.report([]) == "No similar record."


def test_models_separate_classes(spark):
    rows = [(float(i % 7), float(i), int(i > 20), 1.0) for i in range(40)]
    df = spark.createDataFrame(rows, "x double, y double, label int, z double")
    for fit in (model.fit, lambda d, c: model.fit_descent(d, c, epochs=30)):
        scored = fit(df, ["x", "y", "z"]).score(df).collect()
        assert all((r.score > 0.5) == (r.label == 1) for r in scored if abs(r.y - 20.5) > 3)
    for label in (0, 1):
        one = df.where(f"label = {label}")
        assert abs(model.fit(one, ["x"]).score(one).first().score - label) < 1e-6


def test_descent_query_runs_all_epochs(spark, tmp_path):
    r = np.random.default_rng(3)
    docs = [(i, int(r.integers(1, 20000))) for i in range(60)]
    labels = [(i, int(n + r.normal(0, 6000) > 9000), int(r.random() < 0.3)) for i, n in docs]
    spark.createDataFrame(docs, "doc_id long, n_chars long").write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
    got = {x.doc_id: x.score for x in queries.QUERIES["lr_gd"](spark, f"file://{tmp_path}").collect()}
    x, y = np.array([[n, t] for (_, n), (_, _, t) in zip(docs, labels, strict=True)], float), np.array([q for _, q, _ in labels], float)
    x = (x - x.mean(0)) / x.std(0)
    weight, w, b = np.where(y == 1, (y == 0).sum() / (y == 1).sum(), 1.0), np.zeros(2), 0.0
    for _ in range(400):
        error = (1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) - y) * weight
        w, b = w - 0.05 * (x.T @ error / len(y) + 0.01 * w), b - 0.05 * error.sum() / len(y)
    want = 1 / (1 + np.exp(-(x @ w + b)))
    assert np.abs(want - [got[i] for i, _ in docs]).max() < 2e-6


def tables(spark, split):
    data = sample.frames(spark, split)
    return tuple(entities.standardize(data[k], f"s{k}") for k in "123"), data["truth"]


def test_pipeline(spark, tmp_path):
    train, truth = tables(spark, "train")
    test, known = tables(spark, "test")
    issues = pipeline.run(train, links.link_pairs(truth), test, f"file://{tmp_path}")
    assert issues.count() == 0
    found = spark.read.option("sep", "\t").option("header", True).csv(f"file://{tmp_path}/matching_results")
    got = {r.source1_id: set((r.matched_id or "").split(",")) - {""} for r in found.collect()}
    want = {r.source1_id: set(r.matched_id.split(",")) for r in known.collect()}
    assert got.keys() == want.keys()
    right = sum(len(got[k] & want[k]) for k in want)
    assert right >= 0.9 * sum(map(len, got.values())) and right >= 0.8 * sum(map(len, want.values()))
    metrics = json.loads("\n".join(r.value for r in spark.read.text(f"file://{tmp_path}/validation_metrics").collect()))
    assert len(metrics["history"]) == 16 and metrics["best_threshold"] == metrics["validation_metrics"]["threshold"]


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    sample.write(spark, f"file://{tmp_path}/d")
    assert main(["--data-dir", f"file://{tmp_path}/d", "--lookup", "Harbor Light Bakery", "--limit", "2"]) == 0
    assert "Harbor Light Bakery" in capsys.readouterr().out
    answers = iter(["Quiet Lane Dental", ""])
    monkeypatch.setattr("builtins.input", lambda _: next(answers))
    assert main(["--data-dir", f"file://{tmp_path}/d"]) == 0
    assert "MATCH" in capsys.readouterr().out


def test_stream_equals_table(spark, tmp_path):
    names = spark.createDataFrame([(1, "Starlight"), (2, "Moon beam"), (3, "")], "query_id long, name string")
    names.write.parquet(f"file://{tmp_path}/in")
    found = []
    stream = spark.readStream.schema(names.schema).parquet(f"file://{tmp_path}/in")
    query = stream_lookup(stream, records(spark), lambda df, _: found.extend(df.collect()), f"file://{tmp_path}/ck")
    query.processAllAvailable()
    query.stop()
    want = match_names(names, records(spark)).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, want)) and {r.query_id for r in want} == {1, 2}
    assert {(r.query, r.business_name, r.score) for r in want if r.is_match} == {("Starlight", "Starlight", 0.6625)}


def test_names_without_rare_keys_are_held_against_all_records(spark):
    many = spark.range(1600).selectExpr("cast(id AS string) AS id", "concat('Acme Holdings ', id) AS name").unionByName(spark.createDataFrame([("hp", "HP")], "id string, name string"))
    names = spark.createDataFrame([(1, "Acme Holdings 77"), (2, "HP"), (3, " ")], "query_id long, name string")
    best = {}
    for r in match_names(names, many, 2).collect():
        best.setdefault(r.query_id, []).append((r.score, r.business_name, r.is_match))
    assert {k: max(v) for k, v in best.items()} == {1: (0.6625, "Acme Holdings 77", True), 2: (0.6625, "HP", True)}
    assert all(len(v) == 2 for v in best.values())
