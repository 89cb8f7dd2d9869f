import pytest
from mergewell.functions.normalize import with_normalised
from mergewell.operators import audit, blocking, evaluate
from mergewell.sources.entities import values_source


def entities(spark, rows, tag):
    return with_normalised(values_source(spark, rows, tag))


def test_keys_of_a_record(spark):
    row = {"id": "1", "name": "The Blue Lagoon Ltd", "zip": "123", "country": "US"}
    keys = [r.key for r in blocking.block_keys(entities(spark, [row], "s1")).collect()]
    assert keys == ["C_PRE::US::the", "PRE::the", "C_TOK::US::blue", "TOK::blue", "C_ZIP::US::123", "ZIP::123", "C_LONG::US::lagoon", "LONG::lagoon"]
    assert blocking.block_keys(entities(spark, [{"id": "1", "name": "ab"}], "s1")).count() == 0


def test_pruning_keeps_the_bound_itself(spark):
    keys = spark.createDataFrame([("x", i) for i in range(3)] + [("y", i) for i in range(4)], "key string, id int")
    assert {r.key for r in blocking.prune_keys(keys, 3).collect()} == {"x"}


def test_best_candidates(spark):
    s1 = entities(spark, [{"id": "a", "name": "green tea house", "country": "US"}], "s1")
    targets = entities(spark, [{"id": f"t{i}", "name": n, "country": c} for i, (n, c) in enumerate([("green tea house", "US"), ("green field", "US"), ("green tea", "FR"), ("other", "US")])], "s2")
    found = blocking.candidates(s1, targets).orderBy("pre_score", ascending=False).collect()
    assert [(r.target_id, r.hits) for r in found] == [("t0", 6), ("t1", 6), ("t2", 3)]
    assert found[0].pre_score == 17.0
    assert blocking.candidates(s1, targets, most=2).count() == 2
    plan = blocking.candidates(s1, targets)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "CartesianProduct" not in plan


def test_positives_need_both_records(spark):
    s1, t = entities(spark, [{"id": "a"}], "s1"), entities(spark, [{"id": "x"}, {"id": "y"}], "s2")
    pos = spark.createDataFrame([("a", "x"), ("a", "gone"), ("gone", "y")], "s1_id string, target_id string")
    pairs = spark.createDataFrame([("a", "y")], "s1_id string, target_id string")
    got = blocking.label_pairs(blocking.with_positives(pairs, pos, s1, t), pos)
    assert sorted(map(tuple, got.collect())) == [("a", "x", 1), ("a", "y", 0)]


def test_scores_and_sweep(spark):
    rows = spark.createDataFrame([(0.9, 1), (0.8, 1), (0.72, 0), (0.4, 1), (0.1, 0)], "score double, label int")
    row = evaluate.with_scores(evaluate.confusion(rows, 0.75)).first()
    assert (row.tp, row.fp, row.fn, row.tn, row.precision, row.recall, row.f0_5, row.f1) == (2, 0, 1, 2, 1.0, 0.66667, 0.90909, 0.8)
    swept = evaluate.sweep(rows)
    assert swept.count() == 16
    for r in swept.collect():
        one = evaluate.confusion(rows, r.threshold).first()
        assert (r.tp, r.fp, r.fn, r.tn) == (one.tp, one.fp, one.fn, one.tn)
    assert evaluate.best_threshold(swept).first().threshold == 0.75
    assert evaluate.with_scores(evaluate.confusion(rows.limit(0), 0.5)).first().f1 == 0.0


def test_split_and_scaling(spark):
    ids = spark.createDataFrame([(f"e{i}",) for i in range(15) for _ in range(2)], "s1_id string")
    split = evaluate.group_split(ids)
    assert split.count() == 15 and split.where("is_val").count() == 3
    assert evaluate.group_split(ids.limit(1)).where("is_val").count() == 1
    out = evaluate.standardize_columns(spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, y double"), ["x", "y"]).collect()
    assert sorted(map(tuple, out)) == [(-1.0, 0.0), (1.0, 0.0)]
    weights = evaluate.class_weights(spark.createDataFrame([(1,), (0,), (0,), (0,)], "label int")).collect()
    assert {r.label: r.weight for r in weights} == {1: 2.0, 0: pytest.approx(2 / 3)}


def test_audit(spark):
    s1 = spark.createDataFrame([("1",), ("2",), ("3",), ("4",)], "id string")
    targets = spark.createDataFrame([("x",), ("2",)], "id string")
    results = spark.createDataFrame([("1", "x, gone"), ("2", "2"), ("1", ""), ("1", "")], "source1_id string, matched_id string")
    got = sorted(map(tuple, audit.audit(results, s1, targets).collect()))
    assert got == [("duplicate", "1", ""), ("duplicate", "1", ""), ("invalid_target", "1", "gone"), ("missing", "", "2"), ("self_match", "2", "2")]
    assert [r.kind for r in audit.audit(results.limit(0), s1, targets, results.limit(0)).collect()] == ["no_candidates", "no_results"]
    assert audit.audit(spark.createDataFrame([(str(i), "x") for i in range(1, 5)], results.schema), s1, targets).count() == 0
