import random

import pytest
from mergewell.functions import similarity as s
from mergewell.functions.features import length_features, name_features
from mergewell.functions.normalize import tokens
from pyspark.sql import functions as F


def pairs(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string").coalesce(1)


def values(spark, make, rows):
    return [r.x for r in pairs(spark, rows).select("i", make(F.col("a"), F.col("b")).alias("x")).orderBy("i").collect()]


def test_jaro_winkler_cases(spark):
    rows = [("", ""), ("a", ""), ("a", "b"), ("abcd", "abce"), ("abxy", "ahkz"), ("mahindra", "maharaja"), ("same", "same")]
    assert values(spark, s.jaro_winkler, rows) == pytest.approx([1.0, 0.0, 0.0, 0.8833333, 0.55, 0.825, 1.0])


def plain_edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_edit_distances_and_grams_against_plain_definitions(spark):
    r = random.Random(1)
    word = lambda: "".join(r.choice("abé ") for _ in range(r.choice([0, 1, 3, 8, 130])))
    rows = [(word(), word()) for _ in range(60)]
    grams = lambda t: sorted({f"  {t}  "[i : i + 3] for i in range(len(t) + 2)}) if t else []
    assert values(spark, s.edit_distance, rows) == [plain_edit(a[:100], b[:100]) for a, b in rows]
    assert values(spark, lambda a, _: F.sort_array(s.char_ngrams(a)), rows) == [grams(a) for a, _ in rows]
    size = lambda a, b: 1 - plain_edit(a[:100], b[:100]) / max(len(a), len(b)) if a or b else 0.5
    assert values(spark, lambda a, b: s.edit_similarity(a, b, 0.5), rows) == pytest.approx([size(a, b) for a, b in rows])


def test_sets_and_empty_sides(spark):
    rows = [("", ""), ("a", ""), ("a b", "b c"), ("a a", "a")]
    sets = lambda f, *x: values(spark, lambda a, b: f(tokens(a), tokens(b), *x), rows)
    assert sets(s.jaccard) == pytest.approx([1, 0, 1 / 3, 1])
    assert sets(s.jaccard, 0.5, 0.5) == pytest.approx([0.5, 0.5, 1 / 3, 1])
    assert sets(s.containment) == pytest.approx([1, 0, 0.5, 1])
    assert values(spark, s.tri_state, [("a", "a"), ("a", "b"), ("", "b"), ("", "")]) == [1, -1, 0, 0]


def test_name_features(spark):
    a, b = F.col("a"), F.col("b")
    made = name_features(a, b, tokens(a), tokens(b)) | length_features(a, b, tokens(a), tokens(b))
    row = pairs(spark, [("blue fern", "blue fir")]).select(*[c.alias(k) for k, c in made.items()]).first()
    assert (row.name_token_jaccard, row.name_prefix_match, row.name_first_token_match, row.name_exact_match) == (pytest.approx(1 / 3), 1, 1, 0)
    assert (row.len_diff, row.len_ratio, row.token_diff) == (1, pytest.approx(8 / 9), 0)
