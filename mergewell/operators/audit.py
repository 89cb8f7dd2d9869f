"""Checks of results: rows (kind, s1_id, target_id), none if all is well."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_ids(results: DataFrame) -> DataFrame:
    """A row for each occurrence of an id after its first."""
    extra = results.groupBy("source1_id").agg(F.count("*").alias("n")).where("n > 1")
    return extra.select(F.explode(F.sequence(F.lit(2).cast("long"), "n")).alias("_"), "source1_id").select(F.lit("duplicate").alias("kind"), F.col("source1_id").alias("s1_id"), F.lit("").alias("target_id"))


def matched_pairs(results: DataFrame) -> DataFrame:
    ids = F.filter(F.transform(F.split("matched_id", ","), lambda x: F.trim(x)), lambda x: x != "")
    return results.select(F.col("source1_id").alias("s1_id"), F.explode(ids).alias("target_id"))


def invalid_targets(pairs: DataFrame, targets: DataFrame) -> DataFrame:
    """Targets that don't exist."""
    known = targets.select(F.col("id").alias("target_id"))
    return pairs.join(known, "target_id", "left_anti").select(F.lit("invalid_target").alias("kind"), "s1_id", "target_id")


def self_matches(pairs: DataFrame) -> DataFrame:
    return pairs.where(F.col("s1_id") == F.col("target_id")).select(F.lit("self_match").alias("kind"), "s1_id", "target_id")


def missing_entities(results: DataFrame, s1: DataFrame) -> DataFrame:
    """Records that have no row."""
    expected = s1.select(F.col("id").alias("s1_id")).distinct()
    return expected.join(results.select(F.col("source1_id").alias("s1_id")), "s1_id", "left_anti").select(F.lit("missing").alias("kind"), "s1_id", F.lit("").alias("target_id"))


def missing_count(results: DataFrame, s1: DataFrame) -> DataFrame:
    """One issue with the number of missing records in target_id, or none."""
    n = missing_entities(results, s1).agg(F.count("*").alias("n")).where("n > 0")
    return n.select(F.lit("missing").alias("kind"), F.lit("").alias("s1_id"), F.col("n").cast("string").alias("target_id"))


def audit(results: DataFrame, s1: DataFrame, targets: DataFrame, candidates: DataFrame | None = None) -> DataFrame:
    """All issues of results (source1_id, matched_id). An empty table of candidates is an issue; so is one of results, for
    which nothing else is checked."""
    spark = results.sparkSession
    schema = "kind string, s1_id string, target_id string"
    issues = spark.createDataFrame([("no_candidates", "", "")] if candidates is not None and candidates.isEmpty() else [], schema)
    if results.isEmpty():
        return issues.unionByName(spark.createDataFrame([("no_results", "", "")], schema))
    pairs = matched_pairs(results)
    for found in (duplicate_ids(results), invalid_targets(pairs, targets), self_matches(pairs), missing_count(results, s1)):
        issues = issues.unionByName(found)
    return issues
