"""Results written as delimited text and JSON."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def score_text(score: Column) -> Column:
    """A score with five decimals."""
    return F.format_string("%.5f", score.cast("double"))


def formatted_scores(scored: DataFrame) -> DataFrame:
    """(source1_id, candidate_id, score) with five decimals, as strings."""
    return scored.select(F.col("s1_id").alias("source1_id"), F.col("target_id").alias("candidate_id"), score_text(F.col("score")).alias("score"))


def match_results(s1: DataFrame, scored: DataFrame, threshold: float, names: tuple[str, str] = ("source1_id", "matched_id"), position: str | None = None) -> DataFrame:
    """Two columns of these names: every record of s1 once, with its sorted distinct targets of at least the threshold,
    comma-joined, or "". position: a column of s1 by which rows are put in order; of a repeated record its first counts."""
    kept = scored.where(F.col("score") >= threshold)
    ids = kept.groupBy("s1_id").agg(F.array_join(F.sort_array(F.collect_set("target_id")), ",").alias("matched_id"))
    place = F.min(position) if position else F.lit(0)
    records = s1.groupBy(F.col("id").alias("s1_id")).agg(place.alias("place"))
    out = records.join(ids, "s1_id", "left")
    out = out.orderBy("place") if position else out
    return out.select(F.col("s1_id").alias(names[0]), F.coalesce("matched_id", F.lit("")).alias(names[1]))


def write_tsv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Empty cells are written as nothing. single_file puts all rows through one task: for small results only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("sep", "\t").option("header", True).option("emptyValue", "").option("quote", "").csv(path)


def write_json(spark: SparkSession, value: dict, path: str) -> None:
    """A small value as one JSON document in a folder, in any store that Spark writes to."""
    spark.createDataFrame([(json.dumps(value, indent=2),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str) -> dict:
    """A document that write_json wrote."""
    return json.loads("\n".join(r.value for r in spark.read.text(path, wholetext=True).collect()))


def metrics_document(history: list[dict], best: dict) -> dict:
    return {"best_threshold": best["threshold"], "validation_metrics": best, "history": history}
