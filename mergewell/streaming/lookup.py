"""Names from a stream are matched against a static table of records: blocking keys, then the lookup's score.

A name is answered by itself, so nothing is kept between batches. Each batch runs the same plan as a table of names would.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.normalize import normalize_name, tokens
from ..operators.blocking import MAX_POSTINGS, key_array, prune_keys
from ..plans.lookup import DEFAULT_THRESHOLD, name_score


def name_keys(df: DataFrame, id_col: str) -> DataFrame:
    """(key, id, norm_name) of names by their prefix, first and longest word."""
    none = F.lit("")
    named = df.withColumn("norm_name", normalize_name(F.col("name")))
    return named.select(F.explode(key_array(F.col("norm_name"), tokens(F.col("norm_name")), none, none)).alias("key"), F.col(id_col).alias("id"), "norm_name", "name")


def record_keys(records: DataFrame) -> DataFrame:
    """The keys of records (id, name) that few enough of them share."""
    return prune_keys(name_keys(records, "id"), MAX_POSTINGS)


def match_names(names: DataFrame, records: DataFrame, limit: int = 5, threshold: float = DEFAULT_THRESHOLD, keys: DataFrame | None = None) -> DataFrame:
    """(query_id, query, business_name, score, is_match): for each name (query_id, name) its best records (id, name) among
    those that share a key with it. Keys of very many records are left out; a name that has none of the other records' keys
    is held against all records, as in a lookup. A blank name finds nothing. keys: record_keys(records), if they are at hand."""
    theirs = record_keys(records) if keys is None else keys
    mine = name_keys(names, "query_id").select("key", F.col("id").alias("query_id"), F.col("norm_name").alias("q"), F.col("name").alias("query"))
    pairs = mine.join(theirs, "key").groupBy("query_id", "id").agg(*[F.first(c).alias(c) for c in ("q", "query", "norm_name", "name")])
    asked = names.where(F.col("name").rlike(r"\S")).select("query_id", normalize_name(F.col("name")).alias("q"), F.col("name").alias("query"))
    left = asked.join(mine.join(theirs, "key", "left_semi"), "query_id", "left_anti")
    scanned = left.crossJoin(records.select("id", normalize_name(F.col("name")).alias("norm_name"), "name"))
    scored = pairs.unionByName(scanned).withColumn("raw", name_score(F.col("q"), F.col("norm_name")))
    best = Window.partitionBy("query_id").orderBy(F.desc("raw"), "name", "id")
    top = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= limit)
    return top.select("query_id", "query", F.col("name").alias("business_name"), F.round("raw", 4).alias("score"), (F.col("raw") >= threshold).alias("is_match"))


def stream_lookup(names: DataFrame, records: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, limit: int = 5) -> StreamingQuery:
    """Runs match_names on every batch of a stream of names, and hands the result and the batch's number to sink. Records'
    keys are made once and kept in memory or on disk for all batches."""
    keys = record_keys(records).persist()
    return names.writeStream.foreachBatch(lambda batch, number: sink(match_names(batch, records, limit, keys=keys), number)).option("checkpointLocation", checkpoint).start()
