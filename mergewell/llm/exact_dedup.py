"""Exact dedup: group by a 128-bit content hash, keep the smallest id, compare bytes inside groups. Native throughout.

Only hashes, ids and counts are grouped, and Spark adds them up before it shuffles, so a text with very many copies costs
each task one row. Bytes are compared by grouping the texts of hashes with company by hash and bytes: each task first brings
its own copies down to one, so a text moves once a task, however many copies it has. A hash with two texts is a collision;
its rows are grouped again by their bytes. Rows meet their group by a broadcast of checked size, or else by a join of two
written tables, whose large keys adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import Store

SPACE = r"[\x20\x09-\x0D]+"
#: Up to so many hashes of groups may be broadcast; more are joined by a shuffle.
MOST_BROADCAST = 1_000_000


def normalised(text: Column) -> Column:
    """The text with each run of white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACE, " ")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row of docs.

    Rows with equal normalised texts are a group; keep_id is its smallest id. Nulls count as empty texts, which are equal.
    Of rows that repeat the smallest id, one is kept. A null id comes after all others: its row stays only where every id
    of its group is null, and keep_id is null then. Other columns are not looked at.
    """
    store = Store(docs.sparkSession, "exact-dedup")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), normalised(F.col(text_col)).alias("text"))
    rows = rows.select("doc_id", "text", F.unhex(F.md5("text")).alias("h"), F.sha2("text", 256).alias("text_sha256"))
    narrow = store.write(rows.select("doc_id", "h", "text_sha256"), "rows")
    groups = narrow.groupBy("h").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    several = store.write(groups.where("group_size > 1"), "several")
    few = several.count() <= MOST_BROADCAST
    several = F.broadcast(several) if few else several
    texts = rows.select("h", "text").join(several.select("h"), "h", "left_semi").groupBy("h", "text").agg(F.count("*").alias("n"))
    bad = store.write(texts.groupBy("h").agg(F.count("*").alias("texts")).where("texts > 1").select("h"), "collisions")
    sure = narrow.join(several, "h", "left")
    if bad.limit(1).count():  # bytes differ under one hash: these groups are formed by the bytes themselves
        sure = sure.join(bad, "h", "left_anti")
        mixed = store.write(rows.join(bad, "h", "left_semi"), "mixed")
        by_bytes = store.write(mixed.groupBy("text").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")), "by_bytes")
        again = mixed.join(by_bytes, "text").select(F.concat("h", F.unhex("text_sha256")).alias("h"), "doc_id", "text_sha256", "keep_id", "group_size")
        sure = sure.unionByName(again)
    sure = sure.select("doc_id", "h", "text_sha256", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"))
    first = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    # Rows that repeat the kept id: one of them stays. Such ids are looked for among kept rows only.
    repeated = sure.where(first).groupBy("h", "keep_id").count().where("count > 1").select("h")
    repeated = store.write(repeated, "repeated")
    if not repeated.limit(1).count():
        out = sure.withColumn("kept", first)
    else:
        plain = sure.join(repeated, "h", "left_anti").withColumn("kept", first)
        held = sure.join(repeated, "h", "left_semi")
        others = held.where(~first).withColumn("kept", F.lit(False))
        same = held.where(first).groupBy("h", "doc_id", "text_sha256", "keep_id", "group_size").count()
        same = same.withColumn("kept", F.explode(F.expr("transform(sequence(1, count), i -> i = 1)"))).drop("count")
        out = plain.unionByName(others).unionByName(same)
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that are copies of another. Ids must be unique."""
    kept = exact_duplicates(docs, id_col, text_col).where("kept").select(F.col("doc_id").alias(id_col))
    return docs.join(kept, id_col, "left_semi")
