"""Splits by group, confusion counts, F-scores and the choice of a threshold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VALIDATION_SHARE = 0.2
#: Thresholds of a sweep, in hundredths.
SWEEP = range(20, 100, 5)


def group_split(ids: DataFrame, id_col: str = "s1_id", share: float = VALIDATION_SHARE, seed: int = 42) -> DataFrame:
    """(id, is_val): the groups with the smallest salted hashes validate: the share of them, rounded down, one at least.

    Counts of the hashes' first digits, 65,536 at most, tell where the last of them is; only there are ids put in order."""
    distinct = ids.select(F.col(id_col).cast("string").alias("id")).distinct().withColumn("place", F.md5(F.concat(F.col("id"), F.lit(f"#{seed}"))))
    counts = sorted((r.first, r.n) for r in distinct.groupBy(F.left("place", F.lit(4)).alias("first")).agg(F.count("*").alias("n")).collect())
    left = max(1, int(sum(n for _, n in counts) * share))
    edge = ""
    for edge, n in counts:  # noqa: B007
        if left <= n:
            break
        left -= n
    cut = distinct.where(F.left("place", F.lit(4)) == edge).orderBy("place", "id").limit(left).agg(F.max(F.struct("place", "id")).alias("last"))
    return distinct.crossJoin(F.broadcast(cut)).select("id", (F.struct("place", "id") <= F.col("last")).alias("is_val"))  # cut is one row


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / F.greatest(b, F.lit(1e-12))).otherwise(0.0)


def with_scores(counts: DataFrame) -> DataFrame:
    """Adds precision, recall, f0_5 and f1, rounded to five places; a ratio without a denominator is 0."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    scored = counts.withColumn("p", _ratio(tp, tp + fp)).withColumn("r", _ratio(tp, tp + fn))
    f = lambda b2: _ratio((1 + b2) * F.col("p") * F.col("r"), b2 * F.col("p") + F.col("r"))
    named = {"precision": F.col("p"), "recall": F.col("r"), "f0_5": f(0.25), "f1": f(1.0)}
    return scored.select(*counts.columns, *[F.round(c, 5).alias(k) for k, c in named.items()])


def confusion(scored: DataFrame, threshold: Column | float, by: list[str] | None = None) -> DataFrame:
    """tp, fp, fn and tn of (score, label) rows."""
    said, true = F.col("score") >= threshold, F.col("label") == 1
    counts = {"tp": said & true, "fp": said & ~true, "fn": ~said & true, "tn": ~said & ~true}
    return scored.groupBy(*(by or [])).agg(*[F.count_if(c).cast("double").alias(k) for k, c in counts.items()])


def sweep(scored: DataFrame) -> DataFrame:
    """Confusion counts and scores at each threshold of SWEEP. Rows are first counted by the thresholds that they reach."""
    reached = sum((F.col("score") >= t / 100).cast("int") for t in SWEEP)
    counts = scored.where("score IS NOT NULL AND label IS NOT NULL").groupBy(reached.alias("reached"), "label").agg(F.count("*").alias("n"))
    steps = scored.sparkSession.createDataFrame([(k + 1, t / 100) for k, t in enumerate(SWEEP)], "step int, threshold double")
    said, true = F.col("reached") >= F.col("step"), F.col("label") == 1
    each = counts.crossJoin(F.broadcast(steps))  # at most 17 x 2 rows by 16
    tally = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0)).cast("double")
    out = each.groupBy("threshold").agg(tally(said & true).alias("tp"), tally(said & ~true).alias("fp"), tally(~said & true).alias("fn"), tally(~said & ~true).alias("tn"))
    return with_scores(out)


def best_threshold(swept: DataFrame) -> DataFrame:
    """The row with the highest f0_5; of equal ones the lowest threshold."""
    return swept.orderBy(F.desc("f0_5"), "threshold").limit(1)


def class_weights(labelled: DataFrame) -> DataFrame:
    """(label, n, weight): weights that give both classes the same total."""
    counts = labelled.groupBy("label").agg(F.count("*").alias("n"))
    every = Window.partitionBy()
    total, classes = F.sum("n").over(every), F.count("*").over(every)
    return counts.select("label", "n", (total / (classes * F.col("n"))).alias("weight"))  # a row for each class


def standardize_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns less their mean, by their population deviation; a deviation of 0 counts as 1."""
    stats = df.agg(*[F.avg(c).alias(f"mean_{c}") for c in columns], *[F.stddev_pop(c).alias(f"std_{c}") for c in columns])
    both = df.crossJoin(F.broadcast(stats))  # one row
    scaled = {c: (F.col(c) - F.col(f"mean_{c}")) / F.when(F.col(f"std_{c}") == 0, 1.0).otherwise(F.col(f"std_{c}")) for c in columns}
    return both.select(*[scaled[c].alias(c) if c in scaled else c for c in df.columns])
