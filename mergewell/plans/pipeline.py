"""From sources and known links to scored candidates, results and their audit."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import features, tfidf
from ..functions.normalize import with_normalised
from ..operators import audit, blocking, evaluate
from ..sources import sinks
from . import model as models


log = logging.getLogger(__name__)
_PLACE = "_mergewell_place"


@dataclass
class Trained:
    model: models.LinkModel
    idf: DataFrame
    history: list[dict]
    best: dict


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """df, whose rows are counted on the way when it is written."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def train(s1: DataFrame, targets: DataFrame, positives: DataFrame, threshold: float | None = None, validating: list[str] | None = None) -> Trained:
    """Fit on standard entities and known links: once without the validation groups, to tune the threshold, then on all.
    validating: the s1 ids that validate; without it they are chosen by hash."""
    s1, targets = with_normalised(s1), with_normalised(targets)
    idf = tfidf.fit_idf(s1.select("full_text").unionByName(targets.select("full_text")))
    pairs = blocking.candidates(s1, targets)
    pairs = blocking.label_pairs(blocking.with_positives(pairs, positives, s1, targets), positives)
    table = features.pair_features(pairs, s1, targets, idf).persist()
    try:
        if validating is None:
            split = evaluate.group_split(table, "s1_id").withColumnRenamed("id", "s1_id")
        else:
            split = table.select("s1_id", F.col("s1_id").isin(validating).alias("is_val")).distinct()
        fitting = table.join(split.where("NOT is_val"), "s1_id", "left_semi")
        held = table.join(split.where("is_val"), "s1_id", "left_semi")
        tuned = models.fit(fitting, features.NAMES)
        swept = evaluate.sweep(tuned.score(held).select("score", "label"))
        history = [r.asDict() for r in swept.orderBy("threshold").collect()]  # a row for each threshold
        best = max(history, key=lambda r: (r["f0_5"], -r["threshold"])) if history else {"threshold": 0.60}
        model = models.fit(table, features.NAMES)
    finally:
        table.unpersist()
    model.threshold = best["threshold"] if threshold is None else threshold
    return Trained(model, idf, history, best)


def score_candidates(trained: Trained, s1: DataFrame, targets: DataFrame) -> DataFrame:
    """(s1_id, target_id, score) of all candidates of standard entities, by the weights of training."""
    s1, targets = with_normalised(s1), with_normalised(targets)
    pairs = blocking.candidates(s1, targets).select("s1_id", "target_id")
    return trained.model.score(features.pair_features(pairs, s1, targets, trained.idf)).select("s1_id", "target_id", F.col("score").cast("double"))


def run(
    train_tables: tuple[DataFrame, DataFrame, DataFrame], positives: DataFrame, test_tables: tuple[DataFrame, DataFrame, DataFrame], folder: str,
    threshold: float | None = None, names: tuple[str, str] = ("source1_id", "matched_id"), validating: list[str] | None = None,
) -> DataFrame:
    """Train, score, write candidates, results and metrics under folder, and return the audit's issues. Results are in the
    order of the first test table, under these names; row counts go to the log."""
    spark = positives.sparkSession
    s1, second, third = train_tables
    trained = train(s1, second.unionByName(third), positives, threshold, validating)
    s1, second, third = test_tables
    targets = second.unionByName(third)
    scored = score_candidates(trained, s1, targets).persist()
    records, n_records = counted(s1.withColumn(_PLACE, F.monotonically_increasing_id()), "records")
    pairs, n_pairs = counted(scored, "pairs")
    try:
        sinks.write_tsv(sinks.formatted_scores(pairs), f"{folder}/candidate_pairs")
        sinks.write_tsv(sinks.match_results(records, scored, trained.model.threshold, names, _PLACE), f"{folder}/matching_results")
    finally:
        scored.unpersist()
    log.info("%s records, %s candidate pairs", n_records.get["rows"], n_pairs.get["rows"])
    sinks.write_json(spark, sinks.metrics_document(trained.history, trained.best), f"{folder}/validation_metrics")
    sinks.write_json(spark, trained.model.document(), f"{folder}/model")
    read = lambda name, schema: spark.read.schema(schema).option("sep", "\t").option("header", True).option("enforceSchema", True).csv(f"{folder}/{name}")
    results = read("matching_results", "source1_id string, matched_id string").na.fill("")
    return audit.audit(results, s1, targets, read("candidate_pairs", "source1_id string, candidate_id string, score string"))


def load_model(spark: SparkSession, folder: str) -> models.LinkModel:
    """The model that a run wrote under folder."""
    return models.LinkModel.of_document(sinks.read_json(spark, f"{folder}/model"))
