"""Logistic regression on pair features: balanced classes, population scaling, and a plain gradient descent beside it."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class LinkModel:
    """Coefficients on scaled features; scoring is one expression, without a join."""

    columns: list[str]
    mean: list[float]
    std: list[float]
    weights: list[float]
    intercept: float
    threshold: float = 0.60

    def document(self) -> dict:
        """The model as plain values, which of_document takes back."""
        return {"best_threshold": self.threshold, **{k: v for k, v in asdict(self).items() if k != "threshold"}}

    @staticmethod
    def of_document(value: dict) -> LinkModel:
        return LinkModel(*(value[k] for k in ("columns", "mean", "std", "weights", "intercept", "best_threshold")))

    def logit(self) -> Column:
        z = F.lit(self.intercept)
        for c, m, s, w in zip(self.columns, self.mean, self.std, self.weights, strict=True):
            z = z + F.lit(w) * ((F.col(c) - F.lit(m)) / F.lit(s))
        return z

    def score(self, features: DataFrame) -> DataFrame:
        """features with `score`, the probability of a link."""
        return features.withColumn("score", 1.0 / (1.0 + F.exp(-self.logit())))


def _moments(df: DataFrame, columns: list[str]) -> tuple[list[float], list[float], dict[int, int]]:
    row = df.agg(*[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns], F.count_if(F.col("label") == 1).alias("ones"), F.count("*").alias("n")).first()
    return [row[f"m_{c}"] or 0.0 for c in columns], [row[f"s_{c}"] or 1.0 for c in columns], {1: row["ones"], 0: row["n"] - row["ones"]}


def _prior(columns: list[str], counts: dict[int, int]) -> LinkModel:
    """With one class only there is nothing to learn: its probability is near 1 or 0."""
    return LinkModel(columns, [0.0] * len(columns), [1.0] * len(columns), [0.0] * len(columns), 30.0 if counts[1] else -30.0)


def fit(df: DataFrame, columns: list[str], strength: float = 1.0, rounds: int = 1000) -> LinkModel:
    """L2-penalised logistic regression with balanced class weights, on features scaled by population deviation."""
    mean, std, counts = _moments(df, columns)
    n = counts[0] + counts[1]
    if not counts[0] or not counts[1]:
        return _prior(columns, counts)
    scaled = df.select("label", F.when(F.col("label") == 1, n / (2.0 * counts[1])).otherwise(n / (2.0 * counts[0])).alias("weight"), *[((F.col(c) - m) / s).alias(c) for c, m, s in zip(columns, mean, std, strict=True)])
    rows = VectorAssembler(inputCols=columns, outputCol="features").transform(scaled).select(F.col("label").cast("double").alias("label"), "weight", "features")
    lr = LogisticRegression(weightCol="weight", regParam=1.0 / (strength * n), elasticNetParam=0.0, standardization=False, maxIter=rounds, tol=1e-9)
    fitted: LogisticRegressionModel = lr.fit(rows)
    return LinkModel(columns, mean, std, fitted.coefficients.toArray().tolist(), float(fitted.intercept))


def gradient(df: DataFrame, fitted: LinkModel, strength: float = 1.0) -> dict[str, float]:
    """The gradient of what fit minimises, by column and "intercept": near 0 where it is well fitted."""
    _, _, counts = _moments(df, fitted.columns)
    n = max(1, counts[0] + counts[1])
    weight = F.when(F.col("label") == 1, n / (2.0 * max(1, counts[1]))).otherwise(n / (2.0 * max(1, counts[0])))
    error = weight * (1.0 / (1.0 + F.exp(-fitted.logit())) - F.col("label"))
    sums = [F.sum((F.col(c) - F.lit(m)) / F.lit(s) * error) for c, m, s in zip(fitted.columns, fitted.mean, fitted.std, strict=True)]
    found = df.agg(*sums, F.sum(error)).first()
    decay = [w / (strength * n) for w in fitted.weights] + [0.0]
    return {c: (g or 0.0) / n + d for c, g, d in zip([*fitted.columns, "intercept"], found, decay, strict=True)}


def fit_descent(df: DataFrame, columns: list[str], epochs: int = 400, rate: float = 0.05, decay: float = 0.01) -> LinkModel:
    """Full-batch gradient descent; each epoch is one aggregation over the rows, which are kept in memory meanwhile.

    Links weigh as many times as there are more non-links, and logits stay within 30 of 0. It survives a lack of either class."""
    mean, std, counts = _moments(df, columns)
    n, weight = max(1, counts[0] + counts[1]), counts[0] / max(counts[1], 1)
    rows = df.select("label", *[((F.col(c) - m) / s).alias(c) for c, m, s in zip(columns, mean, std, strict=True)]).persist()
    model = LinkModel(columns, [0.0] * len(columns), [1.0] * len(columns), [0.0] * len(columns), 0.0)
    try:
        for _ in range(epochs):
            z = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), model.logit()))
            error = (1.0 / (1.0 + F.exp(-z)) - F.col("label")) * F.when(F.col("label") == 1, weight).otherwise(1.0)
            g = rows.select("*", error.alias("error")).agg(*[F.sum(F.col(c) * F.col("error")).alias(c) for c in columns], F.sum("error").alias("error")).first()
            model.weights = [w - rate * ((g[c] or 0.0) / n + decay * w) for c, w in zip(columns, model.weights, strict=True)]
            model.intercept -= rate * (g["error"] or 0.0) / n
    finally:
        rows.unpersist()
    return LinkModel(columns, mean, std, model.weights, model.intercept)
