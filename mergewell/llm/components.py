"""Connected components of an edge table, with tables between rounds; only counts reach the driver."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import Store


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch's edges as (node, smallest node of its component in the batch)."""
    for batch in batches:
        u, v = (np.asarray(batch.column(i)) for i in (0, 1))
        if not len(u):
            continue
        nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        a, b = at[: len(u)], at[len(u) :]
        label = np.arange(len(nodes))
        while True:
            low = np.minimum(label[a], label[b])
            new = label.copy()
            np.minimum.at(new, label[a], low)
            np.minimum.at(new, label[b], low)
            new = new[new]
            while not np.array_equal(new, new[new]):
                new = new[new]
            new = new[label]
            if np.array_equal(new, label):
                break
            label = new
        moved = label != np.arange(len(nodes))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[label[moved]])], names=["node", "root"])


def components(edges: DataFrame, store: Store, name: str, most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node that isn't the smallest of its component. edges: two long columns, in any order, no nulls.
    Repeated edges and those from a node to itself change nothing; without edges there are no rows.

    Each task first reduces its own edges to a forest. A round then points every node at its smallest neighbour below it,
    links its other ones to that, and shortens paths by one jump; the numbers only fall, so rounds end when none changes.
    """
    a, b = edges.columns
    low = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("node"), F.least(a, b).alias("root"))
    forest = store.write(low.mapInArrow(_forest, "node long, root long").distinct(), f"{name}_0")
    for k in range(1, most_rounds + 1):
        best = forest.groupBy("node").agg(F.min("root").alias("best"))
        joined = forest.join(best, "node")
        other = joined.where("root <> best").select(F.col("root").alias("node"), F.col("best").alias("root"), F.lit(True).alias("changed"))
        parents = best.select("node", F.col("best").alias("root"), F.lit(False).alias("changed"))
        jumps = best.select(F.col("node").alias("root"), F.col("best").alias("further"))
        step = parents.unionByName(other).join(jumps, "root", "left")
        step = step.select("node", F.coalesce("further", "root").alias("root"), (F.col("changed") | F.col("further").isNotNull()).alias("changed"))
        step = step.groupBy("node", "root").agg(F.max("changed").alias("changed"))
        done = store.write(step, f"{name}_{k}")
        changed = done.where("changed").limit(1).count()
        store.drop(f"{name}_{k - 1}")
        forest = done.select("node", "root")
        if not changed:
            return forest
    raise RuntimeError(f"components didn't settle in {most_rounds} rounds")
