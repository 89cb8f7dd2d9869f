"""Mixing sources to target weights by iterative proportional fitting.

Token weights are raked to source, language and topic marginals: each margin in turn scales its values to their target
shares, until all hold. A document's weight is the product of its values' factors. Divided by the largest product, it is the
probability with which the document is sampled, so no document is taken twice and the best wanted ones are all taken.

Target shares are given by the user; a margin without given ones flattens the corpus' own shares a little. So are topics: by
default a text's topic is what it looks like, which any column of another classifier can replace.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import Store

#: Up to so many cells (combinations of values) the driver rakes them itself; more are raked as a table.
MOST_CELLS = 100_000


@dataclass(frozen=True)
class Targets:
    """shares: a margin's target shares, by value; values that they leave out get nothing. temper: a margin without given
    shares has its own token shares to this power. topic: a text's topic. rounds and close: when raking ends."""

    temper: dict[str, float] = field(default_factory=lambda: {"source": 0.85, "lang": 0.9, "topic": 0.9})
    shares: dict[str, dict[str, float]] = field(default_factory=dict)
    topic: Callable[[Column], Column] | None = None
    rounds: int = 100
    close: float = 1e-9

    @property
    def margins(self) -> list[str]:
        return sorted({*self.temper, *self.shares})


def tokens_of(text: Column) -> Column:
    """Runs of characters other than ASCII white space."""
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def topic_of(text: Column) -> Column:
    """What a text looks like: rows of a table, strewn symbols, license wording, prose, or nothing."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return (
        F.when(text == "", F.lit("empty")).when(F.contains(text, F.lit(" | ")), F.lit("table"))
        .when(text.rlike(r"[#$%&*]{3}"), F.lit("symbols")).when(F.contains(text, F.lit("icense")), F.lit("license")).otherwise(F.lit("prose"))
    )


def targets_of(values: list[str], tokens: np.ndarray, margin: str, t: Targets) -> np.ndarray:
    """Target shares of a margin's values."""
    if margin in t.shares:
        want = np.array([t.shares[margin].get(v, 0.0) for v in values])
    else:
        want = np.where(tokens > 0, np.power(np.maximum(tokens, 1e-300), t.temper[margin]), 0.0)
    return want / want.sum() if want.sum() else want


def rake(cells: list[tuple], t: Targets) -> dict[str, dict[str, float]]:
    """Factors by margin and value. cells: (a value for each margin, tokens). Values without tokens keep a factor of 1."""
    tokens = np.array([c[-1] for c in cells], float)
    weight = tokens / max(tokens.sum(), 1.0)
    names = [sorted({c[m] for c in cells}) for m in range(len(t.margins))]
    at = [np.searchsorted(np.array(n), [c[m] for c in cells]) for m, n in enumerate(names)]
    want = [targets_of(n, np.bincount(at[m], tokens, len(n)), t.margins[m], t) for m, n in enumerate(names)]
    factors = [np.ones(len(n)) for n in names]
    for _ in range(t.rounds):
        worst = 0.0
        for m, own in enumerate(at):
            now = np.bincount(own, weight, len(names[m]))
            scale = np.where(now > 0, want[m] / np.where(now > 0, now, 1), 1.0)
            worst = max(worst, float(np.abs(now - want[m])[now > 0].max(initial=0)))
            factors[m] *= scale
            weight = weight * scale[own]
        if worst <= t.close:
            break
    return {m: dict(zip(n, f.tolist(), strict=True)) for m, n, f in zip(t.margins, names, factors, strict=True)}


def rake_table(cells: DataFrame, t: Targets, store: Store) -> dict[str, DataFrame]:
    """The same as tables (value, factor), for any number of cells. Each step writes the cells' weights anew and drops those of
    the step before; factors are of the size of a margin."""
    margins = t.margins
    targets, factors = {}, {}
    for m in margins:
        sums = cells.groupBy(m).agg(F.sum("tokens").alias("tokens"))
        if m in t.shares:
            given = cells.sparkSession.createDataFrame(list(t.shares[m].items()), f"`{m}` string, want double")
            want = sums.join(given, m, "left").withColumn("want", F.coalesce("want", F.lit(0.0)))
        else:
            want = sums.withColumn("want", F.when(F.col("tokens") > 0, F.pow("tokens", F.lit(t.temper[m]))).otherwise(0.0))
        total = want.agg(F.sum("want")).first()[0] or 1.0
        targets[m] = store.write(want.select(m, (F.col("want") / total).alias("want")), f"want_{m}")
        factors[m] = store.write(targets[m].select(m, F.lit(1.0).alias("factor")), f"factor_{m}_0")
    total = float(cells.agg(F.sum("tokens")).first()[0] or 1)
    weight, last = cells.select(*margins, (F.col("tokens") / total).alias("weight")), None
    for k in range(1, t.rounds + 1):
        worst = 0.0
        for m in margins:
            now = weight.groupBy(m).agg(F.sum("weight").alias("now")).join(targets[m], m)
            scale = store.write(now.select(m, "now", "want", F.when(F.col("now") > 0, F.col("want") / F.col("now")).otherwise(1.0).alias("scale")), f"scale_{m}_{k}")
            worst = max(worst, scale.where("now > 0").agg(F.max(F.abs(F.col("now") - F.col("want")))).first()[0] or 0.0)
            factors[m] = store.write(factors[m].join(scale, m).select(m, (F.col("factor") * F.col("scale")).alias("factor")), f"factor_{m}_{k}")
            name = f"weight_{m}_{k}"
            weight = store.write(weight.join(scale.select(m, "scale"), m).select(*margins, (F.col("weight") * F.col("scale")).alias("weight")), name)
            store.drop(f"factor_{m}_{k - 1}", f"scale_{m}_{k}", *([last] if last else []))
            last = name
        if worst <= t.close:
            break
    return factors


def drawn(doc_id: Column, seed: int = 17) -> Column:
    """A number from 0 to 1 that an id always gets."""
    return F.pmod(F.xxhash64(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(seed)), F.lit(1 << 53)) / float(1 << 53)


def _marked(docs: DataFrame, t: Targets, id_col: str, text_col: str) -> list[Column]:
    """A document's id and its values."""
    text = docs[text_col]
    topic = (t.topic or topic_of)(text)
    return [docs[id_col].alias("doc_id"), *[F.coalesce(c.cast("string"), F.lit("")).alias(m) for m, c in (("source", docs["source"]), ("lang", docs["lang"]), ("topic", topic))]]


def probabilities(cells: DataFrame, t: Targets, store: Store) -> DataFrame:
    """(source, lang, topic, probability) of cells (source, lang, topic, tokens), a written table."""
    if cells.count() <= MOST_CELLS:
        made = rake([tuple(c) for c in cells.select(*t.margins, "tokens").collect()], t)
        factors = {m: cells.sparkSession.createDataFrame([(k, v) for k, v in f.items()], f"`{m}` string, factor double") for m, f in made.items()}
    else:
        factors = rake_table(cells, t, store)
    weighed, product = cells, F.lit(1.0)
    for m in t.margins:
        weighed = weighed.join(factors[m].withColumnRenamed("factor", f"factor_{m}"), m)
        product = product * F.col(f"factor_{m}")
    weighed = store.write(weighed.select(*t.margins, product.alias("factor")), "weighed")
    most = weighed.agg(F.max("factor")).first()[0] or 0.0
    return weighed.select(*t.margins, (F.col("factor") / most if most else F.lit(0.0)).alias("probability"))


def _with_probability(rows: DataFrame, weighed: DataFrame, t: Targets) -> DataFrame:
    few = weighed.count() <= MOST_CELLS
    out = rows.join(F.broadcast(weighed) if few else weighed, t.margins)
    return out.withColumn("sampled", drawn(F.col("doc_id")) < F.col("probability"))


def sample(docs: DataFrame, t: Targets = Targets(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, source, lang, topic, tokens, probability, sampled): every row of docs, and how it is sampled. Texts are read
    once.

    A null source or lang is the value "". Texts without tokens don't weigh, but are sampled by their values' factors. Rows
    that share an id are sampled together, up to their probabilities; null ids count as one. If all targets are 0, nothing is
    sampled; an empty table stays empty. Other columns are not looked at.
    """
    store = Store(docs.sparkSession, "mixing")
    rows = store.write(docs.select(*_marked(docs, t, id_col, text_col), tokens_of(docs[text_col]).alias("tokens")), "rows")
    cells = store.write(rows.groupBy(*t.margins).agg(F.sum("tokens").alias("tokens")), "cells")
    out = _with_probability(rows, probabilities(cells, t, store), t)
    return out.select("doc_id", "source", "lang", "topic", "tokens", "probability", "sampled")


def mixed(docs: DataFrame, t: Targets = Targets(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that sample would sample, as they came; see there for null and repeated values and empty tables.

    Tokens are counted in a first pass over texts; a second one deals with whole rows. No column's name matters but those of
    id, text, source and lang."""
    store = Store(docs.sparkSession, "mixing")
    counted = docs.select(*_marked(docs, t, id_col, text_col), tokens_of(docs[text_col]).alias("tokens"))
    cells = store.write(counted.groupBy(*t.margins).agg(F.sum("tokens").alias("tokens")), "cells")
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), *_marked(docs, t, id_col, text_col))
    kept = _with_probability(rows, probabilities(cells, t, store), t).where("sampled")
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
