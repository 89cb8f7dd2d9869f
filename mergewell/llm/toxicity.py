"""Toxicity: a classifier of word features that is regularised by counterfactuals.

Counterfactuals of a labelled sentence have its label. Where a sentence has identity terms, they are swapped for others of
their kind; where it has none, a neutral mention of one is put in, and that one is swapped. Changes of score between a
sentence and its counterfactuals are penalised with the training loss. Mentions of a group then carry no weight of their own,
neither as words nor by the beginnings that they share with others, which reduces false positives on neutral ones.

Features are the distinct words of a text and their first bytes, hashed. The model is trained by the driver on a bounded sample
of labelled rows; every text is scored as a whole.
"""

from __future__ import annotations

import gc
import logging
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import Store, bounded_batches
from .textvec import ALNUM, U64, Words, distinct_by_text, give_back, mix, pieces, ragged, released

log = logging.getLogger(__name__)

#: Identity terms; those of one line stand for each other.
IDENTITIES = [
    "muslim muslims christian christians jewish jews hindu hindus buddhist buddhists atheist atheists catholic catholics",
    "black white asian latino hispanic african european arab",
    "american mexican chinese indian german french russian turkish polish nigerian",
    "gay lesbian straight bisexual transgender queer heterosexual",
    "woman women man men girl girls boy boys female male",
    "immigrant immigrants refugee refugees foreigner foreigners native natives",
    "disabled deaf blind autistic",
    "old young elderly",
    "musulman chrétien juif noir blanc étranger femme homme",
    "muslim christ jude schwarzer weißer ausländer frau mann",
    "musulmán cristiano judío negro blanco extranjero mujer hombre",
]


#: Lengths, in bytes, of the beginnings of words that are features.
BEGINNINGS = (4, 6)


@dataclass(frozen=True)
class Training:
    """sample: the most labelled rows that are learnt from, those first by a hash of their id. features: hashed features.
    rows_each: a feature is learnt for each so many rows. least: rows that a learnt feature is in, and no fewer than one in
    `rare`. decay: the weight of squared weights. swapped: that of score changes under swaps. swaps: counterfactuals of a
    text. most: the features of all learnt rows together, so that the driver's memory is bounded however long texts are;
    rows beyond it, by the hash of their features, are not learnt from."""

    sample: int = 12_000
    features: int = 1 << 18
    rows_each: int = 4
    least: int = 3
    rare: int = 1_200
    decay: float = 0.3
    swapped: float = 1.0
    swaps: int = 3
    most: int = 20_000_000
    rounds: int = 40


def word_features(words: Words) -> np.ndarray:
    """A row for each word: its hash, and those of its beginnings, 0 where it is shorter."""
    size, out = words.ends - words.starts, [words.hashes]
    for n in BEGINNINGS:
        value = np.zeros(len(words), U64)
        long = np.flatnonzero(size >= n)
        for j in range(n):
            value[long] = (value[long] << U64(8)) | words.data[words.starts[long] + j].astype(U64)
        value[long] = mix(value[long] * U64(16) + U64(n)) | U64(1)
        out.append(value)
    return np.stack(out, 1)


def _words_of(text: str) -> Words:
    data = np.frombuffer(text.encode(), np.uint8)
    return Words(data, np.array([0, len(data)]), ALNUM)


def identity_sets() -> list[np.ndarray]:
    """Features of the identity terms, a line each."""
    return [word_features(_words_of(line)) for line in IDENTITIES]


def _features(column: pa.Array, n: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, Words]]:
    """Rows lo to hi, their distinct features and how many each has."""
    for lo, hi, data, offsets in pieces(column):
        words = Words(data, offsets, ALNUM)
        every, of = word_features(words), words.text_of
        held = every != 0
        number = (every[held] % U64(n)) << U64(10)  # the bits that number texts
        feature, of = distinct_by_text(number, np.broadcast_to(of[:, None], every.shape)[held], hi - lo)
        yield lo, hi, feature.astype(np.int64), np.bincount(of, minlength=hi - lo), words


def counterfactuals(every: np.ndarray, sets: list[np.ndarray], swaps: int) -> list[np.ndarray]:
    """Copies of a text's word features with each identity term swapped for another of its kind; none without such terms."""
    which = {int(h): (k, i) for k, line in reversed(list(enumerate(sets))) for i, h in enumerate(line[:, 0])}
    places = [(p, *which[h]) for p, h in enumerate(every[:, 0].tolist()) if h in which]
    if not places:
        return []
    out = []
    for s in range(1, swaps + 1):
        other = every.copy()
        for p, k, i in places:
            step = 1 + int(mix(np.array([s * 1009 + k], U64))[0] % U64(len(sets[k]) - 1))
            other[p] = sets[k][(i + step) % len(sets[k])]
        out.append(other)
    return out


def mentions(lines: list[list[list[int]]], own: np.ndarray, seed: int, swaps: int) -> list[list[int]]:
    """Score changes of a text without identity terms, whose features are own, in ascending order: between it and itself with
    one more word, an identity term, and between it with that term and with another of its kind. lines: terms' features."""
    chosen = []
    for s in range(swaps):
        line = lines[(seed >> 7 * s) % len(lines)]
        first = (seed >> 5 * s + 3) % len(line)
        chosen.append((line[first], line[(first + 1 + (seed >> 3 * s + 11) % (len(line) - 1)) % len(line)]))
    wanted = np.array([f for pair in chosen for term in pair for f in term], np.int64)
    at = np.minimum(np.searchsorted(own, wanted), max(0, len(own) - 1))
    there = set(wanted[own[at] == wanted].tolist()) if len(own) else set()
    out = []
    for one, other in chosen:
        out.append([-f - 1 for f in one if f not in there])
        out.append([f + 1 for f in one if f not in there and f not in other] + [-f - 1 for f in other if f not in there and f not in one])
    return [x for x in out if x]


def _sampled(t: Training) -> Callable:
    """Features of labelled texts, and of their counterfactuals: +f for what the text alone has, -f for the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = identity_sets()
        marked = np.unique(np.concatenate([line[:, 0] for line in sets]))
        lines = [[np.unique(row[row != 0] % U64(t.features)).astype(np.int64).tolist() for row in line] for line in sets]
        for batch in batches:
            for lo, hi, feature, sizes, words in _features(batch.column(1), t.features):
                near = np.minimum(np.searchsorted(marked, words.hashes), len(marked) - 1)
                has = set(words.text_of[marked[near] == words.hashes].tolist())
                changes: list[list[list[int]]] = [[] for _ in range(hi - lo)]
                begin = np.concatenate([[0], np.cumsum(sizes)])
                for r in range(hi - lo):
                    own = feature[begin[r] : begin[r + 1]]
                    if r not in has:
                        changes[r] = mentions(lines, own, int(own.sum()) * 0x9E3779B97F4A7C15 % (1 << 61), t.swaps)
                        continue
                    every = word_features(words)[words.first[r] : words.first[r + 1]]
                    for x in counterfactuals(every, sets, t.swaps):
                        new = np.unique(x[x != 0] % U64(t.features)).astype(np.int64)
                        changes[r].append([*(np.setdiff1d(own, new) + 1).tolist(), *(-np.setdiff1d(new, own) - 1).tolist()])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), ragged(feature.astype(np.int32), sizes, pa.int32()), pa.array(changes, pa.list_(pa.list_(pa.int32())))], names=["toxic", "features", "changes"])

    return run


def _sparse(rows: list) -> tuple[np.ndarray, np.ndarray]:
    """Values of rows one after the other, and the number of the row of each."""
    flat = np.concatenate([np.zeros(0, np.int32), *(np.asarray(r, np.int32) for r in rows)])
    return flat, np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])


def telling(col: np.ndarray, positive: np.ndarray, y: np.ndarray, t: Training) -> np.ndarray:
    """Which features are learnt: those whose rows' labels differ most from all rows'."""
    df, hit = np.bincount(col, minlength=t.features), np.bincount(col[np.asarray(positive, bool)], minlength=t.features)
    share, enough = y.mean(), df >= max(t.least, len(y) // t.rare)
    chi = np.where(enough, (hit - df * share) ** 2 / np.maximum(df * share * (1 - share), 1e-9), -1)
    kept = np.zeros(t.features, bool)
    kept[np.argsort(-chi, kind="stable")[: max(20, len(y) // t.rows_each)]] = True
    return kept & enough


def fit(y: np.ndarray, features: list, changes: list[list], t: Training) -> np.ndarray:
    """Weights of the features, and the intercept last: those that minimise the log loss, the squares of weights, and the
    squares of score changes by counterfactuals. Both labels count as much in all. Without both, there is only the prior."""
    y, n = np.asarray(y, float), len(y)
    prior = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if n else 1e-3
    w = np.zeros(t.features + 1)
    w[-1] = np.log(prior / (1 - prior))
    if len(np.unique(y)) < 2:
        return w
    col, row = _sparse(features)
    kept = telling(col, y[row] > 0.5, y > 0.5, t)
    number = (np.cumsum(kept) - 1).astype(np.int32)
    n_kept = int(kept.sum())
    learnt = kept[col]
    col, row = number[col[learnt]], row[learnt]
    del learnt
    swaps = [c for of_row in changes for c in of_row]
    at, of = _sparse(swaps)
    sign, at = np.sign(at).astype(float), np.abs(at) - 1
    sign, at, of = sign[kept[at]], number[at[kept[at]]], of[kept[at]]
    share = np.where(y > 0.5, n / (2 * (y > 0.5).sum()), n / (2 * (y <= 0.5).sum()))

    def cost(w: np.ndarray) -> tuple[float, np.ndarray]:
        z = np.clip(np.bincount(row, w[col], n) + w[-1], -30, 30)
        error = share * (1 / (1 + np.exp(-z)) - y)
        loss = (share * (np.logaddexp(0, z) - y * z)).sum() + t.decay * (w[:-1] @ w[:-1]) / 2
        g = np.append(np.bincount(col, error[row], n_kept) + t.decay * w[:-1], error.sum())
        if len(swaps):
            d = np.bincount(of, sign * w[at], len(swaps))
            loss += t.swapped * (d @ d) / 2
            g[:-1] += t.swapped * np.bincount(at, sign * d[of], n_kept)
        return float(loss), g

    found = _lbfgs(cost, np.append(np.zeros(n_kept), 0.0), t.rounds)
    w[:-1][kept], w[-1] = found[:-1], found[-1]
    return w


def _lbfgs(cost: Callable, w: np.ndarray, rounds: int, memory: int = 8) -> np.ndarray:
    """Limited-memory quasi-Newton descent with halved steps."""
    f, g = cost(w)
    s_list: list[np.ndarray] = []
    y_list: list[np.ndarray] = []
    for _ in range(rounds):
        q, alphas = g.copy(), []
        for s, y in zip(reversed(s_list), reversed(y_list), strict=True):
            a = s @ q / (y @ s)
            alphas.append(a)
            q -= a * y
        q *= s_list[-1] @ y_list[-1] / (y_list[-1] @ y_list[-1]) if s_list else 1 / max(1.0, np.abs(g).max())
        for (s, y), a in zip(zip(s_list, y_list, strict=True), reversed(alphas), strict=True):
            q += s * (a - y @ q / (y @ s))
        step, slope = 1.0, g @ q
        if slope <= 0:
            break
        while True:
            new = w - step * q
            f2, g2 = cost(new)
            if f2 <= f - 1e-4 * step * slope or step < 1e-8:
                break
            step /= 2
        s, y = new - w, g2 - g
        done = abs(f - f2) <= 1e-7 * max(1.0, abs(f))
        w, f, g = new, f2, g2
        if s @ y > 1e-12:
            s_list, y_list = [*s_list[-memory + 1 :], s], [*y_list[-memory + 1 :], y]
        if done:
            break
    return w


def held_out(doc_id: Column) -> Column:
    """Rows that labels aren't learnt from; a null id counts as empty text, whose remainder is 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def examples(docs: DataFrame, labels: DataFrame, t: Training) -> tuple[np.ndarray, list, list[list]]:
    """Labels, features and counterfactual changes of the rows that are learnt from, which aren't held out.

    Repeated labels of an id count as their mean; null ones as none. A bounded sample: see Training."""
    spark = docs.sparkSession
    store = Store(spark, "toxicity")
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.avg("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(t.sample)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")  # at most t.sample rows
    rows = texts.select("toxic", "text").mapInArrow(released(_sampled(t)), "toxic double, features array<int>, changes array<array<int>>")
    rows = store.write(rows.withColumn("place", F.xxhash64("features")), "examples")
    # An id may have several rows; so many at most are learnt from, and so many as have the most features together.
    sizes = rows.select("place", "toxic", F.size("features").alias("n")).orderBy("place", "toxic").limit(2 * t.sample).toArrow()
    held = int(np.searchsorted(np.cumsum(np.asarray(sizes["n"], np.int64)), t.most, side="right"))
    found = rows.orderBy("place", "toxic").limit(held).drop("place").toArrow().combine_chunks()
    features = found["features"].combine_chunks() if found.num_rows else pa.array([], pa.list_(pa.int32()))
    offsets, flat = np.asarray(features.offsets), np.asarray(features.values)
    changes = found["changes"].to_pylist()
    store.drop("examples")
    log.info("%s labelled rows, %s counterfactual pairs", found.num_rows, sum(map(len, changes)))
    return found["toxic"].to_numpy(), [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)], changes


def train(docs: DataFrame, labels: DataFrame, t: Training) -> np.ndarray:
    """Weights from labelled rows that aren't held out."""
    w = fit(*examples(docs, labels, t), t)
    gc.collect()
    give_back()  # the driver goes on to live too
    return w


def _scorer(weights, n: int) -> Callable:  # noqa: ANN001
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        w = weights.value
        try:
            for texts in batches:
                scores = [np.zeros(0)]
                for lo, hi, feature, sizes, _ in _features(texts, n):
                    z = np.bincount(np.repeat(np.arange(hi - lo), sizes), w[feature], hi - lo) + w[-1]
                    scores.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
                yield pa.array(np.concatenate(scores))
        finally:
            give_back()

    return F.arrow_udf(run, "double").asNondeterministic()  # else a filter on the score would score again


def score(docs: DataFrame, weights: np.ndarray, text_col: str = "text") -> DataFrame:
    """(row, score): every row of docs as it came, and the chance from 0 to 1 that label 1 fits its text.

    Only texts go to Python. Null and empty ones get the intercept's score; repeated rows get equal scores."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float64))  # 8 bytes a feature, whatever the texts
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    return docs.select(row, _scorer(shared, len(weights) - 1)(docs[text_col].cast("string")).alias("score"))


def classify(docs: DataFrame, labels: DataFrame, t: Training = Training(), threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of docs, and of no others.

    Null and empty texts get the intercept's score, and rows that repeat get equal ones. A null id is not held out and has no
    label. Without labels of both kinds, or without any, all scores are the labels' share. Only doc_id and text are looked at,
    whatever other columns are called."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels, t))
    return scored.select(F.col("row.doc_id").alias("doc_id"), held_out(F.col("row.doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, t: Training = Training(), threshold: float = 0.3) -> DataFrame:
    """docs without the rows whose score reaches the threshold. Null and empty texts stay, as their score is the intercept's,
    unless most labels are toxic; rows that repeat stay or go together; columns may have any names."""
    kept = score(docs, train(docs, labels, t)).where(F.col("score") < threshold)
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
