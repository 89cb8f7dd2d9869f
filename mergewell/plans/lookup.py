"""Is there a record with a similar name? One projection over all records, then a top-k; nothing is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import normalize_name, tokens
from ..functions.similarity import gram_codes, jaccard, jaro_winkler, set_jaccard

DEFAULT_THRESHOLD = 0.60
#: What a name alone gives for an address: half for unknown words, nothing for places.
ADDRESS_PART = 0.30 * 0.45 * 0.5


def clamp(c: Column) -> Column:
    return F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))


def name_score(query: Column, name: Column, query_grams: Column | None = None) -> Column:
    """Score of two normalised names. Without a fitted corpus there is no TF-IDF part, so equal names reach 0.6625.
    query_grams: the query's coded trigrams, if they are at hand."""
    words = jaccard(tokens(query), tokens(name))
    grams = set_jaccard(gram_codes(query) if query_grams is None else query_grams, gram_codes(name))
    return clamp(0.70 * clamp(0.40 * jaro_winkler(query, name) + 0.25 * words + 0.20 * grams) + ADDRESS_PART)


def lookup(records: DataFrame, name: str, limit: int = 5, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """(business_name, source, score, is_match): the records with the best scores, of equal rounded ones the first loaded.

    records: name, source_tag and load_pos. A blank name finds nothing. is_match looks at the score before rounding."""
    if not name.strip():
        records = records.limit(0)
    asked = records.sparkSession.range(1).select(normalize_name(F.lit(name)).alias("q")).select("q", gram_codes(F.col("q"))).first()  # a few words
    query, grams = F.lit(asked[0]), F.array(*map(F.lit, asked[1])).cast("array<bigint>")
    known = records.where(F.col("id") != "query").withColumn("norm_name", normalize_name(F.col("name")))
    scored = known.withColumn("raw", name_score(query, F.col("norm_name"), grams))
    hits = scored.select(F.col("name").alias("business_name"), F.col("source_tag").alias("source"), F.round("raw", 4).alias("score"), (F.col("raw") >= threshold).alias("is_match"), "load_pos")
    return hits.orderBy(F.desc("score"), "load_pos", "business_name").limit(limit).drop("load_pos")


def report(hits: list) -> str:
    """Lines of a lookup for a console."""
    lines = [f"{'MATCH' if h.is_match else 'NO MATCH':9}{h.score * 100:6.2f} %  {h.business_name} ({h.source})" for h in hits]
    return "\n".join([*lines, "Similar record found." if any(h.is_match for h in hits) else "No similar record."])
