"""Candidate pairs by shared blocking keys: keys that too many targets have are dropped, then each record keeps its best."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import set_jaccard

#: Words that make no key.
STOPWORDS = [
    "the", "and", "of", "in", "at", "for", "on", "by", "a", "an", "to",
    "llc", "inc", "ltd", "corp", "co", "company", "pvt", "limited",
]
#: A key that more targets have is dropped; a record has at most so many candidates.
MAX_POSTINGS, MAX_CANDIDATES = 1500, 60


def key_tokens(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: ~t.isin(STOPWORDS) & (F.length(t) >= 2))


def longest_token(tokens: Column) -> Column:
    """The first of the longest; null if there is none."""
    most = F.array_max(F.transform(tokens, F.length))
    return F.get(F.filter(tokens, lambda t: F.length(t) == most), F.lit(0))


def key_array(name: Column, tokens: Column, zip_code: Column, country: Column) -> Column:
    """A record's keys in order: name prefix, first word, postal code and longest word, each within its country, if there
    is one, and then without."""
    words = key_tokens(tokens)
    first, longest = F.get(words, F.lit(0)), longest_token(words)
    wanted = [
        ("PRE", F.left(name, F.lit(3)), F.length(name) >= 3),
        ("TOK", first, F.length(first) >= 3),
        ("ZIP", zip_code, F.length(zip_code) >= 3),
        ("LONG", longest, (F.size(words) >= 2) & (F.length(longest) >= 4)),
    ]
    keys = []
    for kind, value, ok in wanted:
        keys.append(F.when(ok & (country != ""), F.concat(F.lit(f"C_{kind}::"), country, F.lit("::"), value)))
        keys.append(F.when(ok, F.concat(F.lit(f"{kind}::"), value)))
    return F.array_compact(F.array(*keys))


def block_keys(entities: DataFrame) -> DataFrame:
    """(key, id) of normalised entities."""
    keys = key_array(F.col("norm_name"), F.col("name_tokens"), F.col("norm_zip"), F.col("norm_country"))
    return entities.select(F.explode(keys).alias("key"), "id")


def posting_counts(keys: DataFrame) -> DataFrame:
    return keys.groupBy("key").agg(F.count("*").alias("postings"))


def prune_keys(keys: DataFrame, most: int = MAX_POSTINGS) -> DataFrame:
    """Keys' rows without those of keys that more than `most` rows have."""
    return keys.join(posting_counts(keys).where(F.col("postings") <= most), "key", "left_semi")


def candidate_hits(s1_keys: DataFrame, target_keys: DataFrame, most: int = MAX_POSTINGS) -> DataFrame:
    """(s1_id, target_id, hits): pairs that share keys, and how many. target_keys are pruned; s1_keys needn't be."""
    kept = prune_keys(target_keys, most)
    pairs = s1_keys.select("key", F.col("id").alias("s1_id")).join(kept.select("key", F.col("id").alias("target_id")), "key")
    return pairs.groupBy("s1_id", "target_id").agg(F.count("*").alias("hits"))


def pre_scores(hits: DataFrame, s1: DataFrame, targets: DataFrame) -> DataFrame:
    """hits with pre_score: two for each shared key and five times the Jaccard similarity of name words."""
    left = s1.select(F.col("id").alias("s1_id"), F.array_distinct("name_tokens").alias("ta"))
    right = targets.select(F.col("id").alias("target_id"), F.array_distinct("name_tokens").alias("tb"))
    score = 2.0 * F.col("hits") + 5.0 * set_jaccard(F.col("ta"), F.col("tb"), 0.0)
    return hits.join(left, "s1_id").join(right, "target_id").select("s1_id", "target_id", "hits", score.alias("pre_score"))


def top_candidates(scored: DataFrame, most: int = MAX_CANDIDATES) -> DataFrame:
    """Each record's best candidates by pre_score; of equal ones the first by target id."""
    best = Window.partitionBy("s1_id").orderBy(F.desc("pre_score"), "target_id")
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most).drop("rank")


def candidates(s1: DataFrame, targets: DataFrame, most_postings: int = MAX_POSTINGS, most: int = MAX_CANDIDATES) -> DataFrame:
    """(s1_id, target_id, hits, pre_score) of normalised entities."""
    hits = candidate_hits(block_keys(s1), block_keys(targets), most_postings)
    return top_candidates(pre_scores(hits, s1, targets), most)


def with_positives(pairs: DataFrame, positives: DataFrame, s1: DataFrame, targets: DataFrame) -> DataFrame:
    """Distinct pairs, and the known links among them or not, whose records both exist."""
    known = positives.join(targets.select(F.col("id").alias("target_id")), "target_id", "left_semi")
    known = known.join(s1.select(F.col("id").alias("s1_id")), "s1_id", "left_semi")
    return pairs.select("s1_id", "target_id").union(known.select("s1_id", "target_id")).distinct()


def label_pairs(pairs: DataFrame, positives: DataFrame) -> DataFrame:
    """pairs with label 1 for known links, else 0."""
    known = positives.select("s1_id", "target_id").distinct().withColumn("label", F.lit(1))
    return pairs.join(known, ["s1_id", "target_id"], "left").withColumn("label", F.coalesce("label", F.lit(0)))
