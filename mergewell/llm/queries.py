"""The registered queries of this folder: each applies one operator to its whole table. SQL has those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_parts, exact_dedup, license_scan, mixing, suffix_automaton, token_store, toxicity, url_rules, warc_chain
from .ngram_join import Measure, near_duplicates
from .store import read_table

#: Path of the tokenizer that op3 and the pipeline use.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: op5's rules: host, path, verdict.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
#: The conversation that op7 adds: a template must keep its control strings apart from its own.
ADDED = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_warc_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_chain.archive_round_trip(read_table(spark, sf_dir, "pages"))


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store_round_trip(read_table(spark, sf_dir, "documents"), token_store.Format(TOKENIZER, added=True))


def op4_suffix_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_automaton.hits(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), window=10)


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge(pages, rules, default="allow").select("row.page_id", "host", "path", "rule", "verdict")


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), Measure(width=3, num=90, den=100))


def op7_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame(ADDED, "conv_id long, turn long, role string, text string")
    return chat_parts.read_back(chat_parts.format_turns(turns.unionByName(added)))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read_table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(read_table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.sample(read_table(spark, sf_dir, "documents")).withColumn("probability", F.round("probability", 9))


def license_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op9 says of the phrases alone, which SQL can say too."""
    return op9_license_scan(spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def mixing_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op10 finds in each document before it rakes."""
    return op10_mixing(spark, sf_dir).select("doc_id", "source", "lang", "topic", "tokens")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_warc_chain": op2_warc_chain,
    "op3_token_store": op3_token_store,
    "op4_suffix_automaton": op4_suffix_automaton,
    "op5_url_rules": op5_url_rules,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_chat_parts": op7_chat_parts,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_license_scan": op9_license_scan,
    "op10_mixing": op10_mixing,
    "license_phrases": license_phrases,
    "mixing_values": mixing_values,
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER.format('coalesce(text, chr(32))')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_ESCAPED = "replace(replace(replace(coalesce({}, ''), chr(92), chr(92) || chr(92)), '<', chr(92) || '<'), '[', chr(92) || '[')"
_FIXED = len(chat_parts.TURN) + len(chat_parts.CLOSE) + len(chat_parts.END)

SQL: dict[str, str] = {
    "op2_warc_chain": f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages),
        q AS (SELECT *, sha256(html) AS payload_digest, CASE WHEN payload_bytes >= {warc_chain.LEAST_BYTES} THEN min(page_id) OVER (PARTITION BY html) END AS least FROM p)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN least <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN least <> page_id THEN least END AS refers_to
        FROM q""",
    "op4_suffix_automaton": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
        g AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS gram
              FROM (SELECT item, w, least(10, len(w)) AS n, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS i FROM b WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT n FROM g),
        runs AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
               FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
        hit AS (SELECT doc_id, n, i, item FROM runs JOIN g USING (n, gram)),
        place AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY doc_id),
        item AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN place USING (doc_id) LEFT JOIN item USING (doc_id)""",
    "op5_url_rules": f"""
        WITH u AS (SELECT page_id, {_LOWER.format("regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's')")} AS host,
                          regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages),
        r(h, p, v) AS (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)}),
        m AS (SELECT page_id, h || p AS rule, v, row_number() OVER (PARTITION BY page_id ORDER BY length(h) DESC, length(p) DESC) AS k
              FROM u JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
        SELECT u.page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM u LEFT JOIN m ON m.page_id = u.page_id AND k = 1""",
    "op6_ngram_jaccard_join": f"""
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS gram
              FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 2))) AS i FROM d WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
        link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
        reach AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT x, b FROM reach JOIN link ON y = a)
        SELECT x AS doc_id, coalesce(any_value(n), 0) AS n_shingles, min(y) AS component_id FROM reach LEFT JOIN n ON n.doc_id = x GROUP BY x""",
    "op7_chat_parts": f"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(length({_ESCAPED.format("text")}) + length({_ESCAPED.format("role")}) + {_FIXED}) AS BIGINT) AS formatted_chars,
               CAST(0 AS BIGINT) AS n_attachments, CAST(0 AS BIGINT) AS attached_tokens
        FROM c GROUP BY conv_id""",
    "license_phrases": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        p(label, phrase) AS (VALUES {", ".join(f"('{label}', {phrase.split(' ')!r})" for label, phrase in license_scan.PHRASES)}),
        h AS (SELECT doc_id, i - 1 AS place, label FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS i FROM d), p WHERE w[i:i + len(phrase) - 1] = phrase),
        s AS (SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM h GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels
        FROM d LEFT JOIN s USING (doc_id)""",
    "mixing_values": r"""
        SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
               CASE WHEN coalesce(text, '') = '' THEN 'empty' WHEN contains(text, ' | ') THEN 'table' WHEN regexp_matches(text, '[#$%&*]{3}') THEN 'symbols'
                    WHEN contains(text, 'icense') THEN 'license' ELSE 'prose' END AS topic,
               CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS tokens
        FROM documents""",
    "op8_exact_dedup": r"""
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents)
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = min(doc_id) OVER same AS kept, sha256(text) AS text_sha256
        FROM t WINDOW same AS (PARTITION BY text)""",
}
