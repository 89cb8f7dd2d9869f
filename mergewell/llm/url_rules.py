"""URL filters by a sort-merge range join: rules are intervals of reversed-host keys, a sorted sweep keeps a stack of them.

A host's key is its labels from last to first, each followed by a full stop: "a.example.org" is "org.example.a.". The keys
of a host and all its subdomains are those that begin with its own, which is an interval. Hosts of rules are nested or
disjoint, so while a sweep passes over sorted keys, the rules that hold there form a stack. A url then looks from the top
of the stack downwards for the longest path that its own begins with.

Urls are dealt into ranges by (key, path, id), so a host with very many urls falls into several. A rule goes to each range
that its interval meets; a range therefore has the rules that it needs from its start, and nothing is broadcast.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that range limits are drawn from, for each range.
DRAWN = 50
#: Most bytes of a key, and characters of a path, in a range's limit.
LIMIT_BYTES = 200


def host_of(url: Column) -> Column:
    """From after the first :// up to /, ?, # or the end, A to Z lower-cased; empty without ://, and for null."""
    host = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ?, # or the end."""
    return F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def key_of(host: Column) -> Column:
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit(".")))


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rules and urls of ranges, sorted by range, key and kind (rules first). Out: each url's row with its rule."""
    stack: list[tuple[bytes, dict[str, tuple[str, str]], list[int]]] = []
    part = None
    for batch in batches:
        rows, rules, verdicts = [], [], []
        columns = [batch.column(c).to_pylist() for c in ("part", "key", "kind", "path", "rule", "verdict")]
        for i, (at, key, kind, path, rule, verdict) in enumerate(zip(*columns, strict=True)):
            if at != part:
                part, stack = at, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if kind == 0:
                if not stack or stack[-1][0] != key:
                    stack.append((key, {}, []))
                _, paths, lengths = stack[-1]
                old = paths.get(path)
                paths[path] = (rule, "block" if old and old[1] == "block" else verdict)
                lengths[:] = sorted({len(p) for p in paths}, reverse=True)
                continue
            hit = next((paths[path[:n]] for _, paths, lengths in reversed(stack) for n in lengths if path[:n] in paths), (None, None))
            rows.append(i)
            rules.append(hit[0])
            verdicts.append(hit[1])
        yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(rows, pa.int64())), batch.column("host").take(pa.array(rows, pa.int64())), batch.column("path").take(pa.array(rows, pa.int64())), pa.array(rules, pa.string()), pa.array(verdicts, pa.string())], names=["row", "host", "path", "rule", "verdict"])


def _dealt(limits: list[tuple[bytes, str, int]]) -> Callable:
    """The range of each url: limits are the ranges' first (key, path, tie)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = zip(batch.column("key").to_pylist(), batch.column("path").to_pylist(), batch.column("tie").to_pylist(), strict=True)
            parts = pa.array([bisect_left(limits, x) for x in places], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, parts], names=[*batch.schema.names, "part"])

    return run


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", url_col: str = "url", ranges: int | None = None) -> DataFrame:
    """(row, host, path, rule, verdict) of every row of pages: the row as it came, and the rule that fits its url.

    rules: (host, path, verdict), verdict allow or block. A rule fits its host and all subdomains where the url's path
    begins with the rule's. The longest wins: the one with the longer host, then with the longer path. Of rules that are
    equal, block wins. rule is host and path as one string; without a rule it is null and the verdict is the default. Null
    urls and urls without :// have neither host nor path. Rules without a host, or null in a column, fit nothing. Rows that
    repeat are judged each; an empty table stays empty; other columns, whatever they are called, stay inside row.
    """
    spark = pages.sparkSession
    ranges = ranges or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    url = pages[url_col]
    urls = pages.select(F.struct(*[pages[f"`{c}`"] for c in pages.columns]).alias("row"), host_of(url).alias("host"), path_of(url).alias("path"))
    urls = urls.withColumn("key", F.encode(key_of(F.col("host")), "utf-8")).withColumn("tie", F.xxhash64("row"))
    # Any limits give right results, so long keys and paths are cut short before the driver gets them.
    places = urls.select(F.substring("key", 1, LIMIT_BYTES).alias("key"), F.left("path", F.lit(LIMIT_BYTES)).alias("path"), "tie")
    drawn = places.orderBy(F.xxhash64("key", "path", "tie"), "tie").limit(DRAWN * ranges).orderBy("key", "path", "tie").collect()
    limits = sorted((bytes(r.key), r.path, r.tie) for r in drawn[DRAWN::DRAWN]) if len(drawn) > DRAWN else []
    row = urls.schema["row"].dataType.simpleString()
    dealt = urls.mapInArrow(_dealt(limits), f"row {row}, host string, path string, key binary, tie long, part int")
    dealt = dealt.select("part", "key", F.lit(1).alias("kind"), "path", "tie", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"), "row", "host")
    known = rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL AND host <> ''").select("host", "path", "verdict").distinct()
    known = known.select(F.encode(key_of(F.col("host")), "utf-8").alias("key"), F.lit(0).alias("kind"), "path", F.lit(0).cast("long").alias("tie"), F.concat("host", "path").alias("rule"), "verdict", F.lit(None).cast(row).alias("row"), "host")
    # A rule's interval goes from its key to just before its key with the last full stop as a slash.
    first = F.udf(lambda k: bisect_left(limits, (bytes(k), "", -(2**63))), "int")
    last = F.udf(lambda k: bisect_left(limits, (bytes(k)[:-1] + b"/", "", -(2**63))), "int")
    placed = known.withColumn("part", F.explode(F.sequence(first("key"), last("key")))).select(*dealt.columns)
    both = dealt.unionByName(placed).repartitionById(ranges, F.col("part")).sortWithinPartitions("part", "key", "kind", "path", "tie")
    swept = both.mapInArrow(_sweep, f"row {row}, host string, path string, rule string, verdict string")
    return swept.withColumn("verdict", F.coalesce("verdict", F.lit(default)))
