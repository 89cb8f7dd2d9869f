"""Command line: look a name up, answer names from standard input, run the pipeline, or write sample data."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .plans import lookup, pipeline
from .sources import entities, links, sample


def run_lookup(spark: SparkSession, folder: str, name: str, limit: int, threshold: float) -> str:
    records = entities.read_lookup(spark, folder)
    return lookup.report(lookup.lookup(records, name, limit, threshold).collect())


def run_pipeline(spark: SparkSession, folder: str, out: str, threshold: float | None) -> int:
    read = lambda split: tuple(entities.read_source(spark, f"{folder}/{split}_source{k}.tsv", f"s{k}") for k in (1, 2, 3))
    truth = entities.read_delimited(spark, f"{folder}/train_ground_truth.tsv")
    issues = pipeline.run(read("train"), links.link_pairs(truth), read("test"), out, threshold, links.header(truth)).limit(100).collect()
    for issue in issues:
        print(*issue, sep="\t")
    return int(bool(issues))


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="mergewell", description=__doc__)
    parser.add_argument("--data-dir", default="data")
    parser.add_argument("--output-dir", default="output")
    parser.add_argument("--threshold", type=float)
    parser.add_argument("--limit", type=int, default=5)
    parser.add_argument("--lookup", metavar="NAME")
    parser.add_argument("--interactive", action="store_true", help="ask for names until a blank one; so does a call without other modes")
    parser.add_argument("--pipeline", action="store_true")
    parser.add_argument("--create-sample-data", action="store_true", help="write sample data first; alone, run the pipeline on it")
    a = parser.parse_args(argv)
    spark = SparkSession.builder.appName("mergewell").getOrCreate()
    if a.create_sample_data:
        sample.write(spark, a.data_dir)
    threshold = lookup.DEFAULT_THRESHOLD if a.threshold is None else a.threshold
    if a.lookup is not None:
        print(run_lookup(spark, a.data_dir, a.lookup, a.limit, threshold))
    elif a.pipeline or (a.create_sample_data and not a.interactive):
        return run_pipeline(spark, a.data_dir, a.output_dir, a.threshold)
    else:
        while name := input("Name: ").strip():
            print(run_lookup(spark, a.data_dir, name, a.limit, threshold))
    return 0


if __name__ == "__main__":
    sys.exit(main())
