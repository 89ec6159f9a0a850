"""Rank a corpus from the command line:

    spark-submit ... quillrank/__main__.py --queries Q --articles A --output O

Every location may come from the environment instead.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from quillrank import RankOptions, Workspace, rank_files
from quillrank.functions.text import TokenRules
from quillrank.sinks.packed import write_packed_report
from quillrank.sinks.report import write_ranking, write_report


def main(argv: list[str] | None = None) -> None:
    # Variables and defaults that existing callers set or rely on.
    parser = argparse.ArgumentParser(prog="quillrank")
    parser.add_argument("--queries", default=os.environ.get("BIGDATA_QUERIES", "data/queries.list"))
    parser.add_argument("--articles", default=os.environ.get("BIGDATA_NEWS"))
    parser.add_argument("--output", default=os.environ.get("BIGDATA_RESULTS", "results/"))
    parser.add_argument("--master", default=os.environ.get("SPARK_MASTER"), help="left to spark-submit if not given")
    parser.add_argument("--k", type=int, default=10)
    parser.add_argument("--no-stem", action="store_true")
    parser.add_argument("--stem-table", help="folder in which stems are kept over runs")
    parser.add_argument("--body-passes", type=int, default=1, choices=(1, 2))
    parser.add_argument("--ratio", default="real", choices=("real", "integer"))
    parser.add_argument("--include-unmatched", action="store_true")
    parser.add_argument("--stopwords", help="a file with one word per line instead of the English list")
    parser.add_argument("--max-token-length", type=int)
    parser.add_argument("--max-token-digits", type=int)
    parser.add_argument("--max-token-repeats", type=int)
    parser.add_argument("--max-paragraphs", type=int, default=5)
    parser.add_argument("--min-title-distance", type=float, default=0.5)
    parser.add_argument("--rejects", help="where lines that are no article go; without it they fail the job")
    parser.add_argument("--packed", action="store_true", help="few large report files with an index instead of a folder per query")
    parser.add_argument("--rows", help="write the ranking as Parquet there as well")
    parser.add_argument("--work", help="folder for work tables that all executors share; spark.checkpoint.dir if not given")
    args = parser.parse_args(argv)
    if not args.articles:
        parser.error("--articles or BIGDATA_NEWS is needed")

    builder = SparkSession.builder.appName("quillrank")
    if args.master:
        builder = builder.master(args.master)
    spark = builder.getOrCreate()
    options = RankOptions(
        stopword_table=args.stopwords,
        rules=TokenRules(args.max_token_length, args.max_token_digits, args.max_token_repeats),
        max_paragraphs=args.max_paragraphs,
        min_title_distance=args.min_title_distance,
        k=args.k,
        stem=not args.no_stem,
        stem_table=args.stem_table,
        body_passes=args.body_passes,
        ratio=args.ratio,
        include_unmatched=args.include_unmatched,
    )
    with Workspace(spark, args.work) as workspace:
        ranking = workspace.save(rank_files(spark, args.queries, args.articles, options, workspace, args.rejects), "ranking")
        if args.packed:
            write_packed_report(ranking, args.output, workspace)
        else:
            write_report(ranking, args.output)
        if args.rows:
            write_ranking(ranking, args.rows)


if __name__ == "__main__":
    main()
