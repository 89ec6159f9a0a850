"""Time the headline queries; prints one JSON line. A time is the median of three runs.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores (default 8). The sample tables are
single files of one row group, which one task would read; they are copied into one file per core first, as a corpus of any
size has more files than that.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from registry.queries import QUERIES

RUNS = 3
HEADLINE = (
    "ranked_top10",
    "ranked_top10_stemmed",
    "ranked_top10_body_passes2",
    "ranked_include_unmatched_integer_ratio",
    "ranked_all",
    "dph_scores",
    "term_frequencies",
    "collection_tf",
    "corpus_stats",
    "tokenize",
    "articles_scan",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    with tempfile.TemporaryDirectory(prefix="bench-") as scratch:
        run(folder, cpus, scratch)


def run(folder: str, cpus: str, scratch: str) -> None:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for table in ("documents", "benchmark"):
        spark.read.parquet(f"{folder}/{table}.parquet").repartition(int(cpus)).write.parquet(f"{scratch}/{table}.parquet")
    QUERIES["query_terms"](spark, scratch).collect()  # start Parquet and code generation once
    seconds = {}
    for key in HEADLINE:
        runs = []
        for _ in range(RUNS):
            start = time.perf_counter()
            QUERIES[key](spark, scratch).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[key] = round(statistics.median(runs), 3)
    spark.stop()
    match, score = seconds["collection_tf"], seconds["dph_scores"]
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "phases": {"match": match, "score": round(score - match, 3), "select": round(seconds["ranked_top10"] - score, 3)},
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
