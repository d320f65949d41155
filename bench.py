"""Headline timings: one JSON line.

    BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores (default 8)
    BENCH_RUNS    timed runs per query after one warm-up; the median counts (default 3)
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession

from termloom.plans import queries as registry
from termloom.session import new_path
from termloom.sinks.index_store import write_index
from termloom.sources.tables import TABLE_SPEC, document_docs

HEADLINE = (
    "tokenize",
    "build_postings",
    "doc_freq",
    "all_field_stats",
    "vocabulary",
    "term_vector",
    "postings_lookup",
    "postings_with_df",
    "best_terms_tfxidf",
    "best_terms_all_docs_tf",
    "best_terms_all_docs_df",
    "best_terms_all_docs_tfxidf",
    "cosine_similarity_tfxidf",
    "similar_terms_bin",
    "similar_terms_tf",
    "similar_terms_tfxidf",
    "terms_clusters",
    "write_vocabulary",
)
ONCE = ("merge_partial_indexes", "upsert_documents")


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("termloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()

    def build() -> None:
        write_index(document_docs(spark, sf_dir), TABLE_SPEC, new_path(spark, "bench"))

    build()
    seconds: dict[str, float] = {}
    seconds["write_index"] = statistics.median(timed(build) for _ in range(runs))
    registry.corpus(spark, sf_dir)
    for name in HEADLINE:
        run(queries[name](spark, sf_dir))
        samples = [timed(lambda: run(queries[name](spark, sf_dir))) for _ in range(runs)]
        seconds[name] = statistics.median(samples)
    for name in ONCE:
        seconds[name] = timed(lambda: run(queries[name](spark, sf_dir)))

    result = {
        "metric": "total seconds of the headline queries, median of warm runs",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {name: round(value, 3) for name, value in seconds.items()},
        "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
