"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` is the data folder and ``BENCH_CPUS`` the number of cores. Each
query runs once to warm up the JVM and then ``BENCH_RUNS`` times; the best run
counts. Those of ``ONCE`` run once at the end. Rows go to Spark's no-op sink, so nothing but the query is timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from termscope.catalog import all_queries

HEADLINE = (
    "tokenize",
    "doc_terms",
    "category_doc_counts",
    "category_term_doc_freq",
    "term_doc_freq",
    "tagged_counts",
    "join_nt_ntc",
    "chi_square_scores",
    "topk_terms_per_category",
    "topk_terms_per_source",
    "topn_terms_global",
    "category_lines",
    "merged_dictionary",
    "compare_scores",
    "term_set_overlap",
    "scan_reviews_json",
    "term_frequency",
    "vocabulary",
    "idf",
    "tfidf",
    "l2_tfidf",
    "split_counts",
    "best_per_group",
    "main_effects",
    "ml_feature_statistics",
    "ml_selected_terms",
    "feature_pipeline",
)

#: Fits of many short jobs: timed in one run, in a JVM that the others have warmed up.
ONCE = ("svm_quality_predictions", "svm_lang_predictions", "test_f1")


def session(cpus: str) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("termscope-bench")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def run(query, spark: SparkSession, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    names = sys.argv[1:] or (*HEADLINE, *ONCE)
    times = {}
    for name in names:
        if name not in ONCE:
            run(queries[name], spark, sf_dir)
        again = 1 if name in ONCE else runs
        times[name] = round(min(run(queries[name], spark, sf_dir) for _ in range(again)), 3)
    spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_dir.rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
