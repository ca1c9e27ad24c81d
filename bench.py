"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and then three times; the median counts. Results go to Spark's no-op sink,
so every row and column is computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dialogeval.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "flagship",
    "rouge_l",
    "rouge_l_unstemmed",
    "stem_vocabulary",
    "bert_score",
    "bert_score_joined",
    "extract_entities",
    "entity_scores",
    "evaluate_outputs",
    "leaderboard",
    "build_training_set",
    "mix_corpora",
    "mix_corpora_eval",
    "prepare_eval_prompts",
    "batch_generate",
    "batch_generate_predictor",
    "dedup_exact",
    "wide_to_long",
    "long_to_wide",
    "identical_outputs",
    "train_test_split_exact",
    "range_slice",
    "range_slice_ranked",
    "human_eval_sheet",
    "describe_scores",
    "mean_by_model",
    "win_counts",
]


def run(query, spark, folder) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        # Text costs far more time per byte than the default partition size of 1 MB assumes.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128KB")
        # Do not record a Python stack for every column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        run(QUERIES[name], spark, folder)
        seconds[name] = round(statistics.median(run(QUERIES[name], spark, folder) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
