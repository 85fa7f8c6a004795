"""Headline queries, timed. Prints one JSON line.

Where a query of ``verification`` also checks what it made, the product itself is timed: the checks run
in the tests. BENCH_REPEATS (1) repetitions are run of each and their median is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

HEADLINES = [
    "feature_table",
    "active_policies",
    "eda_payment_status",
    "upsert_new_keys",
    "threshold_sweep",
    "calibration",
    "stratified_split",
    "adjusted_rand",
    "policy_detail",
    "lr_scores",
    "segments",
    "score_batch",
]


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lapsewise")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def products() -> dict:
    """Headline queries by name: ``(spark, folder) -> DataFrame``."""
    from lapsewise.operators import models
    from lapsewise.plans import scoring, segmentation, training
    from lapsewise.plans.features import build_active_feature_table, build_feature_table
    from verification.order_history import billing_tables
    from verification.queries import QUERIES

    def score_batch(spark, folder):
        tables = billing_tables(spark, folder)
        trained = training.train(build_feature_table(tables), models.random_forest())
        return scoring.score_policies(trained.model, build_active_feature_table(tables)).scores

    return {
        **QUERIES,
        "lr_scores": lambda spark, folder: training.held_out_scores(training.train(build_feature_table(billing_tables(spark, folder)))),
        "segments": lambda spark, folder: segmentation.build_segments(billing_tables(spark, folder)),
        "score_batch": score_batch,
    }


def main() -> None:
    queries = products()
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session()
    # one untimed query over the smallest tables, so that no timing includes starting the engine
    smallest = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    queries["feature_table"](spark, smallest if os.path.isdir(smallest) else folder).collect()
    seconds: dict[str, float] = {}
    for name in HEADLINES:
        taken = []
        for _ in range(repeats):
            began = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(taken), 3)
    print(
        json.dumps(
            {
                "metric": "total_wall_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
