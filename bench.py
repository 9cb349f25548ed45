"""Time the headline queries and print one JSON line.

The staged tables (``series``, ``labelled``, ``assessed``) are built first and timed as queries of their
own; the others read them. After a warm-up each query is run once and its rows are written to the no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from wearcurve.plans import registry
from wearcurve.plans.staged import Tables

HEADLINE = [
    "series_of_events",
    "series_of_lineitems",
    "C1_train_rul",
    "C7_time_to_next_stage",
    "H6_rul_stages",
    "E3_rolling",
    "E3_rolling_lines",
    "E6_running_lines",
    "E7_crossovers",
    "E9_sequences",
    "B8_scale_robust",
    "B9_scale_per_unit_standard",
    "D1_sensor_profile_lines",
    "D5_stage_statistics",
    "L3_time_series_splits",
    "L5_unit_sample",
    "I3_anova",
    "I4_mutual_information",
    "C4_ward_links",
    "J4_J5_J6_unit_cluster_quality",
    "J10_error_distribution",
    "K7_score_table",
    "K11_dynamic_thresholds",
    "K12_best_threshold",
    "K15_unit_report",
    "M1_preparation",
    "M5_risk_metrics",
    "I6_clusters_of_units",
    "I13_ridge_predictions",
    "I5_oversample",
    "I9_random_forest",
    "I14_random_forest_regressor",
    "M2_stages",
    "M3_classification",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("wearcurve-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}

    def timed(name, action):
        begin = time.time()
        action()
        timings[name] = round(time.time() - begin, 3)

    # start the task threads and compile the common code once, outside the measured time
    warm = spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type").count()
    warm.write.format("noop").mode("overwrite").save()
    tables = Tables(spark, sf_dir)
    for name in ("series", "lines", "labelled", "assessed"):
        timed(f"stage_{name}", lambda name=name: getattr(tables, name))
    known = registry.load_all()
    for name in HEADLINE:
        build = registry.runnable(known[name])
        timed(name, lambda build=build: build(spark, sf_dir).write.format("noop").mode("overwrite").save())
    spark.stop()
    line = {
        "metric": "headline_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
