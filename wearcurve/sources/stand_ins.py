"""Fleet series taken from general business tables, for trials and tests.

Both number a unit's rows by time. Rows are shuffled by (unit, time slice), so a unit with a large
part of all rows is numbered by many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearcurve.operators.blocks import blocked_rank


def event_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One user is one unit, the user's n-th event is cycle n; two sensors, one setting.

    The order is (ts, event_id) and (user, ts) is unique at microseconds, so one (user, minute) slice
    holds at most 60 million rows.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    order = [F.col("ts"), F.col("event_id")]
    ranked = blocked_rank(events, ["user_id"], order, {"_slice": F.date_trunc("minute", "ts")}, "_cycle")
    kinds = ["view", "click", "signup", "purchase"]
    setting = F.lit(4)
    for code, kind in enumerate(kinds):
        setting = F.when(F.col("event_type") == kind, F.lit(code)).otherwise(setting)
    return ranked.select(
        F.col("user_id").cast("int").alias("unit_number"),
        F.col("_cycle").cast("int").alias("time_cycles"),
        setting.cast("double").alias("setting_1"),
        F.col("value").alias("sensor_1"),
        F.get_json_object("props", "$.k").cast("double").alias("sensor_2"),
    )


def lineitem_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One supplier is one unit, ordered by ship date; four sensors.

    Slices are (ship time, range of 2**20 order keys): at most 2**20 orders of one supplier each.
    """
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    order = [F.col(c) for c in ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")]
    slices = {
        "_time": F.col("l_shipdate"),
        "_keys": F.shiftright("l_orderkey", 20),
    }
    ranked = blocked_rank(lines, ["l_suppkey"], order, slices, "_cycle")
    return ranked.select(
        F.col("l_suppkey").cast("int").alias("unit_number"),
        F.col("_cycle").cast("int").alias("time_cycles"),
        F.col("l_quantity").alias("sensor_1"),
        F.col("l_extendedprice").alias("sensor_2"),
        F.col("l_discount").alias("sensor_3"),
        F.col("l_tax").alias("sensor_4"),
    )
