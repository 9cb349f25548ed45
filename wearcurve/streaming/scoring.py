"""Risk scoring of arriving predictions.

Only the row-wise part of the work runs on a stream: probabilities, times, scores, levels, alerts and
ratio features. The score range and the thresholds are fitted in batch beforehand; rolling features and
labels need a unit's order (and its future) and stay batch work.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wearcurve.functions import risk as rx
from wearcurve.functions.features import clip, min_max
from wearcurve.operators import risk

PREDICTIONS = T.StructType(
    [
        T.StructField("unit_number", T.IntegerType()),
        T.StructField("time_cycles", T.IntegerType()),
        T.StructField("predicted_stage", T.IntegerType()),
        T.StructField("predicted_time_to_next_stage", T.DoubleType()),
    ]
)


@dataclass(frozen=True)
class FittedRisk:
    """Five numbers fitted on past predictions."""

    lowest: float
    highest: float
    high: float
    medium: float
    low: float


def fit_risk(past: DataFrame) -> FittedRisk:
    scored = risk.score_risk(past)
    ends = scored.agg(F.min("urgency_score").alias("lo"), F.max("urgency_score").alias("hi")).first()
    limits = risk.dynamic_thresholds(scored, "normalized_urgency").first()
    return FittedRisk(ends["lo"], ends["hi"], limits["high"], limits["medium"], limits["low"])


def score(rows: DataFrame, fitted: FittedRisk) -> DataFrame:
    """Scores, level and alert of each row; the same on a batch frame and on a stream."""
    scored = risk.add_row_scores(rows)
    normal = min_max(F.col("urgency_score"), F.lit(fitted.lowest), F.lit(fitted.highest))
    level = rx.risk_level(F.col("normalized_urgency"), F.lit(fitted.high), F.lit(fitted.medium), F.lit(fitted.low))
    return (
        scored.withColumn("normalized_urgency", clip(normal, 0.0))
        .withColumn("risk_level", level)
        .withColumn("maintenance_alert", F.col("risk_level") == "HIGH")
    )


def read_predictions(spark: SparkSession, path: str, files_per_trigger: int = 64) -> DataFrame:
    """Predictions arriving as Parquet files in a folder."""
    return spark.readStream.schema(PREDICTIONS).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def write_scores(scored: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append scored rows as Parquet; all files present are processed, then the query ends."""
    return (
        scored.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .format("parquet")
        .start(path)
    )
