"""Arrow batches for columns of long texts."""

from __future__ import annotations

from pyspark.sql import SparkSession

_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows of a batch: enough to keep Python busy, few enough for texts of some hundred thousand characters.
ROWS = 500


def small_batches(rows: int = ROWS) -> None:
    """Let the session send at most so many rows to Python at once; a smaller setting stays."""
    spark = SparkSession.getActiveSession()
    if spark is not None and not 0 < int(spark.conf.get(_KEY)) <= rows:
        spark.conf.set(_KEY, rows)
