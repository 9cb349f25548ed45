"""Tables the phases hand to each other, written once per application to the shared folder.

Every phase reads the table before it instead of recomputing the chain, and a lost executor costs one
read. The key holds size and time of the source's files, so changed data is staged again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearcurve.layout import CONTIGUOUS
from wearcurve.operators import labels, risk
from wearcurve.sources.stand_ins import event_series, lineitem_series
from wearcurve.sources.tables import materialize, path_exists, scratch_path

_STAGED: dict[tuple, tuple[str, DataFrame]] = {}


def _stamp(spark: SparkSession, path: str) -> tuple:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.getFileStatus(target).isDirectory():
        status = files.getFileStatus(target)
        return status.getLen(), status.getModificationTime()
    parts = list(files.listStatus(target))
    return len(parts), sum(p.getLen() for p in parts), max((p.getModificationTime() for p in parts), default=0)


class Tables:
    """The source tables of one folder and the phase tables made from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _staged(self, name: str, source: str, build: Callable[[], DataFrame]) -> DataFrame:
        stamp = _stamp(self.spark, f"{self.sf_dir}/{source}.parquet")
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name, stamp)
        known = _STAGED.get(key)
        if known is None or not path_exists(self.spark, known[0]):
            path = scratch_path(self.spark, name)
            known = (path, materialize(build(), name, path))
            _STAGED[key] = known
        return known[1]

    @property
    def series(self) -> DataFrame:
        return self._staged("series", "events", lambda: event_series(self.spark, self.sf_dir))

    @property
    def lines(self) -> DataFrame:
        return self._staged("lines", "lineitem", lambda: lineitem_series(self.spark, self.sf_dir))

    @property
    def labelled(self) -> DataFrame:
        """The event series with remaining life, stages, the label and stand-in predictions."""

        def build() -> DataFrame:
            rows = labels.rul_stages(labels.train_rul(self.series, CONTIGUOUS), CONTIGUOUS)
            rows = rows.withColumns(
                {
                    "predicted_stage": (F.floor("sensor_1") % 5).cast("int"),
                    "cluster": ((F.col("time_cycles") * 7 + F.col("sensor_2").cast("int")) % 5).cast("int"),
                    "dataset_id": F.concat(F.lit("FD00"), (1 + F.col("unit_number") % 4).cast("string")),
                }
            )
            rows = labels.time_to_next_stage(rows, CONTIGUOUS)
            label = F.col("time_to_next_stage")
            return rows.withColumns(
                {
                    "predicted_time_to_next_stage": F.col("sensor_2"),
                    "pred_a": label + F.col("sensor_2") / 100,
                    "pred_b": label * 0.9,
                }
            )

        return self._staged("labelled", "events", build)

    @property
    def assessed(self) -> DataFrame:
        """The labelled series with risk scores, levels and alerts by fleet-wide dynamic thresholds."""

        def build() -> DataFrame:
            scored = risk.score_risk(self.labelled)
            return risk.assign_levels(scored, risk.dynamic_thresholds(scored, "normalized_urgency"))

        return self._staged("assessed", "events", build)
