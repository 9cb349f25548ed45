"""Remaining life, stages from remaining life, and the time to the next stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wearcurve.functions.features import equal_width_stage
from wearcurve.layout import BLOCK, Layout
from wearcurve.operators.blocks import attach, block_carry, block_window, join_units, unit_table


def train_rul(df: DataFrame, layout: Layout, out: str = "RUL") -> DataFrame:
    """Remaining life when every unit runs to failure: its last cycle minus this cycle."""
    rows = attach(df, layout, _last=F.max(layout.cycle))
    return rows.withColumn(out, F.col("_last") - F.col(layout.cycle)).drop("_last")


def test_rul(df: DataFrame, known: DataFrame, layout: Layout, out: str = "RUL") -> DataFrame:
    """Remaining life when it is known at each unit's last cycle; ``known`` is (unit…, RUL).

    Both per-unit tables are joined first, then brought to the rows.
    """
    ends = unit_table(df, layout, F.max(layout.cycle).alias("_last"))
    ends = ends.join(known.select(*layout.unit, F.col("RUL").alias("_known")), list(layout.unit), "left")
    rows = join_units(df, ends, layout)
    return rows.withColumn(out, F.col("_known") + F.col("_last") - F.col(layout.cycle)).drop(
        "_known", "_last"
    )


def rul_stages(
    df: DataFrame, layout: Layout, stages: int = 5, rul: str = "RUL", out: str = "true_stage"
) -> DataFrame:
    """Stage by equal-width bins of the unit's own remaining-life range, 0 = most life left."""
    rows = attach(df, layout, _rul_lo=F.min(rul), _rul_hi=F.max(rul))
    stage = equal_width_stage(F.col(rul), F.col("_rul_lo"), F.col("_rul_hi"), stages)
    return rows.withColumn(out, stage).drop("_rul_lo", "_rul_hi")


def time_to_next_stage(
    df: DataFrame,
    layout: Layout,
    stage: str = "predicted_stage",
    rul: str = "RUL",
    out: str = "time_to_next_stage",
    stages: int | None = 5,
) -> DataFrame:
    """Cycles until the unit next shows the following stage, its remaining life if it never does.

    For each stage one running minimum looks ahead inside the block; the first occurrence in later
    blocks is carried over. ``stages`` is the number of stages; None reads it from the data with one
    small aggregation. Never negative; rows without a label are dropped.
    """
    if stages is None:
        stages = int(df.agg(F.max(stage)).first()[0]) + 1
    had_block = BLOCK in df.columns
    at = {k: F.when(F.col(stage) == k, F.col(layout.cycle)) for k in range(1, stages)}
    partial = {f"_f{k}": F.min(cond) for k, cond in at.items()}
    merge = {f"_l{k}": F.min(f"_f{k}") for k in at}
    rows = block_carry(df, layout, partial, merge, forward=False)
    ahead = block_window(layout).rowsBetween(1, Window.unboundedFollowing)
    following = F.lit(None)
    for k, cond in at.items():
        nearest = F.coalesce(F.min(cond).over(ahead), F.col(f"_l{k}"))
        following = F.when(F.col(stage) == k - 1, nearest).otherwise(following)
    label = F.coalesce(following - F.col(layout.cycle), F.col(rul))
    label = F.when(label.isNotNull(), F.greatest(label, F.lit(0)))
    out_rows = rows.withColumn(out, label.cast("double")).drop(*merge).na.drop(subset=[out])
    return out_rows if had_block else out_rows.drop(BLOCK)
