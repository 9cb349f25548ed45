"""Risk scores, thresholds, levels and alerts, and the reports built on them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearcurve.functions import risk as rx
from wearcurve.functions.features import clip, min_max
from wearcurve.layout import Layout
from wearcurve.operators.blocks import join_groups, range_parts
from wearcurve.operators.quantiles import exact_percentiles

STAGE = "predicted_stage"
TIME = "predicted_time_to_next_stage"
SCORE_PREFERENCE = ("normalized_urgency", "normalized_risk_score", "urgency_score")
METHODS = ("urgency", "calibrated_minmax", "calibrated_urgency")


def _spread(df: DataFrame) -> list[str]:
    return [c for c in ("unit_number", "time_cycles") if c in df.columns] or df.columns


def score_columns(failure_stage: int = rx.FAILURE_STAGE, stage: str = STAGE, time: str = TIME) -> dict[str, Column]:
    """Row-wise scores, in terms of each other's names: apply them in order."""
    p, t = F.col("failure_probability"), F.col("time_to_failure")
    return {
        "failure_probability": rx.failure_probability(F.col(stage)),
        "time_to_failure": rx.time_to_failure(F.col(stage), F.col(time), failure_stage),
        "raw_risk_score": clip(rx.horizon_risk(p, t), 0.0),
        "urgency_score": clip(rx.urgency(p, t), 0.0),
    }


def add_row_scores(df: DataFrame, **options) -> DataFrame:
    columns = score_columns(**options)
    first = {c: columns[c] for c in ("failure_probability", "time_to_failure")}
    second = {c: columns[c] for c in ("raw_risk_score", "urgency_score")}
    return df.withColumns(first).withColumns(second)


def score_risk(df: DataFrame, by: Sequence[str] = (), **options) -> DataFrame:
    """All row scores and ``normalized_urgency``, min-max over the fleet (or over each ``by`` group)."""
    scored = add_row_scores(df, **options)
    u = "urgency_score"
    ranges = scored.groupBy(*by).agg(F.min(u).alias("_ulo"), F.max(u).alias("_uhi"))
    rows = join_groups(scored, ranges, list(by), _spread(df))
    normal = min_max(F.col(u), F.col("_ulo"), F.col("_uhi"))
    return rows.withColumn("normalized_urgency", normal).drop("_ulo", "_uhi")


def calibrate_risk(
    df: DataFrame,
    method: str = "minmax",
    by: Sequence[str] = (),
    train: DataFrame | None = None,
    failure_stage: int = rx.FAILURE_STAGE,
) -> DataFrame:
    """Table-based probability, fixed time per stage, and a score scaled by the longest time in ``train``."""
    rx.calibrated_raw(F.lit(0.0), F.lit(0.0), F.lit(0.0), method)  # rejects an unknown method early
    limits = (df if train is None else train).groupBy(*by).agg(
        F.greatest(F.lit(100.0), F.max("time_cycles") * 2.0).alias("_max_t")
    )
    p, t, max_t = F.col("failure_probability"), F.col("time_to_failure"), F.col("_max_t")
    rows = join_groups(df, limits, list(by), _spread(df)).withColumns(
        {
            "failure_probability": rx.stage_probability(F.col(STAGE)),
            "time_to_failure": rx.time_to_failure_fixed(F.col(STAGE), F.col(TIME), failure_stage),
        }
    )
    rows = rows.withColumn("raw_risk_score", rx.calibrated_raw(p, t, max_t, method))
    normal = rx.calibrated_normal(F.col("raw_risk_score"), max_t, method)
    return rows.withColumn("normalized_risk_score", normal).drop("_max_t")


def compute_scores(
    df: DataFrame, method: str = "urgency", by: Sequence[str] = (), failure_stage: int = rx.FAILURE_STAGE
) -> DataFrame:
    if method == "urgency":
        return score_risk(df, by, failure_stage=failure_stage)
    if method in METHODS:
        return calibrate_risk(df, method.removeprefix("calibrated_"), by, failure_stage=failure_stage)
    raise ValueError(f"unknown risk method {method!r}: use one of {METHODS}")


def score_column(df: DataFrame) -> str:
    for name in SCORE_PREFERENCE:
        if name in df.columns:
            return name
    raise ValueError("no risk score column found")


def fixed_thresholds(df: DataFrame, by: Sequence[str] = (), **values: float) -> DataFrame:
    levels = {**rx.DEFAULT_THRESHOLDS, **values}
    row = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    return row.select(*by, *[F.lit(levels[k]).alias(k) for k in ("high", "medium", "low")])


def dynamic_thresholds(
    df: DataFrame, score: str, by: Sequence[str] = (), defaults: Mapping[str, float] | None = None, **options
) -> DataFrame:
    """The 85th, 60th and 30th percentiles, where strictly decreasing; the defaults elsewhere."""
    levels = {**rx.DEFAULT_THRESHOLDS, **(defaults or {})}
    probs = rx.DYNAMIC_PERCENTILES
    table = exact_percentiles(df, [score], list(probs.values()), by, **options)
    row = table.groupBy(*by).agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(f"_{k}") for k, p in probs.items()]
    )
    usable = (F.col("_high") > F.col("_medium")) & (F.col("_medium") > F.col("_low"))
    return row.select(
        *by,
        *[F.when(usable, F.col(f"_{k}")).otherwise(F.lit(levels[k])).alias(k) for k in probs],
    )


def threshold_curve(df: DataFrame, score: str, failure: Column, beta: float = 1.0) -> DataFrame:
    """Precision, recall and F-beta of alerting at each distinct score or above.

    Equal scores are merged first and written in order, highest first. Each part of the order adds up its own scores,
    and the totals of the parts before it are added, so no task sees all scores and work grows with their number. The
    scores are written before this returns.
    """
    from wearcurve.sources.tables import materialize

    tally = df.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("score")).agg(
        F.sum(failure.cast("long")).alias("_hit"), F.count(F.lit(1)).alias("_n")
    )
    tally = materialize(tally, "scores")
    placed = range_parts(tally, [F.desc("score")])
    sums = placed.groupBy("_part").agg(F.sum("_hit").alias("_bh"), F.sum("_n").alias("_bn"))
    # one row for each part
    higher = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    above = sums.select(
        "_part",
        F.coalesce(F.sum("_bh").over(higher), F.lit(0)).alias("_ah"),
        F.coalesce(F.sum("_bn").over(higher), F.lit(0)).alias("_an"),
    )
    down = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    rows = placed.withColumns({"_ch": F.sum("_hit").over(down), "_cn": F.sum("_n").over(down)}).join(above, "_part")
    total = tally.agg(F.sum("_hit")).scalar()
    hits, alerts = F.col("_ch") + F.col("_ah"), F.col("_cn") + F.col("_an")
    b2 = beta * beta
    precision, recall = F.col("precision"), F.col("recall")
    f_beta = F.lit(1 + b2) * precision * recall / (F.lit(b2) * precision + recall + F.lit(1e-10))
    return rows.select(
        "score",
        (hits / alerts).alias("precision"),
        F.coalesce(F.try_divide(hits, total), F.lit(1.0)).alias("recall"),
    ).withColumn("f_beta", f_beta)


def best_threshold(df: DataFrame, score: str, failure: Column, beta: float = 1.0) -> DataFrame:
    """One row: the score with the best F-beta (the lowest on ties) as ``high``, and what follows from it."""
    curve = threshold_curve(df, score, failure, beta)
    best = curve.agg(F.max(F.struct("f_beta", (-F.col("score")).alias("_neg"))).alias("b"))
    high = -F.col("b._neg")
    return best.select(
        high.alias("high"),
        F.greatest(F.lit(0.1), high * 0.6).alias("medium"),
        F.greatest(F.lit(0.05), high * 0.3).alias("low"),
        F.col("b.f_beta").alias("f_beta"),
    )


def assign_levels(
    df: DataFrame, thresholds: DataFrame, by: Sequence[str] = (), score: str | None = None
) -> DataFrame:
    """``risk_level`` and ``maintenance_alert`` from the preferred score column and a threshold table."""
    name = score or score_column(df)
    levels = thresholds.select(*by, *[F.col(k).alias(f"_t_{k}") for k in ("high", "medium", "low")])
    rows = join_groups(df.withColumn(name, clip(F.col(name), 0.0)), levels, list(by), _spread(df))
    level = rx.risk_level(F.col(name), F.col("_t_high"), F.col("_t_medium"), F.col("_t_low"))
    return (
        rows.withColumn("risk_level", level)
        .withColumn("maintenance_alert", F.col("risk_level") == "HIGH")
        .drop("_t_high", "_t_medium", "_t_low")
    )


def metrics_score(df: DataFrame) -> str:
    return "normalized_risk_score" if "normalized_risk_score" in df.columns else "urgency_score"


def risk_metrics(
    df: DataFrame, thresholds: DataFrame, by: Sequence[str] = (), score: str | None = None, **options
) -> DataFrame:
    """Score statistics, thresholds, alert counts and the share of units with any HIGH row."""
    name = score or metrics_score(df)
    high = F.col("risk_level") == "HIGH"
    # units first: a unit's rows merge on the map side, so the distinct count has no wide state
    per_unit = df.groupBy(*by, "unit_number").agg(
        F.count(name).alias("_n"),
        F.sum(name).alias("_s"),
        F.avg(name).alias("_m"),
        F.var_pop(name).alias("_v"),
        F.min(name).alias("_lo"),
        F.max(name).alias("_hi"),
        F.count_if(high).alias("_alerts"),
    )
    n, mean = F.col("_n"), F.col("_m")
    totals = per_unit.groupBy(*by).agg(
        F.sum("_n").alias("_rows"),
        F.sum(n * F.col("_v")).alias("_within"),
        F.sum(F.col("_s")).alias("_sum"),
        # deviations of unit means around the plain mean of unit means; corrected below
        F.sum(n * mean * mean).alias("_m2"),
        F.min("_lo").alias("min_risk_score"),
        F.max("_hi").alias("max_risk_score"),
        F.count_if(F.col("_alerts") > 0).alias("units_with_high_risk"),
        F.count(F.lit(1)).alias("total_units"),
        F.sum("_alerts").alias("total_high_risk_alerts"),
    )
    fleet_mean = F.col("_sum") / F.col("_rows")
    between = F.greatest(F.col("_m2") - F.col("_rows") * fleet_mean * fleet_mean, F.lit(0.0))
    std = F.sqrt(F.try_divide(F.col("_within") + between, F.col("_rows") - 1))
    median = exact_percentiles(df, [name], [0.5], by, **options).select(*by, F.col("value").alias("median_risk_score"))
    limits = thresholds.select(
        *by, F.col("high").alias("high_risk_threshold"), F.col("medium").alias("medium_risk_threshold")
    )
    rows = join_groups(join_groups(totals, median, list(by), ["total_units"]), limits, list(by), ["total_units"])
    return rows.select(
        *by,
        fleet_mean.alias("mean_risk_score"),
        "median_risk_score",
        std.alias("std_risk_score"),
        "min_risk_score",
        "max_risk_score",
        "high_risk_threshold",
        "medium_risk_threshold",
        "units_with_high_risk",
        "total_units",
        "total_high_risk_alerts",
        (F.col("units_with_high_risk") / F.col("total_units") * 100).alias("percentage_high_risk_units"),
    )


def with_run_time(df: DataFrame) -> DataFrame:
    return df.withColumn("timestamp", F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss"))


# --- reports -----------------------------------------------------------------------------------


def unit_report(df: DataFrame, score: str, layout: Layout, threshold: float = 0.7) -> DataFrame:
    """Scores, cycles and current state of every unit at once."""
    current = F.max_by(
        F.struct(F.col(score).alias("score"), F.col(STAGE).alias("stage"), F.col(TIME).alias("time"), "risk_level"),
        F.col(layout.cycle),
    )
    table = df.groupBy(*layout.unit).agg(
        F.max(score).alias("max_score"),
        F.avg(score).alias("mean_score"),
        current.alias("_now"),
        F.count(F.lit(1)).alias("total_cycles"),
        F.count_if(F.col(score) >= threshold).alias("high_risk_cycles"),
    )
    return table.select(
        *layout.unit,
        "max_score",
        "mean_score",
        F.col("_now.score").alias("current_score"),
        "total_cycles",
        "high_risk_cycles",
        F.col("_now.stage").alias("current_stage"),
        F.col("_now.time").alias("time_to_next_stage"),
        F.col("_now.risk_level").alias("current_level"),
    )


def unit_means(df: DataFrame, score: str, layout: Layout) -> DataFrame:
    return df.groupBy(*layout.unit).agg(F.avg(score).alias("mean_score"))


def top_units(df: DataFrame, score: str, layout: Layout, k: int = 10) -> DataFrame:
    """The k units with the highest mean score, ties by unit."""
    return unit_means(df, score, layout).orderBy(F.desc("mean_score"), *layout.unit).limit(k)


def level_shares(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    from wearcurve.operators.reports import shares

    return shares(df, ["risk_level"], by)


def top_unit_trends(df: DataFrame, score: str, layout: Layout, k: int = 5) -> DataFrame:
    """Score over cycles of the k units with the highest mean score."""
    # k rows
    chosen = F.broadcast(top_units(df, score, layout, k).select(*layout.unit))
    return df.join(chosen, list(layout.unit), "left_semi").select(*layout.unit, layout.cycle, score)


def first_unit_trends(df: DataFrame, score: str, layout: Layout, k: int = 5) -> DataFrame:
    """Score over cycles of the k units with the lowest numbers."""
    # k rows
    chosen = F.broadcast(df.groupBy(*layout.unit).agg(F.lit(1).alias("_")).orderBy(*layout.unit).limit(k).drop("_"))
    return df.join(chosen, list(layout.unit), "left_semi").select(*layout.unit, layout.cycle, score)


def heat_map(df: DataFrame, score: str, layout: Layout, k: int = 10, columns: int = 20) -> DataFrame:
    """Mean score of the top units at every n-th cycle, 0 where a unit has no row, as long rows.

    Cycles whose scores are all 0 are left out before every n-th one is taken; n = cycles // columns.
    """
    from wearcurve.operators.reports import every_nth

    # k rows
    chosen = F.broadcast(top_units(df, score, layout, k).select(*layout.unit))
    cells = (
        df.join(chosen, list(layout.unit), "left_semi")
        .groupBy(*layout.unit, layout.cycle)
        .agg(F.avg(score).alias("mean_score"))
    )
    busy = cells.groupBy(layout.cycle).agg(F.sum("mean_score").alias("_t")).where("_t > 0").select(layout.cycle)
    step = F.greatest(F.lit(1), F.floor(busy.agg(F.count(F.lit(1))).scalar() / columns))
    kept = every_nth(busy, layout.cycle, step)
    # every kept cycle for every chosen unit: at most k rows carry the list of at most 2 * columns cycles
    cycles = kept.agg(F.sort_array(F.collect_list(layout.cycle))).scalar()
    grid = chosen.select(*layout.unit, F.explode(cycles).alias(layout.cycle))
    filled = grid.join(cells, [*layout.unit, layout.cycle], "left")
    return filled.withColumn("mean_score", F.coalesce("mean_score", F.lit(0.0)))


def fleet_totals(df: DataFrame) -> DataFrame:
    """Units, units with any HIGH row, and rows."""
    per_unit = df.groupBy("unit_number").agg(
        F.count(F.lit(1)).alias("_n"), F.bool_or(F.col("risk_level") == "HIGH").alias("_h")
    )
    return per_unit.agg(
        F.count(F.lit(1)).alias("total_units"),
        F.count_if("_h").alias("high_risk_units"),
        F.sum("_n").alias("total_observations"),
    )


def threshold_types(metrics: DataFrame) -> DataFrame:
    """(dataset_id, threshold_type, threshold_value) from a per-dataset metrics table."""
    names = ["high_risk_threshold", "medium_risk_threshold"]
    return metrics.unpivot(["dataset_id"], names, "threshold_type", "threshold_value")
