"""Row-wise risk expressions; they hold no state, so they work on batch and streaming frames alike."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wearcurve.functions.features import clip

FAILURE_STAGE = 4

# Fixed values
STAGE_PROBABILITY = {0: 0.1, 1: 0.3, 2: 0.5, 3: 0.8, 4: 1.0}
TIME_HORIZON = 100.0
EPSILON = 1e-6
CYCLES_PER_STAGE = 30.0
EXTRA_STAGE_FACTOR = 0.8
DEFAULT_THRESHOLDS = {"high": 0.6, "medium": 0.3, "low": 0.1}
DYNAMIC_PERCENTILES = {"high": 0.85, "medium": 0.60, "low": 0.30}


def _nonnegative(x: Column) -> Column:
    """max(0, x) with null and NaN taken as 0."""
    return F.greatest(F.lit(0.0), F.nanvl(x.cast("double"), F.lit(0.0)))


def failure_probability(stage: Column, stages_total: int = FAILURE_STAGE) -> Column:
    """Quadratic growth with the stage, 1 from the failure stage on."""
    s = stage.cast("double")
    growth = F.pow(s / F.lit(float(stages_total)), F.lit(2.0)) + F.lit(0.1) * s
    return F.when(s >= stages_total, F.lit(1.0)).otherwise(F.least(F.lit(1.0), growth))


def stage_probability(stage: Column) -> Column:
    """Table lookup; 0 for a stage that is not in the table."""
    s = stage.cast("int")
    out = F.lit(0.0)
    for known, p in STAGE_PROBABILITY.items():
        out = F.when(s == known, F.lit(p)).otherwise(out)
    return out


def time_to_failure(stage: Column, time_to_next: Column, failure_stage: int = FAILURE_STAGE) -> Column:
    """Time to the failure stage when each further stage costs 0.8 of the time to the next one."""
    s = stage.cast("int")
    t = _nonnegative(time_to_next)
    left = F.lit(failure_stage) - s
    return (
        F.when(s >= failure_stage, F.lit(0.0))
        .when(left == 1, t)
        .otherwise(t * (F.lit(1.0) + F.lit(EXTRA_STAGE_FACTOR) * (left - 1)))
    )


def time_to_failure_fixed(
    stage: Column, time_to_next: Column, failure_stage: int = FAILURE_STAGE
) -> Column:
    """Time to the failure stage at a constant 30 cycles per further stage."""
    s = stage.cast("int")
    further = F.lit(failure_stage - 1) - s
    return F.when(s >= failure_stage, F.lit(0.0)).otherwise(
        _nonnegative(time_to_next) + further * F.lit(CYCLES_PER_STAGE)
    )


def horizon_risk(probability: Column, time_left: Column, horizon: float = TIME_HORIZON) -> Column:
    return probability * (F.lit(horizon) / F.greatest(time_left, F.lit(1.0)))


def urgency(probability: Column, time_left: Column, epsilon: float = EPSILON) -> Column:
    return probability / (F.greatest(time_left, F.lit(1.0)) + F.lit(epsilon))


def product_risk(probability: Column, time_left: Column) -> Column:
    return probability * time_left


def calibrated_raw(probability: Column, time_left: Column, max_time: Column, method: str) -> Column:
    if method == "minmax":
        return probability * (max_time - time_left)
    if method == "urgency":
        return probability / (time_left + F.lit(EPSILON))
    raise ValueError(f"unknown method {method!r}: use minmax or urgency")


def calibrated_normal(raw: Column, max_time: Column, method: str) -> Column:
    """The calibration grid spans raw scores from 0 to ``max_time``."""
    if method == "minmax":
        return raw / max_time
    if method == "urgency":
        return clip(raw, 0.0, 1.0)
    raise ValueError(f"unknown method {method!r}: use minmax or urgency")


def risk_level(score: Column, high: Column, medium: Column, low: Column) -> Column:
    s = _nonnegative(score)
    return (
        F.when(s >= high, F.lit("HIGH"))
        .when(s >= medium, F.lit("MEDIUM"))
        .when(s >= low, F.lit("LOW"))
        .otherwise(F.lit("NEGLIGIBLE"))
    )
