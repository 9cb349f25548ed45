"""Column expressions used by feature builders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip(x: Column, low: Column | float | None = None, high: Column | float | None = None) -> Column:
    """Clamp ``x``; null stays null (``greatest`` and ``least`` would skip it)."""
    out = x
    if high is not None:
        out = F.least(out, high if isinstance(high, Column) else F.lit(high))
    if low is not None:
        out = F.greatest(out, low if isinstance(low, Column) else F.lit(low))
    return F.when(x.isNotNull(), out)


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0 or either side is null."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def monomial(columns: Sequence[Column]) -> Column:
    """Product of the columns, nulls taken as 0."""
    out = None
    for c in columns:
        filled = F.coalesce(c.cast("double"), F.lit(0.0))
        out = filled if out is None else out * filled
    return out


def min_max(x: Column, low: Column, high: Column) -> Column:
    """Scale to [0, 1]; 0.5 where all scores are equal."""
    return F.when(high > low, (x - low) / (high - low)).when(x.isNotNull(), F.lit(0.5))


def softmax(logits: Column) -> Column:
    """Probabilities of an array of logits, shifted by the largest one."""
    shifted = F.transform(logits, lambda v: F.exp(v - F.array_max(logits)))
    total = F.aggregate(shifted, F.lit(0.0), lambda acc, v: acc + v)
    return F.transform(shifted, lambda v: v / total)


def equal_width_stage(value: Column, low: Column, high: Column, stages: int = 5) -> Column:
    """Stage by equal-width bins, 0 = highest values; a value on an inner edge takes the worse stage."""
    width_index = F.ceil((value - low) * F.lit(stages) / (high - low))
    stage = F.lit(stages) - F.greatest(F.least(width_index, F.lit(stages)), F.lit(1))
    return F.when(high > low, stage).otherwise(F.lit(stages - 1)).cast("int")


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)


def distance(a: Column, b: Column, metric: str = "euclidean") -> Column:
    """Distance of two numeric arrays; the cosine distance is 1 if either norm is 0."""
    if metric == "euclidean":
        squares = F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2.0)))
        return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, v: acc + v))
    if metric == "manhattan":
        gaps = F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double")))
        return F.aggregate(gaps, F.lit(0.0), lambda acc, v: acc + v)
    if metric == "cosine":
        norms = F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b))
        return F.when(norms == 0, F.lit(1.0)).otherwise(1.0 - F.try_divide(_dot(a, b), norms))
    raise ValueError(f"unknown metric {metric!r}: use euclidean, manhattan or cosine")


METRICS = ("euclidean", "manhattan", "cosine")
