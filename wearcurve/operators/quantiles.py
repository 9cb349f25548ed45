"""Exact percentiles with linear interpolation, for groups of any size.

Spark's own exact ``percentile`` keeps every distinct value of a group in one buffer. Here a sketch
first brackets each wanted rank. One more pass keeps the values inside a bracket and only counts those
between brackets, so what has to be ordered in one place is about 4 / accuracy of the group. Groups of
up to ``small`` rows are kept whole. A bracket that misses its rank fails the job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 100_000
SMALL = 1_000_000
_SALTS = 64
_NEG_INF = "double('-Infinity')"
_POS_INF = "double('Infinity')"


def _array_sql(values: Sequence[float]) -> str:
    return "array(" + ", ".join(f"{float(v)!r}D" for v in values) + ")"


def exact_percentiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int = ACCURACY,
    small: int = SMALL,
) -> DataFrame:
    """Rows (by…, column, prob, value) with the interpolated percentile of the non-null values."""
    by = list(by)
    probs = sorted(float(p) for p in probs)
    entries = ", ".join(f"struct('{c}' AS column, CAST(`{c}` AS DOUBLE) AS value)" for c in columns)
    long = (
        df.selectExpr(*[f"`{c}`" for c in by], f"inline(array({entries}))").where("value IS NOT NULL")
    )
    keys = [*by, "column"]
    margin = 2.0 / accuracy
    marks = [max(0.0, p - margin) for p in probs] + [min(1.0, p + margin) for p in probs]
    sketched = long.groupBy(*keys).agg(
        F.count("value").alias("_n"),
        F.percentile_approx("value", F.lit(marks), accuracy).alias("_marks"),
    )
    probs_sql = _array_sql(probs)
    low = f"transform({probs_sql}, (p, i) -> if(p <= {margin!r}D, {_NEG_INF}, get(_marks, i)))"
    high = f"transform({probs_sql}, (p, i) -> if(p >= {1 - margin!r}D, {_POS_INF}, get(_marks, i + {len(probs)})))"
    # The bracket table is repeated per salt, so that a group with most of the rows is joined by
    # many tasks when the table is too large to be broadcast.
    brackets = sketched.selectExpr(
        *[f"`{k}`" for k in keys],
        f"if(_n <= {small}, array({_NEG_INF}), {low}) AS _lo",
        f"if(_n <= {small}, array({_POS_INF}), {high}) AS _hi",
        f"explode(sequence(0, {_SALTS - 1})) AS _salt",
    )
    if not by:
        # one row per (column, salt): bounded by the argument list, not by the data
        brackets = F.broadcast(brackets)
    salted = long.selectExpr("*", f"CAST(pmod(xxhash64(value), {_SALTS}) AS INT) AS _salt")
    # Brackets are in ascending order. Segment 2i+1 is bracket i, segment 2i the gap before it; the
    # values of a gap share the null value and are only counted.
    named = [f"`{k}`" for k in keys]
    tally = (
        salted.join(brackets, [*keys, "_salt"])
        .selectExpr(*named, "value", "_lo", "size(filter(_hi, h -> h < value)) AS _at")
        .selectExpr(*named, "value", "_at", "coalesce(value >= get(_lo, _at), false) AS _in")
        .selectExpr(*named, "2 * _at + CAST(_in AS INT) AS _seg", "if(_in, value, NULL) AS value")
        .groupBy(*keys, "_seg", "value")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    # both uses of ``tally`` read the same shuffle
    segments = tally.groupBy(*keys, "_seg").agg(F.sum("_c").alias("_sc"))
    # at most 2 * probs + 1 segments per group
    group = Window.partitionBy(*keys)
    before = group.orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    offsets = segments.select(
        *keys,
        "_seg",
        F.coalesce(F.sum("_sc").over(before), F.lit(0)).alias("_off"),
        F.sum("_sc").over(group).alias("_n"),
    )
    upto = Window.partitionBy(*keys, "_seg").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = tally.withColumn("_run", F.sum("_c").over(upto)).join(offsets, [*keys, "_seg"])
    low_rank, high_rank = "floor((_n - 1) * p)", "least(floor((_n - 1) * p) + 1, _n - 1)"
    holds = "{0} >= _off + _run - _c AND {0} < _off + _run"
    low_hits = f"transform(filter({probs_sql}, p -> {holds.format(low_rank)}), p -> struct(p AS prob, 0 AS side))"
    high_hits = f"transform(filter({probs_sql}, p -> {holds.format(high_rank)}), p -> struct(p AS prob, 1 AS side))"
    picked = (
        ranked.selectExpr(*named, "_n", "value", f"inline(concat({low_hits}, {high_hits}))")
        .groupBy(*keys, "prob")
        .agg(
            F.expr("max(value) FILTER (WHERE side = 0) AS _v0"),
            F.expr("max(value) FILTER (WHERE side = 1) AS _v1"),
            F.expr("max((_n - 1) * prob - floor((_n - 1) * prob)) AS _part"),
        )
    )
    failure = "CAST(raise_error('percentile bracket missed its rank') AS DOUBLE)"
    between = "if(_v0 = _v1, _v0, _v0 + (_v1 - _v0) * _part)"
    return picked.selectExpr(*named, "prob", f"if(_v0 IS NULL OR _v1 IS NULL, {failure}, {between}) AS value")
