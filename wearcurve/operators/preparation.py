"""Cleaning and scaling. Everything fitted is a small DataFrame or a scalar subquery of one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearcurve.functions.features import clip
from wearcurve.layout import Layout
from wearcurve.operators import features
from wearcurve.operators.blocks import attach, join_units, unit_table, with_row
from wearcurve.operators.quantiles import exact_percentiles

# Fixed values
MIN_VARIANCE = 0.001
OUTLIER_DEVIATIONS = 5.0

METHODS = ("minmax", "standard", "robust", "none")


def nan_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in columns})


def drop_short_units(df: DataFrame, layout: Layout, min_rows: int) -> DataFrame:
    sized = attach(df, layout, _rows=F.count(F.lit(1)))
    return sized.where(F.col("_rows") >= min_rows).drop("_rows")


def keep_units(df: DataFrame, units: DataFrame, layout: Layout) -> DataFrame:
    """Rows of the listed units. A fleet with one giant unit is joined on (unit, block)."""
    wanted = units.select(*layout.unit).distinct()
    present = unit_table(df, layout).join(wanted, list(layout.unit), "left_semi")
    return join_units(df, present, layout, "inner")


def medians(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return exact_percentiles(df, columns, [0.5], by).drop("prob")


def _one_row(long: DataFrame, columns: Sequence[str], value: str = "value") -> DataFrame:
    """One row with a field per column from rows (column, value)."""
    return long.agg(
        *[F.max(F.when(F.col("column") == c, F.col(value))).alias(f"c{i}") for i, c in enumerate(columns)]
    )


def impute_medians(df: DataFrame, columns: Sequence[str], train: DataFrame | None = None) -> DataFrame:
    """Fill nulls with the medians of ``train`` (of the frame itself if not given)."""
    rows = with_row(df, _one_row(medians(df if train is None else train, columns), columns), "_fit")
    return rows.withColumns(
        {c: F.coalesce(F.col(c), F.col(f"_fit.c{i}")) for i, c in enumerate(columns)}
    ).drop("_fit")


def cap_outliers(
    df: DataFrame,
    columns: Sequence[str],
    train: DataFrame | None = None,
    deviations: float = OUTLIER_DEVIATIONS,
) -> DataFrame:
    """Clip to mean ± ``deviations`` sample deviations of ``train``."""
    fitted = (df if train is None else train).agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(columns)],
    )
    out = {}
    for i, c in enumerate(columns):
        mean, reach = F.col(f"_fit.m{i}"), F.col(f"_fit.s{i}") * deviations
        out[c] = clip(F.col(c), mean - reach, mean + reach)
    return with_row(df, fitted, "_fit").withColumns(out).drop("_fit")


def variances(df: DataFrame, columns: Sequence[str], sample: bool) -> DataFrame:
    """Rows (column, variance), from one aggregation over all columns."""
    measure = F.var_samp if sample else F.var_pop
    row = df.agg(*[measure(c).alias(c) for c in columns])
    return row.unpivot([], list(columns), "column", "variance")


def scalable_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns worth scaling: sample variance above 0.001."""
    return variances(df, columns, sample=True).where(F.col("variance") > MIN_VARIANCE)


def varying_columns(df: DataFrame, columns: Sequence[str], threshold: float = MIN_VARIANCE) -> DataFrame:
    """Columns whose population variance exceeds ``threshold`` over the whole fleet."""
    return variances(df, columns, sample=False).where(F.col("variance") > threshold)


def column_names(selected: DataFrame) -> list[str]:
    """Names of a (column, …) table, in order; as many as the input has columns at most."""
    return [r["column"] for r in selected.select("column").collect()]


def _scale_aggregates(method: str, c: str, i: int) -> list[Column]:
    if method == "minmax":
        return [F.min(c).alias(f"a{i}"), (F.max(c) - F.min(c)).alias(f"b{i}")]
    if method == "standard":
        return [F.avg(c).alias(f"a{i}"), F.stddev_pop(c).alias(f"b{i}")]
    raise ValueError(f"unknown scaling method {method!r}: use one of {METHODS}")


def _robust_table(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Centre = median, width = interquartile range, one row per group."""
    quartiles = exact_percentiles(df, columns, [0.25, 0.5, 0.75], by)

    def pick(c, p):
        return F.max(F.when((F.col("column") == c) & (F.col("prob") == p), F.col("value")))

    aggs = []
    for i, c in enumerate(columns):
        aggs += [pick(c, 0.5).alias(f"a{i}"), (pick(c, 0.75) - pick(c, 0.25)).alias(f"b{i}")]
    return quartiles.groupBy(*by).agg(*aggs)


def scale_table(df: DataFrame, columns: Sequence[str], method: str, by: Sequence[str] = ()) -> DataFrame:
    """Fitted offsets ``a<i>`` and widths ``b<i>``, one row per group."""
    if method == "robust":
        return _robust_table(df, columns, by)
    aggs = [a for i, c in enumerate(columns) for a in _scale_aggregates(method, c, i)]
    return df.groupBy(*by).agg(*aggs)


def _apply(c: str, offset: Column, width: Column) -> Column:
    return (F.col(c) - offset) / F.when(width == 0, F.lit(1.0)).otherwise(width)


def scale(df: DataFrame, columns: Sequence[str], method: str = "minmax", train: DataFrame | None = None) -> DataFrame:
    """Scale with statistics of ``train``; a zero width counts as 1."""
    if method == "none":
        return df
    fitted = scale_table(df if train is None else train, columns, method)
    names = [n for i in range(len(columns)) for n in (f"a{i}", f"b{i}")]
    rows = with_row(df, fitted.agg(*[F.max(n).alias(n) for n in names]), "_fit")
    return rows.withColumns(
        {c: _apply(c, F.col(f"_fit.a{i}"), F.col(f"_fit.b{i}")) for i, c in enumerate(columns)}
    ).drop("_fit")


def scale_per_unit(
    df: DataFrame,
    columns: Sequence[str],
    layout: Layout,
    method: str = "minmax",
    train: DataFrame | None = None,
) -> DataFrame:
    """Scale each unit with its own statistics in ``train``, units unseen there with the fleet's."""
    source = df if train is None else train
    names = [n for i in range(len(columns)) for n in (f"a{i}", f"b{i}")]
    fleet = scale_table(source, columns, method).agg(*[F.max(n).alias(n) for n in names])
    own = scale_table(source, columns, method, layout.unit)
    units = unit_table(df, layout).join(own, list(layout.unit), "left")
    rows = with_row(join_units(df, units, layout), fleet, "_fleet")
    out = {
        c: _apply(
            c,
            F.coalesce(F.col(f"a{i}"), F.col(f"_fleet.a{i}")),
            F.coalesce(F.col(f"b{i}"), F.col(f"_fleet.b{i}")),
        )
        for i, c in enumerate(columns)
    }
    return rows.withColumns(out).drop("_fleet", *names)


def normalize_columns(df: DataFrame, columns: Sequence[str], train: DataFrame | None = None) -> DataFrame:
    """Min-max by ``train``; constant columns are left as they are."""
    fitted = (df if train is None else train).agg(
        *[F.min(c).alias(f"lo{i}") for i, c in enumerate(columns)],
        *[F.max(c).alias(f"hi{i}") for i, c in enumerate(columns)],
    )
    out = {}
    for i, c in enumerate(columns):
        lo, hi = F.col(f"_fit.lo{i}"), F.col(f"_fit.hi{i}")
        out[c] = F.when(hi > lo, (F.col(c) - lo) / (hi - lo)).otherwise(F.col(c))
    return with_row(df, fitted, "_fit").withColumns(out).drop("_fit")


def variance_weights(df: DataFrame, columns: Sequence[str], layout: Layout) -> DataFrame:
    """Multiply each column by its share of the unit's total (population) variance."""
    rows = attach(df, layout, **{f"_v{i}": F.var_pop(c) for i, c in enumerate(columns)})
    total = sum((F.col(f"_v{i}") for i in range(len(columns))), F.lit(0.0))
    weighted = {c: F.col(c) * F.try_divide(F.col(f"_v{i}"), total) for i, c in enumerate(columns)}
    return rows.withColumns(weighted).drop(*[f"_v{i}" for i in range(len(columns))])


def add_cycle_features(df: DataFrame, layout: Layout) -> DataFrame:
    """``cycle_ratio`` and ``remaining_cycles`` from the unit's last cycle."""
    rows = attach(df, layout, _last=F.max(layout.cycle))
    cycle = F.col(layout.cycle)
    return rows.withColumns(
        {"cycle_ratio": cycle / F.col("_last"), "remaining_cycles": F.col("_last") - cycle}
    ).drop("_last")


def add_rul_features(df: DataFrame, rul: str = "RUL") -> DataFrame:
    """``normalized_RUL`` (share of the fleet's largest) and ``RUL_quartile`` (0..3, right-closed)."""
    table = exact_percentiles(df, [rul], [0.25, 0.5, 0.75])
    quartiles = table.agg(F.sort_array(F.collect_list("value")).alias("q"))
    rows = with_row(with_row(df, quartiles, "_q"), df.agg(F.max(rul).alias("top")), "_t")
    value, q = F.col(rul), F.col("_q.q")
    quartile = (
        F.when(value <= q[0], F.lit(0)).when(value <= q[1], F.lit(1)).when(value <= q[2], F.lit(2)).otherwise(F.lit(3))
    )
    return rows.withColumns(
        {
            "normalized_RUL": F.try_divide(value.cast("double"), F.col("_t.top")),
            "RUL_quartile": F.when(value.isNotNull(), quartile),
        }
    ).drop("_q", "_t")


def sensor_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: mean, sample deviation, min, max, median and bias-corrected skew and kurtosis."""
    row = df.agg(
        *[
            F.struct(
                F.count(c).cast("double").alias("n"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).alias("min"),
                F.max(c).alias("max"),
                F.skewness(c).alias("g1"),
                F.kurtosis(c).alias("g2"),
            ).alias(c)
            for c in columns
        ]
    )
    s = F.col("s")
    n = s["n"]
    long = row.unpivot([], list(columns), "column", "s")
    skew = s["g1"] * F.sqrt(n * (n - 1)) / (n - 2)
    kurt = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * s["g2"] + 6)
    stats = long.select(
        "column",
        s["mean"].alias("mean"),
        s["std"].alias("std"),
        s["min"].alias("min"),
        s["max"].alias("max"),
        F.when(n > 2, skew).alias("skew"),
        F.when(n > 3, kurt).alias("kurtosis"),
    )
    return stats.join(medians(df, columns).withColumnRenamed("value", "median"), "column", "left")


class Preparation:
    """Clean, enrich and scale a series with statistics of a training frame.

    Fitting reads a few numbers per column to the driver; ``transform`` then needs no second look at the
    training frame (unless each unit has its own scaler).
    """

    def __init__(
        self,
        train: DataFrame,
        layout: Layout,
        method: str = "minmax",
        per_unit: bool = False,
        sensor_columns: Sequence[str] | None = None,
        setting_columns: Sequence[str] | None = None,
    ):
        if method not in METHODS:
            raise ValueError(f"unknown scaling method {method!r}: use one of {METHODS}")
        self.train = train
        self.layout = layout
        self.method = method
        self.per_unit = per_unit
        self.sensors = list(sensor_columns) if sensor_columns is not None else features.sensors(train)
        self.settings = list(setting_columns) if setting_columns is not None else features.settings(train)
        columns = [*self.sensors, *self.settings]
        measures = {
            "mean": F.avg,
            "std": F.stddev_samp,
            "pop": F.stddev_pop,
            "var": F.var_samp,
            "min": F.min,
            "max": F.max,
        }
        row = train.agg(*[f(c).alias(f"{k}_{i}") for i, c in enumerate(columns) for k, f in measures.items()]).first()
        self.statistics = {c: {k: row[f"{k}_{i}"] for k in measures} for i, c in enumerate(columns)}
        self.percentiles: dict[tuple[str, float], float] = {}
        if method == "robust":
            self._rank(columns, [0.25, 0.5, 0.75])
        self.scaled = (
            [] if method == "none" else [c for c in columns if (self.statistics[c]["var"] or 0.0) > MIN_VARIANCE]
        )

    def _rank(self, columns: Sequence[str], probs: Sequence[float]) -> None:
        found = exact_percentiles(self.train, columns, probs).collect()
        self.percentiles |= {(r["column"], r["prob"]): r["value"] for r in found}

    def _clean(self, df: DataFrame) -> DataFrame:
        """Median for missing readings, then mean ± 5 deviations as limits.

        Medians take two passes over the training frame, so they are worked out for columns with gaps only.
        """
        out = {}
        if self.sensors:
            gaps = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"g{i}") for i, c in enumerate(self.sensors)]).first()
            asked = [c for i, c in enumerate(self.sensors) if gaps[f"g{i}"] and (c, 0.5) not in self.percentiles]
            if asked:
                self._rank(asked, [0.5])
        for c in self.sensors:
            s = self.statistics[c]
            filled = F.coalesce(F.col(c), F.lit(self.percentiles.get((c, 0.5))))
            if s["std"] is not None:
                reach = OUTLIER_DEVIATIONS * s["std"]
                filled = clip(filled, s["mean"] - reach, s["mean"] + reach)
            out[c] = filled
        return df.withColumns(out)

    def _offset_and_width(self, c: str) -> tuple[float, float]:
        s = self.statistics[c]
        if self.method == "minmax":
            return s["min"], s["max"] - s["min"]
        if self.method == "standard":
            return s["mean"], s["pop"]
        return self.percentiles[c, 0.5], self.percentiles[c, 0.75] - self.percentiles[c, 0.25]

    def _scale(self, df: DataFrame) -> DataFrame:
        if self.per_unit:
            return scale_per_unit(df, self.scaled, self.layout, self.method, self.train)
        fitted = {c: self._offset_and_width(c) for c in self.scaled}
        return df.withColumns({c: _apply(c, F.lit(a), F.lit(b)) for c, (a, b) in fitted.items()})

    def transform(
        self,
        df: DataFrame,
        cycle_features: bool = True,
        differences: bool = True,
        window: int = 5,
    ) -> DataFrame:
        out = self._clean(df)
        if cycle_features:
            out = add_cycle_features(out, self.layout)
            if "RUL" in out.columns:
                out = add_rul_features(out)
        if differences:
            out = features.add_differences_and_rolling(out, self.sensors, self.layout, window)
        return self._scale(out) if self.scaled else out
