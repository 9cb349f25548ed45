"""Time-series features: differences, rolling and running statistics, crossovers, ratios, sequences."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearcurve.functions import features as fx
from wearcurve.layout import BLOCK, Layout
from wearcurve.operators.blocks import Lookback, attach, block_window, positions, store_blocks

# Fixed values
WINDOWS = (5, 10, 20)

_BACK = Window.unboundedPreceding


def sensors(df: DataFrame) -> list[str]:
    """The base sensor columns: ``sensor_<number>``."""
    return [c for c in df.columns if c.startswith("sensor_") and c[7:].isdigit()]


def settings(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("setting_")]


def _diff(column: str, window) -> Column:
    return F.coalesce(F.col(column) - F.lag(column).over(window), F.lit(0.0))


def add_differences(df: DataFrame, columns: Sequence[str], layout: Layout) -> DataFrame:
    """``<c>_diff``: change since the unit's previous row, 0 on its first row. Existing ones are kept."""
    wanted = [c for c in columns if f"{c}_diff" not in df.columns]
    if not wanted:
        return df
    look = Lookback(layout, 1)
    rows = look.open(df)
    return look.close(rows.withColumns({f"{c}_diff": _diff(c, look.window) for c in wanted}))


def add_accelerations(df: DataFrame, columns: Sequence[str], layout: Layout) -> DataFrame:
    """``<c>_diff`` (reused if present) and ``<c>_accel``, its own difference."""
    look = Lookback(layout, 2)
    rows = look.open(df)
    missing = [c for c in columns if f"{c}_diff" not in df.columns]
    rows = rows.withColumns({f"{c}_diff": _diff(c, look.window) for c in missing})
    rows = rows.withColumns({f"{c}_accel": _diff(f"{c}_diff", look.window) for c in columns})
    return look.close(rows)


def rolling_columns(column: str, look: Lookback, rows: int) -> tuple[Column, Column]:
    frame = look.over(rows - 1)
    mean = F.avg(column).over(frame)
    std = F.coalesce(F.stddev_samp(column).over(frame), F.lit(0.0))
    return mean, std


def add_rolling(
    df: DataFrame,
    columns: Sequence[str],
    layout: Layout,
    windows: Sequence[int] = WINDOWS,
    mean_name: str = "{c}_roll{w}_mean",
    std_name: str = "{c}_roll{w}_std",
    differences: bool = False,
) -> DataFrame:
    """Rolling mean and sample deviation over the last ``w`` rows (fewer at the unit's start).

    All columns and all window lengths share one shuffle and one sort.
    """
    look = Lookback(layout, max(windows))
    rows = look.open(df)
    new = {}
    for c in columns:
        if differences and f"{c}_diff" not in df.columns:
            new[f"{c}_diff"] = _diff(c, look.window)
        for w in windows:
            mean, std = rolling_columns(c, look, w)
            new[mean_name.format(c=c, w=w)] = mean
            new[std_name.format(c=c, w=w)] = std
    return look.close(rows.withColumns(new))


def add_short_rolling(df: DataFrame, columns: Sequence[str], layout: Layout, window: int = 5) -> DataFrame:
    """``<c>_roll_mean`` and ``<c>_roll_std`` for one window length."""
    return add_rolling(df, columns, layout, (window,), "{c}_roll_mean", "{c}_roll_std")


def add_differences_and_rolling(
    df: DataFrame, columns: Sequence[str], layout: Layout, window: int = 5
) -> DataFrame:
    """``<c>_diff``, ``<c>_roll_mean_<w>``, ``<c>_roll_std_<w>`` in one pass."""
    return add_rolling(
        df, columns, layout, (window,), "{c}_roll_mean_{w}", "{c}_roll_std_{w}", differences=True
    )


def add_running(
    df: DataFrame, columns: Sequence[str], layout: Layout, differences: bool = True
) -> DataFrame:
    """``<c>_cummean`` and ``<c>_cumstd`` since the unit's first row, and ``<c>_diff``.

    Each block computes its own running count, mean and squared deviation; those of all earlier
    blocks are merged per block and combined with them, so a unit is never read by one task.
    """
    had_block = BLOCK in df.columns
    base = add_differences(df, columns, layout) if differences else df
    blocked = layout.with_block(base)
    keys = layout.block_keys
    aggs, refs, sums = [], {}, []
    order = Window.partitionBy(*layout.unit).orderBy(BLOCK)
    upto, earlier = order.rowsBetween(_BACK, 0), order.rowsBetween(_BACK, -1)
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        n = F.col(f"_n{i}")
        gap = F.col(f"_m{i}") - F.col(f"_ref{i}")
        aggs += [
            F.count(c).alias(f"_n{i}"),
            F.avg(x).alias(f"_m{i}"),
            F.coalesce(F.var_pop(x) * F.count(c), F.lit(0.0)).alias(f"_q{i}"),
        ]
        # deviations are taken from the unit's first block mean, which keeps the sums small
        refs[f"_ref{i}"] = F.first(f"_m{i}", ignorenulls=True).over(upto)
        sums += [
            F.col(f"_ref{i}"),
            F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_n0{i}"),
            F.coalesce(F.sum(n * gap).over(earlier), F.lit(0.0)).alias(f"_d0{i}"),
            F.coalesce(
                F.sum(F.col(f"_q{i}") + F.coalesce(n * gap * gap, F.lit(0.0))).over(earlier), F.lit(0.0)
            ).alias(f"_s0{i}"),
        ]
    carried = blocked.groupBy(*keys).agg(*aggs).withColumns(refs).select(*keys, *sums)
    rows = blocked.join(carried, keys, "left")
    frame = block_window(layout).rowsBetween(_BACK, 0)
    new = {}
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        n0, d0, s0, ref = (F.col(f"_{k}{i}") for k in ("n0", "d0", "s0", "ref"))
        n1 = F.count(c).over(frame)
        d1 = F.coalesce((F.avg(x).over(frame) - ref) * n1, F.lit(0.0))
        s1 = F.coalesce(F.var_pop(x).over(frame) * n1, F.lit(0.0)) + F.coalesce(
            F.try_divide(d1 * d1, n1), F.lit(0.0)
        )
        n = n0 + n1
        offset = F.try_divide(d0 + d1, n)
        squares = F.greatest(s0 + s1 - (d0 + d1) * offset, F.lit(0.0))
        new[f"{c}_cummean"] = ref + offset
        new[f"{c}_cumstd"] = F.coalesce(F.sqrt(F.try_divide(squares, n - 1)), F.lit(0.0))
    kept = [*base.columns, *new]
    out = rows.withColumns(new)
    return out.select(*kept) if had_block else out.select(*[c for c in kept if c != BLOCK])


@dataclass(frozen=True)
class Rolling:
    """Mean and sample deviation over the last ``w`` rows, for each of ``windows``."""

    columns: Sequence[str]
    windows: Sequence[int] = WINDOWS
    mean_name: str = "{c}_roll{w}_mean"
    std_name: str = "{c}_roll{w}_std"


@dataclass(frozen=True)
class Running:
    """``<c>_cummean`` and ``<c>_cumstd`` since the unit's first row."""

    columns: Sequence[str]


@dataclass(frozen=True)
class Difference:
    """``<c>_diff``: change since the unit's previous row, 0 on its first row."""

    columns: Sequence[str]


def add_windows(df: DataFrame, layout: Layout, requests: Sequence[Rolling | Running | Difference]) -> DataFrame:
    """All requested columns in one pass over the rows.

    Rows are written once by (unit, block). A block tells the rest of its unit its count, mean and squared deviation of
    each column and its last rows, as many as the longest window; what earlier blocks say is put together for each
    block and joined back to it. So every result is the block's own part merged with what came before, whatever
    gaps the cycles have, and rows are shuffled once. The same values as ``add_rolling``, ``add_running`` and
    ``add_differences``; nulls are skipped, and a mean of nothing is null. The rows are written before this returns.
    """
    names = list(dict.fromkeys(c for r in requests for c in r.columns))
    back = max([max(r.windows) - 1 for r in requests if isinstance(r, Rolling)] + [1])
    had_block, given = BLOCK in df.columns, list(df.columns)
    stored = store_blocks(df, layout)
    keys, own = layout.block_keys, block_window(layout)
    last = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(layout.cycle)))
    values = F.array(*[F.col(c).cast("double") for c in names])
    told = stored.select(*keys, layout.cycle, *names, last.alias("_last"))
    aggs = [F.collect_list(F.when(F.col("_last") <= back, F.struct(F.col(layout.cycle).alias("t"), values.alias("x")))).alias("_tail")]
    for i, c in enumerate(names):
        x = F.col(c).cast("double")
        aggs += [F.count(c).alias(f"_n{i}"), F.avg(x).alias(f"_m{i}"), F.coalesce(F.var_pop(x) * F.count(c), F.lit(0.0)).alias(f"_q{i}")]
    per_block = told.groupBy(*keys).agg(*aggs)
    order = Window.partitionBy(*layout.unit).orderBy(BLOCK)
    upto, earlier = order.rowsBetween(_BACK, 0), order.rowsBetween(_BACK, -1)
    # a block has a row at least, so the last rows are in as many blocks
    tails = F.sort_array(F.flatten(F.collect_list("_tail").over(order.rowsBetween(-back, -1))), asc=False)
    refs, sums = {"_tails": F.transform(F.slice(tails, 1, back), lambda r: r["x"])}, []
    for i in range(len(names)):
        n, gap = F.col(f"_n{i}"), F.col(f"_m{i}") - F.col(f"_ref{i}")
        # deviations are taken from the unit's first block mean, which keeps the sums small
        refs[f"_ref{i}"] = F.first(f"_m{i}", ignorenulls=True).over(upto)
        squares = F.col(f"_q{i}") + F.coalesce(n * gap * gap, F.lit(0.0))
        sums += [
            F.col(f"_ref{i}"),
            F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_n0{i}"),
            F.coalesce(F.sum(n * gap).over(earlier), F.lit(0.0)).alias(f"_d0{i}"),
            F.coalesce(F.sum(squares).over(earlier), F.lit(0.0)).alias(f"_s0{i}"),
        ]
    carried = per_block.withColumns(refs).select(*keys, "_tails", *sums)
    # of the last 0, 1, 2, ... rows before the block: count, sum and sum of squares around the reference
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("d"), F.lit(0.0).alias("s"))

    def so_many(i: int) -> Column:
        def one_more(so_far: Column, row: Column) -> Column:
            gap, before = F.get(row, F.lit(i)) - F.col(f"_ref{i}"), F.element_at(so_far, -1)
            n = before["n"] + gap.isNotNull().cast("long")
            d, s = before["d"] + F.coalesce(gap, F.lit(0.0)), before["s"] + F.coalesce(gap * gap, F.lit(0.0))
            return F.concat(so_far, F.array(F.struct(n.alias("n"), d.alias("d"), s.alias("s"))))

        return F.aggregate("_tails", F.array(zero), one_more)

    parts = {f"_t{i}": so_many(i) for i in range(len(names))}
    carried = carried.withColumns(parts).withColumn("_prev", F.get("_tails", F.lit(0))).drop("_tails")
    rows = stored.join(carried, keys, "left").withColumn("_rn", F.row_number().over(own))

    def merged(i: int, n0: Column, d0: Column, s0: Column, frame) -> tuple[Column, Column]:
        """Mean and sample deviation of what came before and of a frame of the block's own rows."""
        x, ref = F.col(names[i]).cast("double"), F.col(f"_ref{i}")
        n1 = F.count(names[i]).over(frame)
        d1 = F.coalesce((F.avg(x).over(frame) - ref) * n1, F.lit(0.0))
        s1 = F.coalesce(F.var_pop(x).over(frame) * n1, F.lit(0.0)) + F.coalesce(F.try_divide(d1 * d1, n1), F.lit(0.0))
        n = n0 + n1
        offset = F.try_divide(d0 + d1, n)
        squares = F.greatest(s0 + s1 - (d0 + d1) * offset, F.lit(0.0))
        return ref + offset, F.coalesce(F.sqrt(F.try_divide(squares, n - 1)), F.lit(0.0))

    new: dict[str, Column] = {}
    for request in requests:
        for c in request.columns:
            i = names.index(c)
            if isinstance(request, Difference):
                before = F.when(F.col("_rn") == 1, F.get("_prev", F.lit(i))).otherwise(F.lag(F.col(c).cast("double")).over(own))
                new.setdefault(f"{c}_diff", F.coalesce(F.col(c) - before, F.lit(0.0)))
            elif isinstance(request, Running):
                mean, std = merged(i, F.col(f"_n0{i}"), F.col(f"_d0{i}"), F.col(f"_s0{i}"), own.rowsBetween(_BACK, 0))
                new |= {f"{c}_cummean": mean, f"{c}_cumstd": std}
            else:
                for w in request.windows:
                    # a block's first rows are short of so many, the last before the block
                    missing = F.least(F.greatest(F.lit(w) - F.col("_rn"), F.lit(0)), F.size(f"_t{i}") - 1)
                    part = F.get(f"_t{i}", missing.cast("int"))
                    frame = own.rowsBetween(-(w - 1), 0)
                    mean, std = merged(i, part["n"], part["d"], part["s"], frame)
                    inside = F.col("_rn") >= w
                    x = F.col(c).cast("double")
                    mean = F.when(inside, F.avg(x).over(frame)).otherwise(mean)
                    std = F.when(inside, F.coalesce(F.stddev_samp(x).over(frame), F.lit(0.0))).otherwise(std)
                    new |= {request.mean_name.format(c=c, w=w): mean, request.std_name.format(c=c, w=w): std}
    new = {n: e for n, e in new.items() if n not in given}
    return rows.withColumns(new).select(*given, *new) if had_block else rows.withColumns(new).select(*[c for c in given if c != BLOCK], *new)


def add_crossovers(
    df: DataFrame, columns: Sequence[str], layout: Layout, windows: Sequence[int] = WINDOWS
) -> DataFrame:
    """``<c>_cross_<s>_<l>``: 1 where the short moving average rises above the long one at this row.

    The previous row is taken within the unit; units shorter than the long window give 0.
    """
    pairs = [(s, w) for s in windows for w in windows if w > s]
    counted = attach(df, layout, _rows=F.count(F.lit(1)))
    look = Lookback(layout, max(windows))
    rows = look.open(counted)
    averages = {
        f"_{c}_ma{w}": F.avg(c).over(look.over(w - 1)) for c in columns for w in sorted(set(windows))
    }
    rows = rows.withColumns(averages)
    new = {}
    for c in columns:
        for s, w in pairs:
            above = F.col(f"_{c}_ma{s}") > F.col(f"_{c}_ma{w}")
            was_below = F.lag(F.col(f"_{c}_ma{s}") <= F.col(f"_{c}_ma{w}")).over(look.window)
            hit = above & F.coalesce(was_below, F.lit(False)) & (F.col("_rows") >= w)
            new[f"{c}_cross_{s}_{w}"] = F.coalesce(hit, F.lit(False)).cast("int")
    return look.close(rows.withColumns(new)).drop("_rows", *averages)


def add_polynomials(df: DataFrame, columns: Sequence[str], degree: int = 2) -> DataFrame:
    """All products of ``columns`` of total degree 2..degree, e.g. ``a_pow2`` and ``a_x_b``."""
    from itertools import combinations_with_replacement

    new = {}
    for d in range(2, degree + 1):
        for combo in combinations_with_replacement(columns, d):
            parts = []
            for c in dict.fromkeys(combo):
                times = combo.count(c)
                parts.append(c if times == 1 else f"{c}_pow{times}")
            new["_x_".join(parts)] = fx.monomial([F.col(c) for c in combo])
    return df.withColumns(new)


def add_ratios(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``ratio_<a>_<b>`` for every a before b."""
    return df.withColumns(
        {
            f"ratio_{a}_{b}": fx.ratio(F.col(a), F.col(b))
            for i, a in enumerate(columns)
            for b in columns[i + 1 :]
        }
    )


def sequences(
    df: DataFrame,
    length: int,
    features: Sequence[str],
    target: str,
    layout: Layout,
    step: int = 1,
) -> DataFrame:
    """Sliding sequences: the rows' features as an array, the last row's target, the unit.

    A unit shorter than ``length`` gives none. ``end_cycle`` tells the sequences of a unit apart.
    """
    look = Lookback(layout, length - 1) if length > 1 else Lookback(layout, 1)
    rows = look.open(df)
    steps = F.collect_list(F.array(*[F.col(c).cast("double") for c in features])).over(
        look.over(length - 1)
    )
    rows = look.close(rows.withColumn("sequence", steps), keep_pos=True)
    starts = F.col("_pos") - F.lit(length)
    return rows.where((starts >= 0) & (starts % step == 0)).select(
        *layout.unit,
        F.col(layout.cycle).alias("end_cycle"),
        "sequence",
        F.col(target).alias("target"),
    )


def row_positions(df: DataFrame, layout: Layout) -> DataFrame:
    """``row_in_unit`` (1-based) and ``unit_rows``."""
    placed = positions(df, layout, "row_in_unit")
    return attach(placed, layout, unit_rows=F.count(F.lit(1)))
