"""Ordered per-unit work without gathering a unit in one task.

The helpers below are the only place where windows over a unit are built:

* ``blocked_rank``   exact row numbers from per-bucket counts plus in-bucket row numbers
* ``positions``      1-based row position inside a unit
* ``join_units``     brings a per-unit table back to the rows, joined on (unit, block)
* ``attach``         per-unit aggregates on every row
* ``Lookback``       windows that look a bounded number of rows back
* ``block_carry``    running aggregates: what all earlier (or later) blocks of the unit contribute
* ``range_parts``    rows written in order, cut into numbered parts; ``range_positions`` counts rows over them
* ``store_blocks``   rows written once by (unit, block), so that several steps per block share one shuffle
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearcurve.layout import BLOCK, Layout

_UNBOUNDED_BACK = Window.unboundedPreceding
_UNBOUNDED_AHEAD = Window.unboundedFollowing


def blocked_rank(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    bucket: Mapping[str, Column],
    out: str,
) -> DataFrame:
    """Exact 1-based ``row_number`` within ``keys`` (may be empty) in ``order``.

    ``bucket`` are non-decreasing functions of the order, the coarsest first. Rows are shuffled by (keys,
    bucket), never by the keys alone. Row counts are summed level by level: those of the first bucket per
    key, those of the second per key and first bucket, and so on.
    """
    names = list(bucket)
    keyed = df.withColumns(dict(bucket))
    counts = keyed.groupBy(*keys, *names).agg(F.count(F.lit(1)).alias("_n"))
    offsets, above = None, list(keys)
    for level, name in enumerate(names):
        sums = counts if level == len(names) - 1 else counts.groupBy(*above, name).agg(F.sum("_n").alias("_n"))
        before = Window.partitionBy(*(above or [F.lit(0)])).orderBy(name).rowsBetween(_UNBOUNDED_BACK, -1)
        own = sums.select(*above, name, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(f"_b{level}"))
        offsets = own if offsets is None else own.join(offsets, above)
        above.append(name)
    total = sum((F.col(f"_b{level}") for level in range(1, len(names))), F.col("_b0"))
    offsets = offsets.select(*keys, *names, total.alias("_before"))
    inner = Window.partitionBy(*keys, *names).orderBy(*order)
    ranked = keyed.withColumn("_rn", F.row_number().over(inner))
    joined = ranked.join(offsets, [*keys, *names], "left")
    return joined.select(
        *[F.col(c) for c in df.columns], (F.col("_before") + F.col("_rn")).alias(out)
    )


def positions(df: DataFrame, layout: Layout, out: str = "_pos") -> DataFrame:
    """Add the 1-based position of each row in its unit, in cycle order."""
    if layout.contiguous:
        return df.withColumn(out, F.col(layout.cycle).cast("long"))
    bucket = {"_pbk": layout.block_of(F.col(layout.cycle))}
    return blocked_rank(df, layout.unit, [F.col(layout.cycle)], bucket, out)


def unit_table(df: DataFrame, layout: Layout, *aggs: Column) -> DataFrame:
    """One row per unit with ``aggs`` and the range of its blocks; partial aggregation only."""
    blocked = layout.with_block(df)
    return blocked.groupBy(*layout.unit).agg(
        *aggs, F.min(BLOCK).alias("_lo_blk"), F.max(BLOCK).alias("_hi_blk")
    )


def join_units(df: DataFrame, units: DataFrame, layout: Layout, how: str = "left") -> DataFrame:
    """Join rows to a table made by ``unit_table``.

    The unit's row is repeated for each of its blocks, and the join key is (unit, block): a unit that
    holds a large part of the fleet spreads over as many tasks as it has blocks.
    """
    spread = units.withColumn(
        BLOCK, F.explode(F.sequence(F.col("_lo_blk"), F.col("_hi_blk")))
    ).drop("_lo_blk", "_hi_blk")
    had_block = BLOCK in df.columns
    joined = layout.with_block(df).join(spread, layout.block_keys, how)
    added = [c for c in spread.columns if c not in df.columns and c != BLOCK]
    kept = [*df.columns, *added]
    return joined.select(*kept) if had_block else joined.select(*[c for c in kept if c != BLOCK])


def attach(df: DataFrame, layout: Layout, **aggs: Column) -> DataFrame:
    """Add per-unit aggregates to every row of the unit."""
    table = unit_table(df, layout, *[expr.alias(name) for name, expr in aggs.items()])
    return join_units(df, table, layout)


class Lookback:
    """Row windows that need at most ``rows`` earlier rows of the same unit.

    ``open`` cuts a unit into blocks of positions and copies the last ``rows`` rows of each block to
    the block that follows; ``window`` is then exact for every row of the block's own. ``close``
    removes the copies. The copied share is rows / block_rows.
    """

    def __init__(self, layout: Layout, rows: int):
        if rows >= layout.block_rows:
            raise ValueError(f"a lookback of {rows} rows needs blocks larger than {layout.block_rows}")
        self.layout = layout
        self.rows = rows
        self.window = Window.partitionBy(*layout.unit, "_wblk").orderBy("_pos")

    def open(self, df: DataFrame) -> DataFrame:
        size = self.layout.block_rows
        placed = positions(df, self.layout)
        own = F.floor((F.col("_pos") - 1) / F.lit(size)).cast("int")
        in_tail = (F.col("_pos") - 1) % size >= size - self.rows
        blocks = F.when(in_tail, F.array(own, own + 1)).otherwise(F.array(own))
        spread = placed.withColumn("_own", own).withColumn("_wblk", F.explode(blocks))
        return spread

    def over(self, back: int, ahead: int = 0):
        return self.window.rowsBetween(-back, ahead)

    def close(self, df: DataFrame, keep_pos: bool = False) -> DataFrame:
        own = df.where(F.col("_wblk") == F.col("_own")).drop("_wblk", "_own")
        return own if keep_pos else own.drop("_pos")


def block_carry(
    df: DataFrame,
    layout: Layout,
    partial: Mapping[str, Column],
    merge: Mapping[str, Column],
    forward: bool = True,
) -> DataFrame:
    """Add to each row what the unit's earlier (``forward``) or later blocks contribute.

    ``partial`` aggregates one block, ``merge`` aggregates those results over the preceding (or
    following) blocks and gives the output columns; they are null in a unit's first (or last) block.
    """
    blocked = layout.with_block(df)
    per_block = blocked.groupBy(*layout.block_keys).agg(
        *[expr.alias(name) for name, expr in partial.items()]
    )
    order = Window.partitionBy(*layout.unit).orderBy(BLOCK)
    others = (
        order.rowsBetween(_UNBOUNDED_BACK, -1) if forward else order.rowsBetween(1, _UNBOUNDED_AHEAD)
    )
    carried = per_block.select(
        *layout.block_keys, *[expr.over(others).alias(name) for name, expr in merge.items()]
    )
    return blocked.join(carried, layout.block_keys, "left").select(
        *blocked.columns, *[F.col(name) for name in merge]
    )


def range_parts(rows: DataFrame, by: Sequence[Column | str]) -> DataFrame:
    """Rows in order, written: ``_part`` numbers the ranges they were dealt by, ``_place`` grows along the order.

    Rows that are equal in ``by`` share a part, so ``by`` should tell rows apart. ``rows`` should be a stored table.
    """
    from wearcurve.sources.tables import materialize

    dealt = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = materialize(dealt.withColumn("_place", F.monotonically_increasing_id()), "ranges")
    return placed.withColumn("_part", F.shiftright("_place", 33))


def range_positions(rows: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "_pos", total: str = "_of") -> DataFrame:
    """1-based position of each row among those with equal ``keys``, and how many these are.

    Rows are counted for each part of a key's rows: what passes a window is one row for each part.
    """
    keys = list(keys)
    placed = range_parts(rows, [*keys, *order])
    parts = placed.groupBy(*keys, "_part").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    group = Window.partitionBy(*(keys or [F.lit(0)]))
    before = F.sum("_rows").over(group.orderBy("_part")) - F.col("_rows")
    parts = parts.select(*keys, "_part", (before - F.col("_first") + 1).alias("_base"), F.sum("_rows").over(group).alias(total))
    found = placed.join(parts, [*keys, "_part"])
    return found.withColumn(out, F.col("_place") + F.col("_base")).drop("_place", "_part", "_base")


def store_blocks(df: DataFrame, layout: Layout) -> DataFrame:
    """Rows with their block, written as a table bucketed by (unit, block): work per block needs no further shuffle."""
    from wearcurve.sources.tables import scratch_path

    spark, name = df.sparkSession, f"blocks_{uuid.uuid4().hex}"
    n, keys = shuffle_partitions(df), layout.block_keys
    writer = layout.with_block(df).repartition(n, *keys).write.bucketBy(n, *keys).option("path", scratch_path(spark, name))
    writer.saveAsTable(name)
    return spark.table(name)


def block_window(layout: Layout):
    """Window over one block of one unit, ordered by cycle."""
    return Window.partitionBy(*layout.block_keys).orderBy(layout.cycle)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def join_groups(
    df: DataFrame, groups: DataFrame, keys: Sequence[str], spread: Sequence[str], salts: int | None = None
) -> DataFrame:
    """Left join rows to a table of few groups (classes, datasets), any of which may hold most rows.

    The group's row is repeated for each salt, one per shuffle partition by default; a row's salt is a
    hash of the ``spread`` columns. Spark broadcasts the table where its size allows. With no keys the
    table has one row and is read as a scalar subquery.
    """
    added = [c for c in groups.columns if c not in keys]
    if not keys:
        return with_row(df, groups.agg(*[F.max(c).alias(c) for c in added]), "_row").withColumns(
            {c: F.col(f"_row.{c}") for c in added}
        ).drop("_row")
    salts = salts or shuffle_partitions(df)
    repeated = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    return salted.join(repeated, [*keys, "_salt"], "left").select(*df.columns, *added)


def with_row(df: DataFrame, one_row: DataFrame, name: str) -> DataFrame:
    """Add a one-row table to every row as a struct column, read once as a scalar subquery."""
    return df.withColumn(name, one_row.select(F.struct("*")).scalar())


def spread_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hash rows by ``keys`` over all shuffle partitions.

    Groups that are small in bytes but long to compute must not be coalesced into few tasks.
    """
    return df.repartition(shuffle_partitions(df), *keys)
