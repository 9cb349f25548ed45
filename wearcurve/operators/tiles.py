"""Rows near each other in space, without comparing all of them.

Rows of a group are cut into tiles by their coordinates, one coordinate after the other, so that tiles are compact boxes
of about equally many rows. What a row looks for lies within a limit that it already knows, mostly from its own tile. So
a tile needs another one only if the gap between their boxes is within the largest limit of its rows, a row needs it
only if the row's own gap to that box is, and only rows of the other tile within that limit of the first box are
answers. Rows without such a tile are shipped nowhere. The bounds are exact, so nothing is missed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearcurve.operators.blocks import range_positions, shuffle_partitions

TILE_ROWS = 1024
#: Coordinates that tiles are cut by, at most.
_CUTS = 3


def space_tiles(rows: DataFrame, keys: Sequence[str], id: str, vector: str, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Stored rows with their ``_tile``: groups of up to ``tile_rows`` rows are one tile.

    Sizes and spreads of the data are read before the frame is returned.
    """
    from wearcurve.sources.tables import materialize

    keys = list(keys)
    rows = materialize(rows, "tile_rows")
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.max(F.size(vector)).alias("_w"))
    most, width = sizes.agg(F.max("_n"), F.max("_w")).first()
    out = rows.withColumn("_tile", F.lit(0).cast("long"))
    if most is None or most <= tile_rows:
        return out
    spread = rows.agg(*[F.stddev_pop(F.get(vector, F.lit(j))) for j in range(width)]).first()
    cuts = sorted(range(width), key=lambda j: -(spread[j] or 0.0))[:_CUTS]
    for step, j in enumerate(cuts):
        by = out.withColumn("_by", F.get(vector, F.lit(j)))
        placed = range_positions(by, [*keys, "_tile"], ["_by", id])
        # what is left to cut, in equal shares of the coordinates to come
        shares = F.ceil(F.pow(F.ceil(F.col("_of") / tile_rows), F.lit(1.0 / (len(cuts) - step))) - F.lit(1e-9))
        cut = F.floor((F.col("_pos") - 1) * shares / F.col("_of"))
        out = placed.withColumn("_tile", F.col("_tile") * (1 << 20) + cut).drop("_pos", "_of", "_by")
    return materialize(out, "tiles")


def _summed(gaps: Column, metric: str) -> Column:
    if metric == "maximum":
        return F.array_max(gaps)
    return F.aggregate(gaps, F.lit(0.0), lambda s, g: s + (g if metric == "manhattan" else g * g))


def gap(x: Column, lo: Column, hi: Column, metric: str = "euclidean") -> Column:
    """Distance of a point to a box: Manhattan, the largest coordinate's, or squared Euclidean."""
    over = F.zip_with(x, F.arrays_zip(lo.alias("lo"), hi.alias("hi")), lambda v, b: F.greatest(b["lo"] - v, v - b["hi"], F.lit(0.0)))
    return _summed(over, metric)


def box_reach(a_lo: Column, a_hi: Column, b_lo: Column, b_hi: Column, metric: str) -> Column:
    """The largest distance that points of two boxes can have, as ``gap`` measures it."""
    over = F.zip_with(F.arrays_zip(a_lo.alias("lo"), a_hi.alias("hi")), F.arrays_zip(b_lo.alias("lo"), b_hi.alias("hi")), lambda a, b: F.greatest(b["hi"] - a["lo"], a["hi"] - b["lo"]))
    return _summed(over, metric)


def box_gap(a_lo: Column, a_hi: Column, b_lo: Column, b_hi: Column, metric: str) -> Column:
    """The least distance that points of two boxes can have."""
    over = F.zip_with(F.arrays_zip(a_lo.alias("lo"), a_hi.alias("hi")), F.arrays_zip(b_lo.alias("lo"), b_hi.alias("hi")), lambda a, b: F.greatest(b["lo"] - a["hi"], a["lo"] - b["hi"], F.lit(0.0)))
    return _summed(over, metric)


def boxes(rows: DataFrame, keys: Sequence[str], vector: str, width: int, **more: Column) -> DataFrame:
    """The box of every tile, and other aggregates."""
    sides = [F.array(*[f(F.get(vector, F.lit(j))) for j in range(width)]) for f in (F.min, F.max)]
    return rows.groupBy(*keys, "_tile").agg(sides[0].alias("lo"), sides[1].alias("hi"), *[c.alias(n) for n, c in more.items()])


def nearest_tiles(rows: DataFrame, others: DataFrame, vector: str, width: int, metric: str = "euclidean") -> DataFrame:
    """(_tile, _next): for each tile of ``rows`` the tile of ``others`` with the nearest box, the least number of equals."""
    many = shuffle_partitions(rows)
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(many - 1).cast("long"))).alias("_salt")
    left = boxes(rows, [], vector, width).select("_tile", F.pmod(F.xxhash64("_tile"), F.lit(many)).alias("_salt"), F.struct("lo", "hi").alias("_a"))
    right = boxes(others, [], vector, width).select(F.col("_tile").alias("_next"), F.struct("lo", "hi").alias("_b"), salts)
    pairs = left.join(right, "_salt").withColumn("_g", box_gap(*[F.col(c) for c in ("_a.lo", "_a.hi", "_b.lo", "_b.hi")], metric))
    return pairs.groupBy("_tile").agg(F.min(F.struct("_g", "_next"))["_next"].alias("_next"))


def meetings(
    rows: DataFrame,
    keys: Sequence[str],
    vector: str,
    width: int,
    limit: str,
    skip: str | None = None,
    metric: str = "euclidean",
    weigh: tuple[str, str] | None = None,
    answers: str | None = None,
) -> DataFrame:
    """Rows that have to meet, by (keys, _from, _to): those that look (``_looks``) and those that may be found.

    ``limit``: distance, as ``gap`` measures it, within which a row looks (null: it does not). ``skip``: a column; two
    tiles that both have one and the same value in it need not meet. ``weigh``: columns of a cluster's rows n and spread
    v, if what is limited is n1 n2 / (n1 + n2) (distance + v1 + v2), which grows with all of them. ``answers``: a boolean
    column; only those rows are found. Tiles are compared box by box, in as many parts as the session shuffles to.
    """
    keys = list(keys)
    more = {"_one": F.when(F.min(skip) == F.max(skip), F.min(skip))} if skip else {}
    if answers:
        more["_any"] = F.max(answers)
    if weigh:
        more |= {"_n0": F.min(weigh[0]), "_v0": F.min(weigh[1])}

    def bound(distance: Column, one: tuple[str, str], two: tuple[str, str]) -> Column:
        if not weigh:
            return distance
        (n1, v1), (n2, v2) = ([F.col(c) for c in x] for x in (one, two))
        return n1 * n2 / (n1 + n2) * (distance + v1 + v2)

    box = boxes(rows, keys, vector, width, _most=F.max(limit), **more)
    many = shuffle_partitions(rows)
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(many - 1).cast("long"))).alias("_salt")
    left = box.select(*keys, F.pmod(F.xxhash64("_tile"), F.lit(many)).alias("_salt"), F.struct("_tile", "lo", "hi", "_most", *more).alias("_a")).where("_a._most IS NOT NULL")
    right = (box.where("_any") if answers else box).select(*keys, salts, F.struct("_tile", "lo", "hi", *more).alias("_b"))
    between = box_gap(*[F.col(c) for c in ("_a.lo", "_a.hi", "_b.lo", "_b.hi")], metric)
    near = (F.col("_a._tile") != F.col("_b._tile")) & (bound(between, ("_a._n0", "_a._v0"), ("_b._n0", "_b._v0")) <= F.col("_a._most"))
    pairs = left.join(right, [*keys, "_salt"]).where(near)
    if skip:
        pairs = pairs.where(~F.coalesce(F.col("_a._one") == F.col("_b._one"), F.lit(False)))
    pairs = pairs.select(*keys, F.col("_a._tile").alias("_from"), F.col("_b._tile").alias("_to"), "_a", "_b")
    own = weigh or ("", "")
    x = F.col(vector)
    looks = rows.join(pairs.withColumn("_tile", F.col("_from")), [*keys, "_tile"])
    looks = looks.where(bound(gap(x, F.col("_b.lo"), F.col("_b.hi"), metric), own, ("_b._n0", "_b._v0")) <= F.col(limit))
    found = (rows.where(answers) if answers else rows).join(pairs.withColumn("_tile", F.col("_to")), [*keys, "_tile"])
    found = found.where(bound(gap(x, F.col("_a.lo"), F.col("_a.hi"), metric), ("_a._n0", "_a._v0"), own) <= F.col("_a._most"))
    names = [*rows.columns, "_from", "_to"]
    return looks.select(*names, F.lit(True).alias("_looks")).unionAll(found.select(*names, F.lit(False).alias("_looks")))


def visits(rows: DataFrame, keys: Sequence[str], vector: str, width: int, limit: str, most: int = 1 << 16) -> DataFrame:
    """Like ``meetings``, but a looking row travels to the tiles it needs, by (keys, _to, _part): few rows that look are few that travel.

    A tile comes once with all its rows for each part of those that look, of about ``most`` rows; these are counted before
    this returns.
    """
    keys = list(keys)
    box = boxes(rows, keys, vector, width, _most=F.max(limit))
    lookers = rows.where(F.col(limit).isNotNull()).groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    parts = -(-lookers // most) or 1
    many = shuffle_partitions(rows)
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(many - 1).cast("long"))).alias("_salt")
    left = box.select(*keys, F.pmod(F.xxhash64("_tile"), F.lit(many)).alias("_salt"), F.struct("_tile", "lo", "hi", "_most").alias("_a")).where("_a._most IS NOT NULL")
    right = box.select(*keys, salts, F.struct("_tile", "lo", "hi").alias("_b"))
    between = box_gap(*[F.col(c) for c in ("_a.lo", "_a.hi", "_b.lo", "_b.hi")], "euclidean")
    pairs = left.join(right, [*keys, "_salt"]).where((F.col("_a._tile") != F.col("_b._tile")) & (between <= F.col("_a._most")))
    pairs = pairs.select(*keys, F.col("_a._tile").alias("_from"), F.col("_b._tile").alias("_to"), F.pmod(F.xxhash64("_a._tile"), F.lit(parts)).alias("_part"), "_b")
    looks = rows.where(F.col(limit).isNotNull()).join(pairs.withColumn("_tile", F.col("_from")), [*keys, "_tile"])
    looks = looks.where(gap(F.col(vector), F.col("_b.lo"), F.col("_b.hi")) <= F.col(limit))
    found = rows.join(pairs.select(*keys, F.col("_to").alias("_tile"), "_part").distinct(), [*keys, "_tile"])
    names = [*rows.columns, "_to", "_part"]
    return looks.select(*names, F.lit(True).alias("_looks")).unionAll(found.withColumn("_to", F.col("_tile")).select(*names, F.lit(False).alias("_looks")))


def matrix(column: pa.ChunkedArray):
    """Vectors of equal width as a matrix."""
    import numpy as np

    flat = column.combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    return np.asarray(flat.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(flat), -1)


def keyed(group: pa.Table, keys: Sequence[str], size: int) -> dict:
    """The keys of a group, repeated."""
    return {k: pa.array([group[k][0].as_py()] * size, group.schema.field(k).type) for k in keys}


def schema_of(df: DataFrame, names: Sequence[str], **more: T.DataType) -> T.StructType:
    return T.StructType([*[T.StructField(n, df.schema[n].dataType) for n in names], *[T.StructField(n, t) for n, t in more.items()]])


#: A function of the rows of one group.
Solver = Callable[[pa.Table], pa.Table]
