"""Hold-outs, folds and samples. Random choices are ranks of an md5 of the row key and a seed."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearcurve.layout import Layout
from wearcurve.operators.blocks import attach, blocked_rank, join_groups, join_units, positions, unit_table, with_row

# executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEED = 42
#: Rows of a leaf of the bootstrap's tree, at most about.
_LEAF_ROWS = 4096
_HASH_BUCKET_DIGITS = 4  # 65,536 buckets
_BUCKET_ROWS = 1 << 16


def hash_of(columns: Sequence[str], seed: int = SEED) -> Column:
    return F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in columns], F.lit(str(seed))))


def hash_rank(
    df: DataFrame, keys: Sequence[str], row_key: Sequence[str], seed: int = SEED, out: str = "_rank", rows: str | None = None
) -> DataFrame:
    """Random 1-based rank within ``keys``. The leading hash digits are the buckets, so they are even.

    ``rows`` names a column with the row count of the row's keys: then there are only as many buckets as
    that many rows need.
    """
    hashed = df.withColumn("_hash", hash_of(row_key, seed))
    bucket = {"_hbk": F.substring("_hash", 1, _HASH_BUCKET_DIGITS)}
    if rows is not None:
        place = F.conv(F.substring("_hash", 1, 8), 16, 10).cast("double") / F.lit(float(16**8))
        bucket = {"_hbk": F.floor(place * F.ceil(F.col(rows) / F.lit(_BUCKET_ROWS)))}
    order = [F.col("_hash"), *[F.col(c) for c in row_key]]
    return blocked_rank(hashed, keys, order, bucket, out).drop("_hash")


def validation_split(df: DataFrame, layout: Layout, share: float = 0.2, out: str = "part") -> DataFrame:
    """The first ``floor(n * (1 - share))`` rows of each unit train, the rest validate."""
    placed = attach(positions(df, layout), layout, _rows=F.count(F.lit(1)))
    cut = F.floor(F.col("_rows") * F.lit(1 - share))
    part = F.when(F.col("_pos") <= cut, F.lit("train")).otherwise(F.lit("validation"))
    return placed.withColumn(out, part).drop("_pos", "_rows")


def unit_folds(
    df: DataFrame, layout: Layout, folds: int = 5, seed: int = SEED, out: str = "fold"
) -> DataFrame:
    """Fold of each row's unit; fold sizes (in units) differ by at most one."""
    units = hash_rank(unit_table(df, layout), [], layout.unit, seed)
    folded = units.withColumn(out, F.pmod(F.col("_rank") - 1, F.lit(folds)).cast("int")).drop("_rank")
    return join_units(df, folded, layout)


def time_series_splits(df: DataFrame, layout: Layout, folds: int = 5) -> DataFrame:
    """Expanding-window splits of each unit: rows (…, split, role), a row once per split it serves in.

    The test part has n // (folds + 1) rows; split i tests the rows right after its training rows.
    """
    placed = attach(positions(df, layout), layout, _rows=F.count(F.lit(1)))
    size = F.floor(F.col("_rows") / F.lit(folds + 1))
    rows = placed.withColumn("_size", size).withColumn(
        "split", F.explode(F.sequence(F.lit(0), F.lit(folds - 1)))
    )
    start = F.col("_rows") - (F.lit(folds) - F.col("split")) * F.col("_size")
    role = F.when(F.col("_pos") <= start, F.lit("train")).when(
        F.col("_pos") <= start + F.col("_size"), F.lit("test")
    )
    return (
        rows.withColumn("role", role)
        .where(F.col("role").isNotNull() & (F.col("_size") > 0))
        .drop("_pos", "_rows", "_size")
    )


def unit_holdout(
    df: DataFrame,
    layout: Layout,
    share: float = 0.2,
    seed: int = SEED,
    sample_units: int | None = None,
    out: str = "part",
) -> DataFrame:
    """Whole units to train or test: ``ceil(share * units)`` go to test.

    ``sample_units`` first keeps that many units, chosen by hash.
    """
    ranked = hash_rank(unit_table(df, layout), [], layout.unit, seed)
    if sample_units is not None:
        ranked = ranked.where(F.col("_rank") <= sample_units)
    total = ranked.agg(F.count(F.lit(1))).scalar()
    part = F.when(F.col("_rank") <= F.ceil(F.lit(share) * total), F.lit("test")).otherwise(F.lit("train"))
    parts = ranked.withColumn(out, part).drop("_rank")
    return join_units(df, parts, layout, "left" if sample_units is None else "inner")


def unit_sample(df: DataFrame, layout: Layout, share: float = 0.6, seed: int = SEED) -> DataFrame:
    """``round(share * n)`` rows of each unit without replacement (ties round to even)."""
    sized = attach(df, layout, _rows=F.count(F.lit(1)))
    ranked = hash_rank(sized, layout.unit, [*layout.unit, layout.cycle], seed, rows="_rows")
    return ranked.where(F.col("_rank") <= F.bround(F.col("_rows") * F.lit(share))).drop("_rank", "_rows")


def stratified_split(
    df: DataFrame,
    label: str,
    row_key: Sequence[str],
    share: float = 0.2,
    seed: int = SEED,
    out: str = "part",
) -> DataFrame:
    """Row split that keeps the label shares: ``round(share * n)`` rows of each label are held out."""
    ranked = hash_rank(df, [label], row_key, seed)
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_rows"))
    rows = join_groups(ranked, sizes, [label], row_key)
    part = F.when(
        F.col("_rank") <= F.bround(F.col("_rows") * F.lit(share)), F.lit("validation")
    ).otherwise(F.lit("train"))
    return rows.withColumn(out, part).select(*df.columns, out)


def row_sample(df: DataFrame, rows: int, row_key: Sequence[str], seed: int = SEED) -> DataFrame:
    """At most ``rows`` rows, chosen by hash: those whose hash is among the ``rows`` smallest.

    The hash of the last one is found digit by digit: rows are counted by the next digits of those that begin like it,
    until these are few. The rest is a filter. The counts are taken before this returns.
    """
    hashed = df.withColumn("_hash", hash_of(row_key, seed))
    head, left, inside = "", rows, hashed
    while len(head) < 32:
        digits = len(head) + _HASH_BUCKET_DIGITS
        counts = inside.groupBy(F.substring("_hash", 1, digits).alias("_head")).agg(F.count(F.lit(1)).alias("_n"))
        upto = F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_head"))  # one row for each of 65,536 heads
        last = counts.withColumn("_upto", upto).where(F.col("_upto") >= left).agg(F.min(F.struct("_head", "_upto", "_n"))).first()[0]
        if last is None:  # there are not so many rows
            return df
        head, left = last["_head"], left - (last["_upto"] - last["_n"])
        if left == last["_n"]:  # all that begin like this
            return hashed.where(F.substring("_hash", 1, len(head)) <= head).drop("_hash")
        inside = hashed.where(F.col("_hash").startswith(head))
        if last["_n"] <= _BUCKET_ROWS:
            break
    order = Window.partitionBy(F.lit(0)).orderBy("_hash", *row_key)  # some thousand rows
    edge = inside.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= left).drop("_r")
    return hashed.where(F.substring("_hash", 1, len(head)) < head).unionByName(edge).drop("_hash")


def _multinomial(draws: int, weights: np.ndarray, seed: int, node: str) -> np.ndarray:
    """How many of ``draws`` fall to each weight; the same for the same node and weights, whoever asks."""
    total = weights.sum()
    if not draws or not total:
        return np.zeros(len(weights), dtype=np.int64)
    source = np.random.default_rng(list(hashlib.sha256(f"{seed}:{node}".encode()).digest()))
    return source.multinomial(draws, weights / total)


def weighted_bootstrap(
    df: DataFrame, weight: str, row_key: Sequence[str], seed: int = SEED, draws: int | None = None
) -> DataFrame:
    """Sample with replacement, each row drawn in proportion to its weight; rows come once, with ``draws``.

    Exactly ``draws`` rows are drawn, as many as there are rows by default. The draws are dealt down a tree over the
    rows' hashes: a node deals its draws to its children by their sums of weights, and a leaf of some thousand rows to
    its rows. Each node draws by its own seed and weights are added up exactly, so the sample does not depend on the
    order or place of rows. Weights are taken to 2**-40 of the largest; null and negative ones count as zero, and if
    there is no other, no row is drawn. The rows are counted before this returns.
    """
    from pyspark.sql import types as T

    plain = F.greatest(F.coalesce(F.col(weight).cast("double"), F.lit(0.0)), F.lit(0.0))
    rows, most = df.agg(F.count(F.lit(1)), F.max(plain)).first()
    units = F.round(plain / F.lit(most or 1.0) * F.lit(float(1 << 40))).cast("decimal(14,0)") if most else F.lit(0).cast("decimal(14,0)")
    hashed = df.withColumns({"_hash": hash_of(row_key, seed), "_units": units})
    depth = 0
    while rows > _LEAF_ROWS << (8 * depth):
        depth += 1
    head = lambda level: F.substring("_hash", 1, 2 * level) if level else F.lit("")
    given = df.sparkSession.createDataFrame([("", rows if draws is None else draws)], "_node string, _draws long")
    for level in range(1, depth + 1):
        sums = hashed.groupBy(head(level).alias("_child")).agg(F.sum("_units").cast("double").alias("_w"))
        children = sums.withColumn("_node", F.substring("_child", 1, 2 * (level - 1))).join(given, "_node")

        def deal(node: pa.Table) -> pa.Table:
            node = node.sort_by("_child")
            name, many = node["_node"][0].as_py(), node["_draws"][0].as_py()
            return pa.table({"_node": node["_child"], "_draws": _multinomial(many, node["_w"].to_numpy(), seed, name)})

        given = children.groupBy("_node").applyInArrow(deal, "_node string, _draws long")
    leaves = hashed.withColumn("_node", head(depth)).join(given.withColumnRenamed("_draws", "_of_leaf"), "_node")
    keep = df.columns

    def draw(leaf: pa.Table) -> pa.Table:
        order = pc.sort_indices(leaf, [("_hash", "ascending"), ("_units", "ascending")])
        leaf = leaf.take(order)
        weights = np.array([float(u) for u in leaf["_units"].to_pylist()])
        drawn = _multinomial(leaf["_of_leaf"][0].as_py(), weights, seed, "leaf" + leaf["_node"][0].as_py())
        return leaf.select(keep).append_column("draws", pa.array(drawn.astype(np.int32)))

    schema = T.StructType([*df.schema.fields, T.StructField("draws", T.IntegerType())])
    return leaves.groupBy("_node").applyInArrow(draw, schema).where("draws > 0")


def poisson_bootstrap(
    df: DataFrame, weight: str, row_key: Sequence[str], seed: int = SEED
) -> DataFrame:
    """Like ``weighted_bootstrap``, with about as many draws as rows and no shuffle.

    Draw counts are Poisson with mean weight * n / sum(weight), taken from the row's hash by inverting
    the distribution, so the sample is the same on every run. Rows come once, with ``draws``.
    """
    totals = df.agg(F.count(F.lit(1)).alias("n"), F.sum(weight).alias("w"))
    mean = F.col(weight) * F.col("_all.n") / F.col("_all.w")
    u = F.conv(F.substring(hash_of(row_key, seed), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))
    # The number of cumulative Poisson probabilities that are <= u; 16 + 8 * mean terms leave less
    # than 1e-15 of the distribution.
    terms = F.sequence(F.lit(0), (F.lit(16) + 8 * F.ceil(F.col("_mean"))).cast("int"))
    state = F.struct(
        F.exp(-F.col("_mean")).alias("p"), F.exp(-F.col("_mean")).alias("c"), F.lit(0).alias("k")
    )

    def step(acc, i):
        p = acc["p"] * F.col("_mean") / (i + 1)
        return F.struct(
            p.alias("p"),
            (acc["c"] + p).alias("c"),
            (acc["k"] + F.when(acc["c"] <= F.col("_u"), F.lit(1)).otherwise(F.lit(0))).alias("k"),
        )

    drawn = with_row(df, totals, "_all").withColumn("_mean", mean).withColumn("_u", u).withColumn(
        "draws", F.aggregate(terms, state, step, lambda acc: acc["k"])
    )
    return drawn.where(F.col("draws") > 0).drop("_all", "_mean", "_u")
