"""Degradation stages: clustering of each unit's cycles, cluster distances, centroids, stage order."""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wearcurve.functions.features import METRICS, distance
from wearcurve.layout import BLOCK, Layout
from wearcurve.operators import linkage as linkages
from wearcurve.operators import tiles
from wearcurve.operators.blocks import Lookback, attach, join_units, positions, range_positions, shuffle_partitions, spread_groups, unit_table

# executors need not have this package installed
for _module in (sys.modules[__name__], linkages, tiles):
    cloudpickle.register_pickle_by_value(_module)

LINKAGES = ("single", "complete", "average", "ward")

# Fixed values
N_CLUSTERS = 5

METHODS = ("agglomerate", "centroid")

# Largest unit that can be merged bottom-up: its distance matrix takes 512 MB in one task.
MAX_ROWS = 8192
# Centroid rounds end when no centre moves by more than this share of the features' spread.
TOLERANCE = 1e-6
_MOST_ROUNDS = 200
# Links that differ by no more than this share of them are merged one after the other, as ``agglomerate`` says.
NEAR_TIE = 1e-9
# Largest unit whose centroid rounds are one task's.
CENTROID_ROWS = 1 << 16


def _check(linkage: str, metric: str) -> None:
    if linkage not in LINKAGES:
        raise ValueError(f"unknown linkage {linkage!r}: use one of {LINKAGES}")
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}: use one of {METRICS}")


def pair_distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """Distances of every row of ``a`` to every row of ``b``."""
    if metric == "manhattan":
        out = np.zeros((len(a), len(b)))
        for j in range(a.shape[1]):
            out += np.abs(a[:, j, None] - b[None, :, j])
        return out
    if metric == "cosine":
        na, nb = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
        scale = np.outer(na, nb)
        dots = a @ b.T
        return np.where(scale == 0, 1.0, 1.0 - np.divide(dots, scale, out=np.zeros_like(dots), where=scale != 0))
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        out += (a[:, j, None] - b[None, :, j]) ** 2
    return np.sqrt(out)


def agglomerate(x: np.ndarray, k: int, linkage: str, metric: str):
    """Merge the two closest clusters until ``k`` are left.

    Returns the labels, numbered by each cluster's first row, and the merges (a, b, height), where a
    cluster is named by its first row. A matrix of link sums (or extremes) is updated per merge, and
    each row remembers its closest later partner. Equal distances: the earliest pair merges.
    """
    n = len(x)
    link = pair_distances(x, x, metric)
    if linkage == "ward":
        link = link * link
    size = np.ones(n)
    alive = np.ones(n, dtype=bool)

    def heights(i: int, later: np.ndarray) -> np.ndarray:
        if linkage == "average":
            return link[i, later] / (size[i] * size[later])
        if linkage == "ward":
            return link[i, later] / (size[i] + size[later])
        return link[i, later]

    best = np.full(n, np.inf)
    partner = np.full(n, -1)

    def look_up(i: int) -> None:
        later = i + 1 + np.flatnonzero(alive[i + 1 :])
        if len(later) == 0:
            best[i], partner[i] = np.inf, -1
            return
        h = heights(i, later)
        at = int(np.argmin(h))
        best[i], partner[i] = h[at], later[at]

    for i in range(n):
        look_up(i)
    owner = np.arange(n)
    merges = []
    for _ in range(n - k):
        a = int(np.argmin(best))
        b = int(partner[a])
        merges.append((a, b, float(best[a])))
        if linkage == "single":
            link[a] = np.minimum(link[a], link[b])
        elif linkage == "complete":
            link[a] = np.maximum(link[a], link[b])
        else:
            link[a] = link[a] + link[b]
        link[:, a] = link[a]
        size[a] += size[b]
        alive[b] = False
        best[b], partner[b] = np.inf, -1
        owner[owner == b] = a
        look_up(a)
        earlier = np.flatnonzero(alive[:b])
        lost = (partner[earlier] == a) | (partner[earlier] == b)
        for i in earlier[lost]:
            look_up(i)
        # the grown cluster may have come closer to the earlier ones that had another partner
        others = earlier[~lost & (earlier < a)]
        if len(others):
            h = heights(a, others)
            closer = (h < best[others]) | ((h == best[others]) & (a < partner[others]))
            best[others[closer]], partner[others[closer]] = h[closer], a
    roots = np.flatnonzero(alive)
    return np.searchsorted(roots, owner), merges


def ward_labels(x: np.ndarray, k: int, metric: str) -> np.ndarray | None:
    """The labels of ``agglomerate`` by Ward links, or nothing where links are so close that the order of merges may matter.

    Two clusters that are each other's nearest merge sooner or later whatever else merges, so each round merges all such
    pairs; the merges at k clusters are the n - k lowest. Data that merge in very many rounds are left to ``agglomerate``.
    """
    n = len(x)
    if n <= k:
        return None
    # three matrices are made once: fresh ones of this size cost more than what is done with them
    sums, link, rest = (np.empty(n * n) for _ in range(3))
    square = lambda flat, rows, columns=None: flat[: rows * (columns or rows)].reshape(rows, -1)
    if metric == "euclidean":
        total, gaps = square(sums, n), square(link, n)
        for j in range(x.shape[1]):
            out = gaps if j else total
            np.subtract(x[:, j, None], x[None, :, j], out=out)
            np.multiply(out, out, out=out)
            if j:
                total += gaps
    else:
        square(sums, n)[:] = pair_distances(x, x, metric) ** 2
    if not np.isfinite(sums).all():
        return None
    size, name, work = np.ones(n), np.arange(n), 0
    merges = []
    while len(name) > 1:
        m = len(name)
        work += m * m
        if work > 16 * n * n:
            return None
        total, height = square(sums, m), square(link, m)
        np.add(size[:, None], size[None, :], out=height)
        np.divide(total, height, out=height)
        np.fill_diagonal(height, np.inf)
        each = np.arange(m)
        near = height.argmin(axis=1)
        low = height[each, near]
        a = np.flatnonzero((near[near] == each) & (each < near))
        b = near[a]
        height[each, near] = np.inf
        pairs = np.concatenate([a, b])
        if m > 2 and (height[pairs].min(axis=1) <= low[pairs] * (1 + NEAR_TIE)).any():
            return None
        merges += zip(low[a].tolist(), name[a].tolist(), name[b].tolist(), strict=True)
        left = np.ones(m, dtype=bool)
        left[b] = False
        left = np.flatnonzero(left)
        at = np.searchsorted(left, a)
        half = np.take(total, left, axis=0, out=square(rest, len(left), m), mode="clip")
        half[at] += total[b]
        whole = np.take(half, left, axis=1, out=square(sums, len(left)), mode="clip")
        whole[:, at] += half[:, b]
        size[a] += size[b]
        size, name = size[left], name[left]
    merges.sort()
    if merges[n - k][0] <= merges[n - k - 1][0] * (1 + NEAR_TIE):
        return None
    owner = np.arange(n)
    # a cluster is named by its first row and a merge is never lower than those before it; of equal ones the order has no meaning here
    for _, first, second in merges[: n - k]:
        owner[second] = first
    while (owner[owner] != owner).any():
        owner = owner[owner]
    return np.unique(owner, return_inverse=True)[1]


def _unit_groups(df: DataFrame, features: Sequence[str], layout: Layout) -> DataFrame:
    vector = F.array(*[F.col(c).cast("double") for c in features])
    return df.select(*layout.unit, F.col(layout.cycle).alias("_cycle"), vector.alias("_x"))


def _long_enough(df: DataFrame, layout: Layout, n_clusters: int, max_rows: int | None, **more) -> DataFrame:
    """Rows of units with at least ``n_clusters`` rows; a unit of more than ``max_rows`` fails the job. ``more`` is attached."""
    sized = attach(df, layout, _rows=F.count(F.lit(1)), **more).where(F.col("_rows") >= n_clusters)
    if max_rows is not None:
        message = f"a unit has more than {max_rows} rows, too many to merge bottom-up: use method='centroid'"
        sized = sized.where(F.when(F.col("_rows") > max_rows, F.raise_error(F.lit(message))).otherwise(True))
    return sized


def cluster_units(
    df: DataFrame,
    features: Sequence[str],
    layout: Layout,
    n_clusters: int = N_CLUSTERS,
    linkage: str = "ward",
    metric: str = "euclidean",
    method: str = "agglomerate",
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """(unit…, cycle, cluster): each unit's rows in ``n_clusters`` clusters; shorter units are skipped.

    The caller chooses one method for all units. ``agglomerate`` merges rows bottom-up by ``linkage``, one
    group per unit of up to ``max_rows`` rows. Longer units are merged in rounds over tiles of rows
    (``linkage``): single linkage by Euclidean or Manhattan distance, and Ward by Euclidean distance; with
    any other linkage they fail the job. ``centroid`` takes units of any length: distributed centroid rounds, which start from equal stretches of each unit's life and go on
    until no centre moves; it has no linkage. Clusters are numbered by first row or by stretch.
    """
    _check(linkage, metric)
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}: use one of {METHODS}")
    if method == "centroid":
        if linkage != "ward":
            raise ValueError("method 'centroid' has no linkage: leave it at its default")
        given = [F.col(c).cast("double") for c in features]
        odd = F.max(sum(((c.isNull() | F.isnan(c)).cast("int") for c in given), F.lit(0)))
        return _cluster_by_centroids(_long_enough(df, layout, n_clusters, None, _odd=odd), features, layout, n_clusters, metric)
    from pyspark.sql import types as T

    names, cycle = list(layout.unit), layout.cycle

    def solve(group: pa.Table) -> pa.Table:
        group = group.sort_by("_cycle")
        x = tiles.matrix(group["_x"])  # NaN for null
        labels = ward_labels(x, n_clusters, metric) if linkage == "ward" else None
        if labels is None:
            labels, _ = agglomerate(x, n_clusters, linkage, metric)
        return pa.table({**{c: group[c] for c in names}, cycle: group["_cycle"], "cluster": pa.array(labels.astype("int32"))})

    schema = T.StructType([*[df.schema[c] for c in names], df.schema[cycle], T.StructField("cluster", T.IntegerType())])
    by_rounds = (linkage == "single" and metric != "cosine") or (linkage, metric) == ("ward", "euclidean")
    sized = _long_enough(df, layout, n_clusters, None if by_rounds else max_rows)
    longest = unit_table(df, layout, F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] if by_rounds else 0
    if (longest or 0) <= max_rows:
        return spread_groups(_unit_groups(sized, features, layout), names).groupBy(*names).applyInArrow(solve, schema)
    short = _unit_groups(sized.where(F.col("_rows") <= max_rows), features, layout)
    short = spread_groups(short, names).groupBy(*names).applyInArrow(solve, schema)
    rows = _unit_groups(sized.where(F.col("_rows") > max_rows), features, layout).withColumnRenamed("_cycle", "id")
    found = linkages.long_clusters(rows.withColumn("id", F.col("id").cast("long")), names, n_clusters, linkage, metric)
    return short.unionByName(found.select(*names, F.col("id").cast(df.schema[cycle].dataType).alias(cycle), "cluster"))


def dendrograms(
    df: DataFrame,
    features: Sequence[str],
    layout: Layout,
    n_clusters: int = N_CLUSTERS,
    linkage: str = "ward",
    metric: str = "euclidean",
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """(unit…, step, a, b, height) of bottom-up merging; a and b are first cycles.

    Like ``agglomerate``, it fails if a unit has more than ``max_rows`` rows.
    """
    _check(linkage, metric)
    from pyspark.sql import types as T

    names = list(layout.unit)

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_cycle")
        cycles = group["_cycle"].to_numpy()
        _, merges = agglomerate(np.array(group["_x"].tolist()), n_clusters, linkage, metric)
        out = pd.DataFrame(
            [(step, cycles[a], cycles[b], h) for step, (a, b, h) in enumerate(merges)],
            columns=["step", "a", "b", "height"],
        )
        for name in reversed(names):
            out.insert(0, name, group[name].iloc[0])
        return out

    fields = [T.StructField("step", T.IntegerType())]
    fields += [T.StructField(c, df.schema[layout.cycle].dataType) for c in ("a", "b")]
    schema = T.StructType([*[df.schema[c] for c in names], *fields, T.StructField("height", T.DoubleType())])
    rows = _unit_groups(_long_enough(df, layout, n_clusters, max_rows), features, layout)
    return spread_groups(rows, names).groupBy(*names).applyInPandas(solve, schema)


def _cluster_by_centroids(df: DataFrame, features: Sequence[str], layout: Layout, k: int, metric: str) -> DataFrame:
    """Centroid rounds until no centre moves: of a unit of up to ``CENTROID_ROWS`` rows in one task, of others together.

    A round of long units, and of those with nulls, joins every row to its unit's centroids on (unit, block) and averages again. Only the
    centroids, k per unit, change between rounds; they are written to the shared folder, so that a
    round's plan does not contain the rounds before it. A cluster that loses all its rows starts anew at
    the unit's row that is farthest from its centre, so a unit with k distinct rows keeps k clusters.
    """
    from wearcurve.sources.tables import materialize

    vector = F.array(*[F.col(c).cast("double") for c in features])
    rows = positions(df, layout)
    start = F.floor((F.col("_pos") - 1) * k / F.col("_rows")).cast("int")
    alone = (F.col("_odd") == 0) & (F.col("_rows") <= CENTROID_ROWS)
    rows = materialize(rows.select(*layout.unit, layout.cycle, vector.alias("_x"), start.alias("cluster"), F.coalesce(alone, F.lit(False)).alias("_alone")), "unit-rows")
    width = len(features)
    spread = rows.agg(*[F.stddev_pop(F.col("_x")[j]) for j in range(width)]).first()
    limit = TOLERANCE * (sum((s or 0.0) ** 2 for s in spread) ** 0.5 or 1.0)
    short, rows = rows.where("_alone").drop("_alone"), rows.where("NOT _alone").drop("_alone")
    found = _short_centroids(short, layout, k, metric, limit)
    if rows.isEmpty():
        return found
    return found.unionByName(_long_centroids(rows, layout, width, k, metric, limit))


def unit_centroids(x: np.ndarray, cluster: np.ndarray, k: int, metric: str, limit: float) -> np.ndarray:
    """The clusters of one unit's rows after centroid rounds from given ones; as ``_long_centroids``, until nothing moves at all."""
    before, far = None, np.zeros(len(x))
    for _ in range(_MOST_ROUNDS):
        size = np.bincount(cluster, minlength=k)
        centres = np.column_stack([np.bincount(cluster, weights=x[:, j], minlength=k) for j in range(x.shape[1])]) / np.maximum(size, 1)[:, None]
        empty = np.flatnonzero(size == 0)
        if len(empty):
            # the farthest rows of different clusters, one for each empty cluster as far as they go
            order = np.lexsort((*x.T[::-1], far))
            place = np.empty(len(x), dtype=np.int64)
            place[order] = np.arange(len(x))
            last = np.full(k, -1)
            np.maximum.at(last, cluster, place)
            heads = order[np.sort(last[last >= 0])[::-1]][: len(empty)]
            centres[empty[: len(heads)]] = x[heads]
            centres[empty[len(heads) :]] = np.nan
        held = np.flatnonzero(~np.isnan(centres[:, 0]))
        d = pair_distances(x, centres[held], metric)
        at = d.argmin(axis=1)
        after, far = held[at].astype(cluster.dtype), d[np.arange(len(x)), at]
        moved = np.inf if before is None else np.nanmax(pair_gaps(before, centres))
        if moved == 0 or (not len(empty) and (after == cluster).all()):
            return after
        cluster, before = after, centres
    if moved <= limit:
        return cluster
    raise RuntimeError(f"centres still move after {_MOST_ROUNDS} rounds")


def pair_gaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distance of each row of ``a`` to the same row of ``b``; endless where one of them is missing."""
    gaps = np.sqrt(((a - b) ** 2).sum(axis=1))
    return np.where(np.isnan(a[:, 0]) != np.isnan(b[:, 0]), np.inf, np.where(np.isnan(a[:, 0]), 0.0, gaps))


def _short_centroids(rows: DataFrame, layout: Layout, k: int, metric: str, limit: float) -> DataFrame:
    names, cycle = list(layout.unit), layout.cycle

    def solve(group: pa.Table) -> pa.Table:
        group = group.sort_by(cycle)
        found = unit_centroids(tiles.matrix(group["_x"]), group["cluster"].to_numpy(), k, metric, limit)
        return pa.table({**{c: group[c] for c in (*names, cycle)}, "cluster": pa.array(found.astype("int32"))})

    schema = tiles.schema_of(rows, [*names, cycle, "cluster"])
    return spread_groups(rows, names).groupBy(*names).applyInArrow(solve, schema)


def _long_centroids(rows: DataFrame, layout: Layout, width: int, k: int, metric: str, limit: float) -> DataFrame:
    from wearcurve.sources.tables import materialize

    rows = materialize(rows, "long-rows")
    centres = materialize(_unit_centres(rows.withColumn("_d", F.lit(0.0)), width, layout, k), "centres")
    for _ in range(_MOST_ROUNDS):
        moved = _to_nearest(rows, centres, layout, metric)
        after = materialize(_unit_centres(moved, width, layout, k), "centres")
        if not _moves(centres, after, layout, limit):
            return _to_nearest(rows, after, layout, metric).drop("_x", "_d")
        centres = after
    raise RuntimeError(f"centres still move after {_MOST_ROUNDS} rounds")


def _moves(before: DataFrame, after: DataFrame, layout: Layout, limit: float) -> bool:
    """Whether any centre of any unit moved by more than ``limit``."""
    both = before.select(*layout.unit, F.col("_centres").alias("_was")).join(after, list(layout.unit))
    gaps = F.zip_with("_was", "_centres", lambda a, b: distance(a["_c"], b["_c"], "euclidean"))
    return (both.agg(F.max(F.array_max(gaps))).first()[0] or 0.0) > limit


def _unit_centres(rows: DataFrame, width: int, layout: Layout, k: int) -> DataFrame:
    """(unit…, block range, centres): the mean vector of each cluster of a unit as one array by cluster.

    Clusters without rows get the unit's rows that are farthest from their centres (column ``_d``).
    """
    blocked = layout.with_block(rows)
    means = blocked.groupBy(*layout.unit, "cluster").agg(
        F.array(*[F.avg(F.col("_x")[j]) for j in range(width)]).alias("_c"),
        F.max(F.struct("_d", "_x")).alias("_far"),
        F.min(BLOCK).alias("_lo"),
        F.max(BLOCK).alias("_hi"),
    )
    units = means.groupBy(*layout.unit).agg(
        F.map_from_entries(F.collect_list(F.struct("cluster", "_c"))).alias("_by"),
        F.reverse(F.sort_array(F.collect_list("_far"))).alias("_fars"),
        F.min("_lo").alias("_lo_blk"),
        F.max("_hi").alias("_hi_blk"),
    )
    every = F.sequence(F.lit(0), F.lit(k - 1))
    empty = F.filter(every, lambda c: ~F.map_contains_key("_by", c))
    # the farthest rows of different clusters, one for each empty cluster as far as they go
    spare = lambda c: F.try_element_at("_fars", F.array_position(empty, c).cast("int"))["_x"]
    filled = F.transform(every, lambda c: F.struct(c.alias("cluster"), F.coalesce(F.try_element_at("_by", c), spare(c)).alias("_c")))
    return units.select(*layout.unit, F.filter(filled, lambda s: s["_c"].isNotNull()).alias("_centres"), "_lo_blk", "_hi_blk")


def _to_nearest(rows: DataFrame, centres: DataFrame, layout: Layout, metric: str) -> DataFrame:
    placed = join_units(rows.drop("cluster"), centres, layout)
    scored = F.transform(
        "_centres", lambda c: F.struct(distance(F.col("_x"), c["_c"], metric).alias("d"), c["cluster"].alias("cluster"))
    )
    best = placed.withColumn("_best", F.array_min(scored))
    return best.select(*layout.unit, layout.cycle, "_x", F.col("_best.cluster").alias("cluster"), F.col("_best.d").alias("_d"))


def order_stages(
    clusters: DataFrame, layout: Layout, cluster: str = "cluster", out: str = "degradation_stage"
) -> DataFrame:
    """Number each unit's clusters by ascending mean cycle (ties by cluster id), 0 first."""
    means = clusters.groupBy(*layout.unit, cluster).agg(F.avg(layout.cycle).alias("_mean"))
    # a unit has as many rows here as clusters
    rank = Window.partitionBy(*layout.unit).orderBy("_mean", cluster)
    ordered = means.withColumn(out, F.row_number().over(rank) - 1)
    lookup = ordered.groupBy(*layout.unit).agg(F.map_from_entries(F.collect_list(F.struct(cluster, out))).alias("_map"))
    units = unit_table(clusters, layout).join(lookup, list(layout.unit))
    rows = join_units(clusters, units, layout)
    return rows.withColumn(out, F.col("_map")[F.col(cluster)].cast("int")).drop("_map")


def stage_statistics(df: DataFrame, features: Sequence[str], layout: Layout, stage: str = "degradation_stage") -> DataFrame:
    """Rows, mean and population deviation of each feature per unit and stage."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in features:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std")]
    return df.groupBy(*layout.unit, F.col(stage).alias("stage")).agg(*aggs)


def stage_profiles(statistics: DataFrame) -> DataFrame:
    """Fleet profile of each stage: total rows and the plain mean of the units' means."""
    means = [c for c in statistics.columns if c.endswith("_mean")]
    return statistics.groupBy("stage").agg(F.sum("n").alias("n"), *[F.avg(c).alias(c) for c in means])


def centroids(df: DataFrame, vector: str, by: Sequence[str], width: int) -> DataFrame:
    """Mean vector per group: rows (by…, centroid). Sums merge on the map side."""
    mean = F.array(*[F.avg(F.get(F.col(vector), F.lit(j)).cast("double")) for j in range(width)])
    return df.groupBy(*by).agg(mean.alias("centroid"))


def nearest_centroid(
    df: DataFrame, vector: str, centres: DataFrame, label: str, metric: str = "euclidean", chunk: int = 1000
) -> DataFrame:
    """The closest centroid of each row, the first label on ties; ``centres`` is (label, centroid).

    Up to ``chunk`` centroids travel as one array. More are cut into tiles, and so are the rows: a row's limit is its
    nearest centroid in the tile next to its own, and only tiles within that limit are looked into. By cosine there are
    no such limits: then centroids travel as arrays of at most ``chunk``, and a row keeps the best of each and of all.
    The centroids are counted, and tiles written, before this returns.
    """
    from wearcurve.sources.tables import materialize

    listed = materialize(centres.select(F.col(label).alias("label"), F.col("centroid").cast("array<double>").alias("centroid")), "centroids")
    many = listed.count()
    if many > chunk and metric != "cosine":
        return _nearest_by_tiles(df, vector, listed, metric)
    numbered = listed.withColumn("_chunk", F.lit(0).cast("long"))
    if many > chunk:
        numbered = materialize(range_positions(listed, [], ["label"]).withColumn("_chunk", F.floor((F.col("_pos") - 1) / chunk)), "numbered")
    rows = df
    kind = f"struct<d:double,label:{listed.schema['label'].dataType.simpleString()}>"
    best = [F.lit(None).cast(kind)]
    for i in range(-(-many // chunk)):
        packed = numbered.where(F.col("_chunk") == i).agg(F.sort_array(F.collect_list(F.struct("label", "centroid")))).scalar()
        rows = rows.withColumn(f"_centres{i}", packed)
        scored = F.transform(
            f"_centres{i}",
            lambda c: F.struct(distance(F.col(vector), c["centroid"], metric).cast("double").alias("d"), c["label"].alias("label")),
        )
        best.append(F.array_min(scored))
    rows = rows.withColumn("_best", F.array_min(F.array(*best)))
    return rows.select(*df.columns, F.col("_best.label").alias("nearest"), F.col("_best.d").alias("distance"))


def _nearest_by_tiles(df: DataFrame, vector: str, listed: DataFrame, metric: str) -> DataFrame:
    from pyspark.sql import types as T

    from wearcurve.sources.tables import materialize

    rows = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "nearest-rows")
    points = rows.select("_row", F.col(vector).cast("array<double>").alias("_x")).where("_x IS NOT NULL")
    points = tiles.space_tiles(points, [], "_row", "_x")
    heads = tiles.space_tiles(listed.select("label", F.col("centroid").alias("_x")), [], "label", "_x")
    heads = heads.withColumn("_tile", -1 - F.col("_tile"))
    width = heads.agg(F.max(F.size("_x"))).first()[0] or 1
    kind = listed.schema["label"].dataType

    def nearest(cell: pa.Table) -> pa.Table:
        """The nearest centroid of the cell for each of its rows, the first label of equals."""
        looks = cell["_looks"].to_numpy(zero_copy_only=False).astype(bool)
        here, there = cell.filter(pa.array(looks)), cell.filter(pa.array(~looks)).sort_by("label")
        if not len(there) or not len(here):
            return pa.table({"_row": pa.array([], pa.int64()), "_d": pa.array([], pa.float64()), "label": cell["label"].slice(0, 0)})
        x, y = tiles.matrix(here["_x"]), tiles.matrix(there["_x"])
        at, low = np.zeros(len(x), dtype=np.int64), np.zeros(len(x))
        for i in range(0, len(x), 1024):
            d = linkages.apart(x[i : i + 1024], y, metric)
            at[i : i + 1024] = d.argmin(axis=1)
            low[i : i + 1024] = d.min(axis=1)
        return pa.table({"_row": here["_row"], "_d": low, "label": there["label"].take(pa.array(at))})

    schema = T.StructType([T.StructField("_row", T.LongType()), T.StructField("_d", T.DoubleType()), T.StructField("label", kind)])
    # the tile of centroids next to each tile of rows
    guess = tiles.nearest_tiles(points, heads, "_x", width, metric)
    looks = points.join(guess, "_tile").select("_row", F.lit(None).cast(kind).alias("label"), "_x", F.col("_tile").alias("_from"), F.col("_next").alias("_to"), F.lit(True).alias("_looks"))
    known = heads.join(guess.select(F.col("_tile").alias("_from"), F.col("_next").alias("_tile")), "_tile")
    known = known.select(F.lit(None).cast("long").alias("_row"), "label", "_x", "_from", F.col("_tile").alias("_to"), F.lit(False).alias("_looks"))
    first = materialize(looks.unionAll(known).groupBy("_from", "_to").applyInArrow(nearest, schema), "nearest-first")
    limited = points.join(first.select("_row", F.col("_d").alias("_limit")), "_row")
    every = limited.select("_row", F.lit(None).cast(kind).alias("label"), "_x", "_tile", "_limit", F.lit(False).alias("_answers"))
    every = every.unionAll(heads.select(F.lit(None).cast("long"), "label", "_x", "_tile", F.lit(None).cast("double"), F.lit(True)))
    met = tiles.meetings(materialize(every, "nearest-all"), [], "_x", width, "_limit", metric=metric, answers="_answers")
    found = first.unionAll(met.groupBy("_from", "_to").applyInArrow(nearest, schema))
    best = found.groupBy("_row").agg(F.min(F.struct("_d", "label")).alias("_b"))
    joined = rows.join(best, "_row", "left")
    d = F.col("_b._d") if metric == "manhattan" else F.sqrt("_b._d")
    return joined.select(*df.columns, F.col("_b.label").alias("nearest"), d.alias("distance"))


def distance_to_previous(df: DataFrame, features: Sequence[str], layout: Layout) -> DataFrame:
    """All three distances of each row to the unit's previous row (null on the first)."""
    look = Lookback(layout, 1)
    rows = look.open(df.withColumn("_x", F.array(*[F.col(c).cast("double") for c in features])))
    rows = look.close(rows.withColumn("_prev", F.lag("_x").over(look.window)))
    new = {m: F.when(F.col("_prev").isNotNull(), distance(F.col("_x"), F.col("_prev"), m)) for m in METRICS}
    return rows.withColumns(new).drop("_x", "_prev")


def ward_links(df: DataFrame, features: Sequence[str], keys: Sequence[str], cluster: str) -> DataFrame:
    """Ward-like link of every two clusters of a group: sum of squared pair distances / (n_a + n_b).

    The sum over all pairs of rows equals n_b * Q_a + n_a * Q_b - 2 * S_a . S_b with each cluster's row
    count n, coordinate sums S and sum of squares Q, so the pairs themselves are never formed. Sums are
    taken around the group's mean.
    """
    keys = list(keys)
    return _links(df, features, keys, cluster).select(
        *keys, "a", "b", (F.col("_pairs") / (F.col("_na") + F.col("_nb"))).alias("link")
    )


def _links(df: DataFrame, features: Sequence[str], keys: list[str], cluster: str) -> DataFrame:
    stats = df.groupBy(*keys, F.col(cluster).alias("c")).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.avg(F.col(f).cast("double")) for f in features]).alias("m"),
        F.array(*[F.var_pop(F.col(f).cast("double")) for f in features]).alias("v"),
    )
    # one array of clusters per group, as long as the group has clusters
    packed = stats.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("c", "n", "m", "v"))).alias("all"))
    first = packed.select(*keys, "all", F.posexplode("all").alias("i", "x"))
    pairs = first.select(*keys, "x", F.explode(F.slice("all", F.col("i") + 2, F.size("all"))).alias("y"))
    total = lambda arr: F.aggregate(arr, F.lit(0.0), lambda acc, v: acc + v)
    gap = total(F.zip_with(F.col("x.m"), F.col("y.m"), lambda p, q: (p - q) * (p - q)))
    na, nb = F.col("x.n"), F.col("y.n")
    # sum over pairs of |x - y|^2 = na * nb * (spread of a + spread of b + squared centre distance)
    pair_sum = na * nb * (total(F.col("x.v")) + total(F.col("y.v")) + gap)
    return pairs.select(
        *keys, F.col("x.c").alias("a"), F.col("y.c").alias("b"), na.alias("_na"), nb.alias("_nb"), pair_sum.alias("_pairs")
    )


def pair_links(
    df: DataFrame,
    features: Sequence[str],
    layout: Layout,
    cluster: str,
    metric: str = "euclidean",
    tile_rows: int = 2048,
) -> DataFrame:
    """Single, complete, average and Ward-like link of every two clusters of a unit, for any metric.

    Rows are cut into tiles of at most ``tile_rows`` consecutive positions. One group holds two tiles
    of a unit, works out their distances in memory and returns one row per pair of clusters, so neither
    a whole unit nor a list of row pairs ever exists.
    """
    _check("single", metric)
    names = list(layout.unit)
    placed = positions(df, layout)
    placed = attach(placed, layout, _rows=F.count(F.lit(1)))
    tile = F.floor((F.col("_pos") - 1) / F.lit(tile_rows)).cast("int")
    tiles = F.ceil(F.col("_rows") / F.lit(tile_rows)).cast("int")
    vector = F.array(*[F.col(c).cast("double") for c in features])
    other = F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1))
    spread = (
        placed.select(*names, tile.alias("_tile"), tiles.alias("_tiles"), vector.alias("_x"), F.col(cluster).cast("int").alias("_cl"))
        .select("*", other.alias("_other"))
        .withColumn("_i", F.least("_tile", "_other"))
        .withColumn("_j", F.greatest("_tile", "_other"))
        .drop("_tiles", "_other")
    )

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        low, high = group["_i"].iloc[0], group["_j"].iloc[0]
        left = group[group["_tile"] == low]
        right = group[group["_tile"] == high]
        out = []
        for a, x in left.groupby("_cl"):
            xa = np.array(x["_x"].tolist())
            for b, y in right.groupby("_cl"):
                # inside one tile each pair of clusters is met twice: keep a < b
                if a == b or (low == high and a > b):
                    continue
                d = pair_distances(xa, np.array(y["_x"].tolist()), metric)
                out.append((min(a, b), max(a, b), d.min(), d.max(), d.sum(), (d * d).sum(), d.size))
        frame = pd.DataFrame(out, columns=["a", "b", "lo", "hi", "s", "q", "n"])
        for name in reversed(names):
            frame.insert(0, name, group[name].iloc[0])
        return frame

    from pyspark.sql import types as T

    kinds = [("a", T.IntegerType()), ("b", T.IntegerType())]
    kinds += [(c, T.DoubleType()) for c in ("lo", "hi", "s", "q")] + [("n", T.LongType())]
    schema = T.StructType([*[df.schema[c] for c in names], *[T.StructField(c, t) for c, t in kinds]])
    cells = [*names, "_i", "_j"]
    parts = spread_groups(spread, cells).groupBy(*cells).applyInPandas(solve, schema)
    links = parts.groupBy(*names, "a", "b").agg(
        F.min("lo").alias("single"),
        F.max("hi").alias("complete"),
        (F.sum("s") / F.sum("n")).alias("average"),
        F.sum("q").alias("_q"),
    )
    sizes = df.groupBy(*names, F.col(cluster).cast("int").alias("_cl")).agg(F.count(F.lit(1)).alias("_n"))
    per_unit = sizes.groupBy(*names).agg(F.map_from_entries(F.collect_list(F.struct("_cl", "_n"))).alias("_sizes"))
    # one row per unit and pair of clusters joined to one row per unit
    return (
        links.join(per_unit, names)
        .withColumn("ward", F.col("_q") / (F.col("_sizes")[F.col("a")] + F.col("_sizes")[F.col("b")]))
        .select(*names, "a", "b", "single", "complete", "average", "ward")
    )


def extreme_links(
    df: DataFrame, features: Sequence[str], layout: Layout, cluster: str, metric: str = "euclidean", tile_rows: int = tiles.TILE_ROWS
) -> DataFrame:
    """Single and complete link of every two clusters of a unit, without comparing all tiles of their rows.

    The rows of a cluster are cut into compact tiles. The distances of one row of each tile bound both links, so only
    tiles whose boxes may hold a nearer or a farther pair are compared; rows of other tiles are shipped nowhere. For
    distances in a plane of coordinates: Euclidean or Manhattan. The tiles are written before this returns.
    """
    from pyspark.sql import types as T

    if metric not in ("euclidean", "manhattan"):
        raise ValueError(f"no bounds for metric {metric!r}: use pair_links")
    names = list(layout.unit)
    vector = F.array(*[F.col(c).cast("double") for c in features])
    rows = df.select(*names, F.col(cluster).cast("int").alias("_cl"), F.col(layout.cycle).alias("_id"), vector.alias("_x"))
    cut = tiles.space_tiles(rows, [*names, "_cl"], "_id", "_x", tile_rows)
    wanted = extreme_pairs(cut, names, len(features), metric)
    sides = []
    for side, tile, left in (("a", "_ta", True), ("b", "_tb", False)):
        own = cut.withColumnsRenamed({"_cl": side, "_tile": tile})
        sides.append(own.join(wanted, [*names, side, tile]).select(*names, "a", "b", "_ta", "_tb", "_x", F.lit(left).alias("_left")))

    def solve(cell: pa.Table) -> pa.Table:
        left = cell["_left"].to_numpy(zero_copy_only=False).astype(bool)
        x = tiles.matrix(cell["_x"])
        d = linkages.apart(x[left], x[~left], metric)
        return pa.table({**tiles.keyed(cell, [*names, "a", "b"], 1), "lo": [float(d.min())], "hi": [float(d.max())]})

    schema = tiles.schema_of(wanted, [*names, "a", "b"], lo=T.DoubleType(), hi=T.DoubleType())
    found = sides[0].unionAll(sides[1]).groupBy(*names, "a", "b", "_ta", "_tb").applyInArrow(solve, schema)
    links = found.groupBy(*names, "a", "b").agg(F.min("lo").alias("single"), F.max("hi").alias("complete"))
    return links if metric == "manhattan" else links.withColumns({c: F.sqrt(c) for c in ("single", "complete")})


def extreme_pairs(cut: DataFrame, names: Sequence[str], width: int, metric: str, every: bool = False) -> DataFrame:
    """(unit…, a, b, _ta, _tb): pairs of tiles that may hold the nearest or the farthest rows of two clusters, or all pairs."""
    salts = shuffle_partitions(cut)
    box = tiles.boxes(cut, [*names, "_cl"], "_x", width, _rep=F.min_by("_x", "_id"))
    left = box.select(*names, F.col("_cl").alias("a"), F.col("_tile").alias("_ta"), F.struct("lo", "hi", "_rep").alias("_a"), F.pmod(F.xxhash64("_tile"), F.lit(salts)).alias("_salt"))
    spread = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("_salt")
    right = box.select(*names, F.col("_cl").alias("b"), F.col("_tile").alias("_tb"), F.struct("lo", "hi", "_rep").alias("_b"), spread)
    sides = [F.col(c) for c in ("_a.lo", "_a.hi", "_b.lo", "_b.hi")]
    pairs = left.join(right, [*names, "_salt"]).where("a < b").withColumns(
        {"_near": tiles.box_gap(*sides, metric), "_far": tiles.box_reach(*sides, metric), "_one": tiles.gap(F.col("_a._rep"), F.col("_b._rep"), F.col("_b._rep"), metric)}
    )
    pairs = pairs.select(*names, "a", "b", "_ta", "_tb", "_near", "_far", "_one")
    if every:
        return pairs
    bounds = pairs.groupBy(*names, "a", "b").agg(F.min("_one").alias("_most"), F.max("_one").alias("_least"))
    near = (F.col("_near") <= F.col("_most")) | (F.col("_far") >= F.col("_least"))
    return pairs.join(bounds, [*names, "a", "b"]).where(near).select(*names, "a", "b", "_ta", "_tb")
