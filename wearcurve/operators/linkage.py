"""Bottom-up clustering of units of any length: single linkage as a minimum spanning tree, Ward by reciprocal neighbours.

Both work in rounds over all units together, on compact tiles (``tiles``): what a cluster looks for lies within a limit
that is known from its own tile, so only rows near another tile's box are shipped there, and no task holds a unit.

*Single linkage.* Each round every component takes its shortest edge to another component, and components joined by
these edges become one; that at least halves them. Trees inside tiles and one edge from tile to tile give the first
limits. The merges at k clusters are the tree without its k - 1 longest edges.

*Ward.* A cluster is its rows, mean and mean squared deviation, so the link of two clusters needs no rows. If two
clusters are each other's nearest, they merge sooner or later whatever else merges, as a merged cluster is never nearer
to others than both its parts were. So each round merges all such pairs. Units of few clusters are finished in one task
by chains of nearest neighbours, with one vector of links at a time. Heights never fall towards the root, so the merges
at k clusters are all but the k - 1 highest.

Equal links are ordered by the rows that name the clusters (their first cycles). Equal vectors are merged first, at height
0. Each round is written to the shared folder; rounds run before a frame is returned.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearcurve.operators.blocks import join_groups, range_parts
from wearcurve.operators.tiles import TILE_ROWS, keyed, matrix, meetings, schema_of, space_tiles
from wearcurve.sources.tables import materialize

_MOST_ROUNDS = 100
#: Clusters of a unit that one task finishes, and components of a unit that one task follows pointers or edges of.
CHAIN, POINTERS = 2048, 100_000


def apart(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """Manhattan, or squared Euclidean, distances of all rows of ``a`` to all of ``b``."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        gaps = a[:, j, None] - b[None, :, j]
        out += np.abs(gaps) if metric == "manhattan" else gaps * gaps
    return out


# components ---------------------------------------------------------------------------------------------------


def _roots(pointers: DataFrame, keys: Sequence[str], most: int) -> DataFrame:
    """(keys, comp, root) from (keys, comp, other): where following ``other`` ends; two that point at each other end at the lesser.

    ``most``: no group has more components. Groups of up to ``POINTERS`` are one task each.
    """
    keys = list(keys)
    if most <= POINTERS:

        def follow(group: pa.Table) -> pa.Table:
            comp, other = group["comp"].to_numpy(), group["other"].to_numpy()
            order = np.argsort(comp)
            # every component points to another one
            to = order[np.searchsorted(comp, other, sorter=order)]
            each = np.arange(len(comp))
            to = np.where((to[to] == each) & (comp < other), each, to)
            while (to[to] != to).any():
                to = to[to]
            return pa.table({**keyed(group, keys, len(group)), "comp": comp, "root": comp[to]})

        return pointers.groupBy(*keys).applyInArrow(follow, schema_of(pointers, keys, comp=T.LongType(), root=T.LongType()))
    back = pointers.select(*keys, F.col("comp").alias("other"), F.col("other").alias("_back"))
    met = pointers.join(back, [*keys, "other"], "left")
    root = F.when((F.col("_back") == F.col("comp")) & (F.col("comp") < F.col("other")), F.col("comp")).otherwise(F.col("other"))
    found = materialize(met.select(*keys, "comp", root.alias("root")), "pointers")
    for _ in range(_MOST_ROUNDS):
        step = found.select(*keys, F.col("comp").alias("root"), F.col("root").alias("_next"))
        nexts = found.join(step, [*keys, "root"], "left")
        moved = nexts.select(*keys, "comp", F.coalesce("_next", "root").alias("root"), (F.coalesce("_next", "root") != F.col("root")).alias("_moved"))
        moved = materialize(moved, "pointers")
        found = moved.drop("_moved")
        if moved.where("_moved").isEmpty():
            return found
    raise RuntimeError(f"pointers still move after {_MOST_ROUNDS} rounds")


def grow(nodes: DataFrame, edges: DataFrame, keys: Sequence[str], more: Callable[[DataFrame, DataFrame], DataFrame] | None = None):
    """Components and a least spanning forest of (keys, a, b, d) edges over (keys, id) nodes.

    ``more(labelled, best)`` may offer edges that are not in the table: (keys, comp, other, d, a, b), from the nodes with
    their components and the best known edge of each component. Returns (keys, id, comp) and the chosen edges.
    """
    keys = list(keys)
    labels = materialize(nodes.select(*keys, "id", F.col("id").alias("comp")), "components")
    most = labels.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    if more is None and most <= POINTERS:
        return _joined(labels, edges, keys), edges
    chosen, open_edges = [], edges
    for _ in range(_MOST_ROUNDS):
        for end, name in (("a", "_ca"), ("b", "_cb")):
            own = labels.select(*keys, F.col("id").alias(end), F.col("comp").alias(name))
            open_edges = open_edges.drop(name).join(own, [*keys, end])
        open_edges = materialize(open_edges.where("_ca != _cb"), "open-edges")
        if open_edges.isEmpty():
            break
        sides = [open_edges.select(*keys, F.col(c).alias("comp"), F.col(o).alias("other"), "d", "a", "b") for c, o in (("_ca", "_cb"), ("_cb", "_ca"))]
        best = _least(sides[0].unionAll(sides[1]), keys)
        if more is not None:
            best = materialize(best, "known-best")
            best = _least(best.unionAll(more(labels, best).select(best.columns)), keys)
        best = materialize(best, "best-edges")
        chosen.append(best.select(*keys, "a", "b", "d").distinct())
        roots = _roots(best.select(*keys, "comp", "other"), keys, most)
        labels = labels.join(roots, [*keys, "comp"], "left").select(*keys, "id", F.coalesce("root", "comp").alias("comp"))
        labels = materialize(labels, "components")
    else:
        raise RuntimeError(f"components still grow after {_MOST_ROUNDS} rounds")
    forest = chosen[0] if chosen else edges.select(*keys, "a", "b", "d").limit(0)
    for part in chosen[1:]:
        forest = forest.unionAll(part)
    return labels, forest


def _joined(nodes: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """Components, named by their least node, of groups that are one task each."""

    def join(group_nodes: pa.Table, group_edges: pa.Table) -> pa.Table:
        ids = np.sort(group_nodes["id"].to_numpy())
        to = np.arange(len(ids))
        a, b = (np.searchsorted(ids, group_edges[c].to_numpy()) for c in ("a", "b"))
        while len(a):
            low = np.minimum(to[a], to[b])
            for end in (a, b):  # the roots of both ends go to the lesser one
                np.minimum.at(to, to[end], low)
            while (to[to] != to).any():
                to = to[to]
            still = to[a] != to[b]
            a, b = a[still], b[still]
        return pa.table({**keyed(group_nodes, keys, len(ids)), "id": ids, "comp": ids[to]})

    return nodes.groupBy(*keys).cogroup(edges.groupBy(*keys)).applyInArrow(join, schema_of(nodes, [*keys, "id", "comp"]))


def _least(edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    best = edges.groupBy(*keys, "comp").agg(F.min(F.struct("d", "a", "b", "other")).alias("_e"))
    return best.select(*keys, "comp", "_e.other", "_e.d", "_e.a", "_e.b")


# single linkage -----------------------------------------------------------------------------------------------


def spanning_tree(rows: DataFrame, keys: Sequence[str], metric: str = "euclidean", tile_rows: int = TILE_ROWS) -> DataFrame:
    """(keys, a, b, d): a least spanning tree of the (keys, id, _x) rows of each group; d is a distance."""
    keys = list(keys)
    rows = materialize(rows, "span-rows")
    # equal vectors hang on the first of them
    first = rows.groupBy(*keys, "_x").agg(F.min("id").alias("_first"))
    same = rows.join(first, [*keys, "_x"]).where("id != _first").select(*keys, F.col("_first").alias("a"), F.col("id").alias("b"), F.lit(0.0).alias("d"))
    points = first.select(*keys, F.col("_first").alias("id"), "_x")
    tiles = space_tiles(points, keys, "id", "_x", tile_rows)
    width = tiles.agg(F.max(F.size("_x"))).first()[0] or 1
    edge = {"a": T.LongType(), "b": T.LongType(), "d": T.DoubleType()}

    def inside(tile: pa.Table) -> pa.Table:
        """A least spanning tree of one tile, row by row."""
        x, ids = matrix(tile["_x"]), tile["id"].to_numpy()
        n = len(ids)
        near, to, out = np.full(n, np.inf), np.full(n, -1), []
        at, left = 0, np.ones(n, dtype=bool)
        for _ in range(n - 1):
            left[at] = False
            d = apart(x[at : at + 1], x, metric)[0]
            closer = d < near
            near[closer], to[closer] = d[closer], at
            at = int(np.argmin(np.where(left, near, np.inf)))
            out.append((ids[at], ids[to[at]], near[at]))
        a, b = (np.array([e[k] for e in out], dtype=np.int64) for k in (0, 1))
        return pa.table({**keyed(tile, keys, len(out)), "a": np.minimum(a, b), "b": np.maximum(a, b), "d": np.array([e[2] for e in out], dtype=float)})

    trees = tiles.groupBy(*keys, "_tile").applyInArrow(inside, schema_of(tiles, keys, **edge))
    heads = tiles.groupBy(*keys, "_tile").agg(F.min_by("id", "id").alias("id"), F.min_by("_x", "id").alias("_x"))
    after = Window.partitionBy(*keys).orderBy("_tile")  # one row for each tile
    links = heads.select(*keys, "id", "_x", F.lag("id").over(after).alias("_i"), F.lag("_x").over(after).alias("_y")).where("_i IS NOT NULL")
    gaps = F.zip_with("_x", "_y", lambda p, q: F.abs(p - q) if metric == "manhattan" else (p - q) * (p - q))
    links = links.select(*keys, F.least("id", "_i").alias("a"), F.greatest("id", "_i").alias("b"), F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g).alias("d"))
    known = materialize(trees.unionAll(links), "known-edges")
    found = {"comp": T.LongType(), "other": T.LongType(), **{k: edge[k] for k in ("d", "a", "b")}}

    def across(cell: pa.Table) -> pa.Table:
        """The shortest edge of each component that looks from one tile into another."""
        looks = cell["_looks"].to_numpy(zero_copy_only=False).astype(bool)
        x, ids, comps = matrix(cell["_x"]), cell["id"].to_numpy(), cell["comp"].to_numpy()
        best: dict[int, tuple] = {}
        there = np.flatnonzero(~looks)
        for at in range(0, int(looks.sum()), 1024):
            here = np.flatnonzero(looks)[at : at + 1024]
            d = apart(x[here], x[there], metric)
            d[comps[here][:, None] == comps[there][None, :]] = np.inf
            if not d.size:
                continue
            low = d.min(axis=1)
            for k in np.flatnonzero(np.isfinite(low)).tolist():
                for j in there[np.flatnonzero(d[k] == low[k])].tolist():
                    i = ids[here[k]]
                    e = (low[k], min(i, ids[j]), max(i, ids[j]), comps[j])
                    c = comps[here[k]]
                    if c not in best or e < best[c]:
                        best[c] = e
        names = ("d", "a", "b", "other")
        columns = {n: np.array([e[q] for e in best.values()], dtype=float if n == "d" else np.int64) for q, n in enumerate(names)}
        return pa.table({**keyed(cell, keys, len(best)), "comp": np.array(list(best), dtype=np.int64), **{n: columns[n] for n in ("other", "d", "a", "b")}})

    def more(labels: DataFrame, best: DataFrame) -> DataFrame:
        limited = tiles.join(labels, [*keys, "id"]).join(best.select(*keys, "comp", F.col("d").alias("_limit")), [*keys, "comp"], "left")
        met = meetings(materialize(limited, "limited"), keys, "_x", width, "_limit", skip="comp", metric=metric)
        return met.groupBy(*keys, "_from", "_to").applyInArrow(across, schema_of(tiles, keys, **found))

    _, tree = grow(points, known, keys, more)
    tree = tree.unionAll(same)
    return tree if metric == "manhattan" else tree.withColumn("d", F.sqrt("d"))


# ward ---------------------------------------------------------------------------------------------------------


def _links(n, x, v, here, there) -> np.ndarray:
    """Ward-like links: the sum of squared distances of all pairs of rows over the rows of both."""
    both = n[here][:, None] * n[there][None, :] / (n[here][:, None] + n[there][None, :])
    return both * (apart(x[here], x[there], "euclidean") + v[here][:, None] + v[there][None, :])


def chain(ids: np.ndarray, n: np.ndarray, x: np.ndarray, v: np.ndarray, h: np.ndarray) -> list[tuple[int, int, float]]:
    """Merges (a, b, height) of all clusters of a unit by chains of nearest neighbours; memory grows with their number."""
    ids, n, x, v, h = ids.copy(), n.astype(float), x.copy(), v.copy(), h.copy()
    alive, out, path = np.ones(len(ids), dtype=bool), [], []
    for _ in range(len(ids) - 1):
        while True:
            if not path:
                path.append(int(np.flatnonzero(alive)[0]))
            at = path[-1]
            others = np.flatnonzero(alive)
            others = others[others != at]
            d = _links(n, x, v, np.array([at]), others)[0]
            low = np.flatnonzero(d == d.min())
            if len(low) > 1:  # of equals the first pair by name
                low = low[np.lexsort((np.maximum(ids[others[low]], ids[at]), np.minimum(ids[others[low]], ids[at])))]
            to, height = int(others[low[0]]), float(d[low[0]])
            if len(path) > 1 and (path[-2] == to or height == _links(n, x, v, np.array([at]), np.array([path[-2]]))[0, 0]):
                to = path[-2]
                break
            path.append(to)
        del path[-2:]
        a, b = (at, to) if ids[at] < ids[to] else (to, at)
        height = max(height, h[a], h[b])
        out.append((int(ids[a]), int(ids[b]), height))
        total = n[a] + n[b]
        apart = ((x[a] - x[b]) ** 2).sum()
        v[a] = (n[a] * v[a] + n[b] * v[b]) / total + n[a] * n[b] / total**2 * apart
        x[a] = (n[a] * x[a] + n[b] * x[b]) / total
        n[a], h[a], alive[b] = total, height, False
    return out


def ward_merges(rows: DataFrame, keys: Sequence[str], tile_rows: int = TILE_ROWS, chain_rows: int = CHAIN) -> DataFrame:
    """(keys, step, a, b, height): all merges of the (keys, id, _x) rows of each group; clusters are named by their least id."""
    keys = list(keys)
    rows = materialize(rows, "ward-rows")
    first = materialize(rows.groupBy(*keys, "_x").agg(F.min("id").alias("id"), F.count(F.lit(1)).cast("double").alias("_n")), "ward-points")
    heads = first.select(*keys, "_x", F.col("id").alias("_first"))
    kept = [*keys, "step", "a", "b", "height"]
    merges = [rows.join(heads, [*keys, "_x"]).where("id != _first").select(*keys, F.lit(0).alias("step"), F.col("_first").alias("a"), F.col("id").alias("b"), F.lit(0.0).alias("height"))]
    clusters = first.select(*keys, "id", "_n", "_x", F.lit(0.0).alias("_v"), F.lit(0.0).alias("_h"))
    best_schema = {"id": T.LongType(), "d": T.DoubleType(), "a": T.LongType(), "b": T.LongType()}
    width = first.agg(F.max(F.size("_x"))).first()[0] or 1

    def best(group: pa.Table, here: np.ndarray, there: np.ndarray) -> pa.Table:
        ids, n, v, x = group["id"].to_numpy(), group["_n"].to_numpy(), group["_v"].to_numpy(), matrix(group["_x"])
        out = []
        for at in range(0, len(here), 1024):
            some = here[at : at + 1024]
            d = _links(n, x, v, some, there)
            d[ids[some][:, None] == ids[there][None, :]] = np.inf
            if not d.size:
                continue
            low = d.min(axis=1)
            for k in np.flatnonzero(np.isfinite(low)).tolist():
                i = ids[some[k]]
                out.append((i, low[k], *min((min(i, j), max(i, j)) for j in ids[there[np.flatnonzero(d[k] == low[k])]].tolist())))
        columns = {c: np.array([o[q] for o in out], dtype=float if c == "d" else np.int64) for q, c in enumerate(best_schema)}
        return pa.table({**keyed(group, keys, len(out)), **columns})

    def own(tile: pa.Table) -> pa.Table:
        every = np.arange(len(tile))
        return best(tile, every, every)

    def others(cell: pa.Table) -> pa.Table:
        looks = cell["_looks"].to_numpy(zero_copy_only=False).astype(bool)
        return best(cell, np.flatnonzero(looks), np.flatnonzero(~looks))

    def finish(unit: pa.Table) -> pa.Table:
        unit = unit.sort_by("id")
        args = [unit[c].to_numpy() for c in ("id", "_n")] + [matrix(unit["_x"])] + [unit[c].to_numpy() for c in ("_v", "_h")]
        made = chain(*args)
        return pa.table(
            {**keyed(unit, keys, len(made)), "step": np.arange(len(made), dtype=np.int32) + (1 << 20), "a": np.array([m[0] for m in made], dtype=np.int64),
             "b": np.array([m[1] for m in made], dtype=np.int64), "height": np.array([m[2] for m in made], dtype=float)}
        )

    for step in range(1, _MOST_ROUNDS):
        clusters = materialize(clusters, "ward-clusters")
        sizes = clusters.groupBy(*keys).agg(F.count(F.lit(1)).alias("_m"))
        if (sizes.agg(F.max("_m")).first()[0] or 0) <= chain_rows:
            break
        tiles = space_tiles(clusters, keys, "id", "_x", tile_rows)
        schema = schema_of(tiles, keys, **best_schema)
        near = materialize(tiles.groupBy(*keys, "_tile").applyInArrow(own, schema), "ward-own")
        limited = tiles.join(near.select(*keys, "id", F.col("d").alias("_limit")), [*keys, "id"], "left")
        limited = materialize(limited.withColumn("_limit", F.coalesce("_limit", F.lit(float("inf")))), "ward-limited")
        met = meetings(limited, keys, "_x", width, "_limit", weigh=("_n", "_v"))
        near = near.unionAll(met.groupBy(*keys, "_from", "_to").applyInArrow(others, schema))
        near = near.groupBy(*keys, "id").agg(F.min(F.struct("d", "a", "b")).alias("_e"))
        pairs = near.groupBy(*keys, F.col("_e.a").alias("a"), F.col("_e.b").alias("b")).agg(F.count(F.lit(1)).alias("_c"), F.min("_e.d").alias("d"))
        pairs = materialize(pairs.where("_c = 2").select(*keys, "a", "b", "d"), "ward-pairs")
        parts = [clusters.select(*keys, F.col("id").alias(c), F.struct("_n", "_x", "_v", "_h").alias(f"_{c}")) for c in ("a", "b")]
        joined = pairs.join(parts[0], [*keys, "a"]).join(parts[1], [*keys, "b"])
        na, nb = F.col("_a._n"), F.col("_b._n")
        apart = F.aggregate(F.zip_with("_a._x", "_b._x", lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, g: s + g)
        merged = materialize(
            joined.select(
                *keys,
                "a",
                "b",
                F.greatest("d", "_a._h", "_b._h").alias("height"),
                (na + nb).alias("_n"),
                F.zip_with("_a._x", "_b._x", lambda p, q: (na * p + nb * q) / (na + nb)).alias("_x"),
                ((na * F.col("_a._v") + nb * F.col("_b._v")) / (na + nb) + na * nb / ((na + nb) * (na + nb)) * apart).alias("_v"),
            ),
            "ward-merged",
        )
        merges.append(merged.select(*keys, F.lit(step).alias("step"), "a", "b", "height"))
        gone = merged.select(*keys, F.col("a").alias("id")).unionAll(merged.select(*keys, F.col("b").alias("id")))
        grown = merged.select(*keys, F.col("a").alias("id"), "_n", "_x", "_v", F.col("height").alias("_h"))
        clusters = clusters.join(gone, [*keys, "id"], "left_anti").unionAll(grown)
    else:
        raise RuntimeError(f"clusters still merge after {_MOST_ROUNDS} rounds")
    rest = clusters.groupBy(*keys).applyInArrow(finish, schema_of(clusters, keys, step=T.IntegerType(), a=T.LongType(), b=T.LongType(), height=T.DoubleType()))
    out = materialize(rest.select(*kept), "ward-chains")
    for part in merges:
        out = out.unionAll(part.select(*kept))
    return out


# clusters -----------------------------------------------------------------------------------------------------


def _on_a_line(rows: DataFrame, keys: Sequence[str], k: int) -> bool:
    """Whether vectors have one given coordinate, and every group at least ``k`` different ones."""
    x = F.get("_x", F.lit(0))
    lost = F.count_if(F.col("_x").isNull() | (F.size("_x") != 1) | x.isNull() | F.isnan(x))
    # as many different values as rows of the inner table, of which each task holds a part
    groups = rows.groupBy(*keys, "_x").agg(lost.alias("_lost")).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.sum("_lost").alias("_lost"))
    least, lost = groups.agg(F.min("_n"), F.sum("_lost")).first()
    return least is not None and least >= k and not lost


def line_clusters(rows: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """Single linkage of vectors of one coordinate: the least spanning tree joins neighbours in the order, so clusters end at the
    k - 1 widest gaps between different values. Groups have at least ``k`` of these."""
    keys = list(keys)
    points = materialize(rows.groupBy(*keys, F.get("_x", F.lit(0)).alias("_v")).agg(F.min("id").alias("_first")), "line-points")
    placed = range_parts(points, [*keys, "_v"])
    own = Window.partitionBy(*keys, "_part").orderBy("_place")
    inside = placed.select(*keys, "_v", "_first", F.lag("_v").over(own).alias("_w"), F.lag("_first").over(own).alias("_i"))
    ends = placed.groupBy(*keys, "_part").agg(*[f(F.struct("_place", "_v", "_first")).alias(n) for f, n in ((F.min, "_lo"), (F.max, "_hi"))])
    after = Window.partitionBy(*keys).orderBy("_part")  # one row for each part
    between = ends.select(*keys, F.col("_lo._v").alias("_v"), F.col("_lo._first").alias("_first"), F.lag("_hi._v").over(after).alias("_w"), F.lag("_hi._first").over(after).alias("_i"))
    gaps = inside.unionAll(between).where("_w IS NOT NULL").select(*keys, "_v", (F.col("_v") - F.col("_w")).alias("d"), F.least("_first", "_i").alias("a"), F.greatest("_first", "_i").alias("b"))
    widest = Window.partitionBy(*keys).orderBy(F.desc("d"), F.desc("a"), F.desc("b"))
    cuts = gaps.withColumn("_r", F.row_number().over(widest)).where(F.col("_r") < k).groupBy(*keys).agg(F.collect_list("_v").alias("_cuts"))
    cuts = materialize(points.select(*keys).distinct().join(cuts, keys, "left").withColumn("_cuts", F.coalesce("_cuts", F.array())), "line-cuts")
    part = F.size(F.filter("_cuts", lambda c: c <= F.col("_v")))
    firsts = join_groups(points, cuts, keys, ["_first"]).withColumn("_p", part).groupBy(*keys, "_p").agg(F.min("_first").alias("_first"))
    order = Window.partitionBy(*keys).orderBy("_first")  # k rows
    named = firsts.withColumn("_c", (F.row_number().over(order) - 1).cast("int")).groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_p", "_c"))).alias("_names"))
    lookup = materialize(cuts.join(named, keys), "line-names")
    found = join_groups(rows.withColumn("_v", F.get("_x", F.lit(0))), lookup, keys, ["id"])
    return found.select(*keys, "id", F.col("_names")[part].alias("cluster"))


def long_clusters(rows: DataFrame, keys: Sequence[str], k: int, linkage: str, metric: str, tile_rows: int = TILE_ROWS, chain_rows: int = CHAIN) -> DataFrame:
    """(keys, id, cluster) of (keys, id, _x) rows: each group in ``k`` clusters, numbered by their least id."""
    keys = list(keys)
    rows = materialize(rows, "long-rows")
    if linkage == "single" and _on_a_line(rows, keys, k):
        return line_clusters(rows, keys, k)
    if linkage == "single":
        tree = spanning_tree(rows, keys, metric, tile_rows).withColumn("step", F.lit(0)).withColumnRenamed("d", "height")
    else:
        tree = ward_merges(rows, keys, tile_rows, chain_rows)
    tree = materialize(tree, "merges")
    highest = Window.partitionBy(*keys).orderBy(F.desc("height"), F.desc("step"), F.desc("a"), F.desc("b"))
    cut = tree.withColumn("_r", F.row_number().over(highest)).where(F.col("_r") < k).select(*keys, "a", "b")
    edges = tree.join(cut, [*keys, "a", "b"], "left_anti").select(*keys, "a", "b", F.col("height").alias("d"))
    labels, _ = grow(rows.select(*keys, "id"), edges, keys)
    # components are named by any of their rows
    firsts = labels.groupBy(*keys, "comp").agg(F.min("id").alias("_first"))
    order = Window.partitionBy(*keys).orderBy("_first")  # k rows
    named = firsts.withColumn("cluster", (F.row_number().over(order) - 1).cast("int")).select(*keys, "comp", "cluster")
    return labels.join(named, [*keys, "comp"]).select(*keys, "id", "cluster")
