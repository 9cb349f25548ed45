"""Merkle manifest of a dataset: one tree for each group of rows, one tree over the groups' roots.

Rows become leaves in ascending order inside their group. Two nodes next to each other become their parent, the
digest of both digests as text; a last node without a neighbour becomes the digest of its own. The roots of the
groups, in ascending order of the group (null first, by UTF-8 bytes), are joined in the same way.

Only every ``STRIDE``-th level is stored (and the root of each tree): a level is cut into aligned subtrees of
2 ** STRIDE nodes, each small enough for one task, and a subtree hands only its top to the next stored level. Proofs go
the other way: the interior nodes of a subtree are worked out again from its stored nodes, every node gets its
siblings followed by those of the subtree's top, and the interior nodes are dropped. So a tree of n leaves takes n / 255
more stored nodes, and a group with any share of the rows is as many tasks as it has subtrees.

A proof is an array with a step for each level up to the overall root: ``L`` or ``R`` and the digest of the sibling on
that side, or the empty text where a node had no sibling.

Order among rows that are equal in all sort columns is that of the stored table. Null groups and null sort values come
first. Empty tables give a manifest without nodes and no proofs. Columns that are not named are not read. Long texts
are hashed where they are read and never shuffled; only digests are. ``build`` and ``prove`` start jobs before they
return (sizes of trees, stored levels).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wearcurve.sources.tables import materialize, scratch_path

#: Levels from one stored level to the next.
STRIDE = 8
_NODE = "tree string, position long, count long, digest string"


def digest(*values: Column | str) -> Column:
    """Digest of a row: of each value ``-`` if null, else its bytes in UTF-8 as a decimal, ``:`` and the value."""
    texts = [(F.col(v) if isinstance(v, str) else v).cast("string") for v in values]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t), F.lit(":"), t), F.lit("-")) for t in texts)), 256)


@dataclass(frozen=True)
class Manifest:
    """Stored levels of the trees of all groups, leaves first, and of the tree over their roots."""

    groups: tuple[DataFrame, ...]
    top: tuple[DataFrame, ...]


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Stored rows with their ``position`` in their ``tree`` from 0 and its ``count``; ``rows`` must be a stored table.

    Rows are dealt by ranges of (tree, order), counted for each part of a tree, and the counts added up: one row for
    each part, not each row, passes the window.
    """
    keys = ["tree", *order, "stored"]
    dealt = rows.withColumn("stored", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = materialize(dealt.withColumn("place", F.monotonically_increasing_id()), "merkle_sorted")
    part = F.shiftright("place", 33).alias("part")
    parts = placed.groupBy("tree", part).agg(F.min("place").alias("first"), F.count("*").alias("n"))
    tree = Window.partitionBy("tree")
    before = F.sum("n").over(tree.orderBy("part")) - F.col("n")
    parts = parts.select("tree", "part", (before - F.col("first")).alias("base"), F.sum("n").over(tree).alias("count"))
    found = placed.withColumn("part", part).join(parts, ["tree", "part"])
    return found.withColumn("position", F.col("place") + F.col("base")).drop("part", "place", "stored", "base")


def _hash(nodes: Sequence[str]) -> str:
    from hashlib import sha256

    return sha256("".join(nodes).encode()).hexdigest()


def _levels(nodes: list[str], count: int) -> list[list[str]]:
    """Levels of one aligned subtree from its stored nodes to its top; ``count``: nodes of the whole tree's level."""
    levels = [nodes]
    for _ in range(min(STRIDE, (count - 1).bit_length())):
        below = levels[-1]
        levels.append([_hash(below[i : i + 2]) for i in range(0, len(below), 2)])
    return levels


def _tops(subtree: pa.Table) -> pa.Table:
    subtree = subtree.sort_by("position")
    count, first = subtree["count"][0].as_py(), subtree["position"][0].as_py()
    top = _levels(subtree["digest"].to_pylist(), count)[-1]
    row = {"tree": [subtree["tree"][0].as_py()], "position": [first >> STRIDE], "count": [-(-count >> STRIDE)], "digest": top}
    return pa.table(row, schema=pa.schema([("tree", pa.string()), ("position", pa.int64()), ("count", pa.int64()), ("digest", pa.string())]))


def _stored(leaves: DataFrame, path: str) -> tuple[DataFrame, ...]:
    """Every ``STRIDE``-th level of trees with given leaves, each level a table."""
    spark = leaves.sparkSession
    levels = [materialize(leaves, "level", f"{path}/0")]
    most = levels[0].agg(F.max("count")).first()[0] or 0
    while most > 1:
        subtree = F.shiftright("position", STRIDE).alias("subtree")
        open_trees = levels[-1].where("count > 1").select("tree", "position", "count", "digest")
        tops = open_trees.groupBy("tree", subtree).applyInArrow(_tops, _NODE)
        levels.append(materialize(tops, "level", f"{path}/{len(levels)}"))
        most = -(-most >> STRIDE)
    return tuple(spark.read.schema(level.schema).parquet(f"{path}/{i}") for i, level in enumerate(levels))


def _roots(levels: Sequence[DataFrame]) -> DataFrame:
    """(tree, digest) of the root of every tree."""
    found = [level.where("count = 1").select("tree", "digest") for level in levels]
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def build(rows: DataFrame, group: str, order: Sequence[str], leaf: Column, keep: dict[str, Column], path: str | None = None) -> Manifest:
    """Store the manifest of all rows; the columns ``keep`` are stored with the leaves and come back with the proofs."""
    path = path or scratch_path(rows.sparkSession, "merkle")
    # a letter before the group keeps the order of UTF-8 and tells a null from the empty text
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    order_by = [f"order{i}" for i in range(len(order))]
    named = {n: F.col(c) for n, c in zip(order_by, order, strict=True)}
    kept = F.struct(*(c.alias(n) for n, c in keep.items())).alias("row")
    leaves = rows.select(tree.alias("tree"), *(c.alias(n) for n, c in named.items()), leaf.alias("digest"), kept)
    leaves = numbered(materialize(leaves, "merkle_leaves"), [*order_by, "digest"])
    groups = _stored(leaves.select("tree", "position", "count", "digest", "row"), f"{path}/groups")
    roots = _roots(groups).select(F.lit("").alias("tree"), F.col("tree").alias("group"), "digest")
    roots = numbered(materialize(roots, "merkle_roots"), ["group"])
    top = _stored(roots.select("tree", "position", "count", "digest", F.struct("group").alias("row")), f"{path}/top")
    return Manifest(groups, top)


def root(manifest: Manifest) -> DataFrame:
    """One row with the root of all, none for an empty table."""
    return _roots(manifest.top).select(F.col("digest").alias("root"))


def _steps(subtree: pa.Table, above: pa.Table) -> pa.Table:
    """Proofs of the stored nodes of one subtree: their siblings in it, then what its top has."""
    subtree = subtree.sort_by("position")
    levels = _levels(subtree["digest"].to_pylist(), subtree["count"][0].as_py())
    tail = above["proof"][0].as_py()
    ends: list[list[str]] = [tail]  # from the top down, the steps of each node of a level
    for level in reversed(levels[:-1]):
        last = len(level) - 1
        ends = [
            ["L" + level[i - 1] if i & 1 else "R" + level[i + 1] if i < last else "", *ends[i >> 1]]
            for i in range(len(level))
        ]
    kept = [n for n in subtree.schema.names if n in ("tree", "position", "row", "digest")]
    out = subtree.select(kept).append_column("proof", pa.array(ends, pa.list_(pa.string())))
    for name in ("subroot", "root"):
        out = out.append_column(name, pa.array([above[name][0].as_py()] * len(out), pa.string()))
    return out


def _proofs(levels: Sequence[DataFrame], tails: DataFrame) -> DataFrame:
    """Proofs of all leaves; ``tails`` (tree, proof, subroot, root) has what follows the root of each tree."""
    known = None  # of the level above
    for i in reversed(range(len(levels))):
        level = levels[i]
        single = level.where("count = 1").join(tails, "tree")
        names = [n for n in level.columns if n != "count"]
        found = single.select(*names, "proof", "subroot", "root")
        if known is not None:
            keys = ["tree", F.shiftright("position", STRIDE).alias("subtree")]
            subtrees = level.where("count > 1").groupBy(*keys)
            above = known.select("tree", "position", "proof", "subroot", "root").groupBy("tree", F.col("position").alias("subtree"))
            fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in level.schema if f.name != "count")
            below = subtrees.cogroup(above).applyInArrow(_steps, f"{fields}, proof array<string>, subroot string, root string")
            # a top without stored nodes below it is the leaf of a tree with one leaf
            found = found.unionByName(below)
        known = found if i == 0 else materialize(found, "merkle_proofs")
    return known


def prove(manifest: Manifest) -> DataFrame:
    """(row, digest, proof, subroot, root) of every leaf."""
    start = _roots(manifest.top).select("tree", F.array().cast("array<string>").alias("proof"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    of_groups = _proofs(manifest.top, start).select(F.col("row.group").alias("tree"), "proof", F.col("digest").alias("subroot"), "root")
    return _proofs(manifest.groups, of_groups).select("row", "digest", "proof", "subroot", "root")


def siblings_digest(proof: Column) -> Column:
    """Digest of the siblings of a proof, from the leaf up."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.substring(s, 2, 64)), ""), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to, without looking at the manifest."""

    def up(node: Column, step: Column) -> Column:
        side, other = F.substring(step, 1, 1), F.substring(step, 2, 64)
        return F.sha2(F.when(side == "L", F.concat(other, node)).when(side == "R", F.concat(node, other)).otherwise(node), 256)

    return F.aggregate(proof, leaf, up)


def open_manifest(spark: SparkSession, path: str) -> Manifest:
    """A stored manifest."""
    from wearcurve.sources.tables import path_exists

    def levels(name: str) -> tuple[DataFrame, ...]:
        found, i = [], 0
        while path_exists(spark, f"{path}/{name}/{i}"):
            found.append(spark.read.parquet(f"{path}/{name}/{i}"))
            i += 1
        return tuple(found)

    return Manifest(levels("groups"), levels("top"))
