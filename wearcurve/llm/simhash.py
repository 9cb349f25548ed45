"""SimHash near duplicates by multi-index hashing.

A text is lower-cased (A-Z), cut into words at ASCII white space, and its 3-word shingles, repeats included, vote
on the 64 bits of a fingerprint; fewer words make one shingle, no word or a null text gives fingerprint zero,
which links like any other. Fingerprints that differ in at most ``DISTANCE`` = 2 bits are linked.

Only distinct fingerprints are compared. Each is cut into two halves, a table holds them by half, and the small
Hamming ball of each half (radius 1 for the first, 0 for the second) is looked up there: if two fingerprints differ
in 2 bits, then either their first halves differ in 1 at most, or their second halves agree. The complete distance
is verified in the join itself, so what it returns are links, at most 2,081 for each fingerprint. A half that many
fingerprints share is cut once more, by the other half, in the same way; nothing is capped.

Rows with a null id take part and are returned; a group's id is the smallest that is not null. Repeated rows are
returned as often as they come. An empty table gives an empty table. Only the id and text columns are read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearcurve.llm.batches import small_batches
from wearcurve.llm.components import connected_components
from wearcurve.sources.tables import materialize

SHINGLE, SEED, DISTANCE = 3, 42, 2
#: Fingerprints that share a half before the other half is used too.
BUCKET = 512


def fingerprint_of(text: str | None) -> int:
    """Fingerprint of a whole text as a signed 64-bit integer."""
    from itertools import islice, repeat

    import numpy as np
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        words = [b" ".join(words)]
        shingles = iter(words)
        n = 1
    else:
        n = len(words) - SHINGLE + 1
        shingles = map(b" ".join, zip(*(islice(words, k, None) for k in range(SHINGLE)), strict=False))
    hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 8192):
        block = hashes[at : at + 8192].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def fingerprint(text: Column | str) -> Column:
    """Fingerprint of whole texts as ``bigint``."""
    small_batches()

    @F.arrow_udf("bigint")
    def votes(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint_of(t) for t in texts.to_pylist()], pa.int64())

    return votes(F.col(text) if isinstance(text, str) else text)


def fingerprint_hex(fingerprint: Column | str) -> Column:
    """16 lower-case hexadecimal digits of a fingerprint."""
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def _half(fp: Column, half: int) -> Column:
    return F.shiftrightunsigned(fp, 32) if half == 0 else fp.bitwiseAND(F.lit(0xFFFFFFFF))


def _quarter(fp: Column, quarter: int) -> Column:
    return F.shiftrightunsigned(fp, 48 - 16 * quarter).bitwiseAND(F.lit(0xFFFF))


def _ball(width: int, radius: int) -> Column:
    """Masks of the Hamming ball; only radii 0 and 1 are needed for two parts and distance 2."""
    return F.array(*[F.lit(0).cast("long"), *[F.lit(1 << k).cast("long") for k in range(width if radius else 0)]])


def links(fingerprints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints (column ``fp``, no repeats) within the distance, a < b."""
    fp = F.col("fp")
    table = fingerprints.select("fp", F.explode(F.array(*[F.struct(F.lit(h).alias("half"), _half(fp, h).alias("value")) for h in (0, 1)])).alias("s")).select("fp", "s.*")
    probes = []
    for h, radius in ((0, 1), (1, 0)):
        ball = fingerprints.select("fp", F.explode(_ball(32, radius)).alias("mask"))
        # of two halves that differ in one bit only the one without it looks for the other
        seeks = ball.where(_half(fp, h).bitwiseAND(F.col("mask")) == 0)
        probes.append(seeks.select("fp", F.lit(h).alias("half"), _half(fp, h).bitwiseXOR(F.col("mask")).alias("value"), (F.col("mask") == 0).alias("same")))
    probe = probes[0].unionByName(probes[1]).withColumnRenamed("fp", "seeker")
    near = (F.bit_count(F.col("seeker").bitwiseXOR(fp)) <= DISTANCE) & (~F.col("same") | (F.col("seeker") < fp))
    keys = ["half", "value"]

    def matches(t: DataFrame, p: DataFrame, on: list[str]) -> DataFrame:
        t = t.select("fp", *[F.col(c).alias("t_" + c) for c in on])
        met = [F.col("t_" + c) == F.col(c) for c in on]
        condition = near
        for m in met:
            condition = condition & m
        return t.join(p, condition).select(F.least("seeker", "fp").alias("a"), F.greatest("seeker", "fp").alias("b"))

    crowded = table.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > bucket).select(*keys)
    crowded = materialize(crowded, "crowded")
    if crowded.isEmpty():
        return matches(table, probe, keys).distinct()
    light = matches(table.join(crowded, keys, "left_anti"), probe, keys)

    def other_quarter(of: Column, part: int) -> Column:
        return F.when(F.col("half") == 0, _quarter(of, 2 + part)).otherwise(_quarter(of, part))

    parts = [F.struct(F.lit(p).alias("part"), other_quarter(fp, p).alias("rest")) for p in (0, 1)]
    fine = table.join(crowded, keys, "left_semi").select("fp", *keys, F.explode(F.array(*parts)).alias("s")).select("fp", *keys, "s.*")
    seekers = probe.join(crowded, keys, "left_semi")
    finer = [
        seekers.select("*", F.lit(p).alias("part"), F.explode(_ball(16, r)).alias("mask"))
        .withColumn("rest", other_quarter(F.col("seeker"), p).bitwiseXOR(F.col("mask")))
        .drop("mask")
        for p, r in ((0, 1), (1, 0))
    ]
    return light.union(matches(fine, finer[0].unionByName(finer[1]), [*keys, "part", "rest"])).distinct()


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", keep: str | None = None) -> DataFrame:
    """(id, fingerprint, component_id, group) of each row; the component id is the smallest id that links reach, the
    group the smallest fingerprint, which tells groups apart where all ids are null.

    ``keep`` names one more column to return, such as a row number.
    """
    kept = [F.col(keep)] if keep else []
    prints = docs.select(F.col(id).alias("id"), *kept, fingerprint(text).alias("fp"))
    prints = materialize(prints, "fingerprints")
    distinct = materialize(prints.groupBy("fp").agg(F.min("id").alias("first")), "distinct_fingerprints")
    edges = materialize(links(distinct.select("fp")), "links")
    groups = connected_components(edges).withColumnRenamed("node", "fp")
    linked = materialize(groups.join(distinct, "fp"), "linked")
    least = linked.groupBy("component").agg(F.min("first").alias("least"))
    labels = linked.join(least, "component").select("fp", "component", "least")
    by_print = distinct.join(labels, "fp", "left").select(
        "fp", F.coalesce("least", "first").alias("component_id"), F.coalesce("component", "fp").alias("group")
    )
    out = prints.join(by_print, "fp")
    return out.select(F.col("id").alias(id), *kept, F.col("fp").alias("fingerprint"), "component_id", "group")
