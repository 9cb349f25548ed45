"""Cross-entropy difference of two matched language models.

Both models share one vocabulary, the 256 byte values, so no token is unknown to either. They are n-gram models of order
4 with Dirichlet smoothing towards the next lower order. The target model counts the texts marked as target, the background
model counts all texts; background counts are scaled to the target's total, so that smoothing weighs alike in both. A
document's score is the mean over its tokens of target loss minus background loss, in nats: the lower, the more it is like
the target.

Counts are exact and cover all texts whole: tasks count the 4-grams of their part, a shuffle adds them up, and the table
is written, so a model grows with what the corpus holds. Lower orders are sums over it. Only totals come to the driver.

The loss of a token follows from the 4-gram that ends there. ``scored`` deals the texts to blocks of some ``BLOCK`` bytes,
joins each block's distinct 4-grams with their losses, and sums these over each text beside them. A gram is there once for
each run of a block, so a gram that all texts hold is no heavier than their blocks are many.

Null and empty texts have no token and a null score. Without any target text there is no target model: target losses and
differences are null, background losses are unscaled, and all rows stay. An empty table gives an empty table.
Rows are counted and scored as often as they come; a null mark counts as not target. Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearcurve.llm.batches import small_batches
from wearcurve.sources.tables import materialize

STRENGTH = 8.0
#: Bytes worked on at once.
STRETCH = 1 << 20
#: Bytes of text in a block, and of text or different 4-grams that a task gathers before it hands on what it has.
BLOCK, GATHERED = 1 << 23, 1 << 21

_SCORE = T.StructType([T.StructField("n_tokens", T.LongType()), *[T.StructField(c, T.DoubleType()) for c in ("target_loss", "background_loss", "difference")]])


@dataclass(frozen=True)
class Models:
    fours: DataFrame  # (gram, target, both): how often each 4-gram comes in target texts and in all
    threes: DataFrame  # the same of 3-grams
    of_target: int
    of_all: int


def _grams(raw: bytes, at: int = 0):
    """The 4-gram that ends at each byte of a stretch, as a number. Before the text are zero bytes."""
    import numpy as np

    b = np.frombuffer(raw[max(0, at - 3) : at].rjust(3, b"\0") + raw[at : at + STRETCH], dtype=np.uint8).astype(np.uint32)
    return (b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:]


def _bytes(text: pa.Scalar) -> bytes:
    return text.as_buffer().to_pybytes() if text.is_valid else b""


def _stretches(raw: bytes) -> range:
    return range(0, len(raw), STRETCH)


def _summed(counts: DataFrame, mask: int) -> DataFrame:
    """Counts of the lower order that ``mask`` leaves."""
    return counts.groupBy(F.col("gram").bitwiseAND(F.lit(mask)).alias("gram")).agg(F.sum("target").alias("target"), F.sum("both").alias("both"))


def fit(docs: DataFrame, is_target: Column, text: str = "text") -> Models:
    """Count all texts for the background and those where ``is_target`` holds for the target."""
    import numpy as np

    small_batches()
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(is_target, F.lit(False)).alias("target")).where("text != ''")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = {t: (np.zeros(0, np.uint32), np.zeros(0, np.int64)) for t in (False, True)}
        waiting: dict[bool, list] = {False: [], True: []}
        sizes = {False: 0, True: 0}

        def add(target: bool) -> None:
            grams, n = np.unique(np.concatenate(waiting[target]), return_counts=True)
            both, at = np.unique(np.concatenate([have[target][0], grams]), return_inverse=True)
            sums = np.zeros(len(both), np.int64)
            sums[at[: len(have[target][0])]] = have[target][1]
            sums[at[len(have[target][0]) :]] += n
            have[target], waiting[target], sizes[target] = (both, sums), [], 0

        def out(target: bool) -> Iterator[pa.RecordBatch]:
            grams, n = have[target]
            for k in range(0, len(grams), 50_000):
                part = grams[k : k + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int64)), pa.array(np.full(len(part), target)), pa.array(n[k : k + 50_000])], names=["gram", "target", "n"])
            have[target] = np.zeros(0, np.uint32), np.zeros(0, np.int64)

        for batch in batches:
            for t, target in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                raw = _bytes(t)
                for at in _stretches(raw):
                    waiting[target].append(_grams(raw, at))
                    sizes[target] += len(waiting[target][-1])
                    if sizes[target] >= GATHERED:
                        add(target)
                        if len(have[target][0]) >= GATHERED:
                            yield from out(target)
        for target in waiting:
            if waiting[target]:
                add(target)
            yield from out(target)

    partial = rows.mapInArrow(counted, "gram long, target boolean, n long")
    total = partial.groupBy("gram").agg(F.sum(F.when(F.col("target"), F.col("n")).otherwise(0)).alias("target"), F.sum("n").alias("both"))
    fours = materialize(total, "four_grams")
    threes = materialize(_summed(fours, 0xFFFFFF), "three_grams")
    of_target, of_all = threes.agg(F.sum("target"), F.sum("both")).first()
    return Models(fours, threes, of_target or 0, of_all or 0)


def losses(grams: DataFrame, models: Models) -> DataFrame:
    """(gram, target_loss, background_loss) in nats of the last byte of each 4-gram in ``grams``, counted or not."""
    twos = _summed(models.threes, 0xFFFF)
    ones = _summed(twos, 0xFF)
    gram, before = F.col("gram"), F.shiftrightunsigned("gram", 8)
    out = grams.select("gram")
    # a key of three bytes belongs to 256 4-grams at most; orders 1 and 2 have at most 65,792 rows in all
    for name, table, key in (
        ("g4", models.fours, gram),
        ("g3", models.threes, gram.bitwiseAND(F.lit(0xFFFFFF))),
        ("c3", models.threes, before),
        ("g2", F.broadcast(twos), gram.bitwiseAND(F.lit(0xFFFF))),
        ("c2", F.broadcast(twos), before.bitwiseAND(F.lit(0xFFFF))),
        ("g1", F.broadcast(ones), gram.bitwiseAND(F.lit(0xFF))),
        ("c1", F.broadcast(ones), before.bitwiseAND(F.lit(0xFF))),
    ):
        counts = table.select(F.col("gram").alias(name), F.col("target").alias(name + "_target"), F.col("both").alias(name + "_both"))
        out = out.join(counts, key == F.col(name), "left").drop(name)

    def loss(which: str, scale: float) -> Column:
        n = lambda name: F.coalesce(F.col(f"{name}_{which}"), F.lit(0)) * F.lit(scale)
        p = (n("g1") + F.lit(STRENGTH / 256)) / F.lit(size + STRENGTH)
        for order in (2, 3, 4):
            # a context counts at least as often as what follows it: zero bytes before a text are not counted
            p = (n(f"g{order}") + F.lit(STRENGTH) * p) / (F.greatest(n(f"c{order - 1}"), n(f"g{order}")) + F.lit(STRENGTH))
        return -F.log(p)

    # the background is scaled to the target's size, if there is a target
    size = models.of_target or models.of_all
    scale = size / models.of_all if models.of_all else 1.0
    return out.select("gram", loss("target", 1.0).alias("target_loss"), loss("both", scale).alias("background_loss"))


def scored(docs: DataFrame, models: Models, text: str = "text") -> DataFrame:
    """The columns of ``docs`` but the text, and n_tokens, target_loss, background_loss and difference of whole texts."""
    import numpy as np

    small_batches()
    others = [c for c in docs.columns if c != text]
    plain = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(others)], F.col(text).alias("text"))
    block = T.StructField("block", T.LongType())

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc
        from pyspark import TaskContext

        first, sum_ = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(batch.schema.names.index("text"))), 0)).astype(np.int64)) + sum_
            if len(ends):
                sum_ = int(ends[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first + ends // BLOCK)], names=[*batch.schema.names, "block"])

    # written with their blocks, so that both readings deal rows alike
    blocks = materialize(plain.mapInArrow(dealt, T.StructType([*plain.schema.fields, block])), "text_blocks")

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, waiting, size, have = None, [], 0, np.zeros(0, np.uint32)

        def out() -> Iterator[pa.RecordBatch]:
            for k in range(0, len(have), 50_000):
                part = have[k : k + 50_000].astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), now)), pa.array(part)], names=["block", "gram"])

        for batch in batches:
            for b, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if b != now:
                    have = np.unique(np.concatenate([have, *waiting]))
                    yield from out()
                    now, waiting, size, have = b, [], 0, np.zeros(0, np.uint32)
                raw = _bytes(t)
                for at in _stretches(raw):
                    waiting.append(_grams(raw, at))
                    size += len(waiting[-1])
                    if size >= GATHERED:
                        have, waiting, size = np.unique(np.concatenate([have, *waiting])), [], 0
        have = np.unique(np.concatenate([have, *waiting]))
        yield from out()

    held = materialize(blocks.select("block", "text").mapInArrow(distinct, "block long, gram long"), "block_grams")
    known = materialize(losses(held.select("gram").distinct(), models), "gram_losses")
    # a block's losses come before its texts
    kinds = held.join(known, "gram").withColumn("kind", F.lit(0)).unionByName(blocks.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    kept = [f"c{i}" for i in range(len(others))]
    kinds = kinds.select("block", "kind", "gram", "target_loss", "background_loss", "text", *kept).repartition("block").sortWithinPartitions("block", "kind")
    schema = T.StructType([*[f for f in plain.schema.fields if f.name != "text"], *_SCORE.fields])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, grams, both = None, [], None, None
        for batch in batches:
            numbers, marks = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            edges = [0, *(np.flatnonzero((np.diff(numbers) != 0) | (np.diff(marks) != 0)) + 1), len(marks)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                piece = batch.slice(a, b - a)
                if numbers[a] != now:
                    now, parts, grams, both = numbers[a], [], None, None
                if not marks[a]:
                    parts.append([np.asarray(piece.column(i)) for i in (2, 3, 4)])
                    continue
                if grams is None and parts:
                    grams, target, background = (np.concatenate(x) for x in zip(*parts, strict=True))
                    order = np.argsort(grams)
                    grams, both, parts = grams[order].astype(np.uint32), (target[order], background[order]), []
                found: list[list] = [[], [], []]
                for t in piece.column(5):
                    raw = _bytes(t)
                    sums = [0.0, 0.0]
                    for at in _stretches(raw):
                        own = _grams(raw, at)
                        places = np.searchsorted(grams, own)
                        if not (grams[np.minimum(places, len(grams) - 1)] == own).all():
                            raise RuntimeError("a 4-gram without a loss")
                        for i in (0, 1):
                            sums[i] += float(both[i][places].sum())
                    for x, v in zip(found, (len(raw), *[s / len(raw) if raw else None for s in sums]), strict=True):
                        x.append(v)
                n, one, other = found
                difference = [None if x is None else x - y for x, y in zip(one, other, strict=True)]
                scores = [pa.array(n, pa.int64()), *[pa.array(x, pa.float64()) for x in (one, other, difference)]]
                yield pa.RecordBatch.from_arrays([*piece.columns[6:], *scores], names=schema.names)

    out = kinds.mapInArrow(summed, schema)
    # without a target text there is nothing to compare with
    has_target = F.lit(models.of_target > 0)
    scores = [F.when(has_target, F.col(c)).alias(c) if c in ("target_loss", "difference") else F.col(c) for c in _SCORE.names]
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(others)], *scores)
