"""Approximate nearest neighbours by multiprobe p-stable hashing, with exact reranking.

A table hashes a vector by ``HASHES`` random lines cut into steps of one width (Gaussian lines: 2-stable, for Euclidean
distance). Around a query's own bucket, buckets that differ by one step in some lines are visited in the order of their
estimated success: a step is the likelier, the nearer the query is to that border, so each query ranks its borders, and
a list of rank sets, ordered once by the expected squared distance of each rank, names the buckets. The candidates of
all tables are merged, and their distances to the query are computed in double precision on the original vectors.

Vectors are dealt evenly, by row number, to blocks of some ``BLOCK`` rows, each with its own tables, so that a bucket
that holds any share of the vectors is spread over all blocks; a task holds one block and streams the queries against
it. A query's best of each block are ranked at the end. Work and shuffle: each vector moves once, each query once for
each block. The width is fitted on ``SAMPLE`` rows (the median distance of pairs); everything else covers all rows.

A query that lies farther from these rows than they do from each other takes steps that are as many times wider, by
doublings. One that finds fewer than ``k`` rows in a block takes steps twice as wide there, ``WIDER`` times at most, and
then all rows of the block. So each query gets ``k`` rows of each block, or all that the block has.

Vectors that are null, zero, hold null or non-finite components, or are not as long as most of the sample take no part.
Rows, not ids, are candidates: a repeated id or vector is a candidate as often as it comes, and a query row excludes only
itself. Equal distances go by id, null ids last, then by row. Fewer candidates than ``k`` give fewer rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearcurve.sources.tables import materialize

HASHES, TABLES, PROBES = 6, 12, 700
#: Width of a step as a share of the median distance.
WIDTH = 0.7
#: A query this many times farther away than usual takes wider steps; doublings for want of rows, and doublings in all.
FAR, WIDER, MOST_DOUBLINGS = 1.1, 2, 8
BLOCK, SAMPLE, SEED = 16_384, 500, 20


def usable(vector: Column) -> Column:
    """Whether a vector takes part; false for null."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def probe_sets(hashes: int, probes: int) -> list[tuple[int, ...]]:
    """Sets of border ranks (0: the nearest of the 2 x hashes borders) by rising expected score; the empty set first."""
    m = hashes

    def expected(j: int) -> float:  # of the squared distance to the j-th nearest border, j from 1, in steps
        if j <= m:
            return j * (j + 1) / (4 * (m + 1) * (m + 2))
        r = 2 * m + 1 - j
        return 1 - r / (m + 1) + r * (r + 1) / (4 * (m + 1) * (m + 2))

    cost = [expected(j) for j in range(1, 2 * m + 1)]
    found: list[tuple[int, ...]] = [()]
    queue = [(cost[0], (0,))]
    while queue and len(found) < probes:
        score, ranks = heapq.heappop(queue)
        # the two borders of one line have ranks that add up to 2m - 1: a bucket cannot lie beyond both
        if not any(2 * m - 1 - r in ranks for r in ranks):
            found.append(ranks)
        last = ranks[-1]
        if last + 1 < 2 * m:
            heapq.heappush(queue, (score + cost[last + 1], (*ranks, last + 1)))
            heapq.heappush(queue, (score - cost[last] + cost[last + 1], (*ranks[:-1], last + 1)))
    return found


def doublings(query, sample, usual: float) -> int:
    """Of the width, for a query by its median distance to the sampled rows."""
    import numpy as np

    far = float(np.median(np.linalg.norm(sample - query, axis=1))) / (FAR * usual)
    return max(0, int(np.ceil(np.log2(far)))) if far > 0 else 0


class Block:
    """The vectors of one block and their hash tables by doublings of the width, made as queries need them."""

    def __init__(self, vectors, sample, usual: float):
        self.vectors, self.sample, self.usual = vectors, sample, usual
        self.tables: dict[int, Tables] = {}

    def candidates(self, query, enough: int):
        """Rows in the buckets visited, at least ``enough`` of them, or all rows."""
        import numpy as np

        first = doublings(query, self.sample, self.usual)
        for n in range(first, min(first + WIDER, MOST_DOUBLINGS) + 1):
            if n not in self.tables:
                self.tables[n] = Tables(self.vectors, WIDTH * self.usual * 2.0**n)
            found = self.tables[n].candidates(query)
            if len(found) >= enough:
                return found
        return np.arange(len(self.vectors))


class Tables:
    """The hash tables of one block."""

    def __init__(self, vectors, width: float, seed: int = SEED, hashes: int = HASHES, tables: int = TABLES, probes: int = PROBES):
        import numpy as np

        draw = np.random.default_rng(seed)
        dims = vectors.shape[1]
        self.lines = [(draw.normal(size=(dims, hashes)), draw.uniform(0, 1, hashes)) for _ in range(tables)]
        self.mix = draw.integers(1, 1 << 62, hashes) * 2 + 1
        self.width, self.vectors = width, vectors
        sets = probe_sets(hashes, probes)
        self.sets = np.zeros((len(sets), 2 * hashes), dtype=np.int64)
        for i, ranks in enumerate(sets):
            self.sets[i, list(ranks)] = 1
        self.sorted = []
        for k in range(tables):
            keys = self._keys(np.floor(self._places(vectors, k)).astype(np.int64))
            order = np.argsort(keys, kind="stable")
            self.sorted.append((keys[order], order))

    def _places(self, vectors, k: int):
        lines, shift = self.lines[k]
        return vectors @ lines / self.width + shift

    def _keys(self, cells):
        return (cells * self.mix).sum(axis=-1)  # wraps around; equal cells have equal keys

    def candidates(self, query):
        """Rows of the block in any visited bucket of any table."""
        import numpy as np

        seen = np.zeros(len(self.vectors), dtype=bool)
        for k, (keys, order) in enumerate(self.sorted):
            place = self._places(query, k)
            cell = np.floor(place)
            inside = place - cell
            m = len(cell)
            near = np.argsort(np.concatenate([inside, 1 - inside]), kind="stable")  # borders below, then above
            step = np.zeros((2 * m, m), dtype=np.int64)
            step[np.arange(2 * m), near % m] = np.where(near < m, -1, 1)
            probed = self._keys(cell.astype(np.int64) + self.sets @ step)
            low, high = np.searchsorted(keys, probed, "left"), np.searchsorted(keys, probed, "right")
            sizes = high - low
            if sizes.any():
                at = np.repeat(low - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
                seen[order[at]] = True
        return np.flatnonzero(seen)


def _vectors(column: pa.ChunkedArray | pa.Array, dims: int):
    import numpy as np

    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dims)


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score, query_row) of the ``k`` nearest rows found for each row where ``is_query`` holds."""
    import numpy as np

    rows = vectors.where(usable(F.col(vector))).select(F.col(id).cast("long").alias("id"), F.col(vector).alias("v"), is_query.alias("asks"))
    # row numbers are written, so that they are the same wherever rows are read again
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    some = [r["v"] for r in rows.select("v", F.xxhash64("row").alias("h")).orderBy("h").limit(SAMPLE).collect()]
    schema = "query_id long, query_row long, vec_id long, vec_row long, score double"
    if not some:
        return vectors.sparkSession.createDataFrame([], schema).select("query_id", F.lit(0).alias("rank"), "vec_id", "score", "query_row")
    lengths = sorted(map(len, some))
    dims = max(set(lengths), key=lambda n: (lengths.count(n), n))
    sample = np.array([v for v in some if len(v) == dims], dtype=np.float64)
    apart = np.linalg.norm(sample[:, None] - sample[None], axis=2)[np.triu_indices(len(sample), 1)]
    usual = float(np.median(apart)) if len(apart) and np.median(apart) > 0 else 1.0 / WIDTH
    rows = rows.where(F.size("v") == dims)
    blocks = 1 + rows.count() // BLOCK
    held = rows.select(F.pmod(F.xxhash64("row"), F.lit(blocks).cast("long")).alias("block"), F.lit(0).alias("kind"), "id", "row", "v")
    asked = rows.where("asks").select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), F.lit(1).alias("kind"), "id", "row", "v")
    # each block's vectors come before the queries
    dealt = held.unionByName(asked).repartition("block").sortWithinPartitions("block", "kind", "row")
    out = pa.schema([("query_id", pa.int64()), ("query_row", pa.int64()), ("vec_id", pa.int64()), ("vec_row", pa.int64()), ("score", pa.float64())])

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts, held, ids, own = None, [], None, None, None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            marks = np.asarray(table.column("block")) * 2 + np.asarray(table.column("kind"))
            edges = [0, *(np.flatnonzero(np.diff(marks)) + 1), len(marks)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                piece = table.slice(a, b - a)
                if piece.column("block")[0].as_py() != block:
                    block, parts, held = piece.column("block")[0].as_py(), [], None
                if piece.column("kind")[0].as_py() == 0:
                    parts.append(piece)
                    continue
                if not parts:
                    continue
                if held is None:
                    whole = pa.concat_tables(parts)
                    held = Block(_vectors(whole.column("v"), dims), sample, usual)
                    ids = np.asarray(whole.column("id").fill_null(np.iinfo(np.int64).max).combine_chunks())
                    own = np.asarray(whole.column("row").combine_chunks())
                    named = whole.column("id").combine_chunks()
                queries = _vectors(piece.column("v"), dims)
                found = []
                for i, (query_id, query_row) in enumerate(zip(piece.column("id").to_pylist(), piece.column("row").to_pylist(), strict=True)):
                    at = held.candidates(queries[i], k + 1)  # it may find itself
                    at = at[own[at] != query_row]
                    score = np.sqrt(((held.vectors[at] - queries[i]) ** 2).sum(axis=1))
                    best = np.lexsort((own[at], ids[at], score))[:k]
                    found += [(query_id, query_row, named[int(at[j])].as_py(), int(own[at[j]]), float(score[j])) for j in best]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), out, strict=True)], schema=out)

    best = dealt.mapInArrow(searched, schema)
    order = Window.partitionBy("query_row").orderBy("score", F.col("vec_id").asc_nulls_last(), "vec_row")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score", "query_row")
