"""Exact removal of repeated passages: every byte covered by a string of 200 bytes that also starts anywhere else.

Equal strings must meet in one task, but no task may see all suffixes. So every window of 200 bytes is named by its least
gram of 64 bytes (by a hash; the leftmost of equals): equal windows have equal grams. Neighbouring windows share
their gram, so a text falls into short segments, one for each gram it is named by.

1. Texts are packed into blocks, and each block tells its grams and how often it holds them. The blocks are a bucketed
   table, so that what later comes back to a block is joined without shuffling a text again.
2. Grams are counted over the corpus: blocks send them, packed, to shares by hash, and a share sends each block those of
   its grams that are found again. A window whose gram is found once cannot repeat.
3. Blocks send the segments of the other grams, a segment once for each block, to groups of some MB by gram.
4. Each group sorts the suffixes that start a window by two-stage sorting (``suffixes``) and compares neighbours: windows
   with a common prefix of 200 bytes repeat, and so do all windows of a segment that is found twice.
5. The windows that repeat go back to their blocks, which join the bytes they cover.

A gram whose segments are many and differ, such as a common line in changing surroundings, would make one large group.
Beyond ``CROWD`` segments its windows are named anew by their own hash, so only equal windows meet, and windows that are
found once are left out. A window beyond ``CROWD`` blocks is spread over groups of about that many of its places, each of
which gets the window of the first of these blocks too, so that every other place meets an equal one.

Null and empty texts have no bytes. Texts shorter than 200 bytes keep all. Rows that repeat an id are rows like any
other. An empty table gives no rows. Other columns are not read. A very long text is a block of its own; grams and
windows are worked out for about a million bytes at a time. Steps 1 and 2 run before ``removed`` returns.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearcurve.llm.batches import small_batches
from wearcurve.llm.suffixes import DEPTH, common_prefixes, order
from wearcurve.sources.tables import materialize, scratch_path

#: Bytes of text in a block, about, and bytes of segments in a group, about.
BLOCK_TEXT, GROUP = 8_000_000, 2_000_000
#: Keys that one task counts, about.
SHARE = 1_000_000
#: Segments of one gram that may lie in one group.
CROWD = 1024
#: Bytes of a gram: a power of two.
GRAM = 32
#: Windows that are worked out at a time.
_CHUNK = 1 << 20
_LOW = _CHUNK * 2 - 1
_PLAIN, _CROWDED, _WINDOW = 1, 2, 3


def _hashes(data, size: int):
    """A 64-bit hash of the ``size`` bytes from each place on; ``size`` is a power of two."""
    import numpy as np

    factors = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)
    h = data.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
    h ^= h >> np.uint64(29)
    width = 1
    for factor in factors[: size.bit_length() - 1]:
        h = h[:-width] * np.uint64(factor) + h[width:]
        h ^= h >> np.uint64(31)
        width *= 2
    h *= np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(32))


def _least(values, width: int):
    """The least of the ``width`` values from each place on."""
    import numpy as np

    done = 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def _runs(data, text_ends):
    """Runs of windows with the same least gram: first window, number of windows, hash of the gram."""
    import numpy as np

    starts, sizes, keys = [], [], []
    # the last windows that a text has; the windows that reach over an end belong to none
    for at in range(0, len(data) - DEPTH + 1, _CHUNK):
        part = data[at : at + _CHUNK + DEPTH - 1]
        windows = len(part) - DEPTH + 1
        grams = _hashes(part, GRAM)
        places = np.arange(len(grams), dtype=np.uint64)
        least = _least((grams & ~np.uint64(_LOW)) | places, DEPTH - GRAM + 1)
        edge = text_ends[np.searchsorted(text_ends, at, "right") : np.searchsorted(text_ends, at + windows + DEPTH, "right")] - at
        over = np.zeros(windows + 1, dtype=np.int32)
        np.add.at(over, np.clip(edge - DEPTH + 1, 0, windows), 1)
        np.add.at(over, np.clip(edge, 0, windows), -1)
        inside = np.cumsum(over[:windows]) == 0
        new = np.ones(windows, dtype=bool)
        new[1:] = (least[1:] != least[:-1]) | (inside[1:] != inside[:-1])
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, windows))
        kept = inside[first]
        first, size = first[kept], size[kept]
        starts.append(first + at)
        sizes.append(size)
        keys.append(grams[(least[first] & np.uint64(_LOW)).astype(np.int64)].view(np.int64))
    none = np.zeros(0, dtype=np.int64)
    return tuple(np.concatenate([none, *x]) for x in (starts, sizes, keys))


def _windows(data, starts, sizes):
    """Hashes of all windows of the given runs, and where they start."""
    import numpy as np

    from wearcurve.llm.bulkbpe import ranges

    found, places = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    half = DEPTH - 128
    for at in range(0, len(data) - DEPTH + 1, _CHUNK):
        of = (starts >= at) & (starts < at + _CHUNK)
        if not of.any():
            continue
        h = _hashes(data[at : at + _CHUNK + 2 * DEPTH], 128)
        at_window = ranges(starts[of], sizes[of])
        k = at_window - at
        mixed = h[k] * np.uint64(0x9E3779B97F4A7C15) + (h[k + half] ^ (h[k + half] >> np.uint64(29)))
        found.append((mixed ^ (mixed >> np.uint64(31))).view(np.int64))
        places.append(at_window)
    return np.concatenate(found), np.concatenate(places)


# blocks -------------------------------------------------------------------------------------------------------

_BLOCK = "block long, packed binary, keys array<long>, seen array<int>, many array<int>"


def _packed(ids: pa.Array, texts: pa.Array) -> bytes:
    import zstandard

    sink = pa.BufferOutputStream()
    table = pa.table({"id": ids, "text": texts.cast(pa.large_binary())})
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return zstandard.ZstdCompressor(level=3).compress(sink.getvalue())


def _unpacked(body: bytes):
    """Ids, bytes of all texts, and the ends of the texts."""
    import numpy as np
    import pyarrow.compute as pc
    import zstandard

    table = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(body)).read_all().combine_chunks()
    texts = table["text"].chunk(0) if table["text"].num_chunks else pa.array([], pa.large_binary())
    texts = pc.fill_null(texts, b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    return table["id"], data, offsets[1:] - offsets[0]


def _prints(data, starts, sizes):
    """A hash of each segment's bytes."""
    import numpy as np
    from xxhash import xxh3_64_intdigest

    raw = memoryview(np.ascontiguousarray(data))
    return np.array([xxh3_64_intdigest(raw[a : a + n]) for a, n in zip(starts.tolist(), (sizes + DEPTH - 1).tolist(), strict=True)], dtype=np.uint64).view(np.int64)


def _told(data, text_ends) -> dict:
    """Grams of a block: the hash, how often it names a run, and how many different segments it has."""
    import numpy as np

    starts, sizes, keys = _runs(data, text_ends)
    prints = _prints(data, starts, sizes)
    at = np.lexsort((prints, keys))
    keys, prints = keys[at], prints[at]
    new_key = np.append(True, keys[1:] != keys[:-1])[: len(keys)]
    new_print = new_key | np.append(True, prints[1:] != prints[:-1])[: len(keys)]
    of = np.cumsum(new_key) - 1
    many = int(new_key.sum())
    return {"keys": [keys[new_key]], "seen": [np.bincount(of, minlength=many).astype(np.int32)], "many": [np.bincount(of[new_print], minlength=many).astype(np.int32)]}


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    schema = pa.schema([("block", pa.int64()), ("packed", pa.binary()), ("keys", pa.list_(pa.int64())), ("seen", pa.list_(pa.int32())), ("many", pa.list_(pa.int32()))])
    from wearcurve.llm.bulkbpe import slices

    block, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0

    def made() -> pa.RecordBatch:
        body = _packed(pa.concat_arrays(ids), pa.concat_arrays([t.cast(pa.large_string()) for t in texts]))
        _, data, ends = _unpacked(body)
        return pa.RecordBatch.from_pydict({"block": [block], "packed": [body]} | _told(data, ends), schema=schema)

    for batch in batches:
        at = 0
        for part in slices(batch.column(1), 1 << 20):
            ids.append(batch.column(0).slice(at, len(part)))
            texts.append(part)
            at += len(part)
            size += sum(len(t.as_buffer()) for t in part if t.is_valid)
            if size >= BLOCK_TEXT:
                yield made()
                block, ids, texts, size = block + 1, [], [], 0
    if ids:
        yield made()


# counting -----------------------------------------------------------------------------------------------------

_TOLD = "block long, keys array<long>, seen array<int>, many array<int>"
_AGAIN = "block long, keys array<long>, kinds array<int>, places array<long>, firsts array<long>, segments long"


def _mixed(keys):
    """Another hash of 64-bit keys."""
    import numpy as np

    x = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _dealt(shares: int):
    """What a block tells, cut into shares by key."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            for row in range(len(batch)):
                block, (keys, seen, many) = batch.column(0)[row].as_py(), (batch.column(k)[row].values.to_numpy() for k in (1, 2, 3))
                share = (_mixed(keys) % np.uint64(shares)).astype(np.int64)
                at = np.argsort(share, kind="stable")
                cuts = np.flatnonzero(np.diff(share[at], prepend=-1))
                if not len(cuts):
                    continue
                offsets = pa.array(np.append(cuts, len(at)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x[at])) for x in (keys, seen, many)]
                yield pa.RecordBatch.from_arrays([pa.array(share[at][cuts]), pa.array([block] * len(cuts)), *lists], names=["share", "block", "keys", "seen", "many"])

    return of


def _counted(windows: bool, crowd: int):
    """Keys of a share that are found more than once, for each block that has them."""
    schema = pa.schema([("block", pa.int64()), ("keys", pa.list_(pa.int64())), ("kinds", pa.list_(pa.int32())), ("places", pa.list_(pa.int64())), ("firsts", pa.list_(pa.int64())), ("segments", pa.int64())])

    def of(share: pa.Table) -> pa.Table:
        import numpy as np
        import pyarrow.compute as pc

        keys, seen, many = (pc.list_flatten(share[c]).to_numpy().astype(np.int64) for c in ("keys", "seen", "many"))
        row = np.repeat(np.arange(len(share)), pc.list_value_length(share["keys"]).to_numpy())
        blocks = share["block"].to_numpy()
        _, of_key = np.unique(keys, return_inverse=True)
        total = np.bincount(of_key, weights=seen).astype(np.int64)
        places = np.bincount(of_key, weights=many).astype(np.int64)
        first = np.full(len(total), np.iinfo(np.int64).max)
        np.minimum.at(first, of_key, blocks[row])
        kind = np.where(places > crowd, _CROWDED, _PLAIN) if not windows else np.full(len(total), _WINDOW)
        again = np.flatnonzero(total[of_key] > 1)
        row, of_key = row[again], of_key[again]
        sizes = np.where(kind[of_key] == _CROWDED, 0, many[again])
        cuts = np.flatnonzero(np.diff(row, prepend=-1))
        if not len(cuts):
            return schema.empty_table()
        offsets = pa.array(np.append(cuts, len(row)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (keys[again], kind[of_key].astype(np.int32), places[of_key], first[of_key])]
        return pa.Table.from_arrays([pa.array(blocks[row[cuts]]), *lists, pa.array(np.add.reduceat(sizes, cuts))], schema=schema)

    return of


def _found_again(told: DataFrame, windows: bool) -> DataFrame:
    """Of what each block tells, the keys that are found more than once in the corpus; a stored table."""
    total = told.agg(F.sum(F.size("keys").cast("long"))).first()[0] or 0
    dealt = told.mapInArrow(_dealt(1 + total // SHARE), f"share long, {_TOLD}")
    found = dealt.groupBy("share").applyInArrow(_counted(windows, CROWD), _AGAIN)
    return materialize(found, "repeats_again")


# what blocks send ---------------------------------------------------------------------------------------------


def _wanted(rows: pa.Table):
    """Keys, kinds, places and first blocks of all rows of a block."""
    import numpy as np
    import pyarrow.compute as pc

    return [pc.list_flatten(rows[c]).to_numpy().astype(np.int64) for c in ("keys", "kinds", "places", "firsts")]


def _crowded_windows(blocks: pa.Table, again: pa.Table) -> pa.Table:
    """Windows of the crowded grams of a block, by their own hash."""
    import numpy as np

    schema = pa.schema([("block", pa.int64()), ("keys", pa.list_(pa.int64())), ("seen", pa.list_(pa.int32())), ("many", pa.list_(pa.int32()))])
    keys, kinds, _, _ = _wanted(again)
    if not (kinds == _CROWDED).any():
        return schema.empty_table()
    _, data, ends = _unpacked(blocks["packed"][0].as_py())
    starts, sizes, of_run = _runs(data, ends)
    of = np.isin(of_run, keys[kinds == _CROWDED])
    found, seen = np.unique(_windows(data, starts[of], sizes[of])[0], return_counts=True)
    row = {"block": [blocks["of_block"][0].as_py()], "keys": [found], "seen": [seen.astype(np.int32)], "many": [np.ones(len(found), dtype=np.int32)]}
    return pa.table(row, schema=schema)


_SEGMENT = "group long, block long, starts array<long>, body binary"


def _segments(groups: int, crowd: int):
    """Segments of the wanted grams and windows of a block, each different one once with all its starts."""
    schema = pa.schema([("group", pa.int64()), ("block", pa.int64()), ("starts", pa.list_(pa.int64())), ("body", pa.binary())])

    def of(blocks: pa.Table, again: pa.Table) -> pa.Table:
        import numpy as np

        keys, kinds, places, firsts = _wanted(again)
        if not len(keys):
            return schema.empty_table()
        block = blocks["of_block"][0].as_py()
        _, data, ends = _unpacked(blocks["packed"][0].as_py())
        starts, sizes, of_run = _runs(data, ends)
        plain = np.isin(of_run, keys[kinds == _PLAIN])
        crowded = np.isin(of_run, keys[kinds == _CROWDED])
        hashes, at = _windows(data, starts[crowded], sizes[crowded])
        window = kinds == _WINDOW
        repeated = np.isin(hashes, keys[window])
        starts = np.concatenate([starts[plain], at[repeated]])
        sizes = np.concatenate([sizes[plain], np.ones(int(repeated.sum()), dtype=np.int64)])
        names = np.concatenate([of_run[plain], hashes[repeated]])
        raw = data.tobytes()
        found: dict[tuple[int, bytes], list[int]] = {}
        for key, a, n in zip(names.tolist(), starts.tolist(), (sizes + DEPTH - 1).tolist(), strict=True):
            found.setdefault((key, raw[a : a + n]), []).append(a)
        # a window at more than some places goes to one of several groups, that of its first block to all of them
        spread = {k: (1 + n // crowd, f) for k, n, f in zip(keys[window].tolist(), places[window].tolist(), firsts[window].tolist(), strict=True) if n > crowd}
        group_of = dict(zip(names.tolist(), (_mixed(names) % np.uint64(groups)).tolist(), strict=True))
        own, out = int(_mixed(np.array([block]))[0]), []
        for (key, body), where in found.items():
            if key not in spread:
                out.append((group_of[key], where, body))
                continue
            many, first = spread[key]
            salts = np.arange(many) if block == first else np.array([own % many])
            out += [(g, where, body) for g in (_mixed(key ^ salts) % np.uint64(groups)).tolist()]
        return pa.table({"group": [o[0] for o in out], "block": [block] * len(out), "starts": [o[1] for o in out], "body": [o[2] for o in out]}, schema=schema)

    return of


# groups -------------------------------------------------------------------------------------------------------

_FOUND = "block long, begins array<long>, ends array<long>"


def _repeated(group: pa.Table) -> pa.Table:
    """Bytes, by block, that the repeated windows of a group cover."""
    import numpy as np
    import pyarrow.compute as pc

    from wearcurve.llm.bulkbpe import ranges

    schema = pa.schema([("block", pa.int64()), ("begins", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))])
    coded = group["body"].combine_chunks().dictionary_encode()
    coded = coded.chunk(0) if isinstance(coded, pa.ChunkedArray) else coded
    of, bodies = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
    counts = pc.list_value_length(group["starts"]).to_numpy().astype(np.int64)
    copies = np.bincount(of, weights=counts, minlength=len(bodies))
    sizes = np.array([len(b) for b in bodies], dtype=np.int64)
    data = np.frombuffer(b"".join(bodies), dtype=np.uint8)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    last = ends - DEPTH  # the last window of each
    sorted_starts = order(data, begins, ends, last)
    same = np.flatnonzero(common_prefixes(data, sorted_starts) >= DEPTH)
    repeated = np.zeros(len(data) + 1, dtype=bool)
    repeated[sorted_starts[same]] = repeated[sorted_starts[same - 1]] = True
    twice = copies > 1
    repeated[ranges(begins[twice], (last - begins + 1)[twice])] = True
    # runs of repeated windows, of each body; windows of two bodies are never neighbours, as a body ends with no window
    edge = np.flatnonzero(np.diff(repeated.astype(np.int8), prepend=0))
    run_from, run_to = edge[::2], edge[1::2]
    body_of = np.searchsorted(ends, run_from, "right")
    runs_of = np.bincount(body_of, minlength=len(bodies))
    first_run = np.cumsum(runs_of) - runs_of
    # every start of every row, times the runs of its body
    row = np.repeat(np.arange(len(of)), counts)
    start = np.asarray(pc.list_flatten(group["starts"]).to_numpy(), dtype=np.int64)
    body = of[row]
    run = ranges(first_run[body], runs_of[body])
    start, body = np.repeat(start, runs_of[body]), np.repeat(body, runs_of[body])
    block = np.repeat(group["block"].to_numpy()[row], runs_of[of[row]])
    begin, end = start + run_from[run] - begins[body], start + run_to[run] - 1 + DEPTH - begins[body]
    at = np.argsort(block, kind="stable")
    block, begin, end = block[at], begin[at], end[at]
    cuts = np.flatnonzero(np.append(True, block[1:] != block[:-1])[: len(block)])
    pieces = {"block": block[cuts], "begins": np.split(begin, cuts[1:]), "ends": np.split(end, cuts[1:])}
    return pa.table({k: list(v) if len(cuts) else [] for k, v in pieces.items()}, schema=schema)


# texts without repeats ----------------------------------------------------------------------------------------

_KEPT = "id long, n_bytes long, spans array<struct<begin:long,end:long>>, kept binary"


def _kept(blocks: pa.Table, found: pa.Table) -> pa.Table:
    import numpy as np
    import pyarrow.compute as pc

    ids, data, text_ends = _unpacked(blocks["packed"][0].as_py())
    marks = np.zeros(len(data) + 1, dtype=np.int64)
    for name, sign in (("begins", 1), ("ends", -1)):
        np.add.at(marks, pc.list_flatten(found[name]).to_numpy().astype(np.int64), sign)
    gone = np.cumsum(marks[:-1]) > 0
    begins = np.append(0, text_ends[:-1])[: len(text_ends)]
    # runs of removed bytes, cut where texts meet
    new = np.append(True, gone[1:] != gone[:-1])[: len(gone)]
    new[begins[begins < len(data)]] = True
    edge = np.flatnonzero(new)
    to = np.append(edge[1:], len(data))[: len(edge)]
    out = gone[edge]
    edge, to = edge[out], to[out]
    of = np.searchsorted(text_ends, edge, "right")
    spans = pa.StructArray.from_arrays([pa.array(edge - begins[of]), pa.array(to - begins[of])], ["begin", "end"])
    offsets = np.append(0, np.cumsum(np.bincount(of, minlength=len(text_ends)))).astype(np.int32)
    left = np.append(0, np.cumsum(~gone))
    raw, kept_offsets = data[~gone].tobytes(), np.append(0, left[text_ends])
    kept = pa.array([raw[a:b] for a, b in zip(kept_offsets[:-1].tolist(), kept_offsets[1:].tolist(), strict=True)], pa.binary())
    return pa.table({"id": ids, "n_bytes": text_ends - begins, "spans": pa.ListArray.from_arrays(pa.array(offsets), spans), "kept": kept})


def removed(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_bytes, spans removed, bytes kept) of every document; the id must be an integer column."""
    spark = docs.sparkSession
    small_batches()
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    name = f"repeats_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = rows.mapInArrow(_blocks, _BLOCK)
    # bucketed, so that joining a block's own data to it moves no text
    made.write.bucketBy(buckets, "block").option("path", scratch_path(spark, name)).saveAsTable(name)
    blocks = spark.table(name)
    packed = blocks.select(F.col("block").alias("of_block"), "packed")
    again = _found_again(blocks.select("block", "keys", "seen", "many"), False)
    size, crowded = again.agg(F.sum("segments"), F.max(F.array_contains("kinds", _CROWDED))).first()
    if crowded:
        own = packed.groupBy("of_block").cogroup(again.groupBy("block")).applyInArrow(_crowded_windows, _TOLD)
        windows = _found_again(materialize(own, "repeats_windows"), True)
        size += windows.agg(F.sum("segments")).first()[0] or 0
        again = again.unionByName(windows)
    groups = int(1 + (size or 0) * (DEPTH + (DEPTH - GRAM) // 2) // GROUP)
    segments = packed.groupBy("of_block").cogroup(again.groupBy("block")).applyInArrow(_segments(groups, CROWD), _SEGMENT)
    found = materialize(segments.groupBy("group").applyInArrow(_repeated, _FOUND), "repeats_found")
    return packed.groupBy("of_block").cogroup(found.groupBy("block")).applyInArrow(_kept, _KEPT)
