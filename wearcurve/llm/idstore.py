"""Token ids of documents in shard files, with a minimal perfect hash index for access by key.

A store is a folder in shared storage:

``shards/``  files in ascending key order. A record is a flag byte (1: the key is null), the key (8 bytes, big
             endian), the number of ids (4 bytes, big endian), the raw little-endian ids (2 bytes each if the
             vocabulary allows, else 4) and a line break. Spark's text writer puts the records, so any file system
             of Spark holds a store and no record is gathered anywhere but in its own shard.
``index/``   a row for each hash bucket of keys: a minimal perfect hash over the bucket's keys (levels of bit
             arrays; the keys that collide in a level go on to the next) and, at each key's place, a 32-bit
             fingerprint, shard, offset, number of ids, and ids of all records before it.
``meta/``    one row: bytes of an id, buckets, records.

Keys are (key, copy): rows that repeat a key are copies 0, 1, ... in the order of shards, so a repeated key may span
shards; a null key is a key like any other. A look-up hashes a key to its bucket, computes the one place it can have,
compares the fingerprint, and verifies the key in the record itself, so an unknown key gives no row. A look-up of few
keys reads the index folders and the shard files of these keys alone, whatever the store's size. Shards and buckets are
sized by the data; a shard is the largest thing that a task holds.

Null and empty texts give the end id alone. An empty table gives a store without records. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wearcurve.llm.batches import small_batches
from wearcurve.llm.bulkbpe import LETTERS, MARK, byte_merger, content, cut, gathered, slices
from wearcurve.llm.bytebpe import LATIN
from wearcurve.llm.memo import Memo, held, let_go
from wearcurve.llm.token_counts import Vocabulary
from wearcurve.sources.tables import materialize, scratch_path

#: Bytes of text that make a shard, some 3 MB of ids.
SHARD_TEXT = 6_000_000
#: Keys of a bucket, on average.
BUCKET_KEYS = 20_000
#: Index folders, and shards, that a look-up names one by one.
FEW = 1000
HEAD = 13
#: Words of a generation that a worker remembers.
MEMO = 100_000
_ENTRY = [("fingerprint", "<u4"), ("shard", "<i4"), ("offset", "<i8"), ("n", "<i8"), ("start", "<i8")]


@dataclass(frozen=True)
class Store:
    path: str
    width: int
    buckets: int
    records: int


# ids of texts -------------------------------------------------------------------------------------------------


class Encoder:
    """Ids of texts by the tokenizers library; one per Python worker.

    Texts are cut into pre-tokens with Arrow. Words of Latin letters, which are one pre-token each, are merged in bulk by
    the library's own vocabulary; the other words go through the library itself and are remembered. A text in which a
    cut could be inside a pre-token is encoded whole. ``plain``: strings of added tokens are ordinary text.
    """

    def __init__(self, vocabulary: Vocabulary, width: int, plain: bool = False):
        import numpy as np
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(vocabulary.spec)
        tokenizer.encode_special_tokens = plain
        self.kind = f"<u{width}"
        self.added = vocabulary.added
        self.raw = lambda part: np.array(tokenizer.encode(part, add_special_tokens=False).ids, dtype=np.int64)
        self.odd = Memo(self.raw, MEMO)
        self.bulk, self.of_byte = byte_merger(vocabulary)

    def encode(self, texts: pa.Array, spaced: bool = False):
        """Ids of the texts of a slice one after the other, and where each text's ids end; null is empty.

        ``spaced``: a space is put before every text that is not empty.
        """
        import numpy as np
        import pyarrow.compute as pc

        texts = pc.fill_null(texts, "")
        if spaced:
            texts = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(" ", texts, ""))
        codes, starts, words = cut(texts, ",.")
        plain = pc.match_substring_regex(words, f"^ ?[{LETTERS}]{{1,64}}$").to_numpy(zero_copy_only=False)
        letters = words.filter(pa.array(plain)) if not plain.all() else words
        merged, sizes = self.bulk.merged(self.of_byte[content(letters)], pc.binary_length(letters).to_numpy().astype(np.int64))
        odd = np.flatnonzero(~plain)
        others = words.take(pa.array(odd)).to_pylist()
        # what makes a cut doubtful
        bad, empty, mark, joins = (np.zeros(len(words), dtype=bool) for _ in range(4))
        for k, word in zip(odd.tolist(), others, strict=True):
            bad[k] = word != "\n" and (word == " " or (len(word.split()) != 1 if word else False) or word[-1:].isspace() or word[:1] != " " and word[:1].isspace())
            empty[k] = not word
            mark[k] = word[:1] in (",", ".")
            joins[k] = bool(word) and not (word[-1].isalnum() and word[-1] <= LATIN)
        places, first = len(codes), starts[:-1]
        at_edge = np.zeros(places + 1, dtype=bool)
        at_edge[first] = at_edge[starts[1:] - 1] = True
        doubt = bad[codes] | (empty[codes] & ~at_edge[:places])
        after = mark[codes] & np.append(False, joins[codes[:-1]])
        after[first] = False
        whole = np.logical_or.reduceat(doubt | after, first) if places else np.zeros(0, dtype=bool)
        for a in [MARK, *self.added]:
            whole |= pc.match_substring(texts, a).to_numpy(zero_copy_only=False)
        # entries: merged words, the other words, then whole texts
        entry = np.empty(len(words) + 1, dtype=np.int64)
        entry[:-1][plain] = np.arange(len(letters))
        entry[odd] = np.arange(len(letters), len(words))
        found = [self.odd[w] if w and not b else np.zeros(0, dtype=np.int64) for w, b in zip(others, bad[odd], strict=True)]
        codes = entry[codes]
        for k in np.flatnonzero(whole).tolist():
            codes[starts[k] : starts[k + 1]] = len(words)  # nothing
        found.append(np.zeros(0, dtype=np.int64))
        for k in np.flatnonzero(whole).tolist():
            codes[starts[k]] = len(letters) + len(found)
            found.append(self.raw(texts[k].as_py()))
        ids, ends = gathered(codes, np.concatenate([merged, *found]), np.concatenate([sizes, [len(f) for f in found]]).astype(np.int64))
        return ids.astype(self.kind), np.append(0, ends)[starts[1:]]


def id_width(vocabulary: Vocabulary) -> int:
    spec = vocabulary.parsed
    most = max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])
    return 2 if most < 1 << 16 else 4


def raw_ids(text: Column, vocabulary: Vocabulary, end_id: int) -> Column:
    """Raw ids of whole texts with an end id, as ``binary``."""
    width, key, spec = id_width(vocabulary), vocabulary.key, vocabulary.spec
    small_batches()

    @F.arrow_udf("binary")
    def encoded(texts: pa.Array) -> pa.Array:
        encoder = held(f"ids{width}{key}", lambda: Encoder(Vocabulary(spec), width))
        tail, out = end_id.to_bytes(width, "little"), []
        for part in slices(texts):
            ids, ends = encoder.encode(part)
            packed, at = ids.tobytes(), 0
            for end in (ends * width).tolist():
                out.append(packed[at:end] + tail)
                at = end
        return pa.array(out, pa.binary())

    return encoded.asNondeterministic()(text)


def unpacked(raw: Column, width: int) -> Column:
    """Ids as ``array<long>``."""

    @F.arrow_udf("array<bigint>")
    def ids(rows: pa.Array) -> pa.Array:
        import numpy as np

        return pa.array([None if r is None else np.frombuffer(r, f"<u{width}").astype(np.int64) for r in rows.to_pylist()], pa.list_(pa.int64()))

    return ids(raw)


# writing ------------------------------------------------------------------------------------------------------


def write_store(docs: DataFrame, vocabulary: Vocabulary, end_id: int, id: str = "doc_id", text: str = "text", path: str | None = None) -> Store:
    """Encode all documents and write shards and index; the id must be an integer column."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "idstore")
    body = docs.select(F.col(id).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = body.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shards = 1 + total // SHARD_TEXT
    width = id_width(vocabulary)
    # rows that repeat a key may be many: they are spread over shards by content and place
    rows = body.withColumns({"tie": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
    # texts are dealt and then encoded: dealing by range reads its rows twice
    ordered = rows.repartitionByRange(shards, "key", "tie", "place").sortWithinPartitions("key", "tie", "place")
    ordered = ordered.select("key", raw_ids(F.col("text"), vocabulary, end_id).alias("raw"))
    head = F.concat(
        F.when(F.col("key").isNull(), F.unhex(F.lit("01"))).otherwise(F.unhex(F.lit("00"))),
        F.unhex(F.lpad(F.hex(F.coalesce("key", F.lit(0).cast("long"))), 16, "0")),
        F.unhex(F.lpad(F.hex((F.octet_length("raw") / width).cast("long")), 8, "0")),
    )
    # the text writer puts a string's bytes as they are; a cast from binary does not change them
    ordered.select(F.concat(head, "raw").cast("string").alias("record")).write.text(f"{path}/shards")
    return _write_index(spark, path, width)


def _shards(spark: SparkSession, path: str, only: Sequence[int] | None = None) -> DataFrame:
    """Number and content of all shard files, or of those named."""
    glob = "part-*" if only is None else "part-{" + ",".join(f"{k:05d}" for k in only) + "}-*"
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(f"{path}/shards")
    return files.where("length > 0").select(F.regexp_extract("path", r"part-(\d+)[^/]*$", 1).cast("int").alias("shard"), "content")


def _walk(width: int):
    """Records of shards: shard, key, order of a key in its shard, offset, ids, ids before it in the shard."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = memoryview(content.as_buffer())
                out, at, before, last, copy = [], 0, 0, None, 0
                while at < len(data):
                    key = None if data[at] else int.from_bytes(data[at + 1 : at + 9], "big", signed=True)
                    n = int.from_bytes(data[at + 9 : at + HEAD], "big")
                    copy = copy + 1 if out and key == last else 0
                    out.append((shard, key, copy, at, n, before))
                    last = key
                    before += n
                    at += HEAD + n * width + 1
                yield pa.RecordBatch.from_pydict({k: [r[i] for r in out] for i, k in enumerate(names)}, schema=schema)

    names = ["shard", "key", "copy", "offset", "n", "before"]
    schema = pa.schema([(k, pa.int32() if k == "shard" else pa.int64()) for k in names])
    return of


def _hashed(rows: DataFrame, buckets: int) -> DataFrame:
    """Two 64-bit hashes of (key, copy) and the bucket."""
    null = F.col("key").isNull()
    return rows.withColumns(
        {
            "h1": F.xxhash64("key", "copy", null),
            "h2": F.xxhash64(F.lit("second"), null, "copy", "key"),
        }
    ).withColumn("bucket", F.pmod("h1", F.lit(buckets)).cast("int"))


def _write_index(spark: SparkSession, path: str, width: int) -> Store:
    walked = _shards(spark, path).mapInArrow(_walk(width), "shard int, key long, copy long, offset long, n long, before long")
    walked.write.parquet(f"{path}/records")
    records = spark.read.parquet(f"{path}/records")
    of_shard = records.groupBy("shard").agg(
        F.count("*").alias("records"),
        F.sum("n").alias("n"),
        F.min_by(F.struct("key"), "offset")["key"].alias("first"),
        F.max_by(F.struct("key", "copy"), "offset").alias("last"),
    )
    # ids and copies are added up over shards: one row for each shard file passes the windows
    order = Window.partitionBy(F.lit(0)).orderBy("shard")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    of_shard = of_shard.withColumns(
        {
            "base": F.coalesce(F.sum("n").over(before), F.lit(0)),
            "row": F.coalesce(F.sum("records").over(before), F.lit(0)),
            "goes_on": F.lag("shard").over(order).isNotNull() & F.lag("last.key").over(order).eqNullSafe(F.col("first")),
        }
    )
    # the row where the last key of a shard begins; null if a shard is one key that began before it
    begins = F.when(F.col("last.copy") + 1 < F.col("records"), F.col("row") + F.col("records") - 1 - F.col("last.copy")).when(~F.col("goes_on"), F.col("row"))
    of_shard = of_shard.withColumn("begins", begins)
    carry = F.when(F.col("goes_on"), F.col("row") - F.last("begins", ignorenulls=True).over(before)).otherwise(0)
    base = materialize(of_shard.select("shard", "base", carry.alias("carry"), "first", "records"), "shard_bases")
    total = base.agg(F.sum("records")).first()[0] or 0
    base = base.drop("records")
    buckets = 1 + total // BUCKET_KEYS
    placed = records.join(base, "shard").select(
        "shard",
        "key",
        (F.col("copy") + F.when(F.col("key").eqNullSafe(F.col("first")), F.col("carry")).otherwise(0)).alias("copy"),
        "offset",
        "n",
        (F.col("base") + F.col("before")).alias("start"),
    )
    built = _hashed(placed, buckets).groupBy("bucket").applyInArrow(_build, _INDEX)
    built.withColumn("span", _span()).write.partitionBy("span").parquet(f"{path}/index")
    spark.createDataFrame([(width, buckets, total)], "width int, buckets int, records long").write.parquet(f"{path}/meta")
    return Store(path, width, buckets, total)


_INDEX = "bucket int, size int, levels array<binary>, entries binary"


def _span() -> Column:
    """The folder of a bucket's index."""
    return F.shiftright("bucket", 4)


def open_store(spark: SparkSession, path: str) -> Store:
    meta = spark.read.parquet(f"{path}/meta").first()
    return Store(path, meta["width"], meta["buckets"], meta["records"])


# the minimal perfect hash -------------------------------------------------------------------------------------


def _mixed(h1, h2, level: int):
    """A 64-bit hash for each level, from the two hashes of a key."""
    import numpy as np

    x = h1 + h2 * np.uint64(2 * level + 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def build_levels(h1, h2):
    """Bit arrays of a minimal perfect hash over distinct pairs of hashes."""
    import numpy as np

    levels = []
    left = np.arange(len(h1))
    while len(left):
        if len(levels) > 200:
            raise ValueError("keys repeat")
        size = 2 * len(left) + 1
        at = (_mixed(h1[left], h2[left], len(levels)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(alone)
        left = left[~alone[at]]
    return levels


def places(levels, h1, h2):
    """The place of each key: below the number of keys and different for all of them; -1 for some unknown keys."""
    import numpy as np

    out = np.full(len(h1), -1, dtype=np.int64)
    left, before = np.arange(len(h1)), 0
    for k, bits in enumerate(levels):
        at = (_mixed(h1[left], h2[left], k) % np.uint64(len(bits))).astype(np.int64)
        found = bits[at]
        out[left[found]] = before + np.cumsum(bits)[at[found]] - 1
        before += int(bits.sum())
        left = left[~found]
    return out


def _column(table: pa.Table, name: str, kind):
    import numpy as np

    return table.column(name).combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64).view(kind) if len(table) else np.zeros(0, kind)


def _build(group: pa.Table) -> pa.Table:
    import numpy as np

    h1, h2 = _column(group, "h1", "u8"), _column(group, "h2", "u8")
    levels = build_levels(h1, h2)
    entries = np.zeros(len(h1), dtype=_ENTRY)
    at = places(levels, h1, h2)
    entries["fingerprint"][at] = _mixed(h2, h1, 999) >> np.uint64(32)
    for name in ("shard", "offset", "n", "start"):
        entries[name][at] = _column(group, name, "i8")
    sized = [len(bits).to_bytes(4, "little") + np.packbits(bits).tobytes() for bits in levels]
    bucket = group.column("bucket")[0].as_py()
    return pa.table(
        {"bucket": pa.array([bucket], pa.int32()), "size": pa.array([len(h1)], pa.int32()), "levels": pa.array([sized], pa.list_(pa.binary())), "entries": pa.array([entries.tobytes()], pa.binary())}
    )


def _locate(keys: pa.Table, index: pa.Table) -> pa.Table:
    """Where the records of keys of one bucket are, if there are any."""
    import numpy as np

    names = ("shard", "offset", "n", "start")
    out = {k: np.zeros(0, "i8") for k in names}
    rows = keys.slice(0, 0)
    if len(keys) and len(index):
        levels = []
        for sized in index.column("levels")[0].as_py():
            levels.append(np.unpackbits(np.frombuffer(sized[4:], np.uint8), count=int.from_bytes(sized[:4], "little")).astype(bool))
        entries = np.frombuffer(index.column("entries")[0].as_py(), dtype=_ENTRY)
        h1, h2 = _column(keys, "h1", "u8"), _column(keys, "h2", "u8")
        at = places(levels, h1, h2)
        known = at >= 0
        known[known] = entries["fingerprint"][at[known]] == (_mixed(h2, h1, 999) >> np.uint64(32))[known].astype("u4")
        rows = keys.take(pa.array(np.flatnonzero(known)))
        out = {k: entries[k][at[known]].astype("i8") for k in names}
    return pa.table({"key": rows.column("key").cast(pa.int64()), "copy": rows.column("copy").cast(pa.int64()), **{k: pa.array(v, pa.int64()) for k, v in out.items()}})


# reading ------------------------------------------------------------------------------------------------------


def _fetch(width: int, with_ids: bool):
    schema = pa.schema([("key", pa.int64()), ("copy", pa.int64()), ("start", pa.int64()), ("n", pa.int64()), ("crc32", pa.int64()), ("raw", pa.binary())])

    def of(wanted: pa.Table, shard: pa.Table) -> pa.Table:
        from zlib import crc32

        import numpy as np

        let_go()
        found = []
        if len(wanted) and len(shard):
            data = memoryview(shard.column("content")[0].as_buffer())
            for r in wanted.to_pylist():
                at, n, key = r["offset"], r["n"], r["key"]
                here = None if data[at] else int.from_bytes(data[at + 1 : at + 9], "big", signed=True)
                if here == key and int.from_bytes(data[at + 9 : at + HEAD], "big") == n:
                    raw = data[at + HEAD : at + HEAD + n * width]
                    check = crc32(np.frombuffer(raw, f"<u{width}").astype("<u4").tobytes())
                    found.append((key, r["copy"], r["start"], n, check, raw if with_ids else None))
        return pa.table({f.name: pa.array([x[i] for x in found], f.type) for i, f in enumerate(schema)}, schema=schema)

    return of


def look_up(keys: DataFrame, store: Store, with_ids: bool = True) -> DataFrame:
    """(key, copy, start, n, crc32, raw) of each distinct (key, copy) in ``keys`` that the store has.

    ``crc32`` is that of the ids read, as little-endian unsigned 32-bit integers; without ``with_ids`` the raw ids
    are null, for a caller that only verifies a store. If the keys fall into up to ``FEW`` folders of the index, only
    these are read, and only the shards that hold the keys; the numbers of both come to the driver. Keys are hashed
    before this returns.
    """
    spark = keys.sparkSession
    asked = _hashed(keys.select(F.col("key").cast("long").alias("key"), F.col("copy").cast("long").alias("copy")).distinct(), store.buckets)
    index = spark.read.schema(f"{_INDEX}, span int").parquet(f"{store.path}/index")
    where = "key long, copy long, shard long, offset long, n long, start long"
    spans = [r["span"] for r in asked.select(_span().alias("span")).distinct().limit(FEW + 1).collect()]
    few = len(spans) <= FEW
    if few:
        index = index.where(F.col("span").isin(spans))
    located = asked.groupBy("bucket").cogroup(index.drop("span").groupBy("bucket")).applyInArrow(_locate, where)
    only = None
    if few:
        located = materialize(located, "located")
        found = [r["shard"] for r in located.select("shard").distinct().limit(FEW + 1).collect()]
        # a pattern that no file has, if no key was found
        only = (sorted(found) or [-1]) if len(found) <= FEW else None
    shards = _shards(spark, store.path, only).withColumn("shard", F.col("shard").cast("long"))
    return located.groupBy("shard").cogroup(shards.groupBy("shard")).applyInArrow(
        _fetch(store.width, with_ids), "key long, copy long, start long, n long, crc32 long, raw binary"
    )
