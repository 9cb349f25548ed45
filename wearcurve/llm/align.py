"""Alignment of two tokenizers: which tokens of one overlap which of the other, text by text.

A text is encoded by a byte-level vocabulary (A, with a space before the text) and by a merge-type piece model (B, which
puts that space itself). The bytes of both sides are joined and compared with the text; texts on which they differ, null
and empty texts have no tokens. Then, for all texts of a slice at once:

- ``merge_asof`` by text finds for the start of every A token the B token that covers it, and the other way round. Two
  tokens overlap if and only if one of them covers the start of the other, so the union of both is all overlaps;
- where an A and a B token end at one byte, a group ends.

How often a pair of ids is linked is counted over documents of the whole corpus. A block of texts keeps the pairs of
each of its documents packed (a block is one row, some MB of text, or one longer text); pairs are counted once for each block that holds them, the counts
come back to the blocks, and each block adds up its documents. So neither the pairs of a document nor the counts of all
pairs ever lie in one task, and a pair that all documents hold is one row for each block.

Documents are told apart by their place, so repeated and null ids are documents like any other. An empty table gives no
rows. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearcurve.llm.batches import small_batches
from wearcurve.llm.bulkbpe import MARK, content, cut, gathered, piece_merger, ranges, slices
from wearcurve.llm.idstore import Encoder as ByteEncoder
from wearcurve.llm.memo import Memo, held
from wearcurve.llm.pieces import BYTE, CONTROL, SPACE, PieceModel
from wearcurve.llm.pieces import Encoder as PieceSearch
from wearcurve.llm.token_counts import Vocabulary, byte_chars
from wearcurve.sources.tables import materialize

#: Bytes of text of a block, about.
BLOCK_TEXT = 8_000_000
#: A pair of ids is one number: the A id times this, and the B id.
SHIFT = 1 << 32


class PieceEncoder:
    """Ids of texts by a piece model, many at once; one per Python worker."""

    def __init__(self, model: PieceModel):
        import numpy as np

        self.search = PieceSearch(model)
        self.bulk, self.letters = piece_merger(model, self.search.normal, 0x250)
        known = "".join(re.escape(chr(c)) for c in range(33, 0x250) if self.letters[c] >= 0)
        self.plain = f"^ ?[{known}]{{1,64}}$"
        # a line break that is a byte piece separates what is around it
        self.cuts_lines = "\n" not in self.search.letters
        self.odd = Memo(lambda word: np.frombuffer(self.search._ids(word.replace(" ", SPACE)), dtype=np.int32), 100_000)

    def encode(self, texts: pa.Array):
        """Ids of the texts of a slice, which are neither null nor empty, and where each text's ids end."""
        import numpy as np
        import pyarrow.compute as pc

        codes, starts, words = cut(pc.binary_join_element_wise(" ", texts, ""), "")
        plain = pc.match_substring_regex(words, self.plain).to_numpy(zero_copy_only=False)
        letters = words.filter(pa.array(plain))
        points = np.frombuffer(content(letters).tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
        merged, sizes = self.bulk.merged(self.letters[points], pc.utf8_length(letters).to_numpy().astype(np.int64))
        odd = np.flatnonzero(~plain)
        others = words.take(pa.array(odd)).to_pylist()
        # pieces may hold several spaces
        bad = np.zeros(len(words), dtype=bool)
        bad[odd] = [w == " " or SPACE in w for w in others]
        whole = np.logical_or.reduceat(bad[codes], starts[:-1])
        whole |= pc.match_substring(texts, MARK).to_numpy(zero_copy_only=False)
        if not self.cuts_lines:
            whole |= pc.match_substring(texts, "\n").to_numpy(zero_copy_only=False)
        entry = np.empty(len(words), dtype=np.int64)
        entry[plain] = np.arange(len(letters))
        entry[odd] = np.arange(len(letters), len(words))
        found = [self.odd[w] if w and not b else np.zeros(0, dtype=np.int32) for w, b in zip(others, bad[odd], strict=True)]
        codes = entry[codes]
        for k in np.flatnonzero(whole).tolist():
            codes[starts[k] : starts[k + 1]] = len(words)
        found.append(np.zeros(0, dtype=np.int32))
        for k in np.flatnonzero(whole).tolist():
            codes[starts[k]] = len(letters) + len(found)
            found.append(np.frombuffer(self.search.encode(texts[k].as_py()), dtype=np.int32))
        ids, ends = gathered(codes, np.concatenate([merged, *found]), np.concatenate([sizes, [len(f) for f in found]]).astype(np.int64))
        return ids, np.append(0, ends)[starts[1:]]


class TokenBytes:
    """The bytes of all tokens of a side, and the joined bytes of runs of ids."""

    def __init__(self, tokens: list[bytes]):
        import numpy as np

        self.data = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.sizes = np.array([len(t) for t in tokens], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def joined(self, ids):
        return self.data[ranges(self.starts[ids], self.sizes[ids])]


def byte_tokens(vocabulary: Vocabulary) -> list[bytes]:
    """Bytes of each id of a byte-level vocabulary; strings of added tokens are ordinary text and never appear."""
    of = {c: b for b, c in byte_chars().items()}
    vocab = vocabulary.parsed["model"]["vocab"]
    tokens = [b""] * (max([*vocab.values(), *(t["id"] for t in vocabulary.parsed["added_tokens"])]) + 1)
    for token, i in vocab.items():
        if all(c in of for c in token):
            tokens[i] = bytes(of[c] for c in token)
    return tokens


def piece_tokens(model: PieceModel) -> list[bytes]:
    """Bytes of each id of a piece model."""
    return [
        b"" if k == CONTROL else bytes([int(p[3:5], 16)]) if k == BYTE else p.replace(SPACE, " ").encode()
        for p, k in zip(model.pieces, model.kinds, strict=True)
    ]


class Aligner:
    """Aligns slices of texts; one per Python worker."""

    def __init__(self, vocabulary: Vocabulary, model: PieceModel):
        self.a, self.b = ByteEncoder(vocabulary, 4, plain=True), PieceEncoder(model)
        self.bytes_a, self.bytes_b = TokenBytes(byte_tokens(vocabulary)), TokenBytes(piece_tokens(model))
        # text of an id in a listing: the first and the other ids of a group's side
        self.words = [s + str(i) for first in (";", "|") for i in range(max(len(self.bytes_a.sizes), len(self.bytes_b.sizes))) for s in (first, ",")]

    def _encoded(self, texts: pa.Array):
        """Ids and their ends for texts on which both sides are the text itself; which texts those are."""
        import numpy as np
        import pyarrow.compute as pc

        good = pc.not_equal(pc.fill_null(texts, ""), "").to_numpy(zero_copy_only=False).copy()
        some = texts.filter(pa.array(good))
        if not len(some):
            return good, None, None
        given = content(pc.binary_join_element_wise(" ", some, ""))
        sides = [(*self.a.encode(some, spaced=True), self.bytes_a), (*self.b.encode(some), self.bytes_b)]
        sides = [(ids.astype(np.int64), ends, known) for ids, ends, known in sides]
        lengths = pc.binary_length(some).to_numpy().astype(np.int64) + 1
        same = np.ones(len(some), dtype=bool)
        for ids, ends, known in sides:
            joined = known.joined(ids)
            sizes = np.append(0, np.cumsum(known.sizes[ids]))[ends]
            sizes = np.diff(sizes, prepend=0)
            same &= sizes == lengths
            at, begin = np.cumsum(sizes) - sizes, np.cumsum(lengths) - lengths
            ok = np.flatnonzero(same)
            differ = joined[ranges(at[ok], lengths[ok])] != given[ranges(begin[ok], lengths[ok])]
            bad = np.searchsorted(np.cumsum(lengths[ok]), np.flatnonzero(differ), "right")
            same[ok[bad]] = False
        good[good] = same
        kept = []
        for ids, ends, known in sides:
            counts = np.diff(ends, prepend=0)
            kept.append((ids[np.repeat(same, counts)], counts[same], known))
        return good, *kept

    def align(self, texts: pa.Array):
        """Per text: tokens of A and B, groups, links and the digest of the groups; and the links of each (text, pair)."""
        from hashlib import sha256

        import numpy as np
        import pandas as pd

        n = len(texts)
        numbers = {k: np.zeros(n, dtype=np.int64) for k in ("n_a", "n_b", "n_groups", "n_links")}
        digests = [""] * n
        good, a, b = self._encoded(texts)
        if a is None or not good.any():
            return numbers, digests, *(np.zeros(0, dtype=np.int64) for _ in range(3))
        names = np.flatnonzero(good)
        (ids_a, n_a, bytes_a), (ids_b, n_b, bytes_b) = a, b
        numbers["n_a"][names], numbers["n_b"][names] = n_a, n_b
        sides = []
        for ids, counts, known in ((ids_a, n_a, bytes_a), (ids_b, n_b, bytes_b)):
            sizes = known.sizes[ids]
            # both sides have the same bytes, so places in all texts of the slice are comparable
            start = np.cumsum(sizes) - sizes
            sides.append(pd.DataFrame({"doc": np.repeat(names, counts), "start": start, "at": np.arange(len(ids))}))
        left, right = sides
        of_a = pd.merge_asof(left, right, on="start", by="doc", suffixes=("", "_other"))["at_other"].to_numpy().astype(np.int64)
        of_b = pd.merge_asof(right, left, on="start", by="doc", suffixes=("", "_other"))["at_other"].to_numpy().astype(np.int64)
        start_a, start_b = left["start"].to_numpy(), right["start"].to_numpy()
        # equal starts are found both ways; they begin a group, as all before them has ended
        begins_a, begins_b = start_b[of_a] == start_a, start_a[of_b] == start_b
        rest = np.flatnonzero(~begins_b)
        link_a = np.concatenate([np.arange(len(ids_a)), of_b[rest]])
        link_b = np.concatenate([of_a, rest])
        doc_a, doc_b = left["doc"].to_numpy(), right["doc"].to_numpy()
        numbers["n_groups"] += np.bincount(doc_a[begins_a], minlength=n)
        numbers["n_links"] += np.bincount(doc_a[link_a], minlength=n)
        pair = ids_a[link_a] * SHIFT + ids_b[link_b]
        # digests: ids of A, then of B, group by group
        group_a, group_b = np.cumsum(begins_a) - 1, np.cumsum(begins_b) - 1
        groups = int(group_a[-1]) + 1
        many_a, many_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
        out = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
        out[np.arange(len(ids_a)) + (np.cumsum(many_b) - many_b)[group_a]] = 2 * ids_a + ~begins_a
        out[np.arange(len(ids_b)) + np.cumsum(many_a)[group_b]] = len(self.words) // 2 + 2 * ids_b + ~begins_b
        said = list(map(self.words.__getitem__, out.tolist()))
        at = 0
        for name, size in zip(names.tolist(), (n_a + n_b).tolist(), strict=True):
            digests[name] = sha256("".join(said[at : at + size])[1:].encode()).hexdigest()
            at += size
        # one row for each text and pair: pairs get small numbers, so that a sort of one number does it
        pairs, number = np.unique(pair, return_inverse=True)
        keys, times = np.unique(doc_a[link_a] * len(pairs) + number, return_counts=True)
        return numbers, digests, keys // len(pairs), pairs[keys % len(pairs)], times


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
_BLOCK = "block long, packed binary, pairs array<long>, docs array<long>"
_ROW = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _packed(columns: dict) -> bytes:
    import zstandard

    sink = pa.BufferOutputStream()
    table = pa.table(columns)
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return zstandard.ZstdCompressor(level=1).compress(sink.getvalue())


def _unpacked(data: bytes) -> pa.Table:
    import zstandard

    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(data)).read_all()


def _blocks(vocabulary: Vocabulary, model: PieceModel):
    """Blocks of (doc_id, text) rows."""
    spec, key = vocabulary.spec, vocabulary.key + model.key
    schema = pa.schema([("block", pa.int64()), ("packed", pa.binary()), ("pairs", pa.list_(pa.int64())), ("docs", pa.list_(pa.int64()))])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext

        aligner = held("align" + key, lambda: Aligner(Vocabulary(spec), model))
        block = TaskContext.get().partitionId() << 32
        parts, rows, size = [], 0, 0

        def made() -> pa.RecordBatch:
            doc, pair, times = (np.concatenate([p[2][k] for p in parts]) for k in range(3))
            pairs, number = np.unique(pair, return_inverse=True)
            docs = np.bincount(number, minlength=len(pairs))
            heads = {"doc_id": pa.concat_arrays([p[0] for p in parts]), "groups_sha256": pa.array([d for p in parts for d in p[3]], pa.string())}
            heads |= {k: np.concatenate([p[1][k] for p in parts]) for k in _COUNTS}
            heads["pairs"] = np.bincount(doc, minlength=rows)
            # of each document its pairs in ascending order, as steps
            steps = np.diff(number, prepend=0).astype(np.int32)
            packed = [_packed(heads), _packed({"step": steps, "times": times.astype(np.int32)})]
            body = len(packed[0]).to_bytes(8, "little") + b"".join(packed)
            return pa.RecordBatch.from_pydict({"block": [block], "packed": [body], "pairs": [pairs], "docs": [docs]}, schema=schema)

        for batch in batches:
            at = 0
            for texts in slices(batch.column(1), 1 << 20):
                numbers, digests, doc, pair, times = aligner.align(texts)
                parts.append((batch.column(0).slice(at, len(texts)), numbers, (doc + rows, pair, times), digests))
                at += len(texts)
                rows += len(texts)
                size += sum(len(t.as_buffer()) for t in texts if t.is_valid)
                if size >= BLOCK_TEXT:
                    yield made()
                    parts, rows, size, block = [], 0, 0, block + 1
        if rows:
            yield made()

    return of


def _summed(blocks: pa.Table, counts: pa.Table) -> pa.Table:
    """Rows of one block's documents from its packed pairs and the counts of its pairs."""
    import numpy as np

    body = blocks["packed"][0].as_py()
    size = int.from_bytes(body[:8], "little")
    heads, links = _unpacked(body[8 : 8 + size]), _unpacked(body[8 + size :])
    place = counts["place"].to_numpy()
    total, best = np.zeros(len(place), dtype=np.int64), np.zeros(len(place), dtype=np.int64)
    total[place], best[place] = counts["total"].to_numpy(), counts["best"].to_numpy()
    number, times = np.cumsum(links["step"].to_numpy()), links["times"].to_numpy().astype(np.int64)
    ends = np.append(0, np.cumsum(heads["pairs"].to_numpy()))
    sums = [np.append(0, np.cumsum(times * x[number]))[ends] for x in (best, total)]
    out = {n: heads[n] for n in ("doc_id", *_COUNTS)} | {"n_best": np.diff(sums[0]), "count_sum": np.diff(sums[1]), "groups_sha256": heads["groups_sha256"]}
    return pa.table(out)


def align(docs: DataFrame, vocabulary: Vocabulary, model: PieceModel, id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row of alignment figures for every document; the blocks are written before it returns."""
    small_batches()
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    blocks = materialize(rows.mapInArrow(_blocks(vocabulary, model), _BLOCK), "align_blocks")
    held_by = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "docs")).alias("place", "of"))
    held_by = held_by.select("block", "place", F.col("of.pairs").alias("pair"), F.col("of.docs").alias("docs"))
    totals = materialize(held_by.groupBy("pair").agg(F.sum("docs").alias("total")), "align_pairs")
    first = F.floor(F.col("pair") / SHIFT)
    most = totals.groupBy(first.alias("a")).agg(F.max("total").alias("most"))
    totals = totals.withColumn("a", first).join(most, "a").select("pair", "total", (F.col("total") == F.col("most")).cast("long").alias("best"))
    counts = held_by.select("block", "place", "pair").join(totals.hint("merge"), "pair").select("block", "place", "total", "best")
    packed = blocks.select(F.col("block").alias("of_block"), "packed")
    return packed.groupBy("of_block").cogroup(counts.groupBy("block")).applyInArrow(_summed, _ROW)
