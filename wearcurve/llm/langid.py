"""Language identification by the nearest of several centroids per language.

A text is lower-cased, everything but letters becomes a space, and its byte 3-grams are hashed to ``DIMS`` counts.
The vector is (1 + log count) times the inverse document frequency, of length one. A fit takes at most
``SAMPLE`` different labelled texts of each language, chosen by a hash and whole, however long, clusters their vectors
by spherical k-means into ``CLUSTERS`` centroids, and learns how near texts of a given length are to their own
centroids. For that, up to ``PIECES`` pieces of 8, 16, 32, ... bytes are cut from each text of the sample, evenly over
the whole text, and beside each piece stands noise: words as long, of letters drawn evenly from a to z. A language's
floor of a length class lies between what nearly all noise and nearly all pieces score, ``MARGIN`` of the way up where
the two are apart, and is ``SLACK`` times the pieces' score where they are not. A text is rejected as no known language if its
cosine is below the floor of its nearest language.

The model has languages x clusters x dims numbers; a fit refuses more than ``MOST_LANGUAGES``. Prediction reads the
text alone: the nearest centroid by cosine, the first in name order of equals. Null texts and texts without a letter
are ``und`` with score 0 and rejected. Rows with a null text, a null language or a text without a letter teach
nothing; without any row to learn from, every text is ``und`` and only those without a letter are rejected. Copies of
a text within a language are learnt from once, so that none fills the sample; rows are judged as often as they come.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearcurve.llm.batches import small_batches
from wearcurve.llm.memo import held, let_go
from wearcurve.sources.tables import materialize

DIMS, CLUSTERS, SAMPLE, PIECES, MOST_LANGUAGES = 4096, 4, 800, 3, 500
#: Length classes: a class for each doubling of the bytes.
CLASSES = 24
SLACK, LOW, MARGIN = 0.5, 0.002, 0.25
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
#: ASCII bytes that are no letters become spaces.
_PLAIN = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]  # of each centroid, in name order
    centroids: bytes  # float32, centroids x DIMS
    idf: bytes  # float32
    floors: bytes  # float32, centroids x CLASSES: the lowest cosine that is not rejected
    key: str


def _counts(text: bytes):
    """Hashed counts of the byte 3-grams of a prepared text."""
    import numpy as np

    b = np.frombuffer(b" " + text + b" ", dtype=np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(DIMS, dtype=np.float32)
    grams = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    grams = grams[grams != 0x202020]
    return np.bincount((grams * np.uint32(2654435761)) >> np.uint32(20), minlength=DIMS).astype(np.float32)


def _prepared(text: str) -> bytes:
    return text.lower().encode("utf-8").translate(_PLAIN)


def _weighted(counts, idf):
    """Rows of length one; rows without a gram stay zero."""
    import numpy as np

    out = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0) * idf
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return (out / np.where(norm > 0, norm, 1)).astype(np.float32)


def _class_of(n: int) -> int:
    return min(max(n, 1).bit_length(), CLASSES) - 1


def _clustered(vectors, k: int):
    """Spherical k-means from far-apart starts; fewer centroids if there are fewer rows."""
    import numpy as np

    centres = [vectors.mean(axis=0)]
    nearest = vectors @ centres[0]
    for _ in range(min(k, len(vectors)) - 1):
        centres.append(vectors[int(nearest.argmin())])
        nearest = np.maximum(nearest, vectors @ centres[-1])
    centres = np.stack(centres)
    for _ in range(20):
        own = (vectors @ centres.T).argmax(axis=1)
        moved = np.stack([vectors[own == c].mean(axis=0) if (own == c).any() else centres[c] for c in range(len(centres))])
        moved /= np.maximum(np.linalg.norm(moved, axis=1, keepdims=True), 1e-12)
        if np.allclose(moved, centres, atol=1e-6):
            break
        centres = moved
    return centres.astype(np.float32)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Learn from a bounded sample of the different texts of each language."""
    import numpy as np

    spark = docs.sparkSession
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    rows = rows.where(F.col("text").rlike(r"\p{L}"))
    rows = rows.withColumn("order", F.xxhash64("text"))
    # all copies of a text have one hash
    sizes = rows.select("lang", "order").distinct().groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not sizes:
        return Model((), b"", b"", b"", "empty")
    # first some twice the sample by the hash alone, so that few texts are ranked
    share = spark.createDataFrame([(r["lang"], min(1.0, 2.0 * SAMPLE / r["n"])) for r in sizes], "lang string, share double")
    some = rows.join(F.broadcast(share), "lang").where(F.pmod("order", F.lit(1 << 20)) < F.col("share") * (1 << 20))
    single = some.groupBy("lang", "order").agg(F.min("text").alias("text"))
    ranked = single.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("order")))
    sample = materialize(ranked.where(F.col("rank") <= SAMPLE).select("lang", "text"), "language_sample")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # counts of whole texts: what is grouped later has a size that texts do not change
        for batch in batches:
            packed = [_counts(_prepared(t.as_py())).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["lang", "counts"])

    counted = materialize(sample.mapInArrow(vectors, "lang string, counts binary"), "language_counts")

    def matrix(group: pa.Table):
        return np.stack([np.frombuffer(c, np.float32) for c in group.column("counts").to_pylist()])

    def learnt(group: pa.Table) -> pa.Table:
        df = (matrix(group) > 0).sum(axis=0).astype(np.int64).tobytes()
        return pa.table({"lang": group.column("lang").slice(0, 1), "n": pa.array([len(group)], pa.int64()), "df": pa.array([df], pa.binary())})

    frequencies = counted.groupBy("lang").applyInArrow(learnt, "lang string, n long, df binary").collect()
    n = sum(r["n"] for r in frequencies)
    idf = (np.log((1 + n) / (1 + sum(np.frombuffer(r["df"], np.int64) for r in frequencies))) + 1).astype(np.float32)

    def centred(group: pa.Table) -> pa.Table:
        centres = _clustered(_weighted(matrix(group), idf), CLUSTERS)
        return pa.table({"lang": group.column("lang").slice(0, 1), "centres": pa.array([centres.tobytes()], pa.binary())})

    parts = sorted(counted.groupBy("lang").applyInArrow(centred, "lang string, centres binary").collect(), key=lambda r: r["lang"])
    langs = [r["lang"] for r in parts for _ in range(len(r["centres"]) // (4 * DIMS))]
    centroids = b"".join(r["centres"] for r in parts)
    centres_of = spark.sparkContext.broadcast({r["lang"]: r["centres"] for r in parts})

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cosines of pieces of each text, and of noise beside them, to the nearest centroid of the text's language."""
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = _prepared(text.as_py())
                centres = np.frombuffer(centres_of.value[lang], np.float32).reshape(-1, DIMS).T
                out: list[tuple] = []
                for c in range(CLASSES):
                    size = 8 << c
                    if size > len(raw):
                        break
                    at = sorted({round(k * (len(raw) - size) / max(1, PIECES - 1)) for k in range(PIECES)})
                    pieces = [p for p in (raw[a : a + size] for a in at) if p.strip()]
                    if pieces:
                        noise = [_noise(p) for p in pieces]
                        near = [(_weighted(np.stack([_counts(p) for p in kind]), idf) @ centres).max(axis=1).tolist() for kind in (pieces, noise)]
                        out += [(_class_of(size), x, y) for x, y in zip(*near, strict=True)]
                columns = [pa.array([o[k] for o in out], kind) for k, kind in enumerate((pa.int32(), pa.float64(), pa.float64()))]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(out), pa.string()), *columns], names=["lang", "class", "clean", "noise"])

    near = sample.mapInArrow(measured, "lang string, class int, clean double, noise double")
    bounds = near.groupBy("lang", "class").agg(F.count("*").alias("n"), F.percentile("clean", F.lit(LOW)).alias("clean"), F.percentile("noise", F.lit(1 - LOW)).alias("noise"))
    known = {(r["lang"], r["class"]): r for r in bounds.where("n >= 20").collect()}
    floors = np.zeros((len(langs), CLASSES), dtype=np.float32)
    for row, lang in zip(floors, langs, strict=True):
        for c in range(CLASSES):
            r = known.get((lang, c))
            if r is not None:
                row[c] = r["noise"] + MARGIN * (r["clean"] - r["noise"]) if r["noise"] < r["clean"] else SLACK * r["clean"]
            elif c:  # longer texts than any learnt from are as near as the longest of these
                row[c] = row[c - 1]
    from hashlib import sha256

    return Model(tuple(langs), centroids, idf.tobytes(), floors.tobytes(), sha256(centroids + floors.tobytes()).hexdigest())


def _noise(piece: bytes) -> bytes:
    """Words as long as those of a piece, of evenly drawn letters; the same for the same piece."""
    import numpy as np
    from zlib import crc32

    out = np.frombuffer(piece, np.uint8).copy()
    letters = out != 32
    out[letters] = np.random.default_rng(crc32(piece)).integers(97, 123, int(letters.sum()), dtype=np.uint8)
    return out.tobytes()


class Classifier:
    def __init__(self, model: Model):
        import numpy as np

        self.langs = model.langs
        self.centroids = np.frombuffer(model.centroids, np.float32).reshape(-1, DIMS).T.copy() if model.langs else None
        self.idf = np.frombuffer(model.idf, np.float32)
        self.floors = np.frombuffer(model.floors, np.float32).reshape(-1, CLASSES)

    def judge(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """(language, score, rejected) of each text."""
        import numpy as np

        out: list[tuple[str, float, bool]] = [(UNKNOWN, 0.0, True)] * len(texts)
        known = [i for i, t in enumerate(texts) if t and _LETTER.search(t)]
        if not self.langs:
            for i in known:
                out[i] = (UNKNOWN, 0.0, False)
            return out
        for at in range(0, len(known), 256):
            block = known[at : at + 256]
            prepared = [_prepared(texts[i]) for i in block]
            near = _weighted(np.stack([_counts(t) for t in prepared]), self.idf) @ self.centroids
            best = near.argmax(axis=1)
            for i, text, row, b in zip(block, prepared, near, best, strict=True):
                score = min(1.0, max(0.0, float(row[b])))
                out[i] = (self.langs[b], score, score < float(self.floors[b, _class_of(len(text))]))
        return out


def predict(text: Column | str, model: Model, spark) -> Column:
    """Struct (lang, score, rejected) of whole texts. The model is broadcast; its size is bounded by the fit."""
    small_batches()
    shared = spark.sparkContext.broadcast(model)
    key = model.key

    def build() -> Classifier:
        let_go()
        return Classifier(shared.value)

    @F.arrow_udf("struct<lang string, score double, rejected boolean>")
    def judged(texts: pa.Array) -> pa.Array:
        found = held("lang" + key, build).judge(texts.to_pylist())
        kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])
        return pa.array([{"lang": a, "score": b, "rejected": c} for a, b, c in found], kind)

    return judged.asNondeterministic()(F.col(text) if isinstance(text, str) else text)
