"""Benchmark decontamination by a prefix-filtered set join, with DataFrame functions only.

Words are lower-cased (A-Z) runs of digits, letters and characters beyond ASCII. A benchmark item gives windows of
13 consecutive words, or one window if it has fewer; windows of the same words are one. A window is a set of
shingles (5 words, or all of a shorter window) of which every one must be in a document that holds the window, so
its necessary prefix is one shingle. Shingles are ordered by how often they occur in the documents and the rarest
is joined. Its place in the document and in the window gives the only start that can match (positional bound),
which must lie in the document with the whole window (length bound). Then the words are compared.

Documents are keyed by the digest of their text, so copies are compared once, and the joins carry no texts but
those of documents with a candidate. The benchmark's shingle hashes are broadcast only if there are at most
``BROADCAST_ROWS``, the candidates' keys only up to ``BROADCAST_KEYS``; beyond, Spark shuffles.

Null texts have no words. Items without words give no window; items with a null id can hit words but are not
listed. Repeated documents give a row each, repeated item ids count once. Without items, nothing is hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearcurve.sources.tables import materialize

WINDOW, SHINGLE = 13, 5
#: A document is contaminated if one in so many of its words is hit.
ONE_IN = 20
#: A hash takes 8 bytes, so this is at most some 32 MB in a task.
BROADCAST_ROWS = 1_000_000
#: A key takes 32 bytes, so this is at most some 30 MB in a task.
BROADCAST_KEYS = 250_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(text: Column) -> Column:
    """A-Z in lower case; ``lower`` would also change other letters, but not in texts of ASCII alone."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    return F.array_remove(F.split(lowered(F.coalesce(text, F.lit(""))), BETWEEN), "")


def _shingles(w: Column, size: int) -> Column:
    """Structs (pos, hash) of all shingles of one size."""
    n = F.size(w)
    one = lambda i: F.struct(i.alias("pos"), F.xxhash64(F.lit(size), *[F.get(w, i + k) for k in range(size)]).alias("hash"))
    return F.transform(F.when(n >= size, F.sequence(F.lit(0), n - size)).otherwise(F.array().cast("array<int>")), one)


def windows(items: DataFrame, id: str = "item_id", text: str = "text") -> DataFrame:
    """(item, window, size): the distinct windows of each item, as words joined by spaces."""
    w = items.select(F.col(id).alias("item"), words(F.col(text)).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - WINDOW, F.lit(0)))
    cut = w.select("item", F.explode(F.transform(starts, lambda s: F.slice(F.col("w"), s + 1, WINDOW))).alias("w"))
    return cut.select("item", F.array_join("w", " ").alias("window"), F.size("w").alias("size")).distinct()


def text_key(text: Column) -> Column:
    """The digest that stands for a text."""
    return F.md5(F.coalesce(text, F.lit("")))


def contamination(
    docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """(id, key, n_words, n_hit, items, contaminated) of each row.

    ``items`` is the sorted list of item ids as strings; ``key`` is ``text_key`` of the text.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(body.alias("body"), text_key(body).alias("key"))
    of_item = materialize(windows(items, item_id, item_text), "windows")
    window = of_item.select("window", "size").distinct()
    sizes = [r[0] for r in window.select(F.least("size", F.lit(SHINGLE)).alias("s")).distinct().orderBy("s").collect()]
    found = materialize(_occurring(keyed, window, sizes), "occurrences")

    starts = F.sort_array(F.collect_set(F.struct("start", "size")))
    step = lambda a, x: F.struct(
        (a["hit"] + F.greatest(x["start"] + x["size"] - F.greatest(a["end"], x["start"]), F.lit(0))).alias("hit"),
        F.greatest(a["end"], x["start"] + x["size"]).alias("end"),
    )
    none = F.struct(F.lit(0).alias("hit"), F.lit(0).alias("end"))
    hits = found.groupBy("key").agg(F.aggregate(starts, none, step)["hit"].cast("long").alias("n_hit"))
    listed = found.select("key", "window").distinct().join(of_item.where(F.col("item").isNotNull()), "window")
    listed = listed.groupBy("key").agg(F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("items"))
    by_key = hits.join(listed, "key", "left")

    counted = docs.select(
        F.col(id).alias("id"),
        text_key(body).alias("key"),
        F.regexp_count(body, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("long").alias("n_words"),
    )
    out = counted.join(by_key, "key", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select(
        F.col("id").alias(id),
        "key",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (ONE_IN * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def _occurring(keyed: DataFrame, window: DataFrame, sizes: list[int]) -> DataFrame:
    """(key, start, size, window): all places of all windows."""
    if not sizes:
        return keyed.sparkSession.createDataFrame([], "key string, start int, size int, window string")
    # the shingles of each window, and where they are in it
    split = window.withColumn("w", F.split("window", " "))
    parts = [
        split.where(F.least("size", F.lit(SHINGLE)) == k).select("window", "size", F.inline(_shingles(F.col("w"), k)).alias("offset", "hash"))
        for k in sizes
    ]
    part = parts[0]
    for p in parts[1:]:
        part = part.unionByName(p)
    part = materialize(part, "window_shingles")
    wanted = part.select("hash").distinct()
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    # all places of these shingles in the documents
    tokens = keyed.select("key", words(F.col("body")).alias("w"))
    all_shingles = F.concat(*[_shingles(F.col("w"), k) for k in sizes])
    places = tokens.select("key", F.size("w").alias("n"), F.inline(all_shingles).alias("pos", "hash"))
    places = materialize(places.join(wanted, "hash").distinct(), "places")
    # rarity, the necessary prefix, and the bounds
    often = places.groupBy("hash").agg(F.count("*").alias("often"))
    prefix = part.join(often, "hash", "left").groupBy("window", "size").agg(
        F.min(F.struct(F.coalesce("often", F.lit(0)).alias("often"), "hash", "offset")).alias("rarest")
    )
    prefix = prefix.select("window", "size", "rarest.*").where("often > 0")
    start = F.col("pos") - F.col("offset")
    candidates = places.join(prefix, "hash").where((start >= 0) & (start + F.col("size") <= F.col("n")))
    candidates = materialize(candidates.select("key", start.alias("start"), "size", "window").distinct(), "candidates")
    # the words themselves, one text of each key
    asked = candidates.groupBy("key").agg(F.collect_list(F.struct("start", "size", "window")).alias("asked"))
    keys = materialize(candidates.select("key").distinct(), "candidate_keys")
    if keys.count() <= BROADCAST_KEYS:
        keys = F.broadcast(keys)  # then copies of a text are merged before anything is shuffled
    texts = keyed.join(keys, "key", "left_semi").groupBy("key").agg(F.min("body").alias("body"))
    looked = asked.join(texts, "key").select("key", "asked", words(F.col("body")).alias("w"))
    right = F.filter("asked", lambda a: F.array_join(F.slice(F.col("w"), a["start"] + 1, a["size"]), " ") == a["window"])
    return looked.select("key", F.inline(right))
