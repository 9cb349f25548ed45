"""Repeated passages, aligned tokenizers, the Merkle manifest and the id store's query, against brute force or the libraries."""

import base64
import collections
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from wearcurve.llm import align, catalogue, idstore, langid, merkle, pieces, repeats, suffixes, token_counts

SF = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "\n", "  two  spaces ", "a\tb\x1cc", "<|endoftext|> in <|endoftext|>text", "漢字🙂 é\x00", "it's we'll", "x" * 3000, "ab " * 5000,
    "a\n\nb", "a \nb", "a\n b", "\nab c", "ab\n", "Word, word. (x) c++ 12 3a\nb1", "é É\nÉ", "a▁b", "a.,b ,c", "1.5,2 x,.",
]
LETTERS = [*" aAbtheing\n▁é ⁇漢字🙂\t.,'1234567890\x00́²½\x1c\x85\x01", "  ", "'s", "<s>", "</s>", "<0x0A>", "<|endoftext|>", "the", "\n\n"]


def odd_texts(n):
    draw = random.Random(5)
    return ODD + ["".join(draw.choices(LETTERS, k=draw.randint(0, 30))) for _ in range(n)]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x or 0) if not isinstance(x, str) else (False, "", x) for x in r))


def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def vocabulary():
    return token_counts.load_vocabulary(catalogue.tokenizer_path("byte"))


@pytest.fixture(scope="module")
def model():
    return pieces.load_model(catalogue.tokenizer_path("piece"))


# repeated passages


@pytest.mark.parametrize("depth", [5, 200])
def test_suffix_order(monkeypatch, depth):
    monkeypatch.setattr(suffixes, "DEPTH", depth)
    draw = random.Random(depth)
    for _ in range(100):
        sizes = [draw.randint(1, 30) for _ in range(draw.randint(1, 12))]
        strings = [bytes(draw.choices(draw.choice([b"ab", b"a", b"abc\x00\xff"]), k=n + depth - 1)) for n in sizes]
        data = np.frombuffer(b"".join(strings), np.uint8)
        ends = np.cumsum([len(s) for s in strings])
        begins = ends - [len(s) for s in strings]
        found = suffixes.order(data, begins, ends, begins + np.array(sizes) - 1)
        of = np.searchsorted(ends, found, "right")
        got = [strings[k][s : s + depth] for k, s in zip(of.tolist(), (found - begins[of]).tolist(), strict=True)]
        assert got == sorted(s[i : i + depth] for s, n in zip(strings, sizes, strict=True) for i in range(n))
        if depth == 200:
            common = suffixes.common_prefixes(data, found).tolist()
            expected = [next((k for k in range(depth) if a[k] != b[k]), depth) for a, b in zip(got, got[1:], strict=False)]
            assert common[1:] == expected


def brute_repeats(rows):
    seen = collections.Counter()
    raws = [(i, (t or "").encode()) for i, t in rows]
    for _, raw in raws:
        seen.update(xxhash.xxh3_128_digest(raw[k : k + 200]) for k in range(len(raw) - 199))
    out = []
    for i, raw in raws:
        gone = np.zeros(len(raw), dtype=bool)
        for k in range(len(raw) - 199):
            if seen[xxhash.xxh3_128_digest(raw[k : k + 200])] > 1:
                gone[k : k + 200] = True
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out.append((i, len(raw), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return ordered(out)


def removed(df):
    return ordered(
        (r["id"], r["n_bytes"], sum(s["end"] - s["begin"] for s in r["spans"]), len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest())
        for r in repeats.removed(df).collect()
    )


def test_repeats(frame, monkeypatch):
    draw = random.Random(1)
    passages = ["".join(draw.choices("abcde ", k=n)) for n in (150, 199, 200, 201, 260, 400)]
    rows = []
    for k in range(200):
        parts = (draw.choice([draw.choice(passages), "".join(draw.choices("abcdé ", k=draw.randint(0, 300))), "x" * draw.choice([10, 199, 200, 500])]) for _ in range(draw.randint(0, 4)))
        rows.append((k if k % 40 else None, "".join(parts), 1, "a"))
    rows += [(1000, None, 1, ""), (1000, "", 1, ""), (1001, "ab" * 400, 2, ""), (1002, "z" * 199, 1, ""), (7, rows[7][1], 1, ""), (7, rows[7][1], 1, "")]
    expected = brute_repeats([r[:2] for r in rows])
    df = frame(rows, "doc_id long, text string, key int, block string").repartition(5)
    assert removed(df) == expected
    # all grams crowded, windows spread over groups
    monkeypatch.setattr(repeats, "CROWD", 3)
    monkeypatch.setattr(repeats, "GROUP", 3000)
    assert removed(df) == expected
    assert removed(df.limit(0)) == []


def test_repeats_over_chunks(frame):
    """A text longer than what is worked out at a time, with a repeat across the border."""
    draw = random.Random(2)
    long = "".join(draw.choices("abcdefgh ", k=(1 << 20) + 3000))
    rows = [(1, long), (2, "start " + long[(1 << 20) - 150 : (1 << 20) + 150] + " end")]
    got = {r[0]: r for r in removed(frame(rows, "doc_id long, text string"))}
    assert got[1][1:4] == (len(long), 300, 1) and got[2][1:4] == (310, 300, 1)


def test_repeats_query(spark):
    assert ordered(tuple(r) for r in catalogue.op11_suffix_dedup(spark, SF).collect()) == brute_repeats(documents(spark))


# alignment


def brute_alignment(rows, vocabulary):
    import public_tokenizers
    import sentencepiece

    library = Tokenizer.from_file(catalogue.tokenizer_path("byte"))
    library.encode_special_tokens = True
    piece = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    of = {c: b for b, c in token_counts.byte_chars().items()}
    names_a = {i: bytes(of[c] for c in t) for t, i in vocabulary.parsed["model"]["vocab"].items() if all(c in of for c in t)}
    name_b = lambda i: bytes([int(piece.id_to_piece(i)[3:5], 16)]) if piece.is_byte(i) else piece.id_to_piece(i).replace("▁", " ").encode()
    found, counts = [], collections.Counter()
    for i, text in rows:
        a = library.encode(" " + text, add_special_tokens=False).ids if text else []
        b = piece.encode(text) if text else []
        raws = [names_a[x] for x in a], [name_b(x) for x in b]
        if not text or b"".join(raws[0]) != (" " + text).encode() or b"".join(raws[1]) != (" " + text).encode():
            found.append((i, 0, 0, 0, "", []))
            continue
        ends = [np.cumsum([len(r) for r in raw]).tolist() for raw in raws]
        starts = [[0, *e[:-1]] for e in ends]
        links = []
        for k in range(len(a)):
            low = next(j for j in range(len(links) and links[-1][2], len(b)) if ends[1][j] > starts[0][k])
            for j in range(low, len(b)):
                if starts[1][j] >= ends[0][k]:
                    break
                links.append((a[k], b[j], j))
        links = [x[:2] for x in links]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        sides = [np.searchsorted(cuts, e, "left") for e in ends]
        listed = [[[] for _ in cuts] for _ in range(2)]
        for ids, of_group, lists in ((a, sides[0], listed[0]), (b, sides[1], listed[1])):
            for x, g in zip(ids, of_group, strict=True):
                lists[g].append(str(x))
        groups = [",".join(x) + "|" + ",".join(y) for x, y in zip(*listed, strict=True)]
        found.append((i, len(a), len(b), len(cuts), hashlib.sha256(";".join(groups).encode()).hexdigest(), links))
        counts.update(set(links))
    best = collections.Counter()
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    return ordered((i, na, nb, ng, len(links), sum(counts[x] == best[x[0]] for x in links), sum(counts[x] for x in links), h) for i, na, nb, ng, h, links in found)


def test_alignment(frame, vocabulary, model):
    rows = [(k if k % 50 else None, t, 1) for k, t in enumerate(odd_texts(400))] + [(1, "", 1), (None, "no id", 2), (None, "no id", 2)]
    df = frame(rows, "doc_id long, text string, pairs int")
    assert ordered(tuple(r) for r in align.align(df, vocabulary, model).collect()) == brute_alignment([r[:2] for r in rows], vocabulary)
    assert align.align(df.limit(0), vocabulary, model).count() == 0


def test_alignment_query(spark, vocabulary):
    df = catalogue.op12_alignment(spark, SF)
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert ordered(tuple(r) for r in df.collect()) == brute_alignment(documents(spark), vocabulary)


# manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def entry(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def brute_tree(nodes):
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            other = i ^ 1
            proofs[k].append("" if other >= len(nodes) else ("L" if other < i else "R") + nodes[other])
            at[k] //= 2
        nodes = [sha(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
    return nodes[0], proofs


def test_manifest(frame):
    draw = random.Random(4)
    rows = [(draw.choice([None, *range(900)]), draw.choice(["b", "b", "b", "a", None]), draw.choice([None, "", "tëxt", "long " * 50]), "x", 1) for _ in range(1200)]
    rows += [(5, "alone", "t", "x", 1), (6, "", "t", "x", 1), (7, "é", "t", "x", 1), (7, "é", "t", "x", 1), (7, "é", None, "x", 1)]
    df = frame(rows, "id long, kind string, text string, digest string, position int")
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0], sha(*map(entry, r[:3]))))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for name in names:
        leaves = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[name] = (leaves, *brute_tree([r[1] for r in leaves]))
    root, tops = brute_tree([trees[n][1] for n in names])
    expected = [(i, leaf, p + top, trees[n][1], root) for n, top in zip(names, tops, strict=True) for (i, leaf), p in zip(trees[n][0], trees[n][2], strict=True)]
    manifest = merkle.build(df, "kind", ["id"], merkle.digest("id", "kind", "text"), {"id": F.col("id")})
    assert [r["root"] for r in merkle.root(manifest).collect()] == [root]
    proved = merkle.prove(manifest).select("row.id", "digest", "proof", "subroot", "root", merkle.fold(F.col("digest"), F.col("proof")).alias("folded")).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    assert sorted([tuple(r[:5]) for r in proved], key=key) == sorted(expected, key=key)
    assert all(r["folded"] == root for r in proved)
    empty = merkle.build(df.limit(0), "kind", ["id"], merkle.digest("id"), {"id": F.col("id")})
    assert merkle.prove(empty).count() == 0 and merkle.root(empty).count() == 0


def test_stored_manifest(spark, frame, tmp_path):
    df = frame([(i, "g") for i in range(600)], "id long, kind string")
    made = merkle.build(df, "kind", ["id"], merkle.digest("id"), {"id": F.col("id")}, str(tmp_path / "m"))
    opened = merkle.open_manifest(spark, str(tmp_path / "m"))
    assert len(opened.groups) == len(made.groups) == 3
    assert sorted(map(str, merkle.prove(opened).collect())) == sorted(map(str, merkle.prove(made).collect()))


def test_manifest_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in catalogue.op13_merkle_manifest(spark, SF).collect()}
    assert len(got) == len(rows)
    for r in rows:
        changed = zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and r["n_chars"] is not None
        assert got[r["doc_id"]]["leaf"] == sha(*(entry(r[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")))
        assert got[r["doc_id"]]["verified"] != changed


# ids


def test_ids_of_slices(vocabulary):
    library = Tokenizer.from_file(catalogue.tokenizer_path("byte"))
    texts = odd_texts(1500)
    for spaced in (False, True):
        for plain in (False, True):
            library.encode_special_tokens = plain
            encoder = idstore.Encoder(vocabulary, 2, plain)
            ids, ends = encoder.encode(pa.array(texts), spaced)
            got = [x.tolist() for x in np.split(ids, ends[:-1])]
            assert got == [library.encode(" " * (spaced and bool(t)) + (t or ""), add_special_tokens=False).ids for t in texts]


def test_idstore_query(spark):
    library = Tokenizer.from_file(catalogue.tokenizer_path("byte"))
    expected, start = [], 0
    for i, text in sorted(documents(spark)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, catalogue.END_ID]
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = catalogue.op10_idstore(spark, SF)
    assert sorted(tuple(r) for r in got.select("doc_id", "start", "n_tokens", "ids_crc32").collect()) == expected


def test_look_up_reads_the_named_parts(spark, frame, vocabulary, monkeypatch):
    monkeypatch.setattr(idstore, "SHARD_TEXT", 2000)
    monkeypatch.setattr(idstore, "BUCKET_KEYS", 5)
    rows = [(i // 3 if i < 90 else i, f"text of row {i} " * 5) for i in range(400)] + [(None, "no key"), (None, "none")]
    store = idstore.write_store(frame(rows, "doc_id long, text string"), vocabulary, 0)
    assert len(idstore._shards(spark, store.path).inputFiles()) > 5 and store.buckets > 50
    asked = frame([(5, 2), (350, 0), (9999, 0), (None, 1)], "key long, copy long")
    plans, write = [], idstore.materialize
    monkeypatch.setattr(idstore, "materialize", lambda df, name: plans.append(df._jdf.queryExecution().toString()) or write(df, name))
    found = idstore.look_up(asked, store)
    assert "PartitionFilters: [span" in plans[0]
    assert len([f for f in set(found.inputFiles()) if "/shards/" in f]) <= 3
    got = {(r["key"], r["copy"]): r["n"] for r in found.collect()}
    assert set(got) == {(5, 2), (350, 0), (None, 1)}
    every = idstore.look_up(frame([(k, c) for k in {r[0] for r in rows} for c in range(3)], "key long, copy long"), store).collect()
    assert len(every) == len(rows)
    starts = sorted((r["start"], r["n"]) for r in every)
    assert starts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False))


# the pipeline


def test_stages_with_names_they_use_themselves(spark, frame):
    draw = random.Random(3)
    texts = [" ".join("".join(draw.choices("abcdefgh", k=5)) for _ in range(40)) for _ in range(3)]
    rows = [(i, texts[i // 2], "en", 1, 2, 3, 4) for i in range(6)]
    docs = frame(rows, "doc_id long, text string, lang string, kept int, contaminated_key int, row int, found int")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert out.count() == (3 if name == "near_duplicates" else 6), name


def test_noise_is_rejected_and_clean_texts_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    known = langid.Classifier(langid.fit(docs))
    assert not any(r[2] for r in known.judge([r["text"] for r in docs.where("text IS NOT NULL").select("text").collect()]))
    draw = random.Random(1)
    for n in (100, 500, 3000):
        letters = [" ".join("".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randint(2, 9))) for _ in range(n)) for _ in range(20)]
        packed = [base64.b64encode(draw.randbytes(5 * n)).decode() for _ in range(20)]
        assert all(r[2] for r in known.judge(letters + packed)), n


def test_long_texts_teach(spark, frame):
    rows = [("xx", "foo bar baz " * 20_000), ("xx", "fob bar zab " * 20_000), ("yy", "ühm äch öde")]
    assert set(langid.fit(frame(rows, "lang string, text string")).langs) == {"xx", "yy"}
