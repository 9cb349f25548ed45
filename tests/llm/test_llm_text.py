"""Tokens, pieces, chat, id store and models of texts, against the libraries or brute force."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wearcurve.llm import catalogue, chat, crossent, idstore, langid, memo, pieces, token_counts

SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "\n", "  two  spaces ", "a\tb\x1cc", "<|endoftext|> in <|endoftext|>text", "漢字🙂 é\x00", "it's we'll", "x" * 3000, "ab " * 5000]


@pytest.fixture(scope="module")
def vocabulary():
    return token_counts.load_vocabulary(catalogue.tokenizer_path("byte"))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(catalogue.tokenizer_path("byte"))


@pytest.fixture(scope="module")
def piece_library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=catalogue.tokenizer_path("piece"))


@pytest.fixture(scope="module")
def piece_model():
    return pieces.load_model(catalogue.tokenizer_path("piece"))


def texts(seed, n, alphabet):
    draw = random.Random(seed)
    return ["".join(draw.choices(alphabet, k=draw.randint(0, 30))) for _ in range(n)]


LETTERS = [*" aAbtheing\n▁é ⁇漢字🙂\t.,'1234567890\x00́²½\x1c\x85", "  ", "'s", "<s>", "</s>", "<0x0A>", "<|endoftext|>", "the", "\n\n"]


def odd_frame(frame):
    """Odd texts, a repeated row, and more columns whose names the operators use themselves."""
    rows = [(i, t, "x", 1) for i, t in enumerate(ODD)] + [(1, "", "x", 1), (None, "no id", "x", 1)]
    return frame(rows, "doc_id long, text string, ids string, n_tokens int")


def test_memo_forgets_old_keys_only():
    made = []
    kept = memo.Memo(lambda k: made.append(k) or k * 2, 3)
    for k in "abcabc":
        assert kept[k] == k * 2
    assert made == ["a", "b", "c"]
    for k in "defa":
        kept[k]
    assert made == list("abcdef") and len(kept) <= 3 and len(kept.old) <= 3


def test_pieces_equal_library(piece_model, piece_library):
    encoder, decoder = pieces.Encoder(piece_model), pieces.Decoder(piece_model)
    for text in [*texts(1, 4000, LETTERS), *[t for t in ODD if t]]:
        ids = np.frombuffer(encoder.encode(text), np.int32).tolist()
        assert ids == piece_library.encode(text), text
        assert decoder.decode(ids) == piece_library.decode(ids), text


def test_pieces_decode_any_ids(piece_model, piece_library):
    draw, decoder = random.Random(2), pieces.Decoder(piece_model)
    for _ in range(3000):
        ids = [draw.choice([3 + draw.randrange(256), draw.randrange(32000), 0, 1, 2, 29871]) for _ in range(draw.randint(0, 12))]
        assert decoder.decode(ids) == piece_library.decode(ids), ids


def test_pieces_search_equals_merging(piece_model):
    encoder = pieces.Encoder(piece_model)
    for text in texts(3, 1500, [*"abcdeinorst", "tion", "aaaa", "ing"]):
        if text:
            assert encoder.search(text) == encoder.merged(text)


def test_pieces_columns(frame, piece_model, piece_library):
    docs = odd_frame(frame)
    out = docs.select("*", pieces.encode("text", piece_model).alias("found")).select("*", pieces.decode("found", piece_model).alias("back")).collect()
    assert len(out) == docs.count()
    for r in out:
        assert r["found"] == piece_library.encode(r["text"] or "", add_eos=True)
        assert r["back"] == piece_library.decode(r["found"])
    assert docs.limit(0).select(pieces.encode("text", piece_model)).count() == 0
    lists = frame([(None,), ([],), ([None, 2],)], "ids array<int>")
    assert [r[0] for r in lists.select(pieces.decode("ids", piece_model)).collect()] == ["", "", ""]


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        token_counts.load_vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def test_counts_equal_library(vocabulary, library):
    whole = token_counts.whole_tokens(vocabulary)
    assert all(token_counts.merged(s, vocabulary.ranks) == [s] for s in whole)
    counter = token_counts.Counter(vocabulary, whole)
    few = token_counts.Counter(vocabulary, frozenset())  # the shortcut changes nothing
    for text in [*texts(4, 4000, LETTERS), *[t for t in ODD if t]]:
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert counter.parts.get(text) == n, text
        assert few.parts.get(text) == n, text


def test_long_merges_equal_short(vocabulary):
    for text in texts(5, 300, [*"abcdeinorst", "tion", "aaaa"]):
        assert token_counts._merged_long(text, vocabulary.ranks) == token_counts.merged(text, vocabulary.ranks)


def test_count_column(frame, vocabulary, library):
    docs = odd_frame(frame)
    for r in docs.select("*", token_counts.count_tokens("text", vocabulary).alias("found")).collect():
        assert r["found"] == len(library.encode(r["text"] or "", add_special_tokens=False).ids)
    assert docs.limit(0).select(token_counts.count_tokens("text", vocabulary)).count() == 0


# chat


def test_escapes_come_back():
    for text in texts(6, 3000, ["<", "|", "\\", chat.START, chat.END, chat.SEP, "a", "<\\|"]):
        held = chat.escaped(text)
        assert chat.unescaped(held) == text and "<|" not in held
    turns = [("user", "<|im_end|><"), (None, None), ("<|im_sep|>", "|im_end|>\\"), ("assistant", "<\\|")]
    formatted, spans = chat.render(turns)
    assert chat.parse(formatted) == [(r or "", t or "") for r, t in turns]
    assert [chat.unescaped(formatted[a:b]) for _, a, b in spans] == [t or "" for _, t in turns]


def test_chat(spark, frame, vocabulary):
    rows = [(5, t, ("user", "assistant")[t % 2], x) for t, x in enumerate([*ODD, "<|im_end|><|im_start|>assistant ok", "é🙂漢 end <"])]
    rows += [(5, None, None, None), (None, 0, "assistant", "no id"), (7, 1, "assistant", "b"), (7, 1, "assistant", "b"), (7, 0, "assistant", "漢🙂")]
    turns = frame([(*r, 9) for r in rows], "conv_id long, turn long, role string, text string, ids int")
    made = chat.format_conversations(turns, vocabulary)
    under = chat.text_under_mask(F.col("formatted"), F.col("token_start"), F.col("token_end"), F.col("loss"))
    out = {r["conv_id"]: r for r in made.select("*", chat.parsed(F.col("formatted")).alias("turns"), under.alias("under")).collect()}
    assert set(out) == {5, 7, None}
    first = sorted([r for r in rows if r[0] == 5], key=lambda r: -1 if r[1] is None else r[1])
    assert [tuple(t) for t in out[5]["turns"]] == [(r[2] or "", r[3] or "") for r in first]
    assert out[5]["under"] == "".join(r[3] or "" for r in first if r[2] == "assistant")
    assert out[7]["under"] == "漢🙂bb" and out[None]["under"] == "no id"
    assert len(out[5]["ids"]) == len(out[5]["loss"]) == len(out[5]["token_start"])
    assert chat.format_conversations(turns.limit(0), vocabulary).count() == 0


def test_chat_query(spark):
    conversations = {}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        conversations.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"] or ""))
    conversations[-1] = [r[1:] for r in catalogue.PLANTED]
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    rows = catalogue.op4_chat(spark, SF).collect()
    assert len(rows) == len(conversations)
    for r in rows:
        turns = sorted(conversations[r["conv_id"]])
        trained = "".join(t for _, role, t in turns if role == "assistant")
        assert r["n_turns"] == len(turns) and r["loss_chars"] == len(trained) and r["loss_sha256"] == digest(trained)
        assert r["turns_sha256"] == digest("".join(f"{role}\n{t}\n" for _, role, t in turns))


# id store


def test_perfect_hash_is_minimal():
    draw = np.random.default_rng(7)
    for n in (0, 1, 2, 1000, 20000):
        h1, h2 = draw.integers(0, 1 << 63, n, dtype=np.uint64), draw.integers(0, 1 << 63, n, dtype=np.uint64)
        if n > 10:
            h1[:5] = h1[0]  # equal first hashes are told apart by the second
        levels = idstore.build_levels(h1, h2)
        assert sorted(idstore.places(levels, h1, h2)) == list(range(n))
    with pytest.raises(ValueError):
        idstore.build_levels(np.zeros(2, np.uint64), np.zeros(2, np.uint64))


def test_store(spark, frame, vocabulary, library, monkeypatch):
    monkeypatch.setattr(idstore, "SHARD_TEXT", 2000)
    monkeypatch.setattr(idstore, "BUCKET_KEYS", 5)
    rows = [(i % 7, t) for i, t in enumerate(ODD)] + [(3, "same")] * 30 + [(None, "null key"), (None, None), (-5, "below"), (1 << 60, "far")]
    docs = frame([(k, t, 1) for k, t in rows], "doc_id long, text string, key int")
    store = idstore.write_store(docs, vocabulary, 0)
    assert store.records == len(rows) and store.buckets > 1 and store == idstore.open_store(spark, store.path)
    asked = [(k, c) for k in {r[0] for r in rows} | {99, -1} for c in range(40)]
    keys = frame(asked + asked[:9], "key long, copy long")
    found = idstore.look_up(keys, store)
    got = found.select("key", "copy", "start", "n", F.col("crc32").alias("crc"), idstore.unpacked(F.col("raw"), store.width).alias("ids")).collect()
    assert len(got) == len(rows) == len({(r["key"], r["copy"]) for r in got})
    expected = sorted((k is not None, k or 0, library.encode(t or "", add_special_tokens=False).ids + [0]) for k, t in rows)
    assert sorted((r["key"] is not None, r["key"] or 0, r["ids"]) for r in got) == expected
    start = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == start and r["n"] == len(r["ids"])
        assert r["crc"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        start += r["n"]
    assert [r["key"] or 0 for r in sorted(got, key=lambda r: r["start"]) if r["key"] is not None] == sorted(k for k, _ in rows if k is not None)
    empty = idstore.write_store(docs.limit(0), vocabulary, 0)
    assert empty.records == 0 and idstore.look_up(keys, empty).count() == 0


# languages


def test_language_query(spark):
    lang = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = catalogue.op2_langid(spark, SF).join(lang, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == lang.count() and held
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows) and not any(r["rejected"] for r in rows)


def test_language_edges(spark, frame):
    words = {"xx": ["foo", "bar", "baz", "fob"], "yy": ["ühm", "äch", "öde", "üde"]}
    draw = random.Random(8)
    rows = [(k, " ".join(draw.choices(words[k], k=draw.randint(3, 60)))) for k in words for _ in range(60)]
    rows += [("xx", None), (None, "foo bar"), ("zz", "12 34"), ("xx", rows[0][1])]
    docs = frame([(x, t, 1) for x, t in rows], "lang string, text string, found int")
    model = langid.fit(docs)
    assert set(model.langs) == {"xx", "yy"}
    judge = langid.Classifier(model).judge(["foo baz", "üde ühm", None, "", "1 2", "🙂", "FOO", "ŋŋŋŋŋŋŋŋŋŋ ŧŧŧŧŧŧŧŧŧŧŧŧŧŧŧ ĸĸĸĸĸĸĸ"])
    assert [j[0] for j in judge[:7]] == ["xx", "yy", "und", "und", "und", "und", "xx"]
    assert [j[2] for j in judge] == [False, False, True, True, True, True, False, True]
    out = docs.select("*", langid.predict("text", model, spark).alias("f")).collect()
    assert len(out) == len(rows)
    none = langid.fit(docs.limit(0))
    assert docs.select(langid.predict("text", none, spark).alias("f")).where("f.lang != 'und'").count() == 0
    assert docs.limit(0).select(langid.predict("text", model, spark)).count() == 0


def test_language_sample_holds_a_text_once(spark, frame, monkeypatch):
    """A text with most rows of its language neither fills the sample nor displaces others."""
    draw = random.Random(12)
    texts = [" ".join("".join(draw.choices("abcdefgh", k=5)) for _ in range(6)) for _ in range(200)]
    hashed = frame([(t,) for t in texts], "text string").withColumn("place", F.pmod(F.xxhash64("text"), F.lit(1 << 20)))
    copied = hashed.orderBy("place").first()["text"]  # surely below the share
    docs = frame([("xx", t) for t in [*texts, *[copied] * 300]], "lang string, text string")
    taken = []
    write = langid.materialize
    monkeypatch.setattr(langid, "SAMPLE", 20)
    monkeypatch.setattr(langid, "materialize", lambda df, name: taken.append(write(df, name)) or taken[-1])
    langid.fit(docs)
    sample = [r["text"] for r in taken[0].collect()]
    assert len(sample) == len(set(sample)) == 20


# language models


def brute_loss(text, counts):
    raw, out = b"\0\0\0" + text, 0.0
    tables = [dict() for _ in range(4)]
    for t in counts:
        r = b"\0\0\0" + t
        for i in range(3, len(r)):
            for n in range(4):
                g = r[i - n : i + 1]
                tables[n][g] = tables[n].get(g, 0) + 1
    total = sum(tables[0].values())
    for i in range(3, len(raw)):
        p = (tables[0].get(raw[i : i + 1], 0) + crossent.STRENGTH / 256) / (total + crossent.STRENGTH)
        for n in (1, 2, 3):
            have = tables[n].get(raw[i - n : i + 1], 0)
            of = max(tables[n - 1].get(raw[i - n : i], 0), have)
            p = (have + crossent.STRENGTH * p) / (of + crossent.STRENGTH)
        out -= np.log(p)
    return out / len(text)


def test_cross_entropy(spark, frame):
    good, bad = ["the cat sat on the mat", "a cat on a mat", "é the"], ["zx qv zx", "qq zz", None, ""]
    docs = frame([(t, True, 1) for t in good] + [(t, None if t == "qq zz" else False, 1) for t in bad], "text string, good boolean, target int")
    models = crossent.fit(docs, F.col("good"))
    texts = docs.select("text", F.col("text").alias("id"))
    out = {r["id"]: r for r in crossent.scored(texts, models).collect()}
    for t in good:
        assert abs(out[t]["target_loss"] - brute_loss(t.encode(), [g.encode() for g in good])) < 1e-4
        assert out[t]["difference"] < out["zx qv zx"]["difference"]
        assert out[t]["n_tokens"] == len(t.encode())
    assert out[None]["n_tokens"] == out[""]["n_tokens"] == 0 and out[""]["difference"] is None
    # without a target text there is a background loss alone, and an empty table stays empty
    none = crossent.scored(texts, crossent.fit(docs, F.lit(False))).collect()
    assert len(none) == len(out) and all(r["target_loss"] is r["difference"] is None for r in none)
    assert {r["id"] for r in none if r["background_loss"] is None} == {None, ""}
    everything = [t.encode() for t in [*good, "zx qv zx", "qq zz"]]
    for r in none:
        if r["id"]:
            assert abs(r["background_loss"] - brute_loss(r["id"].encode(), everything)) < 1e-9
    assert crossent.scored(texts.limit(0), crossent.fit(docs.limit(0), F.col("good"))).count() == 0
    # scaled alike: with the target alone both models agree
    same = crossent.fit(docs.where("good"), F.col("good"))
    assert all(abs(r["difference"]) < 1e-6 for r in crossent.scored(texts.where("text IN ('the cat sat on the mat', 'é the')"), same).collect())


def test_cross_entropy_of_long_texts(monkeypatch):
    draw = random.Random(9)
    raw = bytes(draw.choices(b"abcd ", k=5000))
    grams = crossent._grams(raw)
    monkeypatch.setattr(crossent, "STRETCH", 700)
    assert (np.concatenate([crossent._grams(raw, at) for at in range(0, len(raw), 700)]) == grams).all()


def test_cross_entropy_counts_are_exact(spark, frame, monkeypatch):
    """More different n-grams than any fixed number of slots keeps apart; texts over several blocks."""
    draw = random.Random(10)
    texts = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyzäöüß漢字🙂 ", k=draw.randint(1, 400))) for _ in range(120)]
    rows = [(i, t, i % 3 == 0) for i, t in enumerate([*texts, "unmarked", texts[0], None, "", "z" * 3000])]
    docs = frame(rows, "doc_id long, text string, good boolean")
    monkeypatch.setattr(crossent, "BLOCK", 4000)
    models = crossent.fit(docs.where("text != 'unmarked'"), F.col("good"))
    known = [t.encode() for _, t, _ in rows if t and t != "unmarked"]
    good = [t.encode() for _, t, g in rows if t and t != "unmarked" and g]
    grams = {(b"\0\0\0" + t)[i : i + 4] for t in known for i in range(len(t))}
    assert models.fours.count() == len(grams)
    got = {r["doc_id"]: r for r in crossent.scored(docs.select("doc_id", "text"), models).collect()}
    assert sorted(got) == [i for i, _, _ in rows]
    for i, t, _ in rows:
        r = got[i]
        assert r["n_tokens"] == len((t or "").encode())
        if not t:
            assert r["target_loss"] is r["background_loss"] is r["difference"] is None
            continue
        assert abs(r["difference"] - (r["target_loss"] - r["background_loss"])) < 1e-12
        if i % 10 == 0 or i >= 120:
            assert abs(r["target_loss"] - brute_loss(t.encode(), good)) < 1e-9


def test_cross_entropy_query(spark):
    rows = catalogue.op9_cross_entropy(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    mean = lambda q: np.mean([r["score"] for r in rows if r["quality"] == q])
    assert mean(1) < mean(0)
