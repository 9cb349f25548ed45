"""Near duplicates, components, contamination, URLs, neighbours and the pipeline, against brute force or SQL."""

import itertools
import random

import numpy as np
import oracle_check
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wearcurve.llm import ann, catalogue, components, decontam, langid, pieces, simhash, urls

SF = "/root/testdata/sf0.001"


def groups(nodes, edges):
    """Smallest member of each node's component."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_queries_with_sql(spark, name):
    df = catalogue.QUERIES[name](spark, SF)
    result = oracle_check.database(SF).execute(catalogue.SQL[name])
    rows = [tuple(r) for r in df.collect()]
    problem = oracle_check.compare(rows, df.columns, result.fetchall(), [d[0] for d in result.description])
    assert rows and problem is None, problem


def test_components(frame):
    draw = random.Random(1)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 460)] + [(500, 500), (500, 500), (7, 7)]
    df = frame([*edges, (None, 3), (3, None)], "a long, b long")
    got = {r["node"]: r["component"] for r in components.connected_components(df).collect()}
    nodes = {x for e in edges for x in e}
    assert got == groups(nodes, edges)
    assert components.connected_components(df.limit(0)).count() == 0
    words = frame([("b", "a"), ("c", "b")], "a string, b string")
    assert {tuple(r) for r in components.connected_components(words).collect()} == {("a", "a"), ("b", "a"), ("c", "a")}


@pytest.mark.parametrize("bucket", [10_000, 2])
def test_links_are_all_links(frame, bucket):
    draw = random.Random(2)
    prints = {draw.getrandbits(64) for _ in range(60)}
    centre = draw.getrandbits(64)
    for _ in range(250):  # a crowd around one fingerprint
        bits = draw.sample(range(64), draw.randint(0, 3))
        prints.add(centre ^ sum(1 << b for b in bits))
    signed = {p - (1 << 64) if p >> 63 else p for p in prints}
    expected = {(min(a, b), max(a, b)) for a, b in itertools.combinations(signed, 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    got = simhash.links(frame([(p,) for p in signed], "fp long"), bucket).collect()
    assert {tuple(r) for r in got} == expected and len(got) == len(expected) > 100


def brute_fingerprint(text):
    from xxhash import xxh64_intdigest

    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    hashes = [xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_near(rows):
    prints = {}
    for i, t in rows:
        prints.setdefault(brute_fingerprint(t), []).append(i)
    pairs = [(a, b) for a, b in itertools.combinations(prints, 2) if (a ^ b).bit_count() <= 2]
    return groups(prints, pairs), prints


def test_near_duplicates(frame):
    base = "the quick brown fox jumps over the lazy dog and runs away " * 6
    rows = [(3, base), (9, base.upper()), (1, base + "now"), (2, "other words here"), (4, None), (5, ""), (6, " \t\n"), (7, "É one"), (7, "É one"), (8, "é one"), (None, base), (None, "alone at last"), (10, "word " * 3000)]
    docs = frame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, fp int, component_id int")
    out = simhash.near_duplicates(docs).collect()
    by_print, prints = brute_near(rows)
    assert len(out) == len(rows)
    for r in out:
        fp = r["fingerprint"] & (2**64 - 1)
        members = [i for f, ids in prints.items() if by_print[f] == by_print[fp] for i in ids]
        assert r["doc_id"] in prints[fp]
        assert r["component_id"] == min((i for i in members if i is not None), default=None)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_near_duplicate_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    by_print, prints = brute_near(rows)
    least = {}
    for fp, ids in prints.items():
        least[by_print[fp]] = min([least.get(by_print[fp], 1 << 60), *ids])
    expected = {(i, f"{fp:016x}", least[by_print[fp]]) for fp, ids in prints.items() for i in ids}
    assert {tuple(r) for r in catalogue.op3_simhash(spark, SF).collect()} == expected


# contamination


def brute_contamination(docs, items):
    import re

    words = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) if w]
    out = []
    for doc_id, text in docs:
        w, hit, listed = words(text), set(), set()
        for item_id, item in items:
            b = words(item)
            for window in {tuple(b[i : i + 13]) for i in range(max(1, len(b) - 12))} if b else ():
                for s in range(len(w) - len(window) + 1):
                    if tuple(w[s : s + len(window)]) == window:
                        hit |= set(range(s, s + len(window)))
                        listed.add(item_id)
        ids = sorted(str(i) for i in listed if i is not None)
        out.append((doc_id, len(w), len(hit), ids, bool(hit) and 20 * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("rows", [decontam.BROADCAST_ROWS, 0])
def test_contamination(frame, monkeypatch, rows):
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", rows)
    monkeypatch.setattr(decontam, "BROADCAST_KEYS", rows)
    long = " ".join(f"w{i}" for i in range(30))
    items = [(1, long), (2, "Short one."), (2, "three word item"), (10, "É"), (4, None), (5, "..."), (None, "nobody owns this"), (6, long), (7, "a a a a a a a a a a a a a a a a")]
    docs = [
        (1, "x " * 50 + long.upper() + " y"), (2, "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11"), (3, "short-one, three word item " * 4), (4, None), (5, ""),
        (6, "é É"), (7, "a " * 40), (7, "a " * 40), (None, "nobody owns this"), (8, "z " * 400 + "short one"), (9, "short onex"), (11, " ".join(f"w{i}" for i in range(5, 30))),
    ]
    d = frame([(i, t, 1, "k") for i, t in docs], "doc_id long, text string, n_hit int, key string")
    b = frame([(i, t, 1) for i, t in items], "item_id long, text string, size int")
    key = lambda r: (r[0] is not None, r[0] or 0, *map(str, r[1:]))
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in decontam.contamination(d, b).collect()]
    assert sorted(got, key=key) == sorted(brute_contamination(docs, items), key=key)
    assert decontam.contamination(d.limit(0), b).count() == 0
    assert decontam.contamination(d, b.limit(0)).where("n_hit > 0 OR contaminated").count() == 0


# URLs


def test_url_aliases(spark, frame):
    page = lambda i, url, html="": (i, url, html, 1)
    link = '<LINK href="{}" rel="canonical">'
    pages = frame(
        [
            page(1, "http://bad.example.com/de/x#top"), page(2, "https://mirror.net/a?q=1", link.format("http://BAD.example.com/de/x")),
            page(3, "http://third.net/", '<meta http-equiv="Refresh" content="0; url=https://mirror.net/a?q=1">'),
            page(4, "http://ok.org/", link.format("http://third.net/")), page(5, "http://free.net/", link.format("http://ok.org/other")),
            page(6, None, None), page(7, "no scheme"), page(7, "no scheme"), page(8, "x://HOST.com/fr/?x"), page(9, "http://gone.net"),
            page(10, "http://xcom/de/"), page(11, "http://a.b.example.com/de/", None), page(12, "://"), page(13, "http://t.net/p", '<link rel=canonical href=/relative>'),
        ],
        "page_id long, url string, html string, host int",
    )
    redirects = frame([("http://gone.net/", "http://never.seen.com/de/1"), (None, "http://x.net/"), ("http://x.net/", "broken")], "source string, target string")
    out = {r["page_id"]: r for r in urls.judge(pages, urls.rule_table(spark, catalogue.RULES), redirects).collect()}
    verdicts = {i: (r["verdict"], r["by"], r["rule"]) for i, r in out.items()}
    assert verdicts[1] == ("block", "rule", "com/de/") and verdicts[2] == verdicts[3] == ("block", "alias", None)
    assert verdicts[4] == ("allow", "rule", "org/")  # an alias of what is blocked, but allowed itself
    assert verdicts[5] == ("allow", "default", None) and verdicts[9] == ("block", "alias", None)
    assert (out[6]["host"], out[6]["path"], out[7]["host"]) == ("", "", "")
    assert (out[8]["host"], out[8]["path"], out[8]["rule"]) == ("host.com", "/fr/", "com/fr/")
    assert verdicts[10] == verdicts[12] == verdicts[13] == ("allow", "default", None) and verdicts[11][2] == "com/de/"
    rules = urls.rule_table(spark, catalogue.RULES)
    assert urls.judge(pages, rules).count() == pages.count()
    assert urls.judge(pages.limit(0), rules, redirects.limit(0)).count() == 0
    assert urls.judge(pages, rules.limit(0)).where("verdict = 'block'").count() == 0


LINKS = [
    ("http://h.net/a/b?q", "https://X.com/p?z#f", "x.com/p?z"),
    ("http://h.net/a/b?q", "//y.com", "y.com/"),
    ("http://h.net/a/b?q", "/c/./d/../e?r=1&amp;s=2#t", "h.net/c/e?r=1&s=2"),
    ("http://h.net/a/b?q", "c", "h.net/a/c"),
    ("http://h.net/a/b?q", "../../../c/..", "h.net/"),
    ("http://h.net/a/b?q", "?x=://no.net/", "h.net/a/b?x=://no.net/"),
    ("http://H.net", "c/", "h.net/c/"),
    ("http://h.net?q", "?x", "h.net/?x"),
    ("http://h.net/a/", "c", "h.net/a/c"),
    ("http://h.net/a", "/go?to=http://evil.com/", "h.net/go?to=http://evil.com/"),
    ("http://h.net/a", "mailto:me@x.com", None),
    ("http://h.net/a", "#top", None),
    ("http://h.net/a", "", None),
    ("http://h.net/a", None, None),
    ("no address", "c", None),
    (None, "/c", None),
    (None, "http://x.com/", "x.com/"),
]


def test_link_targets(frame):
    rows = frame([(i, u, t) for i, (u, t, _) in enumerate(LINKS)], "i long, url string, link string")
    out = rows.select("i", urls.target_of(F.col("link"), F.col("url")).alias("node")).orderBy("i").collect()
    assert [r["node"] for r in out] == [node for _, _, node in LINKS]


def test_relative_links_are_aliases(spark, frame):
    pages = frame(
        [
            (1, "http://bad.example.com/de/x", ""),
            (2, "http://m.net/a/b", '<link rel="canonical" href="../old?a=1&amp;b=2">'),
            (3, "http://m.net/old?a=1&b=2", '<meta http-equiv="refresh" content="0; url=//bad.example.com/de/x">'),
            (4, "http://m.net/other", '<link rel=canonical href="/free">'),
        ],
        "page_id long, url string, html string",
    )
    out = {r["page_id"]: (r["verdict"], r["by"]) for r in urls.judge(pages, urls.rule_table(spark, catalogue.RULES)).collect()}
    assert out == {1: ("block", "rule"), 2: ("block", "alias"), 3: ("block", "alias"), 4: ("allow", "default")}


def test_url_rules_longest_and_allow_first(spark, frame):
    pages = frame([(1, "http://a.b.c/x/y", "")], "page_id long, url string, html string")
    judged = lambda rules: urls.judge(pages, urls.rule_table(spark, rules)).first()
    assert judged([("block", "c", "/"), ("allow", "b.c", "/")])["rule"] == "b.c/"
    assert judged([("block", "b.c", "/x"), ("allow", "b.c", "/x")])["verdict"] == "allow"
    assert judged([("block", "B.C", "/x/y"), ("allow", "a.b.c", "/"), ("allow", "z.a.b.c", "/x/y")])["verdict"] == "block"
    assert judged([("block", None, "/"), ("odd", "c", "/")])["by"] == "default"


# neighbours


def test_probe_order():
    sets = ann.probe_sets(3, 27)
    assert sets[0] == () and sets[1] == (0,) and len(sets) == len(set(sets)) == 27  # each line: below, here, above
    m = 3
    e = [j * (j + 1) / (4 * (m + 1) * (m + 2)) if j <= m else 1 - (7 - j) / (m + 1) + (7 - j) * (8 - j) / (4 * (m + 1) * (m + 2)) for j in range(1, 7)]
    scores = [sum(e[r] for r in s) for s in sets]
    assert scores == sorted(scores)


def test_neighbours(frame, monkeypatch):
    draw = np.random.default_rng(3)
    vectors = draw.normal(size=(900, 16))
    vectors[100:400] = vectors[100]  # a third of all rows are one vector
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(vectors)]
    odd = [(1000, None, 1), (1100, [0.0] * 16, 1), (1200, [1.0] * 15 + [None], 1), (1300, [float("nan")] * 16, 1), (1400, [float("inf")] * 16, 1), (1500, [1.0], 1), (1600, [], 1)]
    more = [(100, rows[100][1], 1), (None, rows[5][1], 1)]
    df = frame(rows + odd + more, "vec_id long, embedding array<double>, rank int")
    monkeypatch.setattr(ann, "BLOCK", 300)
    out = ann.nearest(df, F.col("vec_id") % 50 == 0)
    got = {}
    for r in out.collect():
        got.setdefault((r["query_id"], r["query_row"]), []).append((r["rank"], r["vec_id"], r["score"]))
    whole = [(i, np.array(v)) for i, v, _ in rows + more]
    hits = []
    assert len(got) == 19  # 18 ids, one of them twice
    for (query, _), found in got.items():
        q = next(v for i, v in whole if i == query)
        others = [(np.sqrt(((v - q) ** 2).sum()), i if i is not None else 1 << 62) for i, v in whole]
        others.remove((0.0, query))
        found.sort()
        assert [f[0] for f in found] == list(range(1, 11))
        assert [(s, i if i is not None else 1 << 62) for _, i, s in found] == sorted((s, i if i is not None else 1 << 62) for _, i, s in found)
        best = sorted(others)[:10]
        hits.append(len({s for s, _ in best} & {s for _, _, s in found}) / len({s for s, _ in best}))
        if query == 150:
            assert [i for _, i, _ in found] == [100, 100, *range(101, 109)]
    assert np.mean(hits) >= 0.9
    assert ann.nearest(df.limit(0), F.lit(True)).count() == 0
    few = ann.nearest(df.where("vec_id IN (1, 2, 3)"), F.col("vec_id") == 1).collect()
    assert len(few) <= 2


def test_neighbours_of_far_queries(frame, monkeypatch):
    """Every query gets min(k, candidates) rows, and near ones, however far it is from most rows."""
    draw = np.random.default_rng(11)
    vectors = draw.normal(size=(1500, 64))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    queries = list(range(0, 1500, 100))
    for i, q in enumerate(queries):
        vectors[q] *= (1, 1.5, 3, 5, 10)[i % 5]
    vectors[1400] *= 1e6
    monkeypatch.setattr(ann, "BLOCK", 600)
    df = frame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    hits = []
    for q in queries:
        assert len(got[q]) == 10
        d = np.sqrt(((vectors - vectors[q]) ** 2).sum(axis=1))
        hits.append(len(set(got[q]) & set([i for i in np.argsort(d, kind="stable") if i != q][:10])) / 10)
    assert np.mean(hits) >= 0.9
    few = ann.nearest(df.where("vec_id IN (0, 1, 2, 3, 300)"), F.col("vec_id") % 100 == 0).groupBy("query_id").count().collect()
    assert {tuple(r) for r in few} == {(0, 4), (300, 4)}


def test_neighbour_recall(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float64)
    got = {}
    for r in catalogue.op1_multiprobe_ann(spark, SF).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    recall = []
    for q in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((vectors - vectors[q]) ** 2).sum(axis=1))
        best = [i for i in np.lexsort((ids, d)) if i != q][:10]
        recall.append(len(got[ids[q]] & set(ids[best])) / 10)
    assert np.mean(recall) >= 0.9


# pipeline


def test_pipeline_stages(spark, frame):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    copies = docs.limit(5)
    odd = frame([(10**6, None, None, None, 0), (10**6 + 1, "", "en", "s", 0), (10**6 + 2, "123 %%", "en", "s", 0), (None, "no id at all", "en", None, None)], docs.schema)
    table = docs.unionByName(copies).unionByName(odd).withColumn("row", F.lit(1)).withColumn("found", F.lit("x"))
    names = table.columns
    before = {r["doc_id"] for r in docs.select("doc_id").collect()}
    one = corpus_pipeline.language_id(spark, table, SF)
    assert one.columns == names
    kept = one.collect()
    model = langid.Classifier(langid.fit(table))
    texts = [r["text"] for r in table.collect()]
    assert len(kept) == sum(not rejected for _, _, rejected in model.judge(texts))
    assert {r["doc_id"] for r in kept} >= before  # clean documents stay
    assert not {10**6, 10**6 + 1, 10**6 + 2} & {r["doc_id"] for r in kept}
    two = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(kept, table.schema), SF)
    assert two.columns == names
    by_print, prints = brute_near([(r["doc_id"], r["text"]) for r in kept])
    least = {}
    for fp, ids in prints.items():
        for i in ids:
            least.setdefault(by_print[fp], set()).add(i)
    expected = sorted(min(x for x in s if x is not None) if s != {None} else -1 for s in least.values())
    rows = two.collect()
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in rows) == expected
    three = corpus_pipeline.decontamination(spark, spark.createDataFrame(rows, table.schema), SF)
    assert three.columns == names
    bad = {r[0] for r in brute_contamination([(r["doc_id"], r["text"]) for r in rows], [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]) if r[4]}
    assert sorted(str(r["doc_id"]) for r in three.collect()) == sorted(str(r["doc_id"]) for r in rows if r["doc_id"] not in bad)
    four = corpus_pipeline.encoding(spark, three, SF)
    assert four.where("NOT round_trip").count() == 0
    model = pieces.Encoder(pieces.load_model(catalogue.tokenizer_path("piece")))
    text = {r["doc_id"]: r["text"] for r in rows}
    assert all(r["n_tokens"] == len(model.encode(text[r["doc_id"]])) // 4 + 1 for r in four.collect())


def test_pipeline_run(spark):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "near_duplicates", "decontamination", "encoding"]
    rows = corpus_pipeline.run(spark, SF).collect()
    assert 0 < len(rows) < spark.read.parquet(f"{SF}/documents.parquet").count() and all(r["round_trip"] for r in rows)


def test_pipeline_of_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_pipeline_encodes_in_one_call(spark, frame):
    """Two Python calls in a row keep twice as many workers with vocabularies."""
    texts = [None, "", "Plain words", "a▁b  c ", "日本語 \x00 é", "▁▁"]
    docs = frame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], spark.read.parquet(f"{SF}/documents.parquet").schema)
    out = corpus_pipeline.encoding(spark, docs, SF)
    assert out._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    model = pieces.load_model(catalogue.tokenizer_path("piece"))
    ids = docs.select("doc_id", "text", pieces.encode("text", model).alias("ids"))
    plain = {r["doc_id"]: r for r in ids.select("*", pieces.decode("ids", model).alias("back")).collect()}
    for r in out.collect():
        p = plain[r["doc_id"]]
        assert r["ids"] == p["ids"] and r["n_tokens"] == len(p["ids"]) and r["lang"] == "en" and r["source"] == "s"
        assert r["round_trip"] == (p["back"] == (p["text"] or "").replace("▁", " "))
