"""Operators on units, groups and classes of any size: tiles, spanning trees, many centroids, draws, windows, time models."""

import hashlib
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from wearcurve.layout import CONTIGUOUS as C
from wearcurve.layout import Layout
from wearcurve.operators import balance, clustering, features, linkage, models, splits, tiles, time_models
from wearcurve.plans.staged import Tables

SF = "/root/testdata/sf0.001"
KEY = ["unit_number", "time_cycles"]


@pytest.fixture(scope="module")
def labelled(spark):
    return Tables(spark, SF).labelled


# tiles


def test_tiles_are_small_and_compact(spark):
    draw = np.random.default_rng(1)
    x = draw.normal(size=(4000, 3)).round(1)
    x[:1500] = [0.5, 0.5, 0.5]  # more equal rows than a tile holds
    rows = spark.createDataFrame([(i, int(i % 7 == 0), x[i].tolist()) for i in range(4000)], "id long, g int, v array<double>")
    cut = tiles.space_tiles(rows, ["g"], "id", "v", 100)
    sizes = [r["count"] for r in cut.groupBy("g", "_tile").count().collect()]
    assert sum(sizes) == 4000 and max(sizes) <= 150 and len(sizes) < 120


# over-sampling


def brute_neighbours(x, k):
    out = []
    for i in range(len(x)):
        others = np.delete(np.arange(len(x)), i)
        d = np.zeros(len(others))
        for j in range(x.shape[1]):
            d += (x[others, j] - x[i, j]) ** 2
        out.append(others[np.lexsort((others, d))][:k].tolist())
    return out


def test_neighbours_in_crowds(spark):
    """A third of the rows is one vector, others repeat often: neighbours are the same as by brute force."""
    draw = np.random.default_rng(2)
    x = draw.normal(size=(900, 2)).round(1)
    x[:300] = [0.3, -0.2]
    rows = spark.createDataFrame([(i, 0, x[i].tolist()) for i in range(900)] + [(5000, 0, None), (5001, None, [0.0, 0.0])], "k long, y int, v array<double>")
    got = {r["k"]: r["neighbours"] for r in balance.near_neighbours(rows, "v", "y", "k", 5, 64).collect()}
    assert [got[i] for i in range(900)] == brute_neighbours(x, 5)
    assert 5000 not in got and 5001 not in got


def test_neighbours_ship_few_rows(spark):
    """Of 200,000 rows in 200 tiles only those near other tiles are shipped to them."""
    rows = spark.range(200_000).select(F.col("id").alias("_key"), F.lit(0).alias("g"), F.array(F.rand(1), F.rand(2)).alias("_x"))
    cut = tiles.space_tiles(rows, ["g"], "_key", "_x", 1000)
    # the fifth neighbour of uniform rows in the unit square is nearly always within this distance
    limited = cut.withColumn("_limit", F.lit(20.0 / 200_000))
    assert tiles.meetings(limited, ["g"], "_x", 2, "_limit").count() < 400_000


# bottom-up clustering


@pytest.mark.parametrize("link, metric, copies", [("single", "euclidean", False), ("single", "manhattan", True), ("ward", "euclidean", True)])
def test_long_units_cluster_like_short_ones(spark, monkeypatch, link, metric, copies):
    if metric == "manhattan":
        monkeypatch.setattr(linkage, "POINTERS", 0)  # pointers are followed by joins
    draw = np.random.default_rng(3)
    x = draw.normal(size=(700, 2)) + draw.integers(0, 6, (700, 1)) * 2
    if copies:
        x[draw.random(700) < 0.3] = x[0]
    rows = [(u, i + 1, x[i].tolist()) for u, n in ((1, 700), (2, 250)) for i in range(n)]
    df = spark.createDataFrame(rows, "unit_number int, id long, _x array<double>")
    found = linkage.long_clusters(df, ["unit_number"], 5, link, metric, 128, 150).collect()
    got = {(r["unit_number"], r["id"]): r["cluster"] for r in found}
    for u, n in ((1, 700), (2, 250)):
        labels, _ = clustering.agglomerate(x[:n], 5, link, metric)
        assert [got[u, i + 1] for i in range(n)] == labels.tolist()


def test_units_beyond_the_matrix_take_rounds(spark):
    rows = spark.range(1, 1301).selectExpr("IF(id <= 300, 1, 2) unit_number", "CAST(IF(id <= 300, id, id - 300) AS INT) time_cycles")
    df = rows.withColumn("sensor_1", F.floor(F.col("time_cycles") * 5 / F.when(F.col("unit_number") == 1, 301).otherwise(1001)) * 100 + F.sin("time_cycles"))
    for link in ("single", "ward"):
        got = clustering.cluster_units(df, ["sensor_1"], C, linkage=link, max_rows=400)
        steps = F.floor((F.col("sensor_1") + 50) / 100).cast("int")
        assert got.count() == 1300 and got.join(df, KEY).where(F.col("cluster") != steps).count() == 0
    with pytest.raises(Exception, match="too many to merge"):
        clustering.cluster_units(df, ["sensor_1"], C, linkage="complete", max_rows=400).count()


def test_chain_is_the_plain_merge():
    draw = np.random.default_rng(5)
    x = draw.normal(size=(60, 3))
    ids = np.arange(60)
    made = linkage.chain(ids, np.ones(60), x, np.zeros(60), np.zeros(60))
    _, plain = clustering.agglomerate(x, 1, "ward", "euclidean")
    assert sorted(round(m[2], 9) for m in made) == sorted(round(m[2], 9) for m in plain)


# many centroids


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_nearest_of_many_centroids(spark, metric):
    draw = np.random.default_rng(6)
    x, c = draw.normal(size=(1500, 2)).round(2), draw.normal(size=(2100, 2)).round(2)
    rows = spark.createDataFrame([(i, x[i].tolist()) for i in range(1500)] + [(9999, None)], "id int, v array<double>")
    centres = spark.createDataFrame([(i, c[i].tolist()) for i in range(2100)], "label int, centroid array<double>")
    got = {r["id"]: (r["nearest"], r["distance"]) for r in clustering.nearest_centroid(rows, "v", centres, "label", metric).collect()}
    assert got.pop(9999) == (None, None) and len(got) == 1500
    for i, (label, distance) in got.items():
        gaps = np.abs(c - x[i])
        d = gaps[:, 0] + gaps[:, 1] if metric == "manhattan" else gaps[:, 0] * gaps[:, 0] + gaps[:, 1] * gaps[:, 1]
        assert label == int(d.argmin())
        assert distance == pytest.approx(d.min() if metric == "manhattan" else d.min() ** 0.5)


# samples


def test_bootstrap_draws_exactly(spark, monkeypatch):
    monkeypatch.setattr(splits, "_LEAF_ROWS", 50)
    rows = [(i, float(i % 10) if i % 17 else None) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, w double")
    drawn = {r["id"]: r["draws"] for r in splits.weighted_bootstrap(df, "w", ["id"]).collect()}
    assert sum(drawn.values()) == 3000 and not any(i % 10 == 0 or i % 17 == 0 for i in drawn)
    # the same rows in another order and other partitions
    again = {r["id"]: r["draws"] for r in splits.weighted_bootstrap(df.orderBy(F.desc("id")).repartition(5), "w", ["id"]).collect()}
    assert again == drawn
    other = {r["id"]: r["draws"] for r in splits.weighted_bootstrap(df, "w", ["id"], seed=7, draws=100_000).collect()}
    assert sum(other.values()) == 100_000
    total = sum(w or 0 for _, w in rows)
    for digit in range(1, 10):
        share = sum(w or 0 for i, w in rows if i % 10 == digit) / total
        got = sum(n for i, n in other.items() if i % 10 == digit)
        assert abs(got - 100_000 * share) < 4 * (100_000 * share * (1 - share)) ** 0.5
    assert splits.weighted_bootstrap(df.withColumn("w", F.lit(0.0)), "w", ["id"]).count() == 0
    assert splits.weighted_bootstrap(df.limit(0), "w", ["id"]).count() == 0


def test_row_sample_is_the_smallest_hashes(spark, monkeypatch):
    monkeypatch.setattr(splits, "_BUCKET_ROWS", 3)
    df = spark.range(2000)
    order = sorted(range(2000), key=lambda i: hashlib.md5(f"{i}:42".encode()).hexdigest())
    for n in (1, 500, 1999, 2000, 5000):
        sample = splits.row_sample(df, n, ["id"])
        assert sorted(r["id"] for r in sample.collect()) == sorted(order[:n])
        assert "Limit" not in sample._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert splits.row_sample(df.limit(0), 5, ["id"]).count() == 0


# windows


def test_window_requests_in_one_pass(spark):
    draw = np.random.default_rng(8)
    rows = []
    for u, n in ((1, 400), (2, 1), (3, 35), (4, 3)):
        at = np.cumsum(draw.choice([1, 1, 2, 3, 200], n))
        rows += [(u, int(t), float(draw.normal(1000, 3)), None if draw.random() < 0.1 else float(draw.random()), 7) for t in at]
    df = spark.createDataFrame(rows, "unit_number int, time_cycles int, sensor_1 double, sensor_2 double, other int")
    layout, base = Layout(block_rows=32), ["sensor_1", "sensor_2"]
    requests = [features.Rolling(base, (5,), "{c}_roll_mean", "{c}_roll_std"), features.Rolling(base), features.Difference(base), features.Running(base)]
    one_by_one = features.add_running(features.add_rolling(features.add_short_rolling(df, base, layout), base, layout), base, layout)
    want = {(r["unit_number"], r["time_cycles"]): r.asDict() for r in one_by_one.collect()}
    found = features.add_windows(df, layout, requests)
    got = {(r["unit_number"], r["time_cycles"]): r.asDict() for r in found.collect()}
    assert want.keys() == got.keys() and set(one_by_one.columns) == set(found.columns)
    for key, row in want.items():
        for name, value in row.items():
            assert (got[key][name] is None) == (value is None)
            assert value is None or got[key][name] == pytest.approx(value, abs=1e-7), (key, name)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = features.add_windows(df, layout, requests)._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # one more writes the rows; what is read again is what was written
    assert plan.count("Exchange hashpartitioning") <= 3 and plan.count("Bucketed: true") == plan.count("FileScan") == 2


# time models


def test_time_models_are_saved_and_read(spark, labelled, tmp_path):
    target, columns = "time_to_next_stage", ["sensor_1", "sensor_2"]
    rows = labelled.select(*KEY, *columns, target)
    median = time_models.QuantileRegression(inputCols=columns, labelCol=target, quantile=0.5, regParam=0.0)
    interval = time_models.IntervalRegression(inputCols=columns, labelCol=target)
    median.write().overwrite().save(str(tmp_path / "estimator"))
    assert time_models.QuantileRegression.load(str(tmp_path / "estimator")).getOrDefault("quantile") == 0.5
    ridge = models.fit_ridge(rows, columns, target)
    boosted = models.fit_boosting(rows, columns, target, rounds=2)
    fitted = median.fit(rows)
    ensemble = time_models.weighted({"Ridge": ridge.model, "Quantile": fitted, "HistGradientBoosting": boosted.model}, rows, target)
    for name, model, kind in (("median", fitted, time_models.QuantileRegressionModel), ("interval", interval.fit(rows), time_models.IntervalRegressionModel), ("ensemble", ensemble, time_models.EnsembleRegressionModel)):
        path = str(tmp_path / name)
        model.write().overwrite().save(path)
        read = kind.load(path)
        first, second = (m.transform(rows).orderBy(*KEY).collect() for m in (model, read))
        assert first == second, name
    assert time_models.EnsembleRegressionModel.load(str(tmp_path / "ensemble")).getOrDefault("weights") == ensemble.getOrDefault("weights")


def test_settings_are_searched_at_once(spark, labelled):
    from wearcurve.sources import tables as tb

    rows = tb.materialize(splits.stratified_split(labelled, "true_stage", KEY), "search-parts")
    train, held = rows.where("part = 'train'"), rows.where("part = 'validation'")
    settings = [{"n_estimators": n, "max_depth": d} for n in (2, 3, 4) for d in (2, 3)]
    took, scores = {}, {}
    for at_once in (6, 1):
        begin = time.time()
        found = models.search_classifier(train, held, ["sensor_1", "sensor_2"], "true_stage", KEY, tb.scratch_path(spark, "at-once"), settings, at_once=at_once)
        scores[at_once] = {r["params"]: r["score"] for r in found.collect()}
        took[at_once] = time.time() - begin
    assert scores[6] == scores[1] and len(scores[1]) == 6


# links of clusters


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_extreme_links_skip_most_tiles(spark, metric):
    draw = np.random.default_rng(9)
    label = draw.integers(0, 3, 1500)
    x = draw.normal(size=(1500, 2)) + label[:, None] * 30
    rows = spark.createDataFrame([(u, i, int(label[i]), *x[i].tolist()) for u in (1, 2) for i in range(1500)], "unit_number int, time_cycles int, cluster int, sensor_1 double, sensor_2 double")
    columns = ["sensor_1", "sensor_2"]
    got = clustering.extreme_links(rows, columns, C, "cluster", metric, 50).collect()
    assert len(got) == 6
    for r in got:
        d = clustering.pair_distances(x[label == r["a"]], x[label == r["b"]], metric)
        assert r["single"] == pytest.approx(d.min()) and r["complete"] == pytest.approx(d.max())
    cut = tiles.space_tiles(rows.select("unit_number", F.col("cluster").alias("_cl"), F.col("time_cycles").alias("_id"), F.array(*columns).alias("_x")), ["unit_number", "_cl"], "_id", "_x", 50)
    needed, every = (clustering.extreme_pairs(cut, ["unit_number"], 2, metric, e).count() for e in (False, True))
    assert needed < every / 2
    with pytest.raises(ValueError):
        clustering.extreme_links(rows, columns, C, "cluster", "cosine")
