"""Clustering that takes one task for a unit, or one order for a line, instead of rounds over all rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wearcurve.layout import CONTIGUOUS as C
from wearcurve.operators import clustering, linkage


@pytest.fixture(scope="module")
def units(spark):
    rows = spark.range(240).select((F.col("id") % 4).cast("int").alias("unit_number"), (F.floor(F.col("id") / 4) + 1).cast("int").alias("time_cycles"), "id")
    noise = lambda salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(1000)) / 10
    return rows.withColumns({"x": F.floor(F.col("time_cycles") / 15) * 40 + noise(1), "y": noise(2)}).drop("id").localCheckpoint()


def labels(df):
    return {(r["unit_number"], r["time_cycles"]): r["cluster"] for r in df.collect()}


@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "cosine"])
def test_centroids_of_short_units_need_no_rounds_over_all_rows(units, metric, monkeypatch):
    with monkeypatch.context() as m:
        m.setattr(clustering, "CENTROID_ROWS", 0)
        rounds = labels(clustering.cluster_units(units, ["x", "y"], C, 4, metric=metric, method="centroid"))

    def fail(*_):
        raise AssertionError("a round over all rows")

    monkeypatch.setattr(clustering, "_to_nearest", fail)
    assert labels(clustering.cluster_units(units, ["x", "y"], C, 4, metric=metric, method="centroid")) == rounds


def test_units_with_nulls_keep_their_rounds(units):
    some = units.withColumn("y", F.when((F.col("unit_number") != 1) | (F.col("time_cycles") > 3), F.col("y")))
    found = labels(clustering.cluster_units(some, ["x", "y"], C, 4, method="centroid"))
    plain = labels(clustering.cluster_units(units, ["x", "y"], C, 4, method="centroid"))
    assert len(found) == 240 and all(found[k] == plain[k] for k in found if k[0] != 1)


def test_empty_cluster_starts_at_the_farthest_row():
    x = np.array([[0.0], [0.0], [0.0], [1.0], [9.0], [10.0]])
    found = clustering.unit_centroids(x, np.array([0, 0, 1, 1, 2, 2]), 3, "euclidean", 1e-9)
    assert len(set(found.tolist())) == 3
    same = clustering.unit_centroids(np.zeros((6, 1)), np.arange(6) % 3, 3, "euclidean", 1e-9)
    assert set(same.tolist()) == {0}


def test_ward_labels_are_those_of_single_merges():
    rng, found = np.random.default_rng(3), 0
    for i in range(60):
        x = rng.normal(size=(rng.integers(6, 60), 3)) if i % 3 else rng.integers(0, 5, (30, 2)).astype(float)
        got = clustering.ward_labels(x, 5, "euclidean")
        if got is not None:
            found += 1
            assert got.tolist() == clustering.agglomerate(x, 5, "ward", "euclidean")[0].tolist()
    assert found >= 40


def test_equal_links_are_left_to_single_merges():
    assert clustering.ward_labels(np.arange(12.0)[:, None], 5, "euclidean") is None


def test_single_links_on_a_line_need_no_tree(spark, monkeypatch):
    values = spark.range(4000).select((F.col("id") % 2).cast("int").alias("unit"), "id", F.array((F.pmod(F.xxhash64("id"), F.lit(100_000)) / 10)).alias("_x"))
    values = values.localCheckpoint()
    with monkeypatch.context() as m:
        m.setattr(linkage, "_on_a_line", lambda *_: False)
        by_tree = sorted(map(tuple, linkage.long_clusters(values, ["unit"], 5, "single", "euclidean").collect()))

    def fail(*_):
        raise AssertionError("a spanning tree")

    monkeypatch.setattr(linkage, "spanning_tree", fail)
    assert sorted(map(tuple, linkage.long_clusters(values, ["unit"], 5, "single", "euclidean").collect())) == by_tree


def test_equal_gaps_on_a_line_are_cut_like_trees(spark, monkeypatch):
    values = spark.range(60).select(F.lit(0).alias("unit"), F.col("id"), F.array((F.col("id") * 7 % 20).cast("double")).alias("_x")).localCheckpoint()
    line = sorted(map(tuple, linkage.long_clusters(values, ["unit"], 5, "single", "euclidean").collect()))
    monkeypatch.setattr(linkage, "_on_a_line", lambda *_: False)
    assert line == sorted(map(tuple, linkage.long_clusters(values, ["unit"], 5, "single", "euclidean").collect()))
    assert len({c for _, _, c in line}) == 5


def test_bottom_up_takes_nulls_as_not_a_number(units):
    some = units.withColumn("y", F.when((F.col("unit_number") != 1) | (F.col("time_cycles") > 3), F.col("y")))
    found, plain = labels(clustering.cluster_units(some, ["x", "y"], C, 4)), labels(clustering.cluster_units(units, ["x", "y"], C, 4))
    assert len(found) == 240 and all(found[k] == plain[k] for k in found if k[0] != 1)
