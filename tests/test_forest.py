"""Forests grown from cells: the same rules as Spark ML's, whatever the order of rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wearcurve.operators import forest, models


@pytest.fixture(scope="module")
def rows(spark):
    wide = spark.range(3000).withColumns({"a": F.pmod(F.xxhash64("id"), F.lit(50)).cast("double"), "b": F.pmod(F.hash("id"), F.lit(7)).cast("double")})
    return wide.withColumns({"y": (F.col("a") > 20).cast("int") + (F.col("b") > 3).cast("int"), "z": F.col("a") * 2 + F.col("b")}).localCheckpoint()


def importances(df, **params):
    model = models.fit_classifier(df, ["a", "b"], "y", "random_forest", {"n_estimators": 5, "max_depth": 4, **params})
    return {kind: {r["feature"]: r["importance"] for r in models.feature_importance(model, ["a", "b"], kind).collect()} for kind in ("splits", "impurity")}


def test_search_counts_the_rows_once_for_all_settings(spark, rows, tmp_path, monkeypatch):
    counted = []
    count = forest.class_cells
    monkeypatch.setattr(forest, "class_cells", lambda *a, **k: counted.append(1) or count(*a, **k))
    scores = models.search_classifier(rows.where("id % 5 > 0"), rows.where("id % 5 = 0"), ["a", "b"], "y", ["id"], str(tmp_path / "scores"), models.search_candidates(n=4))
    assert counted == [1]
    assert all(r["score"] > 0.9 for r in scores.collect()) and scores.count() == 4


def test_forest_does_not_depend_on_the_order_of_rows(rows):
    # also the importances: splits and impurity
    first, second = importances(rows.repartition(7, "id")), importances(rows.repartition(2).orderBy(F.desc("id")))
    assert first == second
    assert sum(first["splits"].values()) == pytest.approx(1) and sum(first["impurity"].values()) == pytest.approx(1)


def test_cells_count_all_rows(rows):
    cells = forest.class_cells(rows, ["a", "b"], "y")
    assert cells.counts.sum() == 3000 and len(cells.thresholds[1]) == 6
    by_class = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    assert cells.counts.sum(axis=0).tolist() == [by_class[k] for k in range(3)]


def test_too_many_cells_are_left_to_spark(rows, monkeypatch):
    monkeypatch.setattr(forest, "MOST_CELLS", 10)
    assert forest.class_cells(rows, ["a", "b"], "y") is None
    model = models.fit_classifier(rows, ["a", "b"], "y", "random_forest", {"n_estimators": 2, "max_depth": 2})
    assert model.transform(rows).where("prediction = y").count() > 1500


def test_null_fails(spark, rows):
    with pytest.raises(Exception, match="null"):
        importances(rows.withColumn("a", F.when(F.col("id") > 5, F.col("a"))))


def _rules(**changes):
    return forest._Rules(**{"impurity": "entropy", "depth": 1, "least": 1, "subset": 1, "gain": 0.0, **changes})


def test_tree_takes_the_best_split():
    bins, thresholds = np.arange(4)[:, None], [np.array([0.5, 1.5, 2.5])]
    stats = np.array([[5.0, 0.0], [6.0, 0.0], [0.0, 2.0], [0.0, 2.0]])
    root, left, right = forest.grow_tree(stats, stats.sum(axis=1), bins, thresholds, _rules(), np.random.default_rng(0))
    assert (root["threshold"], root["leftChild"], root["rightChild"]) == (1.5, 1, 2)
    assert left["impurityStats"] == [11, 0] and right["impurityStats"] == [0, 4] and right["prediction"] == 1
    # no split leaves five rows of the second class; of the others both leaves say the same and become one
    assert len(forest.grow_tree(stats, stats.sum(axis=1), bins, thresholds, _rules(least=5), np.random.default_rng(0))) == 1
    # leaves of one prediction become one
    flat = np.array([[5.0, 1.0], [6.0, 0.0], [6.0, 0.0], [6.0, 2.0]])
    assert len(forest.grow_tree(flat, flat.sum(axis=1), bins, thresholds, _rules(), np.random.default_rng(0))) == 1


def test_deep_tree_has_every_cell_in_one_leaf():
    rng = np.random.default_rng(1)
    cells = np.arange(256)
    thresholds = [np.arange(15) + 0.5, np.arange(15) + 0.5]
    y = rng.integers(0, 100, 256).astype(float)
    stats = np.stack([np.ones(256), y, y * y], axis=1)
    nodes = forest.grow_tree(stats, stats[:, 0], forest._bins_of(cells, thresholds), thresholds, _rules(impurity="variance", depth=20, subset=2), rng)
    leaves = [n for n in nodes if n["leftChild"] < 0]
    assert sum(n["rawCount"] for n in leaves) == 256
    assert sum(n["prediction"] * n["rawCount"] for n in leaves) == pytest.approx(y.sum())
    assert all(n["leftChild"] > i for i, n in enumerate(nodes) if n["leftChild"] >= 0)


def test_forest_of_numbers_is_grown_from_cells(rows, monkeypatch):
    grown = []
    grow = forest.grown_numbers
    monkeypatch.setattr(forest, "grown_numbers", lambda *a: grown.append(grow(*a)) or grown[-1])
    model = models.fit_forest(rows, ["a", "b"], "z", trees=10, depth=8)
    assert grown[0] is not None and grown[0].getNumTrees == 10
    error, spread = model.predict(rows, "p").agg(F.avg(F.pow(F.col("p") - F.col("z"), 2)), F.var_pop("z")).first()
    assert error < 0.02 * spread
