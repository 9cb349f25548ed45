"""Clustering, over-sampling and models against brute force or their own guarantees."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wearcurve import CONTIGUOUS as C
from wearcurve.operators import balance, clustering, metrics, models, risk, selection, splits
from wearcurve.plans import phases
from wearcurve.plans.staged import Tables
from wearcurve.sources import tables as tb

S = ["sensor_1", "sensor_2"]
X = ["time_cycles", *S]


@pytest.fixture(scope="module")
def labelled(spark):
    return Tables(spark, "/root/testdata/sf0.001").labelled


def brute_force(x, k, linkage, metric):
    d = clustering.pair_distances(x, x, metric)
    groups = {i: [i] for i in range(len(x))}
    heights = []
    while len(groups) > k:
        best = None
        names = list(groups)
        for i, a in enumerate(names):
            for b in names[i + 1 :]:
                cells = d[np.ix_(groups[a], groups[b])]
                h = {
                    "single": cells.min(),
                    "complete": cells.max(),
                    "average": cells.mean(),
                    "ward": (cells**2).sum() / (len(groups[a]) + len(groups[b])),
                }[linkage]
                if best is None or h < best[0]:
                    best = (h, a, b)
        h, a, b = best
        groups[a] += groups.pop(b)
        heights.append((a, b, h))
    out = np.zeros(len(x), dtype=int)
    for label, members in enumerate(groups.values()):
        out[members] = label
    return out, heights


@pytest.mark.parametrize("linkage", clustering.LINKAGES)
@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "cosine"])
def test_merging_matches_brute_force(linkage, metric):
    rng = np.random.default_rng(5)
    for _ in range(4):
        x = rng.normal(size=(20, 3))
        got, merges = clustering.agglomerate(x, 4, linkage, metric)
        want, heights = brute_force(x, 4, linkage, metric)
        assert (got == want).all()
        assert [m[:2] for m in merges] == [h[:2] for h in heights]
        assert np.allclose([m[2] for m in merges], [h[2] for h in heights])


def test_centroids_keep_all_clusters_of_any_unit(labelled, spark):
    rows = clustering.cluster_units(labelled, X, C, method="centroid")
    per_unit = rows.groupBy("unit_number").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("cluster").alias("k")).collect()
    sizes = {r.unit_number: r.n for r in labelled.groupBy("unit_number").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert {r.unit_number: r.n for r in per_unit} == {u: n for u, n in sizes.items() if n >= 5}
    assert {r.k for r in per_unit} == {5}
    # few distinct values at the ends of life, so that stretches of life share them
    few = [(1, i, float(i % 3 if i < 90 else i % 7)) for i in range(1, 101)] + [(2, i, float(i)) for i in range(1, 6)]
    df = spark.createDataFrame(few, "unit_number int, time_cycles int, sensor_1 double")
    got = clustering.cluster_units(df, ["sensor_1"], C, method="centroid").groupBy("unit_number").agg(F.countDistinct("cluster")).collect()
    assert {tuple(r) for r in got} == {(1, 5), (2, 5)}


def test_units_of_any_length_take_the_same_way(spark):
    rows = spark.range(1, 8001).selectExpr("IF(id <= 3000, 1, 2) unit_number", "CAST(IF(id <= 3000, id, id - 3000) AS INT) time_cycles")
    df = rows.withColumn("sensor_1", F.floor(F.col("time_cycles") * 5 / F.when(F.col("unit_number") == 1, 3001).otherwise(5001)) * 100 + F.sin("time_cycles"))
    for method, linkage in (("agglomerate", "single"), ("centroid", "ward")):
        got = clustering.cluster_units(df, ["sensor_1"], C, linkage=linkage, method=method)
        steps = F.floor((F.col("sensor_1") + 50) / 100).cast("int")
        assert got.join(df, ["unit_number", "time_cycles"]).where(F.col("cluster") != steps).count() == 0
        assert got.count() == 8000
    with pytest.raises(ValueError, match="no linkage"):
        clustering.cluster_units(df, ["sensor_1"], C, linkage="single", method="centroid")
    with pytest.raises(Exception, match="too many to merge"):
        clustering.cluster_units(df, ["sensor_1"], C, linkage="average", max_rows=4000).count()


def test_quality_of_huge_cells(spark):
    conf = spark.createDataFrame([(0, 0, 4_000_000_000), (1, 1, 4_000_000_000)], "true int, pred int, n long")
    row = metrics.cluster_quality(conf).first()
    assert row.gini_index == 0 and row.purity == 1


def test_centroids_in_chunks(spark):
    centres = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(25)], "label int, centroid array<double>")
    rows = spark.createDataFrame([(0, [3.4, 1.0]), (1, [3.5, 0.0]), (2, [99.0, 0.0])], "id int, v array<double>")
    for chunk in (1000, 4):
        got = clustering.nearest_centroid(rows, "v", centres, "label", chunk=chunk).orderBy("id").collect()
        assert [r.nearest for r in got] == [3, 3, 24]


def test_ensemble_weights_are_chosen(spark):
    df = spark.createDataFrame([(1.0, 1.5, 2.0)], "y double, pred_a double, pred_b double")
    by = lambda w: {r.model: r.weight for r in models.ensemble_weights(df, "y", ["a", "b"], w).collect()}
    assert by("equal") == {"a": 0.5, "b": 0.5} and by({"a": 3, "b": 1}) == {"a": 0.75, "b": 0.25}
    assert by("inverse_mse")["a"] == pytest.approx(0.8)
    with pytest.raises(ValueError):
        by("other")


def test_merge_trees_reject_long_units(labelled):
    with pytest.raises(Exception, match="too many to merge"):
        clustering.dendrograms(labelled, X, C, max_rows=10).count()


def test_tiles_do_not_change_links(labelled):
    whole = clustering.pair_links(labelled, S, C, "cluster").orderBy("unit_number", "a", "b").collect()
    tiled = clustering.pair_links(labelled, S, C, "cluster", tile_rows=20).orderBy("unit_number", "a", "b").collect()
    for x, y in zip(whole, tiled, strict=True):
        assert list(x) == pytest.approx(list(y))


def test_neighbours_are_exact_for_any_tiling(labelled):
    rows = labelled.select((F.col("unit_number") * 1000 + F.col("time_cycles")).alias("k"), F.lit(1).alias("y"), F.array(*S).alias("x"))
    data = {r.k: np.array(r.x) for r in rows.collect()}
    keys = np.array(sorted(data))
    points = np.array([data[k] for k in keys])
    got = {r.k: r.neighbours for r in balance.near_neighbours(rows, "x", "y", "k", 5, tile_rows=150).collect()}
    for i in range(0, len(keys), 37):
        d = ((points - points[i]) ** 2).sum(axis=1)
        d[i] = np.inf
        assert got[keys[i]] == keys[np.lexsort((keys, d))[:5]].tolist()


def test_oversampling_balances_and_interpolates(spark):
    rows = [(i, 0, [float(i), 0.0]) for i in range(30)] + [(100 + i, 1, [float(i), float(i * i)]) for i in range(7)] + [(200, 2, [5.0, 5.0])]
    df = spark.createDataFrame(rows, "k long, y int, x array<double>")
    out = balance.oversample(df, "x", "y", "k").collect()
    assert {y: sum(r.y == y for r in out) for y in (0, 1, 2)} == {0: 30, 1: 30, 2: 30}
    given = {k: np.array(x) for k, _, x in rows}
    for r in out:
        a = given[r.k]
        if r.copy == 0:
            assert r.x == a.tolist()
            continue
        b = given[r.near]
        along, reach = np.array(r.x) - a, b - a
        assert abs(along[0] * reach[1] - along[1] * reach[0]) < 1e-9
        assert np.linalg.norm(along) <= np.linalg.norm(reach) + 1e-9
    assert {r.near for r in out if r.y == 2 and r.copy > 0} == {200}


def test_ridge_is_the_closed_form(labelled):
    fitted = models.ridge_model(labelled, X, "time_to_next_stage", 3.0).stages[-1]
    rows = labelled.select(*X, "time_to_next_stage").toPandas().to_numpy()
    a = np.c_[np.ones(len(rows)), rows[:, :-1]]
    penalty = 3.0 * np.eye(a.shape[1])
    penalty[0, 0] = 0
    want = np.linalg.solve(a.T @ a + penalty, a.T @ rows[:, -1])
    assert [fitted.intercept, *fitted.coefficients] == pytest.approx(want.tolist(), rel=1e-7)


def test_quantile_coverage_and_loss(labelled):
    # a target almost without ties: among many equal values the coverage of a quantile is not defined
    rows = labelled.withColumn("y", F.col("time_to_next_stage") + F.col("sensor_1") / 10 + F.col("RUL") / 7)
    for q in (0.1, 0.5, 0.9):
        fitted = models.fit_quantile(rows, X, "y", q, 0.0)
        got = models.pinball(fitted.predict(rows, "_p"), "y", "_p", q).first()
        constant = rows.selectExpr(f"percentile(y, {q})").first()[0]
        flat = models.pinball(rows.withColumn("_p", F.lit(constant)), "y", "_p", q).first()
        assert got.coverage == pytest.approx(q, abs=0.02)
        assert got.loss < flat.loss


def test_quantile_with_ties_is_no_worse_than_the_constant(labelled):
    fitted = models.fit_quantile(labelled, X, "time_to_next_stage", 0.1, 0.0)
    got = models.pinball(fitted.predict(labelled, "_p"), "time_to_next_stage", "_p", 0.1).first()
    constant = labelled.selectExpr("percentile(time_to_next_stage, 0.1)").first()[0]
    flat = models.pinball(labelled.withColumn("_p", F.lit(constant)), "time_to_next_stage", "_p", 0.1).first()
    assert got.loss <= flat.loss + 1e-9


def test_interval_never_crosses(labelled):
    out = models.fit_interval(labelled, X, "time_to_next_stage")(labelled)
    assert out.where("lower_bound > upper_bound").count() == 0


def test_ensemble(spark, labelled):
    ridge = models.fit_ridge(labelled, X, "time_to_next_stage")
    forest = models.fit_forest(labelled, X, "time_to_next_stage", trees=5, depth=4)
    ensemble = models.Ensemble([ridge, forest]).fit(labelled, "time_to_next_stage")
    weights = {r.model: r.weight for r in ensemble.weights.collect()}
    assert sum(weights.values()) == pytest.approx(1) and weights["RandomForest"] > weights["Ridge"]
    out = ensemble.predict(labelled, "_p").first()
    assert out._p == pytest.approx(sum(weights[m] * out[f"pred_{m}"] for m in weights))
    few = labelled.limit(50)
    equal = models.Ensemble([ridge, forest]).fit(few, "time_to_next_stage", weights="equal")
    assert {r.weight for r in equal.weights.collect()} == {0.5}
    with pytest.raises(ValueError):
        models.Ensemble([]).fit(labelled, "time_to_next_stage")
    with pytest.raises(ValueError):
        models.Ensemble([ridge]).predict(labelled)


def test_importance_sums_to_one(labelled):
    for kind, how in (("random_forest", "splits"), ("random_forest", "impurity"), ("logistic_regression", "impurity")):
        model = models.fit_classifier(labelled, X, "true_stage", kind, {"n_estimators": 5, "max_depth": 4, "max_iter": 20})
        got = models.feature_importance(model, X, how).collect()
        assert {r.feature for r in got} == set(X)
        assert sum(r.importance for r in got) == pytest.approx(1)


def test_search_resumes(spark, labelled):
    rows = splits.stratified_split(labelled, "true_stage", ["unit_number", "time_cycles"]).cache()
    train, held = rows.where("part = 'train'"), rows.where("part = 'validation'")
    store = tb.scratch_path(spark, "search")
    one = {"n_estimators": 2, "max_depth": 2}
    args = (X, "true_stage", ["unit_number", "time_cycles"], store)
    models.search_classifier(train, held, *args, candidates=[one])
    both = models.search_classifier(train, held, *args, candidates=[one, {"n_estimators": 3, "max_depth": 5}])
    assert both.count() == 2 and tb.read_scores(spark, store).count() == 2
    assert set(models.best_params(both)) == {"n_estimators", "max_depth"}


def test_presets_and_candidates():
    assert models.preset("random_forest", "FD002") == {"n_estimators": 100, "max_depth": 20, "min_samples_split": 10}
    with pytest.raises(ValueError):
        models.preset("svm", 1)
    found = models.search_candidates(n=10)
    assert len({tb.params_key(c) for c in found}) == 10


def test_scores_reject_unknown_methods(labelled):
    with pytest.raises(ValueError):
        selection.important_features(labelled, "RUL", "other")
    with pytest.raises(ValueError):
        selection.select_k_best(labelled, S, "true_stage", 2, "other")
    with pytest.raises(ValueError):
        selection.correlations(labelled, S, "missing")


def test_stages_cover_the_sampled_rows(labelled):
    staged = phases.derive_stages(labelled.select("unit_number", "time_cycles", "setting_1", *S, "RUL"), C)
    rows = staged.rows.groupBy("unit_number").agg(F.countDistinct("degradation_stage").alias("k"))
    assert {r.k for r in rows.collect()} == {5}
    assert staged.profiles.count() == 5
    scores = phases.evaluate_stages(staged.rows, C.but(contiguous=False))
    assert scores.where("accuracy BETWEEN 0 AND 1 AND purity > 0").count() == 15
    assert set(metrics.QUALITY) < set(scores.columns)


def test_run_of_all_phases(spark, tmp_path, labelled):
    from pyspark.ml import PipelineModel

    from wearcurve.plans.catalogue_series import _as_lines, _wide

    wide = _wide(Tables(spark, "/root/testdata/sf0.001").series)
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    units = wide.select("unit_number").distinct().count()
    for dataset in ("FD001", "FD003"):
        for split in ("train", "test"):
            _as_lines(wide).write.text(f"{root}/{split}/{split}_{dataset}.txt")
        spark.createDataFrame([("20 ",)] * units, "value string").coalesce(1).write.text(f"{root}/RUL/RUL_{dataset}.txt")
    small = {"params": {"n_estimators": 3, "max_depth": 4}, "top_k": 8}
    quick = {"trees": 3, "boosting_rounds": 2}
    runs, compared = phases.run_datasets(spark, root, class_options=small, time_options=quick, output_dir=out)
    assert {r.dataset_id for r in compared.collect()} == {"FD001", "FD003"}
    first = runs["FD001"]
    assert list(runs) == ["FD001", "FD003"] and all(f"dataset_id={d}" in p for d, r in runs.items() for p in r.saved.values())
    with pytest.raises(FileNotFoundError, match="FD002"):
        phases.run_datasets(spark, root, ["FD002", "FD001"], phase=1, at_once=1)
    assert {"unit_metrics", "fold_metrics", "average_metrics", "class_confusion", "feature_importance", "regression_stage_metrics", "model_rmse", "risk_thresholds", "stage_model"} <= set(first.saved)
    assert first.stages.rows.count() == wide.count()  # no row is left out
    # the saved model takes rows as they are
    raw = phases.classification_features(spark.read.parquet(first.saved["degradation_stages"]), C.but(contiguous=False))
    got = models.classify(PipelineModel.load(first.saved["stage_model"]), raw, "again")
    test = spark.read.parquet(first.saved["test_with_preds"]).select("unit_number", "time_cycles", "predicted_stage")
    both = got.join(test, ["unit_number", "time_cycles"])
    assert both.count() == test.count() and both.where("again != predicted_stage").count() == 0
    # one phase alone from the tables of the run before
    again = phases.run(spark, root, "FD001", phase=4, output_dir=out, resume=True, risk_method="calibrated_minmax", risk_options={"thresholds": {"high": 0.9}})
    assert again.stages is None and again.risk.thresholds.first().high == 0.9
    assert {"time_model", "train_labels", "test_labels"} <= set(first.saved)
    # new rows are scored by the saved models: the test units again, as they came
    wanted = spark.read.parquet(first.saved["test_predictions"]).select("unit_number", "time_cycles", F.col(risk.TIME).alias("_was"))
    fresh = spark.read.parquet(first.saved["degradation_stages"]).join(wanted.select("unit_number").distinct(), "unit_number", "left_semi").drop("degradation_stage", "RUL")
    scored = phases.run(spark, root, "FD001", phase=4, output_dir=out, resume=True, new_rows=fresh).risk.rows
    both = scored.join(wanted, ["unit_number", "time_cycles"])
    assert both.count() == wanted.count() and both.where(F.abs(F.col(risk.TIME) - F.col("_was")) > 1e-6).count() == 0
    # the test split with the RUL file, and a logistic model with its preset
    other = phases.run(spark, root, "FD003", phase=2, subset="test", class_options={"model_type": "logistic_regression", "top_k": 5})
    assert other.stages.rows.selectExpr("min(RUL)").first()[0] == 20
    assert other.classification.model.stages[-1].getMaxIter() == 1000
