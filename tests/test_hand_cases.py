"""Small cases with answers worked out by hand."""

import math

import pytest
from conftest import column
from pyspark.sql import functions as F

from wearcurve import CONTIGUOUS as C
from wearcurve import Layout
from wearcurve.functions import features as fx
from wearcurve.functions import risk as rx
from wearcurve.operators import clustering, features, labels, metrics, preparation, risk, splits

KEY = ("unit_number", "time_cycles")
SERIES = "unit_number int, time_cycles int"


def test_train_rul(frame):
    df = frame([(1, 1), (1, 2), (1, 3), (2, 1), (2, 2)], SERIES)
    assert column(labels.train_rul(df, C), "RUL", *KEY) == [2, 1, 0, 1, 0]


def test_test_rul(frame):
    df = frame([(1, 1), (1, 2), (1, 3)], SERIES)
    known = frame([(1, 10)], "unit_number int, RUL int")
    assert column(labels.test_rul(df, known, C), "RUL", *KEY) == [12, 11, 10]


@pytest.mark.parametrize("stages", [3, None])
def test_time_to_next_stage(frame, stages):
    rows = [(1, c, s, 5 - c) for c, s in zip(range(1, 6), (0, 0, 1, 0, 2))]
    df = frame(rows, SERIES + ", predicted_stage int, RUL int")
    assert column(labels.time_to_next_stage(df, C, stages=stages), "time_to_next_stage", *KEY) == [2, 1, 2, 1, 0]


def test_rul_stages(frame):
    df = frame([(1, i, r) for i, r in enumerate((10, 8, 6, 5, 4, 2, 0), 1)] + [(2, 1, 7), (2, 2, 7)], SERIES + ", RUL int")
    assert column(labels.rul_stages(df, C), "true_stage", *KEY) == [0, 1, 2, 2, 3, 4, 4, 4, 4]


def test_differences_and_accelerations(frame):
    df = frame([(1, i, float(v)) for i, v in enumerate((1, 4, 9, 16), 1)], SERIES + ", sensor_1 double")
    out = features.add_accelerations(df, ["sensor_1"], C)
    assert column(out, "sensor_1_diff", *KEY) == [0, 3, 5, 7]
    assert column(out, "sensor_1_accel", *KEY) == [0, 3, 2, 2]
    again = features.add_accelerations(features.add_differences(df, ["sensor_1"], C), ["sensor_1"], C)
    assert column(again, "sensor_1_accel", *KEY) == [0, 3, 2, 2]


def test_rolling(frame):
    df = frame([(1, i, float(v)) for i, v in enumerate((1, 3, 5), 1)], SERIES + ", sensor_1 double")
    out = features.add_rolling(df, ["sensor_1"], C, (2,))
    assert column(out, "sensor_1_roll2_mean", *KEY) == [1, 2, 4]
    assert column(out, "sensor_1_roll2_std", *KEY) == pytest.approx([0, math.sqrt(2), math.sqrt(2)])


def test_crossovers_stay_inside_the_unit(frame):
    low_high = [(1, i, 10.0 - i) for i in range(1, 7)] + [(2, i, 100.0 + i) for i in range(1, 7)] + [(3, 1, 1.0), (3, 2, 9.0)]
    df = frame(low_high, SERIES + ", sensor_1 double")
    out = features.add_crossovers(df, ["sensor_1"], C, (2, 4))
    got = {(r.unit_number, r.time_cycles): r.sensor_1_cross_2_4 for r in out.collect()}
    assert got[2, 1] == 0
    assert got[3, 1] == got[3, 2] == 0  # shorter than the long window
    assert got[2, 3] == 1  # equal averages before, higher short average now


def test_rul_quartile_and_share(frame):
    df = frame([(1, i, 9 - i) for i in range(1, 9)], SERIES + ", RUL int")
    out = preparation.add_rul_features(df)
    assert column(out, "RUL_quartile", F.col("RUL")) == [0, 0, 1, 1, 2, 2, 3, 3]
    assert column(out, "normalized_RUL", F.col("RUL"))[-1] == 1.0


def test_class_weights(frame):
    df = frame([("a",)] * 6 + [("b",)] * 3 + [("c",)], "y string")
    got = {r.y: r.weight for r in metrics.class_weights(df, "y").collect()}
    assert got == pytest.approx({"a": 10 / 18, "b": 10 / 9, "c": 10 / 3})


def test_stage_order(frame):
    df = frame([(1, 1, 7), (1, 2, 7), (1, 9, 3), (1, 4, 5), (1, 5, 5)], SERIES + ", cluster int")
    got = {r.cluster: r.degradation_stage for r in clustering.order_stages(df, C).collect()}
    assert got == {7: 0, 5: 1, 3: 2}


def test_ward_link(frame):
    df = frame([(1, 1, 0.0, 0), (1, 2, 3.0, 1), (1, 3, 4.0, 1)], SERIES + ", sensor_1 double, cluster int")
    got = clustering.ward_links(df, ["sensor_1"], ["unit_number"], "cluster").collect()
    assert [r.link for r in got] == pytest.approx([25 / 3])
    tiles = clustering.pair_links(df, ["sensor_1"], C, "cluster", tile_rows=1).collect()
    assert [(r.single, r.complete, r.average, r.ward) for r in tiles] == [pytest.approx((3, 4, 3.5, 25 / 3))]


def test_cluster_quality(frame):
    df = frame([("x", 0), ("x", 0), ("x", 1), ("x", 1), ("y", 1), ("y", 1)], "c string, s int")
    df = df.withColumn("c", F.when(F.col("c") == "x", 0).otherwise(1))
    got = metrics.cluster_quality(metrics.confusion(df, "s", "c")).first().asDict()
    want = {"gini_index": 1 / 3, "entropy": 2 / 3, "purity": 4 / 6, "inverse_purity": 4 / 6, "f_measure": 2 / 3}
    assert got == pytest.approx(want)


def test_regression_metrics(frame):
    df = frame([(0.0, 1.0), (2.0, 2.0), (4.0, 2.0)], "y double, p double")
    got = metrics.regression_metrics(df, "y", "p").first()
    assert (got.mse, got.mae, got.r2, got.mape) == pytest.approx((5 / 3, 1, 1 - 5 / 8, 25))
    flat = frame([(2.0, 1.0), (2.0, 3.0)], "y double, p double")
    assert metrics.regression_metrics(flat, "y", "p").first().r2 == 0


def value(spark, expr):
    return spark.range(1).select(expr.alias("v")).first().v


def test_failure_probability(spark):
    got = [value(spark, rx.failure_probability(F.lit(s))) for s in range(5)]
    assert got == pytest.approx([0, 0.1625, 0.45, 0.8625, 1])


def test_times_to_failure(spark):
    cases = {(0, 10.0): 34, (2, 10.0): 18, (3, 10.0): 10, (4, 10.0): 0, (1, -5.0): 0}
    for (s, t), want in cases.items():
        assert value(spark, rx.time_to_failure(F.lit(s), F.lit(t))) == pytest.approx(want)
    for (s, t), want in {(0, 10.0): 100, (3, 10.0): 10, (4, 10.0): 0}.items():
        assert value(spark, rx.time_to_failure_fixed(F.lit(s), F.lit(t))) == want
    assert value(spark, rx.time_to_failure(F.lit(3), F.lit(float("nan")))) == 0


def test_row_scores(spark):
    assert value(spark, rx.horizon_risk(F.lit(0.5), F.lit(0.0))) == 50
    assert value(spark, rx.horizon_risk(F.lit(0.5), F.lit(50.0))) == 1


def test_calibrated_minmax(frame):
    df = frame([(1, 30, 2, -20.0)], SERIES + ", predicted_stage int, predicted_time_to_next_stage double")
    got = risk.calibrate_risk(df).first()
    # probability 0.5, 30 cycles for the one further stage, horizon 100
    assert (got.time_to_failure, got.raw_risk_score, got.normalized_risk_score) == pytest.approx((30, 35, 0.35))
    with pytest.raises(ValueError, match="unknown method"):
        risk.calibrate_risk(df, "other")


def test_risk_levels(frame):
    df = frame([(0.6,), (0.3,), (0.1,), (0.05,), (-1.0,)], "normalized_urgency double")
    out = risk.assign_levels(df, risk.fixed_thresholds(df))
    got = {r.normalized_urgency: r.risk_level for r in out.collect()}
    assert [got[v] for v in (0.6, 0.3, 0.1, 0.05, 0.0)] == ["HIGH", "MEDIUM", "LOW", "NEGLIGIBLE", "NEGLIGIBLE"]


def test_equal_scores_keep_default_thresholds(frame):
    df = frame([(0.4,)] * 5, "normalized_urgency double")
    got = risk.dynamic_thresholds(df, "normalized_urgency").first()
    assert tuple(got) == (0.6, 0.3, 0.1)


def test_best_threshold(frame):
    df = frame([(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1)], "s double, y int")
    got = risk.best_threshold(df, "s", F.col("y") == 1).first()
    assert (got.high, got.medium, got.low) == pytest.approx((0.35, 0.21, 0.105))


def test_min_max_and_ratio(spark):
    assert value(spark, fx.min_max(F.lit(3.0), F.lit(3.0), F.lit(3.0))) == 0.5
    assert value(spark, fx.ratio(F.lit(1.0), F.lit(0.0))) == 0
    assert value(spark, fx.distance(F.array(F.lit(0.0)), F.array(F.lit(2.0)), "cosine")) == 1.0
    with pytest.raises(ValueError):
        fx.distance(F.lit(1), F.lit(1), "chebyshev")


def test_splits(frame):
    df = frame([(1, i) for i in range(1, 8)], SERIES)
    assert column(splits.validation_split(df, C, 0.2), "part", *KEY) == ["train"] * 5 + ["validation"] * 2
    rows = splits.time_series_splits(df, C, 2).collect()
    got = {(s, role): sorted(r.time_cycles for r in rows if r.split == s and r.role == role) for s in (0, 1) for role in ("train", "test")}
    assert got == {(0, "train"): [1, 2, 3], (0, "test"): [4, 5], (1, "train"): [1, 2, 3, 4, 5], (1, "test"): [6, 7]}
    assert splits.unit_sample(frame([(1, i) for i in range(1, 6)], SERIES), C).count() == 3


def test_folds_are_even_and_keep_units_whole(frame):
    df = frame([(u, c) for u in range(23) for c in range(1, 4)], SERIES)
    rows = splits.unit_folds(df, C, 5).select("unit_number", "fold").distinct().collect()
    assert len(rows) == 23
    sizes = [sum(r.fold == f for r in rows) for f in range(5)]
    assert max(sizes) - min(sizes) <= 1


def test_sequences(frame):
    df = frame([(1, i, float(i)) for i in range(1, 6)] + [(2, 1, 9.0)], SERIES + ", sensor_1 double")
    got = features.sequences(df, 3, ["sensor_1"], "sensor_1", C, step=2).orderBy("end_cycle").collect()
    assert [(r.sequence, r.target) for r in got] == [([[1.0], [2.0], [3.0]], 3.0), ([[3.0], [4.0], [5.0]], 5.0)]


def test_per_unit_scaling_falls_back_to_the_fleet(frame):
    train = frame([(1, 1, 0.0), (1, 2, 10.0)], SERIES + ", sensor_1 double")
    test = frame([(1, 1, 5.0), (7, 1, 20.0)], SERIES + ", sensor_1 double")
    out = preparation.scale_per_unit(test, ["sensor_1"], C, "minmax", train)
    assert column(out, "sensor_1", *KEY) == [0.5, 2.0]


def test_unknown_arguments(frame):
    df = frame([(1, 1, 1.0)], SERIES + ", sensor_1 double")
    with pytest.raises(ValueError):
        preparation.Preparation(df, C, "other")
    with pytest.raises(ValueError):
        clustering.cluster_units(df, ["sensor_1"], C, linkage="median")
    with pytest.raises(ValueError):
        risk.compute_scores(df, "minmax")
    with pytest.raises(ValueError):
        risk.score_column(df)
    with pytest.raises(ValueError):
        features.Lookback(Layout(block_rows=4), 4)
