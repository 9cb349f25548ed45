"""A unit that holds most rows must give the same results, and no task may receive all of it."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wearcurve import Layout
from wearcurve.operators import blocks, clustering, features, labels, preparation, quantiles, risk, splits
from wearcurve.plans.staged import Tables

WHOLE = Layout(contiguous=True)
CUT = WHOLE.but(block_rows=8)
COUNTED = CUT.but(contiguous=False)
S = ["sensor_1", "sensor_2"]


@pytest.fixture(scope="module")
def skewed(spark):
    """Unit 0 has 300 of 420 rows."""
    rows = spark.range(420).select(
        F.when(F.col("id") < 300, 0).otherwise(1 + (F.col("id") % 12)).cast("int").alias("unit_number"),
        F.when(F.col("id") < 300, F.col("id") + 1).otherwise(F.floor((F.col("id") - 300) / 12) + 1).cast("int").alias("time_cycles"),
        ((F.col("id") * 7919 + 13) % 101).cast("double").alias("sensor_1"),
        ((F.col("id") * 104729 + 5) % 37).cast("double").alias("sensor_2"),
    )
    out = labels.train_rul(rows, WHOLE).withColumn("predicted_stage", (F.col("sensor_1") % 5).cast("int"))
    return out.cache()


def rows_of(df):
    names = sorted(df.columns)
    rows = (tuple(r[c] for c in names) for r in df.collect())
    return sorted(rows, key=lambda r: [(v is None, 0 if v is None else v) for v in r])


def assert_same(a, b):
    left, right = rows_of(a), rows_of(b)
    assert len(left) == len(right)
    for x, y in zip(left, right):
        for p, q in zip(x, y):
            if isinstance(p, float):
                assert math.isclose(p, q, rel_tol=1e-9, abs_tol=1e-9), (x, y)
            else:
                assert p == q, (x, y)


OPERATORS = {
    "rul": lambda d, w: labels.train_rul(d.drop("RUL"), w),
    "stages": lambda d, w: labels.rul_stages(d, w),
    "next": lambda d, w: labels.time_to_next_stage(d, w),
    "diff": lambda d, w: features.add_differences(d, S, w),
    "accel": lambda d, w: features.add_accelerations(d, S, w),
    "rolling": lambda d, w: features.add_rolling(d, S, w, (3, 7)),
    "running": lambda d, w: features.add_running(d, S, w),
    "cross": lambda d, w: features.add_crossovers(d, S, w, (2, 4, 7)),
    "weights": lambda d, w: preparation.variance_weights(d, S, w),
    "cycle": lambda d, w: preparation.add_cycle_features(d, w),
    "unit scale": lambda d, w: preparation.scale_per_unit(d, S, w, "standard"),
    "validation": lambda d, w: splits.validation_split(d, w),
    "series splits": lambda d, w: splits.time_series_splits(d, w, 3),
    "folds": lambda d, w: splits.unit_folds(d, w),
    "holdout": lambda d, w: splits.unit_holdout(d, w),
    "sample": lambda d, w: splits.unit_sample(d, w),
    "previous": lambda d, w: clustering.distance_to_previous(d, S, w),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_blocks_do_not_change_results(skewed, name):
    want = OPERATORS[name](skewed, WHOLE)
    assert_same(want, OPERATORS[name](skewed, CUT))
    assert_same(want, OPERATORS[name](skewed, COUNTED))


def test_sparse_cycles(skewed):
    """Rolling windows count rows, not cycles."""
    thin = skewed.where("sensor_2 > 12")
    got = {(r.unit_number, r.time_cycles): r.sensor_1_roll3_mean for r in features.add_rolling(thin, S, COUNTED, (3,)).collect()}
    frame = thin.toPandas().sort_values(["unit_number", "time_cycles"])
    want = frame.groupby("unit_number")["sensor_1"].rolling(3, min_periods=1).mean().to_numpy()
    for key, w in zip(zip(frame.unit_number, frame.time_cycles), want):
        assert got[key] == pytest.approx(w)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_windows_never_partition_by_the_unit_alone(skewed, spark, tmp_path):
    """Row-level windows use (unit, block); only per-block tables are windowed per unit."""
    path = str(tmp_path / "rows")
    skewed.write.parquet(path)
    rows = spark.read.parquet(path)
    for name in ("rolling", "diff", "cross", "next"):
        plan = _plan(OPERATORS[name](rows, WHOLE))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    rolling = _plan(features.add_rolling(rows, S, WHOLE, (3, 7)))
    assert rolling.count("Exchange hashpartitioning") == 1  # one shuffle for all columns and windows
    assert "Exchange hashpartitioning(unit_number#" in rolling and ", _wblk#" in rolling


def test_a_hot_unit_is_spread_over_tasks(skewed):
    spread = blocks.Lookback(CUT, 2).open(skewed).repartition(8, "unit_number", "_wblk")
    sizes = [r["n"] for r in spread.where("unit_number = 0").groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) > 4


def test_blocked_rank_without_keys(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1009).alias("v"))
    got = blocks.blocked_rank(df, [], [F.col("v")], {"_b": F.floor(F.col("v") / 50)}, "k")
    assert [r.k for r in got.orderBy("v").collect()] == list(range(1, 1001))


@pytest.mark.parametrize("options", [{}, {"accuracy": 50, "small": 10}, {"accuracy": 200, "small": 0}])
def test_percentiles_match_numpy(spark, options):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.exponential(5, 3000), np.full(1500, 2.0), -rng.exponential(1, 500)])
    df = spark.createDataFrame([(int(i % 3), float(v)) for i, v in enumerate(values)], "g int, v double").repartition(4)
    probs = [0.0, 0.01, 0.3, 0.5, 0.85, 0.999, 1.0]
    got = {r.prob: r.value for r in quantiles.exact_percentiles(df, ["v"], probs, **options).collect()}
    assert [got[p] for p in probs] == pytest.approx(np.quantile(values, probs).tolist())
    by = quantiles.exact_percentiles(df, ["v"], [0.25, 0.5], ["g"], **options).collect()
    for r in by:
        assert r.value == pytest.approx(np.quantile(values[r.g :: 3], r.prob))


def test_threshold_curve_over_many_buckets(spark):
    rng = np.random.default_rng(4)
    s, y = rng.normal(size=4000).round(2), rng.integers(0, 2, 4000)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)], "s double, y int")
    got = {r.score: (r.precision, r.recall) for r in risk.threshold_curve(df, "s", F.col("y") == 1).collect()}
    assert len(got) == len(set(s.tolist()))
    for t in sorted(got)[::40]:
        hit = y[s >= t].sum()
        assert got[t] == pytest.approx((hit / (s >= t).sum(), hit / y.sum()))


def test_staged_tables_are_written_once(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    assert t.series.inputFiles() == Tables(spark, "/root/testdata/sf0.001").series.inputFiles()


def test_one_shuffle_of_the_rows_when_nothing_can_be_broadcast(skewed, spark, tmp_path):
    path = str(tmp_path / "rows")
    skewed.write.parquet(path)
    rows = spark.read.parquet(path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(labels.train_rul(rows.drop("RUL"), WHOLE))
        ranked = _plan(blocks.positions(rows, COUNTED))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # unit aggregate, its copies per block, and the rows themselves: all joined on (unit, block)
    assert "SortMergeJoin [unit_number#" in plan and ", _blk#" in plan
    assert plan.count("Exchange hashpartitioning") == 3
    # rows by (unit, bucket), counts by (unit, bucket), offsets by unit and back
    assert "SortMergeJoin [unit_number#" in ranked and ", _pbk#" in ranked
    assert ranked.count("Exchange hashpartitioning") <= 4
