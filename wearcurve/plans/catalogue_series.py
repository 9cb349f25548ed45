"""Queries over scans, cleaning, scaling, labels, windows, splits and expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearcurve.functions import features as fx
from wearcurve.layout import CONTIGUOUS as C
from wearcurve.operators import clustering, features, labels, preparation, reports, risk, splits
from wearcurve.operators.quantiles import exact_percentiles
from wearcurve.plans.registry import query
from wearcurve.plans.staged import Tables
from wearcurve.sources import tables as tb
from wearcurve.sources import text
from wearcurve.sources.schema import DATASETS, SERIES_COLUMNS, informative_sensors
from wearcurve.sources.stand_ins import event_series, lineitem_series

KEY = ["unit_number", "time_cycles"]
S = ["sensor_1", "sensor_2"]


# --- A: scans, sources, sinks ------------------------------------------------------------------


def _wide(df: DataFrame) -> DataFrame:
    """The series with all 26 columns; the missing ones are derived from the first two sensors."""
    extra = {f"setting_{i}": F.col("setting_1") + i for i in (2, 3)}
    extra |= {f"sensor_{i}": F.col("sensor_1") + F.lit(i) * F.col("sensor_2") for i in range(3, 22)}
    return df.withColumns(extra).select(*SERIES_COLUMNS)


_WIDE_SQL = (
    "SELECT unit_number, time_cycles, setting_1, setting_1 + 2 AS setting_2, setting_1 + 3 AS setting_3, "
    "sensor_1, sensor_2, " + ", ".join(f"sensor_1 + {i} * sensor_2 AS sensor_{i}" for i in range(3, 22)) + " FROM u"
)


def _as_lines(df: DataFrame) -> DataFrame:
    return df.select(F.concat_ws("  ", F.lit(""), *[F.col(c).cast("string") for c in df.columns], F.lit("")))


@query("series_of_events", KEY, ["setting_1", *S], "SELECT * FROM u", "u")
def _(t: Tables):
    return event_series(t.spark, t.sf_dir)


@query("series_of_lineitems", KEY, ["sensor_1", "sensor_2", "sensor_3", "sensor_4"], "SELECT * FROM l", "l")
def _(t: Tables):
    return lineitem_series(t.spark, t.sf_dir)


@query("A1_series_scan", KEY, SERIES_COLUMNS[2:], _WIDE_SQL, "u")
def _(t: Tables):
    path = tb.scratch_path(t.spark, "text")
    _as_lines(_wide(t.series)).write.text(path)
    return text.read_series(t.spark, path)


@query(
    "A2_rul_scan",
    ["unit_number", "RUL"],
    (),
    "SELECT CAST(row_number() OVER (ORDER BY unit_number) AS INT) AS unit_number, RUL FROM "
    "(SELECT DISTINCT unit_number, 6 + unit_number % 140 AS RUL FROM u)",
    "u",
)
def _(t: Tables):
    path = tb.scratch_path(t.spark, "rul")
    units = t.series.groupBy("unit_number").agg((6 + F.col("unit_number") % 140).alias("RUL"))
    lines = units.orderBy("unit_number").select(F.concat(F.col("RUL").cast("string"), F.lit(" ")))
    lines.write.text(path)
    return text.read_rul(t.spark, path)


@query(
    "A3_load_all_datasets",
    ["dataset_id", "part", "units", "n"],
    ["total"],
    "SELECT 'FD00' || CAST(1 + unit_number % 4 AS VARCHAR) AS dataset_id, part, count(DISTINCT unit_number) AS units, "
    "count(*) AS n, sum(sensor_1 + 21 * sensor_2) AS total FROM u, (VALUES ('train'), ('test')) x(part) GROUP BY ALL "
    "UNION ALL SELECT 'FD00' || CAST(1 + unit_number % 4 AS VARCHAR), 'rul', count(DISTINCT unit_number), "
    "count(DISTINCT unit_number), count(DISTINCT unit_number) FROM u GROUP BY ALL",
    "u",
    digits=2,
)
def _(t: Tables):
    root = tb.scratch_path(t.spark, "datasets")
    rows = _wide(t.series)
    number = 1 + F.col("unit_number") % 4
    for i, name in enumerate(DATASETS, start=1):
        part = rows.where(number == i)
        for split in ("train", "test"):
            _as_lines(part).write.text(f"{root}/{split}/{split}_{name}.txt")
        part.groupBy("unit_number").agg(F.lit("1 ")).select("1 ").write.text(f"{root}/RUL/RUL_{name}.txt")
    loaded = text.load_all(t.spark, root)
    out = None
    for part, frame in loaded.items():
        total = F.sum("RUL").cast("double") if part == "rul" else F.sum("sensor_21")
        one = frame.groupBy("dataset_id").agg(
            F.lit(part).alias("part"), F.countDistinct("unit_number").alias("units"), F.count(F.lit(1)).alias("n"), total.alias("total")
        )
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "A4_dataset_registry",
    ["dataset_id", "train_units", "test_units", "conditions", "fault_modes", "n"],
    (),
    "SELECT d.*, n FROM (VALUES "
    "('FD001', 100, 100, 'ONE (Sea Level)', 'ONE (HPC Degradation)'), "
    "('FD002', 260, 259, 'SIX', 'ONE (HPC Degradation)'), "
    "('FD003', 100, 100, 'ONE (Sea Level)', 'TWO (HPC Degradation, Fan Degradation)'), "
    "('FD004', 248, 249, 'SIX', 'TWO (HPC Degradation, Fan Degradation)')) "
    "d(dataset_id, train_units, test_units, conditions, fault_modes) "
    "JOIN (SELECT dataset_id, count(*) AS n FROM p GROUP BY 1) USING (dataset_id)",
    "p",
)
def _(t: Tables):
    rows = t.labelled.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("n"))
    return text.dataset_registry(t.spark).join(rows, "dataset_id")


@query("A5_csv_handover", [*KEY, "predicted_stage"], ["sensor_1", "time_to_next_stage"], "SELECT * FROM p", "p")
def _(t: Tables):
    path = tb.scratch_path(t.spark, "csv")
    rows = t.labelled.select(*KEY, "predicted_stage", "sensor_1", "time_to_next_stage")
    tb.write_table(rows, path, "csv", sort_by=KEY)
    tb.require_paths(t.spark, [path])
    return tb.read_table(t.spark, path, rows.schema, "csv")


@query("A6_required_paths", ["dataset_id", "units", "missing"], (), "SELECT dataset_id, count(DISTINCT unit_number) AS units, 'dataset_id=' || dataset_id || 'x' AS missing FROM p GROUP BY 1", "p")
def _(t: Tables):
    """Each dataset is read once its folder is known to be there; of a list with a folder too many, that one is named."""
    path = tb.scratch_path(t.spark, "required")
    tb.write_table(t.labelled.select("dataset_id", "unit_number"), path, partition_by=["dataset_id"])
    found = None
    for name in text.DATASETS:
        here = f"{path}/dataset_id={name}"
        tb.require_paths(t.spark, [here])
        try:
            tb.require_paths(t.spark, [here, f"{here}x"])
            named = []
        except FileNotFoundError as error:
            named = [part.rsplit("/", 1)[-1] for part in str(error).split(", ")]
        one = t.spark.read.schema("unit_number int").parquet(here).agg(F.countDistinct("unit_number").alias("units"))
        one = one.select(F.lit(name).alias("dataset_id"), "units", F.lit(",".join(named)).alias("missing"))
        found = one if found is None else found.unionByName(one)
    return found


@query("A7_partitioned_sink", ["dataset_id", "n"], ["total"], "SELECT dataset_id, count(*) AS n, sum(sensor_1) AS total FROM p GROUP BY 1", "p", digits=4)
def _(t: Tables):
    path = tb.scratch_path(t.spark, "parts")
    rows = t.labelled.select("dataset_id", *KEY, "sensor_1")
    tb.write_table(rows, path, partition_by=["dataset_id"], sort_by=KEY)
    return tb.read_table(t.spark, path, rows.schema).groupBy("dataset_id").agg(F.count(F.lit(1)).alias("n"), F.sum("sensor_1").alias("total"))


@query(
    "A8_score_store",
    ["params"],
    ["score"],
    """SELECT '{"setting": ' || CAST(CAST(setting_1 AS INT) AS VARCHAR) || ', "stage": ' || CAST(predicted_stage AS VARCHAR) || '}' AS params,
      avg(sensor_1) AS score FROM p GROUP BY setting_1, predicted_stage""",
    "p",
)
def _(t: Tables):
    # scores of some settings are stored first; a second run scores only the others
    scored = t.labelled.groupBy("setting_1", "predicted_stage").agg(F.avg("sensor_1").alias("score"))
    template = '{"setting": %d, "stage": %d}'
    all_scores = scored.select(
        F.format_string(template, F.col("setting_1").cast("int"), "predicted_stage").alias("params"), "score", "predicted_stage"
    )
    path = tb.scratch_path(t.spark, "scores")
    tb.write_scores(all_scores.where("predicted_stage = 0"), path)
    todo = tb.unscored(all_scores.select("params"), tb.read_scores(t.spark, path))
    tb.write_scores(all_scores.join(todo, "params"), path)
    return tb.read_scores(t.spark, path)


# --- B: projections, filters, cleaning, scaling ------------------------------------------------


@query("B1_columns_by_prefix", KEY, ["setting_1", *S], "SELECT * FROM p", "p")
def _(t: Tables):
    df = t.labelled
    return df.select(*KEY, *features.settings(df), *features.sensors(df))


@query("B2_informative_sensors", ["column"], ["total"], "SELECT 'sensor_2' AS \"column\", sum(sensor_2) AS total FROM u UNION ALL " + " UNION ALL ".join(f"SELECT 'sensor_{i}', sum(sensor_1 + {i} * sensor_2) FROM u" for i in (3, 4, 7, 8, 9, 11, 12, 13, 14, 15, 17, 20, 21)), "u", digits=3)
def _(t: Tables):
    names = informative_sensors(important_only=True)
    row = _wide(t.series).agg(*[F.sum(c).alias(c) for c in names])
    return row.unpivot([], names, "column", "total")


@query("B3_keep_units", [*KEY], ["sensor_1"], "SELECT * FROM p WHERE unit_number IN (SELECT unit_number FROM p GROUP BY 1 HAVING max(sensor_1) > 200) AND predicted_stage = 2", "p")
def _(t: Tables):
    units = t.labelled.groupBy("unit_number").agg(F.max("sensor_1").alias("m")).where("m > 200")
    return preparation.keep_units(t.labelled.where("predicted_stage = 2"), units, C)


@query("B4_drop_short_units", KEY, ["sensor_1"], "SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY unit_number) AS c FROM u) WHERE c >= 65", "u")
def _(t: Tables):
    return preparation.drop_short_units(t.series, C, 65)


def _holes(df: DataFrame) -> DataFrame:
    """Nulls in both sensors, decided by the row's own values."""
    gap = (F.col("unit_number") + F.col("time_cycles")) % 7 == 0
    return df.withColumns({"sensor_1": F.when(~gap, F.col("sensor_1")), "sensor_2": F.when(F.col("sensor_2") != 50, F.col("sensor_2"))})


_HOLES_SQL = "(SELECT unit_number, time_cycles, CASE WHEN (unit_number + time_cycles) % 7 <> 0 THEN sensor_1 END AS sensor_1, CASE WHEN sensor_2 <> 50 THEN sensor_2 END AS sensor_2 FROM u)"


@query("B5_drop_missing_labels", KEY, S, f"SELECT * FROM {_HOLES_SQL} WHERE sensor_1 IS NOT NULL", "u")
def _(t: Tables):
    return _holes(t.series).na.drop(subset=["sensor_1"])


@query("B6_impute_medians", KEY, S, f"SELECT unit_number, time_cycles, coalesce(sensor_1, (SELECT median(sensor_1) FROM {_HOLES_SQL})) AS sensor_1, coalesce(sensor_2, (SELECT median(sensor_2) FROM {_HOLES_SQL})) AS sensor_2 FROM {_HOLES_SQL}", "u")
def _(t: Tables):
    return preparation.impute_medians(_holes(t.series), S)


@query("B7_cap_outliers", KEY, S, "SELECT unit_number, time_cycles, greatest(least(sensor_1, m + 5 * d), m - 5 * d) AS sensor_1, greatest(least(sensor_2, m2 + 5 * d2), m2 - 5 * d2) AS sensor_2 FROM u, (SELECT avg(sensor_1) AS m, stddev_samp(sensor_1) AS d, avg(sensor_2) AS m2, stddev_samp(sensor_2) AS d2 FROM u)", "u")
def _(t: Tables):
    return preparation.cap_outliers(t.series, S)


def _scaling_sql(offset: str, width: str, over: str = "") -> str:
    parts = []
    for c in S:
        parts.append(f"({c} - {offset.format(c=c)}) / CASE WHEN {width.format(c=c)} = 0 THEN 1 ELSE {width.format(c=c)} END AS {c}")
    return ", ".join(parts)


_FLEET = {
    "minmax": ("(SELECT min({c}) FROM u)", "(SELECT max({c}) - min({c}) FROM u)"),
    "standard": ("(SELECT avg({c}) FROM u)", "(SELECT stddev_pop({c}) FROM u)"),
    "robust": ("(SELECT median({c}) FROM u)", "(SELECT quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) FROM u)"),
}
_UNIT = {
    "minmax": ("min({c}) OVER w", "(max({c}) OVER w - min({c}) OVER w)"),
    "standard": ("avg({c}) OVER w", "stddev_pop({c}) OVER w"),
    "robust": ("median({c}) OVER w", "(quantile_cont({c}, 0.75) OVER w - quantile_cont({c}, 0.25) OVER w)"),
}


def _register_scalers():
    for method in ("minmax", "standard", "robust"):

        @query(f"B8_scale_{method}", KEY, S, f"SELECT unit_number, time_cycles, {_scaling_sql(*_FLEET[method])} FROM u", "u")
        def _(t: Tables, method=method):
            return preparation.scale(t.series, S, method)

        @query(f"B9_scale_per_unit_{method}", KEY, S, f"SELECT unit_number, time_cycles, {_scaling_sql(*_UNIT[method])} FROM u WINDOW w AS (PARTITION BY unit_number)", "u")
        def _(t: Tables, method=method):
            return preparation.scale_per_unit(t.series, S, C, method)


_register_scalers()


_HOLDOUT = (
    "(SELECT u.*, CASE WHEN rk <= ceil(n * CAST(0.2 AS DOUBLE)) THEN 'test' ELSE 'train' END AS part FROM u JOIN "
    "(SELECT unit_number, row_number() OVER (ORDER BY md5(unit_number || ':42'), unit_number) AS rk, "
    "count(*) OVER () AS n FROM (SELECT DISTINCT unit_number FROM u)) USING (unit_number))"
)
_ENDS = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in S)


@query(
    "B9_scale_unseen_units",
    KEY,
    S,
    "SELECT unit_number, time_cycles, "
    + ", ".join(
        f"({c} - coalesce(a.lo_{c}, f.lo_{c})) / (coalesce(a.hi_{c}, f.hi_{c}) - coalesce(a.lo_{c}, f.lo_{c})) AS {c}" for c in S
    )
    + f" FROM u LEFT JOIN (SELECT unit_number, {_ENDS} FROM {_HOLDOUT} WHERE part = 'train' GROUP BY 1) a USING (unit_number), "
    f"(SELECT {_ENDS} FROM {_HOLDOUT} WHERE part = 'train') f",
    "u",
)
def _(t: Tables):
    train = splits.unit_holdout(t.series, C).where("part = 'train'")
    return preparation.scale_per_unit(t.series, S, C, "minmax", train)


@query("B10_normalize_columns", KEY, ["sensor_1", "constant"], "SELECT unit_number, time_cycles, (sensor_1 - (SELECT min(sensor_1) FROM u)) / (SELECT max(sensor_1) - min(sensor_1) FROM u) AS sensor_1, 3.0 AS constant FROM u", "u")
def _(t: Tables):
    return preparation.normalize_columns(t.series.withColumn("constant", F.lit(3.0)), ["sensor_1", "constant"])


_WITH_FLAT = "(SELECT *, sensor_2 / 10000 AS sensor_3, 7.0 AS sensor_4 FROM u)"


def _with_flat(df: DataFrame) -> DataFrame:
    return df.withColumns({"sensor_3": F.col("sensor_2") / 10000, "sensor_4": F.lit(7.0)})


def _variance_sql(measure: str, condition: str) -> str:
    one = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {measure}({c}) AS variance FROM {_WITH_FLAT}" for c in ("setting_1", "sensor_1", "sensor_2", "sensor_3", "sensor_4"))
    return f"SELECT * FROM ({one}) WHERE variance > {condition}"


@query("B11_scalable_columns", ["column"], ["variance"], _variance_sql("var_samp", "0.001"), "u")
def _(t: Tables):
    df = _with_flat(t.series)
    return preparation.scalable_columns(df, [*features.settings(df), *features.sensors(df)])


@query("B12_varying_columns", ["column"], ["variance"], _variance_sql("var_pop", "0.001"), "u")
def _(t: Tables):
    df = _with_flat(t.series)
    return preparation.varying_columns(df, [*features.settings(df), *features.sensors(df)])


@query("B13_nonconstant_columns", ["column"], ["variance"], _variance_sql("var_pop", "0"), "u")
def _(t: Tables):
    df = _with_flat(t.series)
    return preparation.varying_columns(df, [*features.settings(df), *features.sensors(df)], 0.0)


@query("B14_variance_weights", KEY, S, "SELECT unit_number, time_cycles, sensor_1 * v1 / (v1 + v2) AS sensor_1, sensor_2 * v2 / (v1 + v2) AS sensor_2 FROM (SELECT *, var_pop(sensor_1) OVER w AS v1, var_pop(sensor_2) OVER w AS v2 FROM u WINDOW w AS (PARTITION BY unit_number))", "u")
def _(t: Tables):
    return preparation.variance_weights(t.series, S, C)


@query(
    "B15_standardise_training_matrix",
    [*KEY, "part"],
    S,
    f"SELECT unit_number, time_cycles, part, (sensor_1 - m1) / d1 AS sensor_1, (sensor_2 - m2) / d2 AS sensor_2 FROM {_HOLDOUT}, "
    "(SELECT avg(sensor_1) AS m1, stddev_pop(sensor_1) AS d1, avg(sensor_2) AS m2, stddev_pop(sensor_2) AS d2 "
    f"FROM {_HOLDOUT} WHERE part = 'train')",
    "u",
)
def _(t: Tables):
    parts = splits.unit_holdout(t.series, C)
    return preparation.scale(parts, S, "standard", parts.where("part = 'train'"))


# --- C: joins and lookups ----------------------------------------------------------------------


@query("C1_train_rul", [*KEY, "RUL"], (), "SELECT * FROM r", "p")
def _(t: Tables):
    return labels.train_rul(t.series, C)


@query("C2_test_rul", [*KEY, "RUL"], (), "SELECT unit_number, time_cycles, 6 + unit_number % 140 + max(time_cycles) OVER (PARTITION BY unit_number) - time_cycles AS RUL FROM u", "u")
def _(t: Tables):
    known = t.series.groupBy("unit_number").agg((6 + F.col("unit_number") % 140).alias("RUL"))
    return labels.test_rul(t.series, known, C)


_PREV_SQL = """SELECT unit_number, time_cycles,
  sqrt(pow(sensor_1 - a, 2) + pow(sensor_2 - b, 2)) AS euclidean,
  abs(sensor_1 - a) + abs(sensor_2 - b) AS manhattan,
  CASE WHEN a IS NULL THEN NULL WHEN sqrt(sensor_1 ** 2 + sensor_2 ** 2) * sqrt(a ** 2 + b ** 2) = 0 THEN 1 ELSE
    1 - (sensor_1 * a + sensor_2 * b) / (sqrt(sensor_1 ** 2 + sensor_2 ** 2) * sqrt(a ** 2 + b ** 2)) END AS cosine
  FROM (SELECT *, lag(sensor_1) OVER w AS a, lag(sensor_2) OVER w AS b FROM u
        WINDOW w AS (PARTITION BY unit_number ORDER BY time_cycles))"""


@query("C3_distance_to_previous_row", KEY, ["euclidean", "manhattan", "cosine"], _PREV_SQL, "u")
def _(t: Tables):
    return clustering.distance_to_previous(t.series, S, C)


_LINK_SQL = """SELECT x.unit_number, x.cluster AS a, y.cluster AS b, {value}
  FROM {rows} x JOIN {rows} y ON x.unit_number = y.unit_number AND x.cluster < y.cluster
  JOIN (SELECT unit_number, cluster, count(*) AS n FROM {rows} GROUP BY 1, 2) ca ON ca.unit_number = x.unit_number AND ca.cluster = x.cluster
  JOIN (SELECT unit_number, cluster, count(*) AS n FROM {rows} GROUP BY 1, 2) cb ON cb.unit_number = y.unit_number AND cb.cluster = y.cluster
  GROUP BY 1, 2, 3"""
_SQ = "pow(x.sensor_1 - y.sensor_1, 2) + pow(x.sensor_2 - y.sensor_2, 2)"


@query("C4_ward_links", ["unit_number", "a", "b"], ["link"], _LINK_SQL.format(rows="p", value=f"sum({_SQ}) / any_value(ca.n + cb.n) AS link"), "p", digits=4)
def _(t: Tables):
    return clustering.ward_links(t.labelled, S, ["unit_number"], "cluster")


@query(
    "C4_links_of_clusters",
    ["unit_number", "a", "b"],
    ["single", "complete", "average", "ward"],
    _LINK_SQL.format(rows="p", value=f"min(sqrt({_SQ})) AS single, max(sqrt({_SQ})) AS complete, avg(sqrt({_SQ})) AS average, sum({_SQ}) / any_value(ca.n + cb.n) AS ward"),
    "p",
    digits=4,
)
def _(t: Tables):
    return clustering.pair_links(t.labelled, S, C, "cluster")


@query(
    "C4_extreme_links",
    ["unit_number", "a", "b"],
    ["single", "complete"],
    _LINK_SQL.format(rows="p", value=f"min(sqrt({_SQ})) AS single, max(sqrt({_SQ})) AS complete"),
    "p",
    digits=4,
)
def _(t: Tables):
    return clustering.extreme_links(t.labelled, S, C, "cluster")


_MH = "abs(x.sensor_1 - y.sensor_1) + abs(x.sensor_2 - y.sensor_2)"


@query(
    "C4_links_of_clusters_manhattan",
    ["unit_number", "a", "b"],
    ["single", "complete", "average"],
    _LINK_SQL.format(rows="p", value=f"min({_MH}) AS single, max({_MH}) AS complete, avg({_MH}) AS average"),
    "p",
    digits=4,
)
def _(t: Tables):
    return clustering.pair_links(t.labelled, S, C, "cluster", "manhattan")


def _nearest_sql(measure: str) -> str:
    return f"""SELECT vec_id, arg_min(label, (d, label)) AS nearest, min(d) AS distance FROM (
      SELECT e.vec_id, c.label, {measure} AS d FROM (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings) e,
      (SELECT label, list(m ORDER BY i) AS y FROM (SELECT label, i, avg(embedding[i]::DOUBLE) AS m
        FROM embeddings, range(1, 65) g(i) GROUP BY 1, 2) GROUP BY 1) c) GROUP BY 1"""


_MEASURES = {
    "euclidean": "list_distance(x, y)",
    "manhattan": "list_sum(list_transform(list_zip(x, y), lambda z: abs(z[1] - z[2])))",
    "cosine": "1 - list_cosine_similarity(x, y)",
}


def _register_nearest():
    for metric, measure in _MEASURES.items():

        @query(f"C5_nearest_centroid_{metric}", ["vec_id", "nearest"], ["distance"], _nearest_sql(measure))
        def _(t: Tables, metric=metric):
            rows = t.source("embeddings")
            centres = clustering.centroids(rows, "embedding", ["label"], 64)
            return clustering.nearest_centroid(rows, "embedding", centres, "label", metric)


_register_nearest()

_STAGE_ORDER_SQL = """SELECT p.*, sg AS degradation_stage FROM p JOIN (
  SELECT unit_number, cluster, CAST(row_number() OVER (PARTITION BY unit_number ORDER BY m, cluster) - 1 AS INT) AS sg
  FROM (SELECT unit_number, cluster, avg(time_cycles) AS m FROM p GROUP BY 1, 2)) USING (unit_number, cluster)"""


@query("C6_stage_of_cluster", [*KEY, "cluster", "degradation_stage"], (), _STAGE_ORDER_SQL, "p")
def _(t: Tables):
    return clustering.order_stages(t.labelled, C)


@query("C7_time_to_next_stage", KEY, ["time_to_next_stage"], "SELECT * FROM p", "p")
def _(t: Tables):
    return labels.time_to_next_stage(t.labelled.drop("time_to_next_stage"), C)


@query("C7_time_to_next_true_stage", KEY, ["time_to_next_stage"], """SELECT unit_number, time_cycles, coalesce(
  (SELECT min(f.time_cycles) FROM st f WHERE f.unit_number = a.unit_number AND f.true_stage = a.true_stage + 1
   AND f.time_cycles > a.time_cycles) - a.time_cycles, RUL) AS time_to_next_stage FROM st a""", "p")
def _(t: Tables):
    return labels.time_to_next_stage(t.labelled.drop("time_to_next_stage"), C, "true_stage", stages=None)


@query("C8_rows_of_fold_units", KEY, (), "SELECT u.* FROM u WHERE unit_number IN (SELECT unit_number FROM (SELECT unit_number, row_number() OVER (ORDER BY md5(unit_number || ':42'), unit_number) AS rk FROM (SELECT DISTINCT unit_number FROM u)) WHERE (rk - 1) % 5 = 0)", "u")
def _(t: Tables):
    folded = splits.unit_folds(t.series, C)
    units = folded.where("fold = 0").groupBy("unit_number").agg(F.lit(1))
    return preparation.keep_units(t.series, units, C)


@query("C9_align_stages_by_key", [*KEY, "true_stage", "predicted_stage"], (), "SELECT a.unit_number, a.time_cycles, a.true_stage, b.predicted_stage FROM p a JOIN p b USING (unit_number, time_cycles) WHERE b.sensor_2 >= 20", "p")
def _(t: Tables):
    given = t.labelled.select(*KEY, "true_stage")
    called = t.labelled.where("sensor_2 >= 20").select(*KEY, "predicted_stage")
    return given.join(called, KEY)


# --- D: aggregations ---------------------------------------------------------------------------


def _profile_sql(table: str, names: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min, max({c}) AS max, "
        f"median({c}) AS median, skewness({c}) AS skew, kurtosis({c}) AS kurtosis FROM {table}"
        for c in names
    )


_PROFILE = ["mean", "std", "min", "max", "median", "skew", "kurtosis"]


@query("D1_sensor_profile", ["column"], _PROFILE, _profile_sql("u", S), "u", digits=5)
def _(t: Tables):
    return preparation.sensor_profile(t.series, S)


@query("D1_sensor_profile_lines", ["column"], _PROFILE, _profile_sql("l", [f"sensor_{i}" for i in range(1, 5)]), "l", digits=5)
def _(t: Tables):
    return preparation.sensor_profile(t.lines, [f"sensor_{i}" for i in range(1, 5)])


@query("D2_cycle_features", [*KEY, "remaining_cycles"], ["cycle_ratio"], "SELECT unit_number, time_cycles, m - time_cycles AS remaining_cycles, time_cycles / m AS cycle_ratio FROM (SELECT *, max(time_cycles) OVER (PARTITION BY unit_number) AS m FROM u)", "u")
def _(t: Tables):
    return preparation.add_cycle_features(t.series, C)


@query("D3_normalized_rul", KEY, ["normalized_RUL"], "SELECT unit_number, time_cycles, RUL / (SELECT max(RUL) FROM r) AS normalized_RUL FROM r", "p")
def _(t: Tables):
    return preparation.add_rul_features(t.labelled)


@query("D4_rul_quartile", [*KEY, "RUL_quartile"], (), "SELECT unit_number, time_cycles, CASE WHEN RUL <= q[1] THEN 0 WHEN RUL <= q[2] THEN 1 WHEN RUL <= q[3] THEN 2 ELSE 3 END AS RUL_quartile FROM r, (SELECT quantile_cont(RUL, [0.25, 0.5, 0.75]) AS q FROM r)", "p")
def _(t: Tables):
    return preparation.add_rul_features(t.labelled)


_STAGE_STATS = "SELECT unit_number, true_stage AS stage, count(*) AS n, avg(sensor_1) AS sensor_1_mean, stddev_pop(sensor_1) AS sensor_1_std, avg(sensor_2) AS sensor_2_mean, stddev_pop(sensor_2) AS sensor_2_std FROM p GROUP BY 1, 2"


@query("D5_stage_statistics", ["unit_number", "stage", "n"], ["sensor_1_mean", "sensor_1_std", "sensor_2_mean", "sensor_2_std"], _STAGE_STATS, "p")
def _(t: Tables):
    return clustering.stage_statistics(t.labelled, S, C, "true_stage")


@query("D6_stage_profiles", ["stage", "n"], ["sensor_1_mean", "sensor_2_mean"], f"SELECT stage, CAST(sum(n) AS BIGINT) AS n, avg(sensor_1_mean) AS sensor_1_mean, avg(sensor_2_mean) AS sensor_2_mean FROM ({_STAGE_STATS}) GROUP BY 1", "p")
def _(t: Tables):
    return clustering.stage_profiles(clustering.stage_statistics(t.labelled, S, C, "true_stage"))


@query("D7_centroids", ["label", "i"], ["value"], "SELECT label, CAST(i - 1 AS INT) AS i, avg(embedding[i]::DOUBLE) AS value FROM embeddings, range(1, 65) g(i) GROUP BY 1, 2")
def _(t: Tables):
    centres = clustering.centroids(t.source("embeddings"), "embedding", ["label"], 64)
    return centres.select("label", F.posexplode("centroid").alias("i", "value"))


@query("D7_unit_cluster_centroids", ["unit_number", "cluster"], S, "SELECT unit_number, cluster, avg(sensor_1) AS sensor_1, avg(sensor_2) AS sensor_2 FROM p GROUP BY 1, 2", "p")
def _(t: Tables):
    return t.labelled.groupBy("unit_number", "cluster").agg(*[F.avg(c).alias(c) for c in S])


@query("D8_class_distribution", ["predicted_stage", "n"], ["share"], "SELECT predicted_stage, count(*) AS n, count(*) / (SELECT count(*) FROM p) AS share FROM p GROUP BY 1", "p")
def _(t: Tables):
    return reports.shares(t.labelled, ["predicted_stage"])


@query("D10_unit_counts", ["units", "rows"], (), "SELECT count(DISTINCT unit_number) AS units, count(*) AS rows FROM u", "u")
def _(t: Tables):
    return reports.unit_counts(t.series, C)


@query("D12_sensor_by_cycle_and_stage", ["unit_number", "true_stage", "time_cycles"], ["mean_value"], "SELECT unit_number, true_stage, time_cycles, avg(sensor_1) AS mean_value FROM p GROUP BY ALL", "p")
def _(t: Tables):
    return reports.sensor_by_cycle_and_stage(t.labelled, "sensor_1", "true_stage", C)


_BOX = "min({v}) AS min, quantile_cont({v}, 0.25) AS q1, median({v}) AS median, quantile_cont({v}, 0.75) AS q3, max({v}) AS max, count(*) AS n"


@query("D15_rul_by_cluster", ["cluster", "n"], ["min", "q1", "median", "q3", "max"], f"SELECT cluster, {_BOX.format(v='RUL')} FROM p GROUP BY 1", "p")
def _(t: Tables):
    return reports.box_statistics(t.labelled, "RUL", ["cluster"])


@query("D15_rul_by_stage", ["true_stage", "n"], ["min", "q1", "median", "q3", "max"], f"SELECT true_stage, {_BOX.format(v='RUL')} FROM p GROUP BY 1", "p")
def _(t: Tables):
    return reports.box_statistics(t.labelled, "RUL", ["true_stage"])


# --- E: windows --------------------------------------------------------------------------------

_W = "WINDOW w AS (PARTITION BY unit_number ORDER BY time_cycles)"


@query("E1_differences", KEY, ["sensor_1_diff", "sensor_2_diff"], f"SELECT unit_number, time_cycles, coalesce(sensor_1 - lag(sensor_1) OVER w, 0) AS sensor_1_diff, coalesce(sensor_2 - lag(sensor_2) OVER w, 0) AS sensor_2_diff FROM u {_W}", "u")
def _(t: Tables):
    return features.add_differences(t.series, S, C)


@query("E2_accelerations", KEY, ["sensor_1_diff", "sensor_1_accel"], f"SELECT *, coalesce(sensor_1_diff - lag(sensor_1_diff) OVER w, 0) AS sensor_1_accel FROM (SELECT unit_number, time_cycles, coalesce(sensor_1 - lag(sensor_1) OVER w, 0) AS sensor_1_diff FROM u {_W}) {_W}", "u")
def _(t: Tables):
    return features.add_accelerations(t.series, ["sensor_1"], C)


def _rolling_sql(table: str, names: list[str], windows, mean: str, std: str, extra: str = "") -> str:
    parts = []
    for c in names:
        for w in windows:
            frame = f"OVER (PARTITION BY unit_number ORDER BY time_cycles ROWS {w - 1} PRECEDING)"
            parts.append(f"avg({c}) {frame} AS {mean.format(c=c, w=w)}")
            parts.append(f"coalesce(stddev_samp({c}) {frame}, 0) AS {std.format(c=c, w=w)}")
    return f"SELECT unit_number, time_cycles, {extra}{', '.join(parts)} FROM {table}"


def _rolling_names(names, windows, mean, std):
    return [n.format(c=c, w=w) for c in names for w in windows for n in (mean, std)]


_R = ("{c}_roll{w}_mean", "{c}_roll{w}_std")


@query("E3_rolling", KEY, _rolling_names(S, features.WINDOWS, *_R), _rolling_sql("u", S, features.WINDOWS, *_R), "u")
def _(t: Tables):
    return features.add_rolling(t.series, S, C)


_LS = [f"sensor_{i}" for i in range(1, 5)]


@query("E3_rolling_lines", KEY, _rolling_names(_LS, features.WINDOWS, *_R), _rolling_sql("l", _LS, features.WINDOWS, *_R), "l", digits=5)
def _(t: Tables):
    return features.add_rolling(t.lines, _LS, C)


_SAMPLED = (
    "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY unit_number ORDER BY "
    "md5(unit_number || ':' || time_cycles || ':42'), time_cycles) AS rk, count(*) OVER (PARTITION BY unit_number) AS n FROM u) "
    "WHERE rk <= round_even(n * CAST(0.6 AS DOUBLE), 0))"
)


@query("E3_rolling_of_sampled_rows", KEY, _rolling_names(S, (5,), *_R), _rolling_sql(_SAMPLED, S, (5,), *_R), "u")
def _(t: Tables):
    # cycles are no longer contiguous: row positions are counted
    return features.add_rolling(splits.unit_sample(t.series, C), S, C.but(contiguous=False), (5,))


_R4 = ("{c}_roll_mean", "{c}_roll_std")


@query("E4_short_rolling", KEY, _rolling_names(S, (5,), *_R4), _rolling_sql("u", S, (5,), *_R4), "u")
def _(t: Tables):
    return features.add_short_rolling(t.series, S, C)


_R5 = ("{c}_roll_mean_{w}", "{c}_roll_std_{w}")


@query(
    "E5_differences_and_rolling",
    KEY,
    ["sensor_1_diff", *_rolling_names(["sensor_1"], (5,), *_R5)],
    _rolling_sql("u", ["sensor_1"], (5,), *_R5, extra="coalesce(sensor_1 - lag(sensor_1) OVER (PARTITION BY unit_number ORDER BY time_cycles), 0) AS sensor_1_diff, "),
    "u",
)
def _(t: Tables):
    return features.add_differences_and_rolling(t.series, ["sensor_1"], C)


_RUN = "avg({c}) OVER w AS {c}_cummean, coalesce(stddev_samp({c}) OVER w, 0) AS {c}_cumstd"


@query("E6_running", KEY, [f"{c}_{k}" for c in S for k in ("diff", "cummean", "cumstd")], "SELECT unit_number, time_cycles, " + ", ".join(f"coalesce({c} - lag({c}) OVER w, 0) AS {c}_diff, {_RUN.format(c=c)}" for c in S) + f" FROM u {_W}", "u")
def _(t: Tables):
    return features.add_running(t.series, S, C)


@query("E6_running_lines", KEY, [f"{c}_{k}" for c in _LS for k in ("cummean", "cumstd")], "SELECT unit_number, time_cycles, " + ", ".join(_RUN.format(c=c) for c in _LS) + f" FROM l {_W}", "l", digits=5)
def _(t: Tables):
    return features.add_running(t.lines, _LS, C, differences=False)


def _crossover_sql() -> str:
    inner = ", ".join(f"avg(sensor_1) OVER (PARTITION BY unit_number ORDER BY time_cycles ROWS {w - 1} PRECEDING) AS m{w}" for w in (5, 10, 20))
    outer = ", ".join(
        f"CASE WHEN n >= {b} AND m{a} > m{b} AND lag(m{a} <= m{b}) OVER w THEN 1 ELSE 0 END AS sensor_1_cross_{a}_{b}"
        for a, b in ((5, 10), (5, 20), (10, 20))
    )
    return f"SELECT unit_number, time_cycles, {outer} FROM (SELECT *, count(*) OVER (PARTITION BY unit_number) AS n, {inner} FROM u) {_W}"


@query("E7_crossovers", [*KEY, "sensor_1_cross_5_10", "sensor_1_cross_5_20", "sensor_1_cross_10_20"], (), _crossover_sql(), "u")
def _(t: Tables):
    return features.add_crossovers(t.series, ["sensor_1"], C)


@query("E8_row_positions", [*KEY, "row_in_unit", "unit_rows"], (), "SELECT unit_number, time_cycles, row_number() OVER w AS row_in_unit, count(*) OVER (PARTITION BY unit_number) AS unit_rows FROM " + _SAMPLED + " " + _W, "u")
def _(t: Tables):
    return features.row_positions(splits.unit_sample(t.series, C), C.but(contiguous=False))


@query("E9_sequences", ["unit_number", "end_cycle"], ["first_1", "last_2", "total", "target"], """SELECT unit_number, time_cycles AS end_cycle,
  xs[1] AS first_1, ys[4] AS last_2, list_sum(xs) + list_sum(ys) AS total, sensor_1 AS target FROM (
  SELECT *, list(sensor_1) OVER f AS xs, list(sensor_2) OVER f AS ys FROM u
  WINDOW f AS (PARTITION BY unit_number ORDER BY time_cycles ROWS 3 PRECEDING)) WHERE len(xs) = 4 AND (time_cycles - 4) % 3 = 0""", "u")
def _(t: Tables):
    seq = features.sequences(t.series, 4, S, "sensor_1", C, step=3)
    flat = F.aggregate(F.flatten("sequence"), F.lit(0.0), lambda acc, v: acc + v)
    return seq.select(
        "unit_number", "end_cycle", F.col("sequence")[0][0].alias("first_1"), F.col("sequence")[3][1].alias("last_2"), flat.alias("total"), "target"
    )


@query("E10_last_observation", ["unit_number", "time_cycles", "true_stage"], S, "SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY unit_number ORDER BY time_cycles DESC) = 1", "p")
def _(t: Tables):
    return reports.last_observation(t.labelled, ["true_stage", *S], C)


# --- F, G: sorting, top-k, set operations ------------------------------------------------------


@query("F1_sorted_series", KEY, S, "SELECT * FROM u ORDER BY unit_number, time_cycles", "u")
def _(t: Tables):
    return t.series.orderBy(*KEY)


@query("F2_top_units", ["unit_number"], ["mean_score"], "SELECT unit_number, avg(sensor_1) AS mean_score FROM u GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10", "u")
def _(t: Tables):
    return risk.top_units(t.series, "sensor_1", C, 10)


@query("F4_every_nth_unit", ["unit_number"], (), "SELECT unit_number FROM (SELECT unit_number, row_number() OVER (ORDER BY unit_number) AS k FROM (SELECT DISTINCT unit_number FROM u)) WHERE (k - 1) % 7 = 0", "u")
def _(t: Tables):
    return reports.every_nth_unit(t.series, C, 7)


@query("G1_union_of_series", ["source", "n"], ["total"], "SELECT source, count(*) AS n, sum(coalesce(sensor_4, 0) + sensor_1) AS total FROM (SELECT 'events' AS source, sensor_1, NULL AS sensor_4 FROM u UNION ALL SELECT 'lines', l_quantity, l_tax FROM lineitem) GROUP BY 1", "u", digits=3)
def _(t: Tables):
    both = t.series.withColumn("source", F.lit("events")).unionByName(t.lines.withColumn("source", F.lit("lines")), allowMissingColumns=True)
    return both.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("sensor_4", F.lit(0.0)) + F.col("sensor_1")).alias("total"))


@query("G2_side_by_side_features", KEY, ["sensor_1", "a", "b"], "SELECT unit_number, time_cycles, sensor_1, sensor_1 * 2 AS a, sensor_2 + 1 AS b FROM u", "u")
def _(t: Tables):
    return t.series.select("*", (F.col("sensor_1") * 2).alias("a"), (F.col("sensor_2") + 1).alias("b"))


# --- H: expressions ----------------------------------------------------------------------------


@query("H1_polynomials", KEY, ["sensor_1_pow2", "sensor_1_x_sensor_2", "sensor_2_pow2", "sensor_1_pow2_x_sensor_2"], f"SELECT unit_number, time_cycles, a * a AS sensor_1_pow2, a * b AS sensor_1_x_sensor_2, b * b AS sensor_2_pow2, a * a * b AS sensor_1_pow2_x_sensor_2 FROM (SELECT unit_number, time_cycles, coalesce(sensor_1, 0) AS a, coalesce(sensor_2, 0) AS b FROM {_HOLES_SQL})", "u", digits=4)
def _(t: Tables):
    return features.add_polynomials(_holes(t.series), S, 3)


@query("H2_ratios", KEY, ["ratio_sensor_1_sensor_2", "ratio_sensor_1_setting_1", "ratio_sensor_2_setting_1"], "SELECT unit_number, time_cycles, coalesce(sensor_1 / nullif(sensor_2, 0), 0) AS ratio_sensor_1_sensor_2, coalesce(sensor_1 / nullif(setting_1, 0), 0) AS ratio_sensor_1_setting_1, coalesce(sensor_2 / nullif(setting_1, 0), 0) AS ratio_sensor_2_setting_1 FROM u", "u")
def _(t: Tables):
    return features.add_ratios(t.series, ["sensor_1", "sensor_2", "setting_1"])


def _logits() -> Column:
    return F.array(F.col("sensor_1") / 50, F.col("sensor_2") / 50, F.lit(1.0))


@query("H3_softmax", KEY, ["p0", "p1", "p2"], "SELECT unit_number, time_cycles, a / (a + b + c) AS p0, b / (a + b + c) AS p1, c / (a + b + c) AS p2 FROM (SELECT *, exp(sensor_1 / 50) AS a, exp(sensor_2 / 50) AS b, exp(1) AS c FROM u)", "u")
def _(t: Tables):
    p = t.series.withColumn("p", fx.softmax(_logits()))
    return p.select(*KEY, *[F.col("p")[i].alias(f"p{i}") for i in range(3)])


@query("H4_clip", KEY, ["clipped", "nonnegative"], f"SELECT unit_number, time_cycles, CASE WHEN sensor_1 IS NOT NULL THEN greatest(least(sensor_1, 80), 10) END AS clipped, greatest(0, coalesce(sensor_1, 0) - 40) AS nonnegative FROM {_HOLES_SQL}", "u")
def _(t: Tables):
    from wearcurve.functions.risk import _nonnegative

    x = F.col("sensor_1")
    return _holes(t.series).select(*KEY, fx.clip(x, 10.0, 80.0).alias("clipped"), _nonnegative(F.coalesce(x, F.lit(0.0)) - 40).alias("nonnegative"))


@query("H5_min_max", KEY, ["scaled", "flat"], "SELECT unit_number, time_cycles, (sensor_1 - (SELECT min(sensor_1) FROM u)) / (SELECT max(sensor_1) - min(sensor_1) FROM u) AS scaled, 0.5 AS flat FROM u", "u")
def _(t: Tables):
    ends = t.series.agg(F.struct(F.min("sensor_1").alias("lo"), F.max("sensor_1").alias("hi"))).scalar()
    return t.series.select(
        *KEY,
        fx.min_max(F.col("sensor_1"), ends.getField("lo"), ends.getField("hi")).alias("scaled"),
        fx.min_max(F.lit(3.0), F.lit(3.0), F.lit(3.0)).alias("flat"),
    )


@query("H6_rul_stages", [*KEY, "true_stage"], (), "SELECT * FROM st", "p")
def _(t: Tables):
    return labels.rul_stages(labels.train_rul(t.series, C), C)


@query("H7_params_as_json", ["unit_number", "params", "depth", "trees"], (), """SELECT unit_number, '{"max_depth":' || CAST(d AS VARCHAR) || ',"n_estimators":' || CAST(n AS VARCHAR) || '}' AS params, d AS depth, n AS trees
  FROM (SELECT unit_number, CAST(max(time_cycles) AS INT) AS d, CAST(max(sensor_2) AS INT) AS n FROM u GROUP BY 1)""", "u")
def _(t: Tables):
    params = F.struct(F.max("time_cycles").alias("max_depth"), F.max("sensor_2").cast("int").alias("n_estimators"))
    coded = t.series.groupBy("unit_number").agg(F.to_json(params).alias("params"))
    back = F.from_json("params", "max_depth int, n_estimators int")
    return coded.withColumn("_p", back).select("unit_number", "params", F.col("_p.max_depth").alias("depth"), F.col("_p.n_estimators").alias("trees"))


# --- L: splits and samples ---------------------------------------------------------------------


@query("L1_validation_split", [*KEY, "part"], (), "SELECT unit_number, time_cycles, CASE WHEN row_number() OVER w <= floor(count(*) OVER (PARTITION BY unit_number) * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'validation' END AS part FROM u " + _W, "u")
def _(t: Tables):
    return splits.validation_split(t.series, C)


_UNIT_RANK = "(SELECT unit_number, row_number() OVER (ORDER BY md5(unit_number || ':42'), unit_number) AS rk, count(*) OVER () AS n FROM (SELECT DISTINCT unit_number FROM u))"


@query("L2_unit_folds", [*KEY, "fold"], (), f"SELECT unit_number, time_cycles, CAST((rk - 1) % 5 AS INT) AS fold FROM u JOIN {_UNIT_RANK} USING (unit_number)", "u")
def _(t: Tables):
    return splits.unit_folds(t.series, C)


@query("L3_time_series_splits", [*KEY, "split", "role"], (), """SELECT unit_number, time_cycles, CAST(i AS INT) AS split, CASE WHEN time_cycles <= n - (5 - i) * sz THEN 'train' ELSE 'test' END AS role
  FROM (SELECT *, count(*) OVER (PARTITION BY unit_number) AS n, count(*) OVER (PARTITION BY unit_number) // 6 AS sz FROM u), range(5) g(i)
  WHERE time_cycles <= n - (5 - i) * sz + sz""", "u")
def _(t: Tables):
    return splits.time_series_splits(t.series, C, 5)


@query("L4_unit_holdout", [*KEY, "part"], (), f"SELECT unit_number, time_cycles, CASE WHEN rk <= ceil(n * CAST(0.2 AS DOUBLE)) THEN 'test' ELSE 'train' END AS part FROM u JOIN {_UNIT_RANK} USING (unit_number)", "u")
def _(t: Tables):
    return splits.unit_holdout(t.series, C)


@query("L4_unit_holdout_of_sampled_units", [*KEY, "part"], (), f"SELECT unit_number, time_cycles, CASE WHEN rk <= ceil(least(n, 40) * CAST(0.2 AS DOUBLE)) THEN 'test' ELSE 'train' END AS part FROM u JOIN {_UNIT_RANK} USING (unit_number) WHERE rk <= 40", "u")
def _(t: Tables):
    return splits.unit_holdout(t.series, C, sample_units=40)


@query("L5_unit_sample", KEY, ["sensor_1"], "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY unit_number ORDER BY md5(unit_number || ':' || time_cycles || ':42'), time_cycles) AS rk, count(*) OVER (PARTITION BY unit_number) AS n FROM u) WHERE rk <= round_even(n * CAST(0.6 AS DOUBLE), 0)", "u")
def _(t: Tables):
    return splits.unit_sample(t.series, C)


@query("L6_stratified_split", [*KEY, "true_stage", "part"], (), "SELECT unit_number, time_cycles, true_stage, CASE WHEN rk <= round_even(n * CAST(0.2 AS DOUBLE), 0) THEN 'validation' ELSE 'train' END AS part FROM (SELECT *, row_number() OVER (PARTITION BY true_stage ORDER BY md5(unit_number || ':' || time_cycles || ':42'), unit_number, time_cycles) AS rk, count(*) OVER (PARTITION BY true_stage) AS n FROM p)", "p")
def _(t: Tables):
    return splits.stratified_split(t.labelled, "true_stage", KEY)


@query("L7_row_sample", KEY, ["sensor_1"], "SELECT * FROM u ORDER BY md5(unit_number || ':' || time_cycles || ':42'), unit_number, time_cycles LIMIT 500", "u")
def _(t: Tables):
    return splits.row_sample(t.series, 500, KEY)


_POISSON_SQL = """WITH b AS (SELECT unit_number, time_cycles, sensor_1 * (SELECT count(*) FROM u) / (SELECT sum(sensor_1) FROM u) AS m,
    ('0x' || substr(md5(unit_number || ':' || time_cycles || ':42'), 1, 13))::BIGINT / pow(16, 13) AS x FROM u),
  c AS (SELECT unit_number, time_cycles, x, sum(exp(j * ln(m) - lgamma(j + 1) - m)) OVER (PARTITION BY unit_number, time_cycles ORDER BY j) AS c
    FROM b, range(0, 400) g(j) WHERE j <= 16 + 8 * ceil(m))
  SELECT unit_number, time_cycles, CAST(count(*) FILTER (WHERE c <= x) AS INT) AS draws FROM c GROUP BY 1, 2 HAVING draws > 0"""


@query("L8_poisson_bootstrap", [*KEY, "draws"], (), _POISSON_SQL, "u")
def _(t: Tables):
    return splits.poisson_bootstrap(t.series, "sensor_1", KEY)


@query("L8_weighted_bootstrap", [*KEY, "draws"], (), _POISSON_SQL, "u")
def _(t: Tables):
    return splits.poisson_bootstrap(t.series, "sensor_1", KEY)


@query("L8_weighted_shares", ["unit_number", "near_share"], ["total"], "SELECT unit_number, true AS near_share, (SELECT count(*) FROM u) AS total FROM u GROUP BY 1", "u")
def _(t: Tables):
    drawn = t.series.join(splits.weighted_bootstrap(t.series, "sensor_1", KEY).select(*KEY, "draws"), KEY, "left")
    sums = drawn.groupBy("unit_number").agg(F.coalesce(F.sum("draws"), F.lit(0)).alias("draws"), F.sum("sensor_1").alias("w"))
    every = sums.agg(F.sum("draws").alias("total"), F.sum("w").alias("w")).select(F.struct("*")).scalar()
    share = F.col("w") / F.col("_all.w")
    n = F.col("_all.total")
    # five standard deviations of a binomial count
    near = F.abs(F.col("draws") - n * share) <= 5 * F.sqrt(n * share * (1 - share)) + 1
    return sums.withColumn("_all", every).select("unit_number", near.alias("near_share"), n.alias("total"))


@query("L8_weighted_draws", [*KEY, "draws"])
def _(t: Tables):
    return splits.weighted_bootstrap(t.series, "sensor_1", KEY).select(*KEY, "draws")


# --- M1 ----------------------------------------------------------------------------------------

_PREP_SQL = """SELECT unit_number, time_cycles, remaining_cycles, RUL_quartile, cycle_ratio, normalized_RUL,
    (c1 - (SELECT min(sensor_1) FROM u)) / (SELECT max(sensor_1) - min(sensor_1) FROM u) AS sensor_1,
    (c2 - (SELECT min(sensor_2) FROM u)) / (SELECT max(sensor_2) - min(sensor_2) FROM u) AS sensor_2,
    (setting_1 - (SELECT min(setting_1) FROM u)) / (SELECT max(setting_1) - min(setting_1) FROM u) AS setting_1,
    coalesce(c1 - lag(c1) OVER w, 0) AS sensor_1_diff,
    avg(c1) OVER f AS sensor_1_roll_mean_5, coalesce(stddev_samp(c1) OVER f, 0) AS sensor_1_roll_std_5
  FROM (SELECT r.*, RUL AS remaining_cycles, time_cycles / max(time_cycles) OVER (PARTITION BY unit_number) AS cycle_ratio,
      RUL / (SELECT max(RUL) FROM r) AS normalized_RUL,
      CASE WHEN RUL <= q[1] THEN 0 WHEN RUL <= q[2] THEN 1 WHEN RUL <= q[3] THEN 2 ELSE 3 END AS RUL_quartile,
      greatest(least(sensor_1, m1 + 5 * d1), m1 - 5 * d1) AS c1, greatest(least(sensor_2, m2 + 5 * d2), m2 - 5 * d2) AS c2
    FROM r, (SELECT quantile_cont(RUL, [0.25, 0.5, 0.75]) AS q, avg(sensor_1) AS m1, stddev_samp(sensor_1) AS d1,
      avg(sensor_2) AS m2, stddev_samp(sensor_2) AS d2 FROM r))
  WINDOW w AS (PARTITION BY unit_number ORDER BY time_cycles), f AS (PARTITION BY unit_number ORDER BY time_cycles ROWS 4 PRECEDING)"""


@query(
    "M1_preparation",
    [*KEY, "remaining_cycles", "RUL_quartile"],
    ["cycle_ratio", "normalized_RUL", "setting_1", *S, "sensor_1_diff", "sensor_1_roll_mean_5", "sensor_1_roll_std_5"],
    _PREP_SQL,
    "p",
)
def _(t: Tables):
    train = t.labelled.select(*KEY, "setting_1", *S, "RUL")
    return preparation.Preparation(train, C).transform(train)


@query("quantiles_of_all_columns", ["column", "prob"], ["value"], " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({p} AS DOUBLE) AS prob, quantile_cont({c}, {p}) AS value FROM u" for c in S for p in ("0.0", "0.1", "0.37", "0.5", "0.99", "1.0")), "u")
def _(t: Tables):
    return exact_percentiles(t.series, S, [0.0, 0.1, 0.37, 0.5, 0.99, 1.0])
