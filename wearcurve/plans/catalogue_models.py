"""Queries over feature selection, balancing, clustering, learners and the phases that use them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearcurve.layout import CONTIGUOUS as C
from wearcurve.operators import balance, clustering, features, information, labels, metrics, models, selection, splits
from wearcurve.plans import phases
from wearcurve.plans.catalogue_series import _UNIT_RANK
from wearcurve.plans.registry import query
from wearcurve.plans.staged import Tables
from wearcurve.sources import tables as tb

KEY = ["unit_number", "time_cycles"]
S = ["sensor_1", "sensor_2"]
X = ["time_cycles", *S]
TARGET = "time_to_next_stage"

# --- I1..I4: feature scores --------------------------------------------------------------------


def _corr_sql(names: list[str], wrap: str = "{}") -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, {wrap.format(f'corr({c}, {TARGET})')} AS score FROM p" for c in names)


@query("I1_correlations", ["feature"], ["score"], _corr_sql(["setting_1", *S]), "p")
def _(t: Tables):
    return selection.correlations(t.labelled, ["setting_1", *S], TARGET)


_ROLL = ", ".join(
    f"coalesce({c} - lag({c}) OVER w, 0) AS {c}_diff, avg({c}) OVER f AS {c}_roll_mean_5, coalesce(stddev_samp({c}) OVER f, 0) AS {c}_roll_std_5"
    for c in S
)
_ENRICHED = f"(SELECT *, {_ROLL} FROM p WINDOW w AS (PARTITION BY unit_number ORDER BY time_cycles), f AS (PARTITION BY unit_number ORDER BY time_cycles ROWS 4 PRECEDING))"
_ENRICHED_COLUMNS = [*S, *[f"{c}_{k}" for c in S for k in ("diff", "roll_mean_5", "roll_std_5")]]


def _enriched(t: Tables) -> DataFrame:
    return features.add_differences_and_rolling(t.labelled, S, C)


@query(
    "I2_important_features",
    ["feature"],
    ["score"],
    "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, abs(corr({c}, {TARGET})) AS score FROM {_ENRICHED}" for c in _ENRICHED_COLUMNS) + ") ORDER BY score DESC, feature LIMIT 5",
    "p",
)
def _(t: Tables):
    return selection.important_features(_enriched(t), TARGET, "correlation", 5)


@query(
    "F3_top_correlated_sensors",
    ["feature"],
    ["score"],
    "SELECT * FROM (" + " UNION ALL ".join(f"SELECT 'sensor_{i}' AS feature, corr(sensor_{i}, n - time_cycles) AS score FROM (SELECT *, max(time_cycles) OVER (PARTITION BY unit_number) AS n FROM l)" for i in range(1, 5)) + ") ORDER BY score DESC LIMIT 3",
    "l",
)
def _(t: Tables):
    rows = labels.train_rul(t.lines, C)
    return selection.top_features(selection.correlations(rows, features.sensors(rows)), 3)


def _anova_sql(names: list[str], label: str, table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, coalesce((sum(n * pow(m - g, 2)) / (count(*) - 1)) / nullif(sum(n * v) / (sum(n) - count(*)), 0), 0) AS score FROM "
        f"(SELECT {label}, count({c}) AS n, avg({c}) AS m, var_pop({c}) AS v, (SELECT avg({c}) FROM {table}) AS g FROM {table} GROUP BY {label})"
        for c in names
    )


@query("I3_anova", ["feature"], ["score"], _anova_sql(_ENRICHED_COLUMNS, "true_stage", _ENRICHED), "p", digits=4)
def _(t: Tables):
    return selection.anova_f(_enriched(t), _ENRICHED_COLUMNS, "true_stage")


@query("I3_anova_of_embeddings", ["feature"], ["score"], _anova_sql([f"x{j}" for j in range(64)], "label", "(SELECT label, " + ", ".join(f"embedding[{j + 1}]::DOUBLE AS x{j}" for j in range(64)) + " FROM embeddings)"), digits=4)
def _(t: Tables):
    wide = t.source("embeddings").select("label", *[F.col("embedding")[j].cast("double").alias(f"x{j}") for j in range(64)])
    return selection.anova_f(wide, [f"x{j}" for j in range(64)], "label")


@query("I3_select_k_best", ["feature"], ["score"], f"SELECT * FROM ({_anova_sql(_ENRICHED_COLUMNS, 'true_stage', _ENRICHED)}) ORDER BY score DESC, feature LIMIT 3", "p", digits=4)
def _(t: Tables):
    return selection.select_k_best(_enriched(t), _ENRICHED_COLUMNS, "true_stage", 3)


_TENTHS = "[" + ", ".join(f"{i / 10}" for i in range(1, 10)) + "]"


def _bin_sql(c: str) -> str:
    return f"len(list_filter((SELECT list_distinct(quantile_cont({c}, {_TENTHS})) FROM p), lambda e: e <= {c}))"


def _mi_sql(names: list[str], y: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, greatest(sum(n / tt * ln(n * tt / (nx * ny))), 0) AS score FROM (SELECT n, sum(n) OVER (PARTITION BY x) AS nx, sum(n) OVER (PARTITION BY y) AS ny, sum(n) OVER () AS tt FROM (SELECT {_bin_sql(c)} AS x, {y} AS y, count(*)::DOUBLE AS n FROM p GROUP BY 1, 2))"
        for c in names
    )


@query("I4_mutual_information", ["feature"], ["score"], _mi_sql(["time_cycles", *S], _bin_sql("RUL")), "p")
def _(t: Tables):
    return selection.mutual_information(t.labelled, X, "RUL")


@query("I4_mutual_information_with_class", ["feature"], ["score"], _mi_sql(["time_cycles", *S], "true_stage"), "p")
def _(t: Tables):
    return selection.mutual_information(t.labelled, X, "true_stage", discrete_target=True)


def _psi_sql(n: str) -> str:
    """The digamma function of a whole number, by its series from 16 more on."""
    return f"(ln({n} + 16.0::DOUBLE) - 0.5 / ({n} + 16.0::DOUBLE) - 1 / (12 * pow({n} + 16.0::DOUBLE, 2)) + 1 / (120 * pow({n} + 16.0::DOUBLE, 4)) - list_sum([1.0::DOUBLE / ({n} + i) FOR i IN range(16)]))"


def _nudged_sql(c: str) -> str:
    unit = f"(SELECT CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1 END FROM p)"
    size = f"(SELECT pow(2, floor(log2(1e-10::DOUBLE * greatest(1, avg(abs({c})) / {unit})))) FROM p)"
    return f"{c} / {unit} + {size} * (('0x' || substr(md5(unit_number || ':' || time_cycles || ':{c}:42'), 1, 13))::BIGINT / pow(16, 13))"


def _pairs_sql(names: list[str], y: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST(unit_number AS BIGINT) * 100000 + time_cycles AS id, {_nudged_sql(c)} AS x, {y} AS y FROM p" for c in names)


def _inside_sql(v: str) -> str:
    return f"(SELECT a.feature, a.id, count(*) AS m FROM r a JOIN r b ON a.feature = b.feature AND b.{v} < a.{v} + a.r AND b.{v} > a.{v} - a.r GROUP BY 1, 2)"


_STEPS = ", ".join(f"abs(x - {f}(x, {j}) OVER o)" for j in (1, 2, 3) for f in ("lag", "lead"))
_CLASS_MI_SQL = f"""
  WITH z AS ({_pairs_sql(X, "true_stage")}),
  g AS (SELECT *, count(*) OVER (PARTITION BY feature, y) AS n, list_sort(list_filter([{_STEPS}], lambda e: e IS NOT NULL)) AS near FROM z WINDOW o AS (PARTITION BY feature, y ORDER BY x)),
  r AS (SELECT *, least(3, n - 1) AS k, near[least(3, n - 1)] AS r FROM g WHERE n > 1)
  SELECT feature, greatest(0, {_psi_sql("count(*)")} + avg({_psi_sql("k")} - {_psi_sql("n")} - {_psi_sql("m")})) AS score
  FROM r JOIN {_inside_sql("x")} USING (feature, id) GROUP BY 1"""
_NUMBER_MI_SQL = f"""
  WITH z AS MATERIALIZED ({_pairs_sql(S, _nudged_sql("RUL"))}),
  r AS MATERIALIZED (SELECT a.feature, a.id, any_value(a.x) AS x, any_value(a.y) AS y, list_max(min(greatest(abs(a.x - b.x), abs(a.y - b.y)), 3)) AS r
    FROM z a JOIN z b ON a.feature = b.feature AND a.id <> b.id GROUP BY 1, 2)
  SELECT feature, greatest(0, {_psi_sql("count(*)")} + {_psi_sql("3")} - avg({_psi_sql("mx.m")}) - avg({_psi_sql("my.m")})) AS score
  FROM {_inside_sql("x")} mx JOIN {_inside_sql("y")} my USING (feature, id) GROUP BY 1"""


@query("I4_neighbour_information_with_class", ["feature"], ["score"], _CLASS_MI_SQL, "p", digits=4)
def _(t: Tables):
    return information.neighbour_information(t.labelled, X, "true_stage", KEY, discrete_target=True)


@query("I4_neighbour_information", ["feature"], ["score"], _NUMBER_MI_SQL, "p", digits=4)
def _(t: Tables):
    return information.neighbour_information(t.labelled, S, "RUL", KEY)



# --- I5: over-sampling -------------------------------------------------------------------------

_SMOTE_SQL = """
  WITH b AS (SELECT CAST(unit_number AS BIGINT) * 1000 + time_cycles AS k, CASE WHEN sensor_1 > 30 THEN 1 ELSE 0 END AS y, sensor_1 AS x1, sensor_2 AS x2 FROM p),
  c AS (SELECT y, count(*) AS n, max(count(*)) OVER () - count(*) AS need FROM b GROUP BY 1),
  mi AS (SELECT b.*, n, need, row_number() OVER (PARTITION BY y ORDER BY md5(k || ':42'), k) AS rk FROM b JOIN c USING (y) WHERE need > 0),
  nb AS (SELECT k, list(k2 ORDER BY d, k2) AS near FROM (
      SELECT a.k, o.k AS k2, pow(a.x1 - o.x1, 2) + pow(a.x2 - o.x2, 2) AS d,
        row_number() OVER (PARTITION BY a.k ORDER BY pow(a.x1 - o.x1, 2) + pow(a.x2 - o.x2, 2), o.k) AS r
      FROM mi a JOIN mi o ON a.y = o.y AND a.k <> o.k) WHERE r <= 5 GROUP BY 1),
  e AS (SELECT mi.*, unnest(range(1, need // n + CASE WHEN rk <= need % n THEN 2 ELSE 1 END)) AS copy FROM mi),
  h AS (SELECT e.*, md5(k || ':' || copy || ':42') AS h FROM e),
  g AS (SELECT h.k, h.y, h.x1, h.x2, h.copy, nb.near[('0x' || substr(h, 1, 8))::BIGINT % len(nb.near) + 1] AS near,
      ('0x' || substr(h, 9, 13))::BIGINT / pow(16, 13) AS u FROM h JOIN nb USING (k))
  SELECT k, y, 0 AS copy, NULL AS near, x1, x2 FROM b
  UNION ALL SELECT g.k, g.y, CAST(g.copy AS INT), g.near, g.x1 + g.u * (o.x1 - g.x1), g.x2 + g.u * (o.x2 - g.x2) FROM g JOIN b o ON o.k = g.near"""


def _two_classes(t: Tables) -> DataFrame:
    key = F.col("unit_number").cast("long") * 1000 + F.col("time_cycles")
    return t.labelled.select(key.alias("k"), F.when(F.col("sensor_1") > 30, 1).otherwise(0).alias("y"), F.array(*S).alias("x"))


@query("I5_oversample", ["k", "y", "copy", "near"], ["x1", "x2"], _SMOTE_SQL, "p")
def _(t: Tables):
    more = balance.oversample(_two_classes(t), "x", "y", "k")
    return more.select("k", "y", "copy", "near", F.col("x")[0].alias("x1"), F.col("x")[1].alias("x2"))


@query("I5_oversample_counts", ["quality", "n"], (), "SELECT quality, max(count(*)) OVER () AS n FROM labels JOIN documents USING (doc_id) GROUP BY 1")
def _(t: Tables):
    rows = t.source("labels").join(t.source("documents").select("doc_id", "n_chars"), "doc_id")
    packed = rows.select("doc_id", "quality", F.array(F.col("n_chars").cast("double"), F.col("toxic").cast("double")).alias("x"))
    return balance.oversample(packed, "x", "quality", "doc_id").groupBy("quality").agg(F.count(F.lit(1)).alias("n"))


# --- I6, I7: clustering ------------------------------------------------------------------------


@query("I6_clusters_of_units", ["unit_number", "n", "clusters", "first_cluster"], (), "SELECT unit_number, count(*) AS n, 5::BIGINT AS clusters, 0 AS first_cluster FROM p GROUP BY 1", "p")
def _(t: Tables):
    rows = clustering.cluster_units(t.series, X, C)
    return rows.groupBy("unit_number").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("cluster").alias("clusters"),
        # labels are numbered by first row
        F.min_by("cluster", "time_cycles").alias("first_cluster"),
    )


@query("I6_merge_trees", ["unit_number", "merges", "falls"], (), "SELECT unit_number, count(*) - 5 AS merges, 0::BIGINT AS falls FROM p GROUP BY 1", "p")
def _(t: Tables):
    tree = clustering.dendrograms(t.series, X, C, linkage="average", metric="manhattan")
    heights = tree.groupBy("unit_number").agg(F.sort_array(F.collect_list(F.struct("step", "height"))).alias("h"))
    falls = F.filter(
        F.zip_with(F.slice("h", 2, F.greatest(F.size("h") - 1, F.lit(0))), F.slice("h", 1, F.greatest(F.size("h") - 1, F.lit(0))), lambda b, a: b["height"] < a["height"] - 1e-9),
        lambda x: x,
    )
    return heights.select("unit_number", F.size("h").cast("long").alias("merges"), F.size(falls).cast("long").alias("falls"))


# single linkage on one column leaves the widest gaps of the sorted values open
_GAPS = """SELECT unit_number, time_cycles, CAST(dense_rank() OVER (PARTITION BY unit_number ORDER BY first) - 1 AS INT) AS cluster FROM (
  SELECT unit_number, time_cycles, min(time_cycles) OVER (PARTITION BY unit_number, g) AS first FROM (
    SELECT *, sum(CASE WHEN rk <= 4 THEN 1 ELSE 0 END) OVER (PARTITION BY unit_number ORDER BY sensor_2, time_cycles ROWS UNBOUNDED PRECEDING) AS g FROM (
      SELECT *, row_number() OVER (PARTITION BY unit_number ORDER BY gap DESC NULLS LAST) AS rk FROM (
        SELECT *, sensor_2 - lag(sensor_2) OVER (PARTITION BY unit_number ORDER BY sensor_2, time_cycles) AS gap FROM l))))"""


@query("I6_cluster_labels", [*KEY, "cluster"], (), _GAPS, "l")
def _(t: Tables):
    return clustering.cluster_units(t.lines, ["sensor_2"], C, linkage="single")


# two units of many rows: all lines of every second supplier
_LONG = "(SELECT unit_number % 2 AS unit_number, CAST(time_cycles AS BIGINT) * 65536 + unit_number AS time_cycles, sensor_2 FROM l)"

# the widest gaps between different values, of equal ones those of later rows
_LONG_GAPS = f"""WITH x AS {_LONG}, v AS (SELECT unit_number, sensor_2, min(time_cycles) AS head FROM x GROUP BY 1, 2),
  g AS (SELECT *, sensor_2 - lag(sensor_2) OVER w AS gap, lag(head) OVER w AS before FROM v WINDOW w AS (PARTITION BY unit_number ORDER BY sensor_2)),
  k AS (SELECT *, row_number() OVER (PARTITION BY unit_number ORDER BY gap DESC NULLS LAST, least(head, before) DESC, greatest(head, before) DESC) AS rk FROM g),
  c AS (SELECT *, sum(CASE WHEN rk <= 4 THEN 1 ELSE 0 END) OVER (PARTITION BY unit_number ORDER BY sensor_2 ROWS UNBOUNDED PRECEDING) AS part FROM k),
  f AS (SELECT *, min(head) OVER (PARTITION BY unit_number, part) AS first FROM c)
  SELECT x.unit_number, x.time_cycles, CAST(dense_rank() OVER (PARTITION BY x.unit_number ORDER BY f.first) - 1 AS INT) AS cluster
  FROM x JOIN f USING (unit_number, sensor_2)"""


def _long_units(t: Tables) -> DataFrame:
    cycle = F.col("time_cycles").cast("long") * 65536 + F.col("unit_number")
    return t.lines.select((F.col("unit_number") % 2).alias("unit_number"), cycle.alias("time_cycles"), *[f"sensor_{i}" for i in range(1, 5)])


@query("I6_long_unit_labels", [*KEY, "cluster"], (), _LONG_GAPS, "l")
def _(t: Tables):
    return clustering.cluster_units(_long_units(t), ["sensor_2"], C.but(contiguous=False), linkage="single", max_rows=1000)


@query("I6_cluster_labels_of_sensors", [*KEY, "cluster"])
def _(t: Tables):
    return clustering.cluster_units(t.lines, [f"sensor_{i}" for i in range(1, 5)], C)


@query("I6_centroid_clusters", ["unit_number", "n", "clusters"], (), "SELECT unit_number, count(*) AS n, 5::BIGINT AS clusters FROM l GROUP BY 1", "l")
def _(t: Tables):
    rows = clustering.cluster_units(t.lines, [f"sensor_{i}" for i in range(1, 5)], C, method="centroid")
    return rows.groupBy("unit_number").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("cluster").alias("clusters"))


@query("I7_stage_order", ["unit_number", "cluster", "degradation_stage"], (), "SELECT unit_number, cluster, CAST(row_number() OVER (PARTITION BY unit_number ORDER BY avg(time_cycles), cluster) - 1 AS INT) AS degradation_stage FROM p GROUP BY 1, 2", "p")
def _(t: Tables):
    return clustering.order_stages(t.labelled, C).groupBy("unit_number", "cluster").agg(F.max("degradation_stage").alias("degradation_stage"))


# --- I8..I12: classifiers ----------------------------------------------------------------------


def _embedding_columns(t: Tables) -> DataFrame:
    return t.source("embeddings").select("vec_id", "label", *[F.col("embedding")[j].cast("double").alias(f"x{j}") for j in range(64)])


_EMB = [f"x{j}" for j in range(64)]


def _judged(scored: DataFrame) -> DataFrame:
    """Whether the class probabilities add up to 1 and the predicted class has the largest."""
    p = F.col("class_probability")
    total = F.aggregate(p, F.lit(0.0), lambda a, x: a + x)
    return scored.withColumns({"sums_to_one": F.abs(total - 1) < 1e-9, "is_likeliest": F.get(p, F.col("predicted")) == F.array_max(p)})


@query("I8_logistic_regression", ["vec_id", "label", "sums_to_one", "is_likeliest"], (), "SELECT vec_id, label, true AS sums_to_one, true AS is_likeliest FROM embeddings")
def _(t: Tables):
    rows = _embedding_columns(t)
    model = models.fit_classifier(rows, _EMB, "label", "logistic_regression", models.preset("logistic_regression", 1), ["vec_id"])
    return _judged(models.classify(model, rows, "predicted"))


@query("I8_logistic_optimum", ["label", "n", "balanced"], (), "SELECT label, count(*) AS n, true AS balanced FROM embeddings GROUP BY 1")
def _(t: Tables):
    # where the loss of a free intercept is least, the probabilities of a class add up to its rows
    rows = _embedding_columns(t)
    scored = models.classify(models.fit_classifier(rows, _EMB, "label", "logistic_regression", {"iterations": 1000}), rows, "predicted")
    each = scored.select("label", F.posexplode("class_probability").alias("k", "p"))
    sums = each.groupBy(F.col("k").alias("label")).agg(F.sum("p").alias("expected"), F.count_if(F.col("label") == F.col("k")).alias("n"))
    return sums.select("label", "n", (F.abs(F.col("expected") - F.col("n")) < 0.01 * F.col("n")).alias("balanced"))


@query("I9_random_forest", [*KEY, "true_stage", "sums_to_one", "is_likeliest"], (), "SELECT unit_number, time_cycles, true_stage, true AS sums_to_one, true AS is_likeliest FROM p", "p")
def _(t: Tables):
    rows = t.labelled.drop("predicted_stage")
    model = models.fit_classifier(rows, X, "true_stage", "random_forest", models.preset("random_forest", 1))
    return _judged(models.classify(model, rows, "predicted"))


@query("I10_feature_importance", ["model", "features", "positive"], ["total"], "SELECT * FROM (VALUES ('random_forest splits', 3::BIGINT, true, 1.0), ('random_forest impurity', 3::BIGINT, true, 1.0), ('logistic_regression impurity', 3::BIGINT, true, 1.0)) AS v(model, features, positive, total)")
def _(t: Tables):
    rows = t.labelled
    out = None
    for kind, how in (("random_forest", "splits"), ("random_forest", "impurity"), ("logistic_regression", "impurity")):
        model = models.fit_classifier(rows, X, "true_stage", kind, models.preset(kind, 1), KEY)
        one = models.feature_importance(model, X, how).agg(
            F.lit(f"{kind} {how}").alias("model"),
            F.countDistinct("feature").alias("features"),
            F.min(F.col("importance") >= 0).alias("positive"),
            F.sum("importance").alias("total"),
        )
        out = one if out is None else out.unionByName(one)
    return out


@query("I10_importance_values", ["model", "feature"], ["importance"])
def _(t: Tables):
    rows, out = t.labelled, None
    for kind, how in (("random_forest", "splits"), ("random_forest", "impurity"), ("logistic_regression", "impurity")):
        model = models.fit_classifier(rows, X, "true_stage", kind, models.preset(kind, 1), KEY)
        one = models.feature_importance(model, X, how).withColumn("model", F.lit(f"{kind} {how}"))
        out = one if out is None else out.unionByName(one)
    return out


@query("I11_hyper_parameter_search", ["params", "in_range"], (), """SELECT '{"max_depth": ' || d || ', "max_features": "' || f || '", "min_samples_split": ' || s || ', "n_estimators": ' || n || '}' AS params, true AS in_range
  FROM (VALUES (5), (10)) AS a(d), (VALUES ('sqrt'), ('log2')) AS b(f), (VALUES (5), (10)) AS c(s), (VALUES (50), (100)) AS e(n)""")
def _(t: Tables):
    rows = tb.materialize(splits.stratified_split(t.labelled, "true_stage", KEY), "search")
    scores = models.search_classifier(
        rows.where("part = 'train'"),
        rows.where("part = 'validation'"),
        X,
        "true_stage",
        KEY,
        tb.scratch_path(t.spark, "search-scores"),
        models.search_candidates(n=16),
    )
    return scores.select("params", F.col("score").between(0, 1).alias("in_range"))


@query("I12_presets", ["model", "dataset", "params"], (), """SELECT 'random_forest' AS model, d AS dataset, '{"max_depth": ' || m || ', "min_samples_split": ' || s || ', "n_estimators": ' || n || '}' AS params
  FROM (VALUES ('FD001', 10, 5, 50), ('FD002', 20, 10, 100), ('FD003', 12, 5, 50), ('FD004', 20, 5, 100)) AS v(d, m, s, n)
  UNION ALL SELECT 'logistic_regression', d, '{"class_weights": "balanced", "iterations": ' || i || ', "learning_rate": ' || r || '}'
  FROM (VALUES ('FD001', 1000, '0.01'), ('FD002', 500, '0.05'), ('FD003', 1000, '0.01'), ('FD004', 500, '0.05')) AS w(d, i, r)
  WHERE (SELECT count(*) FROM p) > 0""", "p")
def _(t: Tables):
    from wearcurve.sources.text import DATASETS

    found = t.labelled.select(F.lit(1)).limit(1)
    rows = [(kind, d, tb.params_key(models.preset(kind, d))) for kind in models.PRESETS for d in DATASETS]
    return found.select(F.explode(F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(r, ("model", "dataset", "params"))]) for r in rows])).alias("r")).select("r.*")


@query("A9_model_reload", ["n", "same"], (), "SELECT count(*) AS n, count(*) AS same FROM embeddings")
def _(t: Tables):
    from pyspark.ml import PipelineModel

    rows = _embedding_columns(t)
    model = models.fit_classifier(rows, _EMB, "label", "logistic_regression", models.preset("logistic_regression", 1), ["vec_id"])
    path = tb.scratch_path(t.spark, "model")
    model.write().overwrite().save(path)
    first = models.classify(model, rows, "a").select("vec_id", "a")
    second = models.classify(PipelineModel.load(path), rows, "b").select("vec_id", "b")
    return first.join(second, "vec_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("a") == F.col("b")).alias("same"))


# --- I13..I19: regressors ----------------------------------------------------------------------

_RIDGE_SQL = f"""SELECT w1, w2, my - w1 * m1 - w2 * m2 AS intercept FROM (
    SELECT *, (c1 * (v2 + 1) - c2 * v12) / ((v1 + 1) * (v2 + 1) - v12 * v12) AS w1, (c2 * (v1 + 1) - c1 * v12) / ((v1 + 1) * (v2 + 1) - v12 * v12) AS w2
    FROM (SELECT count(*) * var_pop(sensor_1) AS v1, count(*) * var_pop(sensor_2) AS v2, count(*) * covar_pop(sensor_1, sensor_2) AS v12,
      count(*) * covar_pop(sensor_1, {TARGET}) AS c1, count(*) * covar_pop(sensor_2, {TARGET}) AS c2,
      avg(sensor_1) AS m1, avg(sensor_2) AS m2, avg({TARGET}) AS my FROM p))"""


@query("I13_ridge_coefficients", (), ["w1", "w2", "intercept"], _RIDGE_SQL, "p")
def _(t: Tables):
    fitted = models.ridge_model(t.labelled, S, TARGET, 1.0).stages[-1]
    w = [float(c) for c in fitted.coefficients]
    # three fitted numbers beside the row count they came from
    return t.labelled.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(w[0]).alias("w1"), F.lit(w[1]).alias("w2"), F.lit(float(fitted.intercept)).alias("intercept")
    )


@query("I13_ridge_predictions", KEY, ["predicted"], f"SELECT unit_number, time_cycles, w1 * sensor_1 + w2 * sensor_2 + intercept AS predicted FROM p, ({_RIDGE_SQL})", "p")
def _(t: Tables):
    return models.fit_ridge(t.labelled, S, TARGET, 1.0).predict(t.labelled, "predicted")


def _beats_mean(t: Tables, model: models.Regressor) -> DataFrame:
    found = metrics.regression_metrics(model.predict(t.labelled, "_pred"), TARGET, "_pred", count=True)
    # the share of the mean's squared error that is left is 1 - r2
    return found.select("n", (F.col("r2") > 0).alias("beats_mean"))


_BEATS = "SELECT count(*) AS n, true AS beats_mean FROM p"


@query("I14_random_forest_regressor", ["n", "beats_mean"], (), _BEATS, "p")
def _(t: Tables):
    return _beats_mean(t, models.fit_forest(t.labelled, X, TARGET))


@query("I15_quantile_regression", ["n", "not_above_constant"], ["quantile"], f"SELECT q AS quantile, (SELECT count({TARGET}) FROM p) AS n, true AS not_above_constant FROM (VALUES (0.1), (0.5), (0.9)) AS v(q)", "p")
def _(t: Tables):
    out = None
    for q in (0.1, 0.5, 0.9):
        fitted = models.fit_quantile(t.labelled, X, TARGET, q, 0.0)
        constant = t.labelled.agg(F.percentile(TARGET, q)).scalar()
        rows = fitted.predict(t.labelled, "_pred").withColumn("_flat", constant)
        loss = lambda p, q=q: F.avg(F.when(F.col(TARGET) > F.col(p), (F.col(TARGET) - F.col(p)) * q).otherwise((F.col(p) - F.col(TARGET)) * (1 - q)))
        one = rows.agg(F.lit(q).alias("quantile"), F.count(TARGET).alias("n"), (loss("_pred") <= loss("_flat") + 1e-9).alias("not_above_constant"))
        out = one if out is None else out.unionByName(one)
    return out


@query("I16_prediction_interval", [*KEY, "ordered"], (), "SELECT unit_number, time_cycles, true AS ordered FROM p", "p")
def _(t: Tables):
    return models.fit_interval(t.labelled, X, TARGET)(t.labelled).withColumn("ordered", F.col("lower_bound") <= F.col("upper_bound"))


@query("I16_interval_bounds", KEY, ["lower_bound", "upper_bound"])
def _(t: Tables):
    return models.fit_interval(t.labelled, X, TARGET)(t.labelled)


@query("I17_gradient_boosting", ["n", "beats_mean"], (), _BEATS, "p")
def _(t: Tables):
    return _beats_mean(t, models.fit_boosting(t.labelled, X, TARGET))


_EDGES = "[" + ", ".join(repr(i / 256) for i in range(257)) + "]"


@query("I18_quantile_bins", [*KEY, "bin"], (), f"SELECT unit_number, time_cycles, CAST(greatest(least(len(list_filter(e, lambda v: v <= sensor_1)) - 1, len(e) - 2), 0) AS INT) AS bin FROM p, (SELECT list_distinct(quantile_cont(sensor_1, {_EDGES})) AS e FROM p)", "p")
def _(t: Tables):
    return models.quantile_bins(t.labelled, "sensor_1", 256)


_WEIGHT = "(1 / (avg(pow(pred_{m} - time_to_next_stage, 2)) + 1e-10))"
_WEIGHTS_SQL = f"(SELECT {_WEIGHT.format(m='a')} AS ia, {_WEIGHT.format(m='b')} AS ib FROM p)"


@query("I19_ensemble_weights", ["model"], ["weight"], f"SELECT 'a' AS model, ia / (ia + ib) AS weight FROM {_WEIGHTS_SQL} UNION ALL SELECT 'b', ib / (ia + ib) FROM {_WEIGHTS_SQL}", "p")
def _(t: Tables):
    return models.ensemble_weights(t.labelled, TARGET, ["a", "b"])


@query("I19_ensemble_prediction", KEY, ["pred_Ensemble"], f"SELECT unit_number, time_cycles, (ia * pred_a + ib * pred_b) / (ia + ib) AS \"pred_Ensemble\" FROM p, {_WEIGHTS_SQL}", "p")
def _(t: Tables):
    weights = models.ensemble_weights(t.labelled, TARGET, ["a", "b"])
    return models.add_ensemble(t.labelled, weights, ["a", "b"])


_TRACE = " + ".join(f"var_samp(embedding[{j + 1}]::DOUBLE)" for j in range(64))


@query("I20_principal_components", ["n", "falling"], ["total_variance"], f"SELECT count(*) AS n, true AS falling, {_TRACE} AS total_variance FROM embeddings")
def _(t: Tables):
    rows = models.principal_components(_embedding_columns(t), _EMB, 64, ["vec_id"])
    variances = rows.agg(F.count(F.lit(1)).alias("n"), F.array(*[F.var_samp(f"component_{i + 1}") for i in range(64)]).alias("v"))
    steps = F.zip_with(F.slice("v", 1, 63), F.slice("v", 2, 63), lambda a, b: a >= b - 1e-12)
    return variances.select("n", F.forall(steps, lambda s: s).alias("falling"), F.aggregate("v", F.lit(0.0), lambda a, x: a + x).alias("total_variance"))


# --- M2, M3, M4, M6: phases --------------------------------------------------------------------


@query("M2_stages", ["unit_number", "n", "stages"], (), "SELECT unit_number, count(*) AS n, 5::BIGINT AS stages FROM p GROUP BY 1", "p")
def _(t: Tables):
    staged = phases.derive_stages(t.labelled.select(*KEY, "setting_1", *S, "RUL"), C)
    return staged.rows.groupBy("unit_number").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("degradation_stage").alias("stages"))


@query("M2_stage_profiles", ["stages", "n"], (), "SELECT 5::BIGINT AS stages, count(*) AS n FROM p", "p")
def _(t: Tables):
    profiles = phases.derive_stages(t.labelled.select(*KEY, "setting_1", *S, "RUL"), C).profiles
    return profiles.agg(F.countDistinct("stage").alias("stages"), F.sum("n").alias("n"))


@query("M2_stage_profile_values", ["stage", "n"], ["w_time_cycles_mean", "w_sensor_1_mean", "w_sensor_2_mean"])
def _(t: Tables):
    return phases.derive_stages(t.labelled.select(*KEY, "setting_1", *S, "RUL"), C).profiles


@query("M2_stage_evaluation_by_fold", ["fold"], [*metrics.PERFORMANCE, *metrics.QUALITY])
def _(t: Tables):
    staged = phases.derive_stages(t.labelled.select(*KEY, "setting_1", *S, "RUL"), C)
    return phases.evaluate_stages(staged.rows, C.but(contiguous=False), folds=10)


@query("M3_classification", [*KEY, "degradation_stage", "sums_to_one", "is_likeliest"], (), f"SELECT unit_number, time_cycles, true_stage AS degradation_stage, true AS sums_to_one, true AS is_likeliest FROM p JOIN {_UNIT_RANK} USING (unit_number) WHERE rk <= ceil(n * CAST(0.2 AS DOUBLE))", "p")
def _(t: Tables):
    rows = t.labelled.select(*KEY, "setting_1", *S, F.col("true_stage").alias("degradation_stage"))
    return _judged(phases.classify_stages(rows, C).test.withColumn("predicted", F.col("predicted_stage")))


@query("M4_time_predictions", (), ["mse", "rmse", "mae", "r2", "mape"])
def _(t: Tables):
    rows = t.labelled.select(*KEY, "setting_1", *S, "RUL", "predicted_stage")
    parted = tb.materialize(splits.unit_holdout(rows, C), "holdout")
    train, test = (parted.where(f"part = '{p}'").drop("part") for p in ("train", "test"))
    return phases.predict_times(train, test, C).metrics


@query("M6_run_all_phases", ["units_with_high_risk", "total_units", "total_high_risk_alerts"], ["mean_risk_score", "high_risk_threshold"])
def _(t: Tables):
    from wearcurve.plans.catalogue_series import _as_lines, _wide

    root = tb.scratch_path(t.spark, "fleet")
    wide = _wide(t.series)
    units = wide.groupBy("unit_number").agg(F.lit("20 ").alias("value"))
    for split in ("train", "test"):
        _as_lines(wide).write.text(f"{root}/{split}/{split}_FD001.txt")
    units.select("value").write.text(f"{root}/RUL/RUL_FD001.txt")
    return phases.run(t.spark, root, "FD001").risk.metrics
