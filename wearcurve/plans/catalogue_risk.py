"""Queries over metrics, risk scores, thresholds, levels and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wearcurve.functions import risk as rx
from wearcurve.functions.features import softmax
from wearcurve.layout import CONTIGUOUS as C
from wearcurve.operators import metrics, reports, risk, splits
from wearcurve.plans.registry import query
from wearcurve.plans.staged import Tables

KEY = ["unit_number", "time_cycles"]
UNIT = ["unit_number"]

# --- J: metrics --------------------------------------------------------------------------------


def _performance_sql(by: str) -> str:
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    using = f"USING ({by}, k)" if by else "USING (k)"
    report = f"""(SELECT {keys}k, coalesce(support, 0) AS support, coalesce(hit, 0) / nullif(called, 0) AS pr,
        coalesce(hit, 0) / nullif(support, 0) AS rc, 2 * coalesce(hit, 0) / (coalesce(called, 0) + coalesce(support, 0)) AS f
      FROM (SELECT {keys}true_stage AS k, count(*) AS support, sum(CASE WHEN true_stage = predicted_stage THEN 1 ELSE 0 END) AS hit
            FROM rows_ GROUP BY ALL)
      FULL JOIN (SELECT {keys}predicted_stage AS k, count(*) AS called FROM rows_ GROUP BY ALL) {using})"""
    return f"""SELECT {keys}sum(coalesce(rc, 0) * support) / sum(support) AS accuracy, sum(coalesce(pr, 0) * support) / sum(support) AS precision,
      sum(coalesce(rc, 0) * support) / sum(support) AS recall, sum(coalesce(f, 0) * support) / sum(support) AS f1 FROM {report} {group}"""


def _on(rows: str, sql: str) -> str:
    return f"WITH rows_ AS ({rows}) {sql}"


@query("J1_unit_performance", UNIT, metrics.PERFORMANCE, _on("SELECT * FROM p", _performance_sql("unit_number")), "p")
def _(t: Tables):
    return metrics.performance(metrics.confusion(t.labelled, "true_stage", "predicted_stage", UNIT), UNIT)


@query("J2_classifier_performance", (), metrics.PERFORMANCE, _on("SELECT * FROM p", _performance_sql("")), "p")
def _(t: Tables):
    return metrics.performance(metrics.confusion(t.labelled, "true_stage", "predicted_stage"))


@query("J2_class_report", ["label", "support"], ["precision", "recall", "f1"], """SELECT k AS label, CAST(support AS BIGINT) AS support, hit / called AS precision, hit / support AS recall, 2 * hit / (called + support) AS f1 FROM
  (SELECT true_stage AS k, count(*) AS support, sum(CASE WHEN true_stage = predicted_stage THEN 1 ELSE 0 END) AS hit FROM p GROUP BY 1)
  JOIN (SELECT predicted_stage AS k, count(*) AS called FROM p GROUP BY 1) USING (k)""", "p")
def _(t: Tables):
    return metrics.class_report(metrics.confusion(t.labelled, "true_stage", "predicted_stage"))


@query("J3_confusion", ["true", "pred", "n"], ["share"], "SELECT true_stage AS \"true\", predicted_stage AS pred, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY true_stage) AS share FROM p GROUP BY 1, 2", "p")
def _(t: Tables):
    return metrics.normalized_confusion(metrics.confusion(t.labelled, "true_stage", "predicted_stage"))


@query("J3_unit_confusion", [*UNIT, "true", "pred", "n"], ["share"], "SELECT unit_number, true_stage AS \"true\", predicted_stage AS pred, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY unit_number, true_stage) AS share FROM p GROUP BY 1, 2, 3", "p")
def _(t: Tables):
    return metrics.normalized_confusion(metrics.confusion(t.labelled, "true_stage", "predicted_stage", UNIT), UNIT)


def _quality_sql(by: str) -> str:
    keys = f"{by}, " if by else ""
    using = f"USING ({by})" if by else "ON true"
    group = f"GROUP BY {by}" if by else ""
    cells = f"(SELECT {keys}predicted_stage AS c, true_stage AS s, count(*) AS n FROM rows_ GROUP BY ALL)"
    by_c = f"(SELECT {keys}c, sum(n) AS big, max(n) AS top, 1 - sum(n * n) / (sum(n) * sum(n)) AS g, entropy_of FROM (SELECT *, -sum(sh * log2(sh)) OVER (PARTITION BY {keys}c) AS entropy_of FROM (SELECT *, n / sum(n) OVER (PARTITION BY {keys}c) AS sh FROM {cells})) GROUP BY ALL)"
    by_s = f"(SELECT {keys}s, max(n) AS top FROM {cells} GROUP BY ALL)"
    return f"""SELECT *, 2 * purity * inverse_purity / (purity + inverse_purity) AS f_measure FROM (
      SELECT {keys}gini_index, entropy, purity, tops / total AS inverse_purity FROM
      (SELECT {keys}sum(g * big) / sum(big) AS gini_index, sum(entropy_of * big) / sum(big) AS entropy, sum(top) / sum(big) AS purity, sum(big) AS total FROM {by_c} {group}) a
      JOIN (SELECT {keys}sum(top) AS tops FROM {by_s} {group}) b {using})"""


@query("J4_J5_J6_unit_cluster_quality", UNIT, metrics.QUALITY, _on("SELECT * FROM p", _quality_sql("unit_number")), "p")
def _(t: Tables):
    return metrics.cluster_quality(metrics.confusion(t.labelled, "true_stage", "predicted_stage", UNIT), UNIT)


@query("J4_J5_J6_cluster_quality", (), metrics.QUALITY, _on("SELECT * FROM p", _quality_sql("")), "p")
def _(t: Tables):
    return metrics.cluster_quality(metrics.confusion(t.labelled, "true_stage", "predicted_stage"))


@query("D11_average_metrics", (), [*metrics.PERFORMANCE, *metrics.QUALITY], _on("SELECT * FROM p", "SELECT " + ", ".join(f"avg({c}) AS {c}" for c in (*metrics.PERFORMANCE, *metrics.QUALITY)) + f" FROM ({_performance_sql('unit_number')}) JOIN ({_quality_sql('unit_number')}) USING (unit_number)"), "p")
def _(t: Tables):
    conf = metrics.confusion(t.labelled, "true_stage", "predicted_stage", UNIT)
    both = metrics.performance(conf, UNIT).join(metrics.cluster_quality(conf, UNIT), UNIT)
    return metrics.average_metrics(both, [*metrics.PERFORMANCE, *metrics.QUALITY])


_FOLD_SQL = "(SELECT unit_number, CAST((row_number() OVER (ORDER BY md5(unit_number || ':42'), unit_number) - 1) % 5 AS INT) AS fold FROM (SELECT DISTINCT unit_number FROM u))"


@query("J12_fold_evaluation", ["fold"], [*metrics.PERFORMANCE, *metrics.QUALITY], _on("SELECT * FROM p", "SELECT fold, " + ", ".join(f"avg({c}) AS {c}" for c in (*metrics.PERFORMANCE, *metrics.QUALITY)) + f" FROM ({_performance_sql('unit_number')}) JOIN ({_quality_sql('unit_number')}) USING (unit_number) JOIN {_FOLD_SQL} USING (unit_number) GROUP BY 1"), "p")
def _(t: Tables):
    return metrics.fold_evaluation(splits.unit_folds(t.labelled, C), "true_stage", "predicted_stage", UNIT)


_Y, _Z = "time_to_next_stage", "predicted_time_to_next_stage"
_REG = f"""avg(pow({_Y} - {_Z}, 2)) AS mse, sqrt(avg(pow({_Y} - {_Z}, 2))) AS rmse, avg(abs({_Y} - {_Z})) AS mae,
  CASE WHEN var_pop({_Y}) > 0 THEN 1 - avg(pow({_Y} - {_Z}, 2)) / var_pop({_Y}) ELSE 0 END AS r2,
  100 * avg(abs(({_Y} - {_Z}) / nullif({_Y}, 0))) AS mape, count(*) AS n"""


@query("J7_regression_metrics", ["n"], ["mse", "rmse", "mae", "r2", "mape"], f"SELECT {_REG} FROM p", "p", digits=4)
def _(t: Tables):
    return metrics.regression_metrics(t.labelled, _Y, _Z, count=True)


@query("J8_stage_regression_metrics", ["predicted_stage", "n"], ["mse", "rmse", "mae", "r2"], f"SELECT predicted_stage, {_REG} FROM p GROUP BY 1", "p", digits=4)
def _(t: Tables):
    return metrics.regression_metrics(t.labelled, _Y, _Z, ["predicted_stage"], mape=False, count=True)


@query("J9_model_rmse", ["model"], ["rmse"], f"SELECT 'a' AS model, sqrt(avg(pow(pred_a - {_Y}, 2))) AS rmse FROM p UNION ALL SELECT 'b', sqrt(avg(pow(pred_b - {_Y}, 2))) FROM p", "p")
def _(t: Tables):
    return metrics.model_rmse(t.labelled, _Y)


@query("J10_error_distribution", ["predicted_stage", "measure"], ["q1", "median", "q3"], " UNION ALL ".join(f"SELECT predicted_stage, '{m}' AS measure, quantile_cont({e}, 0.25) AS q1, median({e}) AS median, quantile_cont({e}, 0.75) AS q3 FROM p GROUP BY 1" for m, e in (("error", f"{_Y} - {_Z}"), ("abs_error", f"abs({_Y} - {_Z})"))), "p")
def _(t: Tables):
    return metrics.error_distribution(t.labelled, _Y, _Z, ["predicted_stage"])


@query("J11_cross_entropy", (), ["cross_entropy"], """SELECT avg(-w * ln(CASE k WHEN 0 THEN a / (a + b + c) WHEN 1 THEN b / (a + b + c) ELSE c / (a + b + c) END + 1e-8)) AS cross_entropy
  FROM (SELECT true_stage % 3 AS k, exp(sensor_1 / 50) AS a, exp(sensor_2 / 50) AS b, exp(1) AS c FROM p)
  JOIN (SELECT true_stage % 3 AS k, (SELECT count(*) FROM p) / (3 * count(*)) AS w FROM p GROUP BY 1) USING (k)""", "p")
def _(t: Tables):
    rows = t.labelled.withColumn("k", F.col("true_stage") % 3)
    rows = metrics.with_class_weights(rows, "k", KEY, "w")
    p = softmax(F.array(F.col("sensor_1") / 50, F.col("sensor_2") / 50, F.lit(1.0)))
    return metrics.cross_entropy(rows, p, F.col("k"), F.col("w"))


@query("D9_class_weights", ["quality", "n"], ["weight"], "SELECT quality, count(*) AS n, (SELECT count(*) FROM labels) / (2 * count(*)) AS weight FROM labels GROUP BY 1")
def _(t: Tables):
    return metrics.class_weights(t.source("labels"), "quality")


# --- K: risk -----------------------------------------------------------------------------------

def _stage_and_time() -> tuple[Column, Column]:
    return F.col("predicted_stage"), F.col("predicted_time_to_next_stage")


@query("K1_failure_probability", KEY, ["failure_probability"], "SELECT * FROM s0", "s")
def _(t: Tables):
    return t.labelled.select(*KEY, rx.failure_probability(_stage_and_time()[0]).alias("failure_probability"))


_PROBABILITY = "CASE predicted_stage WHEN 0 THEN 0.1 WHEN 1 THEN 0.3 WHEN 2 THEN 0.5 WHEN 3 THEN 0.8 WHEN 4 THEN 1.0 ELSE 0 END::DOUBLE"
_FIXED_TIME = "CASE WHEN predicted_stage >= 4 THEN 0 ELSE greatest(0, predicted_time_to_next_stage) + (3 - predicted_stage) * 30 END::DOUBLE"


@query("K2_stage_probability", KEY, ["probability"], f"SELECT unit_number, time_cycles, {_PROBABILITY} AS probability FROM p", "p")
def _(t: Tables):
    return t.labelled.select(*KEY, rx.stage_probability(_stage_and_time()[0]).alias("probability"))


@query("K3_time_to_failure", KEY, ["time_to_failure"], "SELECT * FROM s0", "s")
def _(t: Tables):
    return t.labelled.select(*KEY, rx.time_to_failure(*_stage_and_time()).alias("time_to_failure"))


@query("K4_time_to_failure_fixed", KEY, ["time_to_failure"], f"SELECT unit_number, time_cycles, {_FIXED_TIME} AS time_to_failure FROM p", "p")
def _(t: Tables):
    return t.labelled.select(*KEY, rx.time_to_failure_fixed(*_stage_and_time()).alias("time_to_failure"))


@query("K5_K6_row_scores", KEY, ["raw_risk_score", "urgency_score"], "SELECT * FROM s1", "s")
def _(t: Tables):
    return risk.add_row_scores(t.labelled)


@query("K7_score_table", KEY, ["failure_probability", "time_to_failure", "raw_risk_score", "urgency_score", "normalized_urgency"], "SELECT * FROM s", "s")
def _(t: Tables):
    return risk.score_risk(t.labelled)


@query("K7_score_table_by_dataset", ["dataset_id", *KEY], ["normalized_urgency"], "SELECT dataset_id, unit_number, time_cycles, (urgency_score - min(urgency_score) OVER d) / (max(urgency_score) OVER d - min(urgency_score) OVER d) AS normalized_urgency FROM s1 WINDOW d AS (PARTITION BY dataset_id)", "s")
def _(t: Tables):
    return risk.score_risk(t.labelled, ["dataset_id"])


_CALIBRATED = f"(SELECT unit_number, time_cycles, predicted_stage, {_PROBABILITY} AS pf, {_FIXED_TIME} AS tf, (SELECT greatest(100, 2 * max(time_cycles)) FROM p) AS mt FROM p)"


@query("K8_calibrated_minmax", KEY, ["raw_risk_score", "normalized_risk_score"], f"SELECT unit_number, time_cycles, pf * (mt - tf) AS raw_risk_score, pf * (mt - tf) / mt AS normalized_risk_score FROM {_CALIBRATED}", "p")
def _(t: Tables):
    return risk.compute_scores(t.labelled, "calibrated_minmax")


@query("K8_calibrated_urgency", KEY, ["normalized_risk_score"], f"SELECT unit_number, time_cycles, greatest(0, least(1, pf / (tf + 1e-6))) AS normalized_risk_score FROM {_CALIBRATED}", "p")
def _(t: Tables):
    return risk.compute_scores(t.labelled, "calibrated_urgency")


@query("K9_product_risk", KEY, ["risk"], "SELECT unit_number, time_cycles, failure_probability * time_to_failure AS risk FROM s0", "s")
def _(t: Tables):
    scored = risk.add_row_scores(t.labelled)
    return scored.select(*KEY, rx.product_risk(F.col("failure_probability"), F.col("time_to_failure")).alias("risk"))


@query("K10_risk_levels", [*KEY, "risk_level"], (), "SELECT unit_number, time_cycles, CASE WHEN normalized_urgency >= 0.6 THEN 'HIGH' WHEN normalized_urgency >= 0.3 THEN 'MEDIUM' WHEN normalized_urgency >= 0.1 THEN 'LOW' ELSE 'NEGLIGIBLE' END AS risk_level FROM s", "s")
def _(t: Tables):
    scored = risk.score_risk(t.labelled)
    return risk.assign_levels(scored, risk.fixed_thresholds(scored))


@query("K11_dynamic_thresholds", (), ["high", "medium", "low"], "SELECT * FROM th", "v")
def _(t: Tables):
    return risk.dynamic_thresholds(risk.score_risk(t.labelled), "normalized_urgency")


@query("K11_dynamic_thresholds_by_dataset", ["dataset_id"], ["high", "medium", "low"], "SELECT dataset_id, CASE WHEN h > m AND m > l THEN h ELSE 0.6 END AS high, CASE WHEN h > m AND m > l THEN m ELSE 0.3 END AS medium, CASE WHEN h > m AND m > l THEN l ELSE 0.1 END AS low FROM (SELECT dataset_id, quantile_cont(x, 0.85) AS h, quantile_cont(x, 0.6) AS m, quantile_cont(x, 0.3) AS l FROM (SELECT dataset_id, sensor_1 / 500 AS x FROM p) GROUP BY 1)", "p")
def _(t: Tables):
    return risk.dynamic_thresholds(t.labelled.withColumn("x", F.col("sensor_1") / 500), "x", ["dataset_id"])


_CURVE = """(SELECT score, hit / n AS pr, hit / total AS rc FROM (
    SELECT score, sum(h) OVER w AS hit, sum(c) OVER w AS n, sum(h) OVER () AS total FROM (
      SELECT {score} AS score, sum(CASE WHEN RUL <= 10 THEN 1 ELSE 0 END) AS h, count(*) AS c FROM {rows} GROUP BY 1)
    WINDOW w AS (ORDER BY score DESC)))"""
_FB = "(1 + {b} * {b}) * pr * rc / ({b} * {b} * pr + rc + 1e-10)"


@query("K12_precision_recall", (), ["score", "precision", "recall", "f_beta"], f"SELECT score, pr AS precision, rc AS recall, {_FB.format(b=1)} AS f_beta FROM {_CURVE.format(score='sensor_1', rows='p')}", "p")
def _(t: Tables):
    return risk.threshold_curve(t.labelled, "sensor_1", F.col("RUL") <= 10)


@query("K12_best_threshold", (), ["high", "medium", "low", "f_beta"], f"SELECT t AS high, greatest(0.1, 0.6 * t) AS medium, greatest(0.05, 0.3 * t) AS low, f AS f_beta FROM (SELECT score AS t, f FROM (SELECT score, {_FB.format(b=0.5)} AS f FROM {_CURVE.format(score='sensor_1', rows='p')}) ORDER BY f DESC, score LIMIT 1)", "p")
def _(t: Tables):
    return risk.best_threshold(t.labelled, "sensor_1", F.col("RUL") <= 10, beta=0.5)


@query("K13_levels_and_alerts", [*KEY, "risk_level", "maintenance_alert"], ["normalized_urgency"], "SELECT * FROM v", "v")
def _(t: Tables):
    scored = risk.score_risk(t.labelled)
    return risk.assign_levels(scored, risk.dynamic_thresholds(scored, "normalized_urgency"))


_METRICS = [
    "mean_risk_score", "median_risk_score", "std_risk_score", "min_risk_score", "max_risk_score",
    "high_risk_threshold", "medium_risk_threshold", "percentage_high_risk_units",
]
_COUNTS = ["units_with_high_risk", "total_units", "total_high_risk_alerts"]


def _metrics_sql(by: str = "", high: str = "(SELECT high FROM th)", medium: str = "(SELECT medium FROM th)") -> str:
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""SELECT {keys}avg(urgency_score) AS mean_risk_score, median(urgency_score) AS median_risk_score,
      stddev_samp(urgency_score) AS std_risk_score, min(urgency_score) AS min_risk_score, max(urgency_score) AS max_risk_score,
      {high} AS high_risk_threshold, {medium} AS medium_risk_threshold,
      count(DISTINCT unit_number) FILTER (WHERE risk_level = 'HIGH') AS units_with_high_risk,
      count(DISTINCT unit_number) AS total_units, count(*) FILTER (WHERE risk_level = 'HIGH') AS total_high_risk_alerts,
      100 * count(DISTINCT unit_number) FILTER (WHERE risk_level = 'HIGH') / count(DISTINCT unit_number) AS percentage_high_risk_units
      FROM v {group}"""


@query("K14_risk_metrics", _COUNTS, _METRICS, _metrics_sql(), "v")
def _(t: Tables):
    rows = t.assessed
    return risk.risk_metrics(rows, risk.dynamic_thresholds(rows, "normalized_urgency"))


_REPORT_SQL = """SELECT unit_number, max(normalized_urgency) AS max_score, avg(normalized_urgency) AS mean_score,
  arg_max(normalized_urgency, time_cycles) AS current_score, count(*) AS total_cycles,
  count(*) FILTER (WHERE normalized_urgency >= 0.7) AS high_risk_cycles, arg_max(predicted_stage, time_cycles) AS current_stage,
  arg_max(predicted_time_to_next_stage, time_cycles) AS time_to_next_stage, arg_max(risk_level, time_cycles) AS current_level
  FROM v GROUP BY 1"""


@query("K15_unit_report", ["unit_number", "total_cycles", "high_risk_cycles", "current_stage", "current_level"], ["max_score", "mean_score", "current_score", "time_to_next_stage"], _REPORT_SQL, "v")
def _(t: Tables):
    return risk.unit_report(t.assessed, "normalized_urgency", C)


@query("K16_fleet_totals", ["total_units", "high_risk_units", "total_observations"], (), "SELECT count(DISTINCT unit_number) AS total_units, count(DISTINCT unit_number) FILTER (WHERE risk_level = 'HIGH') AS high_risk_units, count(*) AS total_observations FROM v", "v")
def _(t: Tables):
    return risk.fleet_totals(t.assessed)


@query("H8_run_time", ["risk_level", "n", "well_formed"], (), "SELECT risk_level, count(*) AS n, true AS well_formed FROM v GROUP BY 1", "v")
def _(t: Tables):
    """The stamp of a run is the time of the query to the second."""
    stamped = risk.with_run_time(t.assessed.groupBy("risk_level").agg(F.count(F.lit(1)).alias("n")))
    age = F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("timestamp", "yyyy-MM-dd HH:mm:ss")
    return stamped.select("risk_level", "n", ((F.length("timestamp") == 19) & (age == 0)).alias("well_formed"))


@query("K16_level_shares", ["risk_level", "n"], ["share"], "SELECT risk_level, count(*) AS n, count(*) / (SELECT count(*) FROM v) AS share FROM v GROUP BY 1", "v")
def _(t: Tables):
    return risk.level_shares(t.assessed)


@query("D10_high_risk_units", ["total_units", "high_risk_units"], (), "SELECT count(DISTINCT unit_number) AS total_units, count(DISTINCT unit_number) FILTER (WHERE normalized_urgency >= 0.9) AS high_risk_units FROM v", "v")
def _(t: Tables):
    strict = t.assessed.withColumn("risk_level", F.when(F.col("normalized_urgency") >= 0.9, "HIGH").otherwise("LOW"))
    return risk.fleet_totals(strict)


@query("D13_unit_means", ["unit_number"], ["mean_score"], "SELECT unit_number, avg(urgency_score) AS mean_score FROM v GROUP BY 1", "v")
def _(t: Tables):
    return risk.unit_means(t.assessed, "urgency_score", C)


_TOP = "(SELECT unit_number FROM v GROUP BY 1 ORDER BY avg(urgency_score) DESC, 1 LIMIT {k})"


@query("F2_top_units_by_risk", ["unit_number"], ["mean_score"], "SELECT unit_number, avg(urgency_score) AS mean_score FROM v GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20", "v")
def _(t: Tables):
    return risk.top_units(t.assessed, "urgency_score", C, 20)


@query("K16_top_unit_trends", KEY, ["urgency_score"], f"SELECT * FROM v WHERE unit_number IN {_TOP.format(k=5)}", "v")
def _(t: Tables):
    return risk.top_unit_trends(t.assessed, "urgency_score", C)


@query("D17_first_unit_trends", KEY, ["urgency_score"], "SELECT * FROM v WHERE unit_number IN (SELECT DISTINCT unit_number FROM v ORDER BY 1 LIMIT 5)", "v")
def _(t: Tables):
    return risk.first_unit_trends(t.assessed, "urgency_score", C)


_HEAT_SQL = f"""WITH cells AS (SELECT unit_number, time_cycles, avg(urgency_score) AS mean_score FROM v
    WHERE unit_number IN {_TOP.format(k=10)} GROUP BY 1, 2),
  busy AS (SELECT time_cycles FROM cells GROUP BY 1 HAVING sum(mean_score) > 0),
  kept AS (SELECT time_cycles FROM (SELECT time_cycles, row_number() OVER (ORDER BY time_cycles) AS k, count(*) OVER () AS n FROM busy)
    WHERE (k - 1) % greatest(1, n // 20) = 0)
  SELECT unit_number, time_cycles, coalesce(mean_score, 0) AS mean_score FROM {_TOP.format(k=10)}
  CROSS JOIN kept LEFT JOIN cells USING (unit_number, time_cycles)"""


@query("D14_heat_map", KEY, ["mean_score"], _HEAT_SQL, "v")
def _(t: Tables):
    return risk.heat_map(t.assessed, "urgency_score", C)


_HIST = "SELECT bin, lo + (bin - 1) * (hi - lo) / 20 AS \"from\", count(*) AS n FROM (SELECT lo, hi, CAST(least(floor((x - lo) * 20 / (hi - lo)) + 1, 20) AS INT) AS bin FROM (SELECT {x} AS x FROM v), (SELECT min({x}) AS lo, max({x}) AS hi FROM v)) GROUP BY bin, lo, hi"


@query("D16_score_histogram", ["bin", "n"], ["from"], _HIST.format(x="urgency_score"), "v")
def _(t: Tables):
    return reports.histogram(t.assessed, "urgency_score")


@query("D16_error_histogram", ["bin", "n"], ["from"], _HIST.format(x=f"({_Y} - {_Z})"), "v")
def _(t: Tables):
    return reports.histogram(t.assessed.withColumn("error", F.col(_Y) - F.col(_Z)), "error")


_TH_BY = "(SELECT dataset_id, CASE WHEN h > m AND m > lo THEN h ELSE 0.6 END AS high, CASE WHEN h > m AND m > lo THEN m ELSE 0.3 END AS medium FROM (SELECT dataset_id, quantile_cont(normalized_urgency, 0.85) AS h, quantile_cont(normalized_urgency, 0.6) AS m, quantile_cont(normalized_urgency, 0.3) AS lo FROM v GROUP BY 1))"
_BY_SQL = f"SELECT * EXCLUDE (high_risk_threshold, medium_risk_threshold), high AS high_risk_threshold, medium AS medium_risk_threshold FROM ({_metrics_sql('dataset_id', '0', '0')}) JOIN {_TH_BY} USING (dataset_id)"


@query("K17_dataset_comparison", ["dataset_id", *_COUNTS], _METRICS, _BY_SQL, "v")
def _(t: Tables):
    by = ["dataset_id"]
    return risk.risk_metrics(t.assessed, risk.dynamic_thresholds(t.assessed, "normalized_urgency", by), by)


@query("G3_threshold_types", ["dataset_id", "threshold_type"], ["threshold_value"], f"SELECT dataset_id, 'high_risk_threshold' AS threshold_type, high AS threshold_value FROM {_TH_BY} UNION ALL SELECT dataset_id, 'medium_risk_threshold', medium FROM {_TH_BY}", "v")
def _(t: Tables):
    by = ["dataset_id"]
    thresholds = risk.dynamic_thresholds(t.assessed, "normalized_urgency", by)
    return risk.threshold_types(risk.risk_metrics(t.assessed, thresholds, by))


# --- M5 ----------------------------------------------------------------------------------------


@query("M5_risk_metrics", _COUNTS, _METRICS, _metrics_sql(), "v")
def _(t: Tables):
    from wearcurve.plans.phases import assess_risk

    return assess_risk(t.labelled).metrics


@query("M5_risk_table", [*KEY, "predicted_stage", "risk_level", "maintenance_alert"], ["failure_probability", "time_to_failure", "raw_risk_score", "urgency_score", "normalized_urgency"], "SELECT * FROM v", "v")
def _(t: Tables):
    from wearcurve.plans.phases import assess_risk

    return assess_risk(t.labelled).rows


@query("M5_calibrated_risk", [*KEY, "risk_level", "maintenance_alert"], ["normalized_risk_score"], f"""SELECT *, risk_level = 'HIGH' AS maintenance_alert FROM (
    SELECT *, CASE WHEN normalized_risk_score >= 0.7 THEN 'HIGH' WHEN normalized_risk_score >= 0.4 THEN 'MEDIUM'
      WHEN normalized_risk_score >= 0.1 THEN 'LOW' ELSE 'NEGLIGIBLE' END AS risk_level
    FROM (SELECT unit_number, time_cycles, greatest(0, pf * (mt - tf) / mt) AS normalized_risk_score FROM {_CALIBRATED}))""", "p")
def _(t: Tables):
    from wearcurve.plans.phases import assess_risk

    return assess_risk(t.labelled, "calibrated_minmax").rows


# --- N: the row-wise part on a stream ----------------------------------------------------------


@query("N_stream_scoring", [*KEY, "risk_level", "maintenance_alert"], ["normalized_urgency"], "SELECT * FROM v", "v")
def _(t: Tables):
    from wearcurve.sources import tables as tb
    from wearcurve.streaming import scoring

    fields = [f.name for f in scoring.PREDICTIONS.fields]
    arriving = tb.scratch_path(t.spark, "arriving")
    t.labelled.select(*fields).write.parquet(arriving)
    out, state = tb.scratch_path(t.spark, "scored"), tb.scratch_path(t.spark, "state")
    scored = scoring.score(scoring.read_predictions(t.spark, arriving), scoring.fit_risk(t.labelled))
    scoring.write_scores(scored, out, state).awaitTermination()
    return t.spark.read.schema(scored.schema).parquet(out)
