"""Quality of stages, classes and predicted times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearcurve.operators.blocks import join_groups
from wearcurve.operators.quantiles import exact_percentiles


def confusion(df: DataFrame, truth: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """(by…, true, pred, n): everything below works on this small table."""
    return df.groupBy(*by, F.col(truth).alias("true"), F.col(pred).alias("pred")).agg(
        F.count(F.lit(1)).alias("n")
    )


def normalized_confusion(conf: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts with their share of the true class."""
    rows = conf.groupBy(*by, "true").agg(F.sum("n").alias("_row"))
    return conf.join(rows, [*by, "true"]).select(*by, "true", "pred", "n", (F.col("n") / F.col("_row")).alias("share"))


def class_report(conf: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class; 0 where a denominator is 0."""
    # squares of counts may exceed 64 bits
    n = F.col("n").cast("double")
    sides = F.array(
        F.struct(
            F.col("true").alias("label"),
            n.alias("support"),
            F.when(F.col("true") == F.col("pred"), n).otherwise(F.lit(0)).alias("hit"),
            F.lit(0).cast("long").alias("called"),
        ),
        F.struct(
            F.col("pred").alias("label"),
            F.lit(0).cast("long").alias("support"),
            F.lit(0).cast("long").alias("hit"),
            n.alias("called"),
        ),
    )
    totals = (
        conf.select(*by, F.explode(sides).alias("s"))
        .select(*by, "s.*")
        .groupBy(*by, "label")
        .agg(F.sum("support").alias("support"), F.sum("hit").alias("_hit"), F.sum("called").alias("_called"))
    )
    zero = F.lit(0.0)
    return totals.select(
        *by,
        "label",
        F.coalesce(F.try_divide("_hit", "_called"), zero).alias("precision"),
        F.coalesce(F.try_divide("_hit", "support"), zero).alias("recall"),
        F.coalesce(F.try_divide(F.col("_hit") * 2, F.col("_called") + F.col("support")), zero).alias("f1"),
        "support",
    )


def performance(conf: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1."""

    def weighted(c):
        return F.sum(F.col(c) * F.col("support")) / F.sum("support")

    return class_report(conf, by).groupBy(*by).agg(
        # weighted recall is the share of rows on the diagonal
        weighted("recall").alias("accuracy"),
        weighted("precision").alias("precision"),
        weighted("recall").alias("recall"),
        weighted("f1").alias("f1"),
    )


def cluster_quality(conf: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Size-weighted Gini impurity and entropy of the clusters, purity, inverse purity and their F."""
    # squares of counts may exceed 64 bits
    n = F.col("n").cast("double")
    sides = F.array(
        F.struct(F.lit("pred").alias("side"), F.col("pred").cast("long").alias("g"), n.alias("n")),
        F.struct(F.lit("true").alias("side"), F.col("true").cast("long").alias("g"), n.alias("n")),
    )
    groups = (
        conf.select(*by, F.explode(sides).alias("s"))
        .select(*by, "s.*")
        .groupBy(*by, "side", "g")
        .agg(
            F.sum("n").alias("_n"),
            F.sum(n * n).alias("_n2"),
            F.sum(n * F.log2(n)).alias("_nlog"),
            F.max("n").alias("_top"),
        )
    )
    on_pred = F.col("side") == "pred"
    size = F.col("_n").cast("double")
    total = F.sum(F.when(on_pred, size))
    gini = F.sum(F.when(on_pred, size - F.col("_n2") / size)) / total
    entropy = F.sum(F.when(on_pred, size * F.log2(size) - F.col("_nlog"))) / total
    purity = F.sum(F.when(on_pred, F.col("_top"))) / total
    inverse = F.sum(F.when(~on_pred, F.col("_top"))) / total
    table = groups.groupBy(*by).agg(
        gini.alias("gini_index"), entropy.alias("entropy"), purity.alias("purity"), inverse.alias("inverse_purity")
    )
    f = 2 * F.col("purity") * F.col("inverse_purity") / (F.col("purity") + F.col("inverse_purity"))
    return table.withColumn("f_measure", F.coalesce(f, F.lit(0.0)))


PERFORMANCE = ("accuracy", "precision", "recall", "f1")
QUALITY = ("gini_index", "entropy", "purity", "inverse_purity", "f_measure")


def average_metrics(table: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return table.groupBy(*by).agg(*[F.avg(c).alias(c) for c in columns])


def fold_evaluation(
    df: DataFrame, truth: str, pred: str, unit: Sequence[str], fold: str = "fold"
) -> DataFrame:
    """Unit metrics averaged per fold, from stages that are already given."""
    keys = [fold, *unit]
    conf = confusion(df, truth, pred, keys)
    both = performance(conf, keys).join(cluster_quality(conf, keys), keys)
    return average_metrics(both, [*PERFORMANCE, *QUALITY], [fold])


def regression_metrics(
    df: DataFrame, truth: str, pred: str, by: Sequence[str] = (), mape: bool = True, count: bool = False
) -> DataFrame:
    """MSE, RMSE, MAE, R² (0 without spread in the truth) and MAPE over non-zero truths, in one pass."""
    y, p = F.col(truth).cast("double"), F.col(pred).cast("double")
    err = y - p
    valid = df.where(y.isNotNull() & p.isNotNull())
    table = valid.groupBy(*by).agg(
        F.avg(err * err).alias("mse"),
        F.avg(F.abs(err)).alias("mae"),
        F.var_pop(y).alias("_var"),
        F.avg(F.when(y != 0, F.abs(err / F.when(y != 0, y)))).alias("_ape"),
        F.count(F.lit(1)).alias("n"),
    )
    r2 = F.when(F.col("_var") > 0, 1 - F.col("mse") / F.when(F.col("_var") > 0, F.col("_var"))).otherwise(F.lit(0.0))
    out = [*by, "mse", F.sqrt("mse").alias("rmse"), "mae", r2.alias("r2")]
    if mape:
        out.append((F.col("_ape") * 100).alias("mape"))
    if count:
        out.append("n")
    return table.select(*out)


def model_rmse(df: DataFrame, truth: str, prefix: str = "pred_") -> DataFrame:
    """RMSE of every ``pred_<model>`` column."""
    models = [c for c in df.columns if c.startswith(prefix)]
    row = df.agg(*[F.sqrt(F.avg(F.pow(F.col(c) - F.col(truth), F.lit(2.0)))).alias(c[len(prefix) :]) for c in models])
    return row.unpivot([], [c[len(prefix) :] for c in models], "model", "rmse")


def error_distribution(df: DataFrame, truth: str, pred: str, by: Sequence[str]) -> DataFrame:
    """Quartiles of the signed and of the absolute error per group."""
    errors = df.withColumns({"error": F.col(truth) - F.col(pred), "abs_error": F.abs(F.col(truth) - F.col(pred))})
    table = exact_percentiles(errors, ["error", "abs_error"], [0.25, 0.5, 0.75], by)
    return table.groupBy(*by, F.col("column").alias("measure")).agg(
        *[
            F.max(F.when(F.col("prob") == p, F.col("value"))).alias(name)
            for p, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))
        ]
    )


def cross_entropy(df: DataFrame, probability: Column, label: Column, weight: Column | None = None) -> DataFrame:
    """Mean of -weight * ln(p(label) + 1e-8); ``probability`` is an array indexed by the label."""
    p = F.get(probability, label.cast("int"))
    w = F.lit(1.0) if weight is None else weight
    return df.agg(F.avg(-w * F.ln(p + F.lit(1e-8))).alias("cross_entropy"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n, weight) with weight = rows / (classes * n)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(F.count(F.lit(1)).alias("_k"), F.sum("n").alias("_total"))
    return join_groups(counts, totals, [], [label]).select(
        label, "n", (F.col("_total") / (F.col("_k") * F.col("n"))).alias("weight")
    )


def with_class_weights(df: DataFrame, label: str, spread: Sequence[str], out: str = "weight") -> DataFrame:
    weights = class_weights(df, label).select(label, F.col("weight").alias(out))
    return join_groups(df, weights, [label], spread)
