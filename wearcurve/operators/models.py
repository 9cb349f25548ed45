"""Classifiers, regressors and their combination, fitted by Spark ML."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import product

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    LogisticRegression,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import PCA, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearcurve.functions.features import clip
from wearcurve.operators import forest
from wearcurve.operators import metrics as mx
from wearcurve.operators.blocks import with_row
from wearcurve.operators.quantiles import exact_percentiles
from wearcurve.operators.splits import SEED, row_sample
from wearcurve.operators.time_models import FEATURES, EnsembleRegressionModel, IntervalRegression, QuantileRegression, weighted
from wearcurve.sources.tables import params_key, read_scores, shared_dir, unscored, write_scores

# Fixed values
PRESETS = {
    "random_forest": {
        1: {"n_estimators": 50, "max_depth": 10, "min_samples_split": 5},
        2: {"n_estimators": 100, "max_depth": 20, "min_samples_split": 10},
        3: {"n_estimators": 50, "max_depth": 12, "min_samples_split": 5},
        4: {"n_estimators": 100, "max_depth": 20, "min_samples_split": 5},
    },
    "logistic_regression": {
        1: {"learning_rate": 0.01, "iterations": 1000, "class_weights": "balanced"},
        2: {"learning_rate": 0.05, "iterations": 500, "class_weights": "balanced"},
        3: {"learning_rate": 0.01, "iterations": 1000, "class_weights": "balanced"},
        4: {"learning_rate": 0.05, "iterations": 500, "class_weights": "balanced"},
    },
}
SEARCH_SPACE = {
    "n_estimators": [50, 100],
    "max_depth": [5, 10],
    "min_samples_split": [5, 10],
    "max_features": ["sqrt", "log2"],
}


def assembler(columns: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=FEATURES, handleInvalid="error")


def preset(model_type: str, dataset: int | str) -> dict:
    """Hyper-parameters for a dataset given as 1..4 or FD001..FD004."""
    number = int(str(dataset)[-1])
    try:
        return dict(PRESETS[model_type][number])
    except KeyError:
        raise ValueError(f"no preset for {model_type!r} on dataset {dataset!r}") from None


def forest_classifier(params: Mapping, label: str, weight: str | None = None, seed: int = SEED) -> RandomForestClassifier:
    """``min_samples_split`` s becomes a least child size of s // 2: a node of s rows may split evenly."""
    forest = RandomForestClassifier(
        featuresCol=FEATURES,
        labelCol=label,
        impurity="entropy",
        numTrees=params.get("n_estimators", 100),
        maxDepth=params.get("max_depth") or 30,
        minInstancesPerNode=max(1, params.get("min_samples_split", 2) // 2),
        featureSubsetStrategy=str(params.get("max_features", "sqrt")),
        seed=seed,
    )
    return forest.setWeightCol(weight) if weight else forest


def logistic_classifier(params: Mapping, label: str, weight: str | None = None) -> LogisticRegression:
    """``iterations`` bounds the solver's; it finds its own step, so a preset's ``learning_rate`` has no use."""
    model = LogisticRegression(
        featuresCol=FEATURES, labelCol=label, family="multinomial", maxIter=params.get("max_iter", params.get("iterations", 100))
    )
    return model.setWeightCol(weight) if weight else model


def fit_classifier(
    df: DataFrame,
    columns: Sequence[str],
    label: str,
    model_type: str = "random_forest",
    params: Mapping | None = None,
    spread: Sequence[str] = (),
    cells: forest.Cells | None = None,
) -> PipelineModel:
    """Fit on named columns; ``class_weights: balanced`` weighs each row by its class.

    A forest without class weights is grown from the cells of the rows' bins where these are few (``forest``); ``cells``
    are those of ``df``, if they have been counted before.
    """
    params = dict(params or {})
    shared_dir(df.sparkSession)
    rows, weight = df, None
    if params.get("class_weights") == "balanced":
        weight = "_weight"
        rows = mx.with_class_weights(df, label, list(spread) or list(columns), weight)
    if model_type == "random_forest":
        estimator = forest_classifier(params, label, weight)
        if weight is None:
            counted = cells or forest.class_cells(df, columns, label, estimator.getMaxBins())
            grown = None if counted is None else forest.grown_classes(estimator, df.sparkSession, counted)
            if grown is not None:
                return PipelineModel(stages=[assembler(columns), grown])
    elif model_type == "logistic_regression":
        estimator = logistic_classifier(params, label, weight)
    else:
        raise ValueError(f"unknown model type {model_type!r}: use one of {tuple(PRESETS)}")
    return Pipeline(stages=[assembler(columns), estimator]).fit(rows)


def classify(model: PipelineModel, df: DataFrame, out: str = "predicted_stage") -> DataFrame:
    """Adds the predicted class and the array of class probabilities."""
    scored = model.transform(df)
    return scored.withColumns(
        {out: F.col("prediction").cast("int"), "class_probability": vector_to_array("probability")}
    ).drop(FEATURES, "rawPrediction", "probability", "prediction")


def feature_importance(model: PipelineModel, columns: Sequence[str], kind: str = "impurity") -> DataFrame:
    """(feature, importance), summing to 1: forest impurity gains or split counts, or sums of absolute
    logistic coefficients."""
    spark = _session()
    fitted = model.stages[-1]
    names = list(columns)
    if isinstance(fitted, RandomForestClassificationModel):
        if kind == "splits":
            return split_counts(fitted, names)
        values = fitted.featureImportances.toArray().tolist()
    else:
        values = abs(fitted.coefficientMatrix.toArray()).sum(axis=0).tolist()
    total = sum(values)
    rows = [(n, v / total if total > 0 else 0.0) for n, v in zip(names, values)]
    return spark.createDataFrame(rows, "feature string, importance double")


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.active()


def split_counts(model: RandomForestClassificationModel, names: Sequence[str]) -> DataFrame:
    """Share of all splits that use each feature, read from the saved trees."""
    from wearcurve.sources.tables import scratch_path

    spark = _session()
    path = scratch_path(spark, "forest")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    used = nodes.select(F.col("nodeData.split.featureIndex").alias("i")).where(F.col("i") >= 0)
    counts = used.groupBy("i").agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    listed = spark.createDataFrame(list(enumerate(names)), "i int, feature string")
    share = F.coalesce(F.try_divide("_n", total), F.lit(0.0))
    return listed.join(counts, "i", "left").select("feature", share.alias("importance"))


def search_candidates(space: Mapping[str, Sequence] = SEARCH_SPACE, n: int = 10, seed: int = SEED) -> list[dict]:
    """``n`` distinct random settings of the space (all of them if there are fewer)."""
    names = sorted(space)
    every = [dict(zip(names, values)) for values in product(*[space[k] for k in names])]
    return random.Random(seed).sample(every, min(n, len(every)))


def search_classifier(
    train: DataFrame,
    validation: DataFrame,
    columns: Sequence[str],
    label: str,
    row_key: Sequence[str],
    store: str,
    candidates: Sequence[Mapping] | None = None,
    validation_rows: int | None = None,
    at_once: int = 4,
) -> DataFrame:
    """Score each setting by weighted F1 on the validation rows, or on so many of them: (params, score).

    ``at_once`` settings are fitted at the same time, each in a thread of the driver. A score is stored after its fit in
    a folder of its own by the setting, so that a repeated fit replaces it, and settings found there are not fitted again.
    """
    spark = train.sparkSession
    settings = [dict(c) for c in (candidates or search_candidates())]
    wanted = spark.createDataFrame([(params_key(s),) for s in settings], "params string")
    from wearcurve.sources.tables import path_exists

    if path_exists(spark, store):
        # at most one name per candidate
        todo = {r["params"] for r in unscored(wanted, read_scores(spark, store)).collect()}
    else:
        todo = {params_key(s) for s in settings}
    held_out = validation if validation_rows is None else row_sample(validation, validation_rows, row_key)
    # all settings learn from the same rows
    cells = forest.class_cells(train, columns, label) if todo else None

    def score(setting: dict) -> None:
        key = params_key(setting)
        model = fit_classifier(train, columns, label, "random_forest", setting, cells=cells)
        conf = mx.confusion(classify(model, held_out, "_pred"), label, "_pred")
        write_scores(mx.performance(conf).select(F.lit(key).alias("params"), F.col("f1").alias("score")), store, key)

    open_settings = [s for s in settings if params_key(s) in todo]
    shared_dir(spark)
    with ThreadPoolExecutor(max(1, at_once)) as pool:
        # a fit is many small jobs; several at once fill the cluster
        for done in [pool.submit(inheritable_thread_target(score), s) for s in open_settings]:
            done.result()
    return read_scores(spark, store).join(wanted, "params", "left_semi").dropDuplicates(["params"])


def best_params(scores: DataFrame) -> dict:
    import json

    return json.loads(scores.orderBy(F.desc("score"), "params").first()["params"])


# --- regression --------------------------------------------------------------------------------


@dataclass
class Regressor:
    """A fitted Spark ML model with a ``prediction`` column, and its name in an ensemble."""

    name: str
    model: Transformer

    def predict(self, df: DataFrame, out: str) -> DataFrame:
        return self.model.transform(df).withColumnRenamed("prediction", out).drop(FEATURES)


def ridge_model(df: DataFrame, columns: Sequence[str], target: str, alpha: float = 1.0):
    """Closed-form ridge with a free intercept.

    Spark divides the penalty by the row count and the target's deviation, hence the factor.
    """
    n, sd = df.agg(F.count(F.lit(1)), F.stddev_pop(target)).first()
    penalty = alpha * (sd or 0.0) / n
    estimator = LinearRegression(
        featuresCol=FEATURES, labelCol=target, solver="normal", regParam=penalty, elasticNetParam=0.0, standardization=False
    )
    return Pipeline(stages=[assembler(columns), estimator]).fit(df)


def fit_ridge(df: DataFrame, columns: Sequence[str], target: str, alpha: float = 1.0) -> Regressor:
    return Regressor("Ridge", ridge_model(df, columns, target, alpha))


def fit_forest(df: DataFrame, columns: Sequence[str], target: str, trees: int = 100, depth: int = 10, seed: int = SEED) -> Regressor:
    estimator = RandomForestRegressor(
        featuresCol=FEATURES, labelCol=target, numTrees=trees, maxDepth=depth, featureSubsetStrategy="sqrt", seed=seed
    )
    grown = forest.grown_numbers(estimator, df, columns, target)
    if grown is not None:
        return Regressor("RandomForest", PipelineModel(stages=[assembler(columns), grown]))
    return Regressor("RandomForest", Pipeline(stages=[assembler(columns), estimator]).fit(df))


def fit_boosting(
    df: DataFrame,
    columns: Sequence[str],
    target: str,
    rounds: int = 100,
    depth: int = 5,
    rate: float = 0.1,
    bins: int = 256,
    subsample: float = 1.0,
    seed: int = SEED,
) -> Regressor:
    """Gradient boosting on quantile-binned features; starts from the target's mean."""
    spark = df.sparkSession
    shared_dir(spark)
    mean = df.agg(F.avg(target)).first()[0]
    estimator = GBTRegressor(
        featuresCol=FEATURES,
        labelCol="_residual",
        maxIter=rounds,
        maxDepth=depth,
        stepSize=rate,
        maxBins=bins,
        subsamplingRate=subsample,
        checkpointInterval=10,
        seed=seed,
    )
    model = Pipeline(stages=[assembler(columns), estimator]).fit(df.withColumn("_residual", F.col(target) - mean))

    shift = SQLTransformer(statement=f"SELECT * EXCEPT (prediction), prediction + {float(mean)!r}D AS prediction FROM __THIS__")
    return Regressor("HistGradientBoosting", PipelineModel(stages=[*model.stages, shift]))


def fit_quantile(
    df: DataFrame, columns: Sequence[str], target: str, quantile: float = 0.5, alpha: float = 0.1, tolerance: float = 1e-3, rounds: int = 200
) -> Regressor:
    """Linear quantile regression, see ``time_models.quantile_fit``."""
    estimator = QuantileRegression(inputCols=list(columns), labelCol=target, quantile=quantile, regParam=alpha, tol=tolerance, maxIter=rounds)
    return Regressor("Quantile", PipelineModel(stages=[estimator.fit(df)]))


def fit_interval(
    df: DataFrame, columns: Sequence[str], target: str, lower: float = 0.1, upper: float = 0.9, alpha: float = 0.1
):
    """Function adding ``lower_bound`` and ``upper_bound`` (never crossed)."""
    return IntervalRegression(inputCols=list(columns), labelCol=target, lower=lower, upper=upper, regParam=alpha).fit(df).transform


def pinball(df: DataFrame, target: str, pred: str, quantile: float) -> DataFrame:
    gap = F.col(target) - F.col(pred)
    return df.agg(
        F.avg(F.when(gap > 0, gap * quantile).otherwise(gap * (quantile - 1))).alias("loss"),
        F.avg((gap <= 0).cast("double")).alias("coverage"),
    )


def ensemble_weights(
    df: DataFrame, target: str, models: Sequence[str], weights: str | Mapping[str, float] = "inverse_mse"
) -> DataFrame:
    """(model, weight), adding up to 1: by inverse MSE, equal, or the given ones in proportion."""
    if weights not in ("inverse_mse", "equal") and not isinstance(weights, Mapping):
        raise ValueError(f"unknown weights {weights!r}: use 'inverse_mse', 'equal' or a mapping")
    if weights != "inverse_mse":
        base = {m: 1.0 if weights == "equal" else float(weights.get(m, 0.0)) for m in models}
        total = sum(base.values())
        return df.sparkSession.createDataFrame([(m, w / total) for m, w in base.items()], "model string, weight double")
    row = df.agg(
        *[F.avg(F.pow(F.col(f"pred_{m}") - F.col(target), F.lit(2.0))).alias(m) for m in models],
    )
    inverse = [1 / (F.col(m) + F.lit(1e-10)) for m in models]
    inverse_total = sum(inverse[1:], inverse[0])
    weighted = row.select(*[(inv / inverse_total).alias(m) for m, inv in zip(models, inverse)])
    return weighted.unpivot([], list(models), "model", "weight")


def add_ensemble(df: DataFrame, weights: DataFrame, models: Sequence[str], out: str = "pred_Ensemble") -> DataFrame:
    """Weighted sum of the ``pred_<model>`` columns; the weights are read as one scalar row."""
    row = weights.agg(*[F.max(F.when(F.col("model") == m, F.col("weight"))).alias(f"w{i}") for i, m in enumerate(models)])
    value = sum((F.col(f"pred_{m}") * F.col(f"_w.w{i}") for i, m in enumerate(models)), F.lit(0.0))
    return with_row(df, row, "_w").withColumn(out, value).drop("_w")


@dataclass
class Ensemble:
    """Fitted regressors with weights by the training frame (or a validation frame); ``model`` can be saved."""

    models: list[Regressor]
    model: EnsembleRegressionModel | None = None

    def fit(self, df: DataFrame, target: str, validation: DataFrame | None = None, weights: str | Mapping[str, float] = "inverse_mse") -> "Ensemble":
        # weights are fixed here so that scoring new frames does not score the training frame again
        self.model = weighted({m.name: m.model for m in self.models}, df if validation is None else validation, target, weights)
        return self

    @property
    def weights(self) -> DataFrame:
        rows = list(zip(self.model.getOrDefault("names"), self.model.getOrDefault("weights"), strict=True))
        return _session().createDataFrame(rows, "model string, weight double")

    def predict(self, df: DataFrame, out: str = "predicted_time_to_next_stage") -> DataFrame:
        """Adds every model's column, ``pred_Ensemble`` and ``out``."""
        if self.model is None:
            raise ValueError("the ensemble has not been fitted")
        return self.model.transform(df).withColumn(out, F.col("pred_Ensemble"))


# --- binning and projection --------------------------------------------------------------------


def quantile_bins(df: DataFrame, column: str, bins: int = 256, out: str = "bin") -> DataFrame:
    """Bin index by distinct percentile edges, clipped to the first and last bin."""
    probs = [i / bins for i in range(bins + 1)]
    table = exact_percentiles(df, [column], probs)
    edges = table.agg(F.array_distinct(F.sort_array(F.collect_list("value")))).scalar()
    rows = df.withColumn("_edges", edges)
    below = F.size(F.filter("_edges", lambda e: e <= F.col(column))) - 1
    index = clip(below, F.lit(0), F.size("_edges") - 2)
    return rows.withColumn(out, index.cast("int")).drop("_edges")


def principal_components(df: DataFrame, columns: Sequence[str], k: int = 2, keep: Sequence[str] = ()) -> DataFrame:
    """Coordinates on the first k principal components."""
    model = Pipeline(stages=[assembler(columns), PCA(k=k, inputCol=FEATURES, outputCol="_pc")]).fit(df)
    values = vector_to_array("_pc")
    return model.transform(df).select(*keep, *[values[i].alias(f"component_{i + 1}") for i in range(k)])
