"""Estimators and models of the time to the next stage: median and interval regression, and weighted ensembles.

They are Spark ML stages with params, so that they fit into pipelines, are written and read again, and score new rows.
Models are linear expressions or other models' columns: scoring stays in one pass over the rows.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasMaxIter, HasPredictionCol, HasRegParam, HasTol
from pyspark.ml.regression import LinearRegression
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearcurve.operators.quantiles import exact_percentiles

FEATURES = "features"


def linear(columns: Sequence[str], coefficients: Sequence[float], intercept: float) -> Column:
    terms = [f"{float(intercept)!r}D", *[f"`{c}` * {float(w)!r}D" for c, w in zip(columns, coefficients, strict=True)]]
    return F.expr(" + ".join(terms))


def quantile_fit(
    df: DataFrame, columns: Sequence[str], target: str, quantile: float, alpha: float, tolerance: float, rounds: int
) -> tuple[list[float], float]:
    """Coefficients and intercept of a linear quantile regression, by rounds of weighted least squares.

    Each round replaces the pinball loss by the quadratic that touches it at the current residuals:
    weight 1 / (|r| + e) and target y + (2q - 1)(|r| + e), on standardised columns. ``alpha`` is the L2
    weight of the standardised coefficients beside the mean pinball loss. The best fit seen is kept, and
    the first one is the target's own quantile. Rounds end when one lowers the best loss by less than
    ``tolerance`` of it; the fit fails if that takes more than ``rounds``.
    """
    from wearcurve.sources.tables import materialize

    names = list(columns)
    stats = df.agg(
        F.stddev_pop(target).alias("sd"),
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(names)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(names)],
    ).first()
    spread = [stats[f"s{i}"] or 1.0 for i in range(len(names))]
    start = exact_percentiles(df, [target], [quantile]).first()["value"]
    floor = 1e-3 * (stats["sd"] or 1.0)
    z = {f"_z{i}": (F.col(c) - F.lit(stats[f"m{i}"])) / F.lit(spread[i]) for i, c in enumerate(names)}
    # every round reads these columns again
    base = materialize(df.select(F.col(target).cast("double").alias("_y"), *[e.alias(k) for k, e in z.items()]), "quantile")
    weights, bias = [0.0] * len(names), float(start)
    best = (float("inf"), weights, bias)
    stage = VectorAssembler(inputCols=list(z), outputCol=FEATURES)
    for _ in range(rounds):
        rows = base.withColumn("_r", F.col("_y") - linear(list(z), weights, bias)).selectExpr(
            "*", f"abs(_r) + {floor!r}D AS _a", f"if(_r > 0, _r * {quantile!r}D, _r * {quantile - 1!r}D) AS _loss"
        )
        # a quarter of 1 / a: the touching quadratic of the pinball loss itself
        rows = rows.selectExpr("*", "0.25D / _a AS _w", f"_y + {2 * quantile - 1!r}D * _a AS _t")
        row = rows.selectExpr(
            "avg(_loss) AS loss", "avg(_w) AS w", "sum(_w * _t) / sum(_w) AS m", "sum(_w * _t * _t) / sum(_w) AS s"
        ).first()
        loss = row["loss"] + alpha / 2 * sum(w * w for w in weights)
        gained, best = best[0] - loss, min(best, (loss, weights, bias), key=lambda fit: fit[0])
        if gained <= tolerance * abs(best[0]):
            break
        # Spark divides the penalty by the mean weight's share and the target's weighted deviation
        deviation = max(row["s"] - row["m"] ** 2, 0.0) ** 0.5
        fitted = LinearRegression(
            featuresCol=FEATURES,
            labelCol="_t",
            weightCol="_w",
            solver="normal",
            regParam=alpha / 2 * deviation / row["w"],
            elasticNetParam=0.0,
            standardization=False,
        ).fit(stage.transform(rows))
        weights, bias = [float(w) for w in fitted.coefficients], float(fitted.intercept)
    else:
        raise RuntimeError(f"the quantile fit still gains after {rounds} rounds")
    _, weights, bias = best
    raw = [w / s for w, s in zip(weights, spread, strict=True)]
    return raw, bias - sum(w * stats[f"m{i}"] for i, w in enumerate(raw))


class _Linear(HasInputCols, HasLabelCol, HasPredictionCol, HasRegParam, HasTol, HasMaxIter):
    def __init__(self, **given):
        super().__init__()
        self._setDefault(labelCol="label", predictionCol="prediction", regParam=0.1, tol=1e-3, maxIter=200)
        self._set(**given)


def _param(name: str, doc: str, kind) -> Param:
    return Param(Params._dummy(), name, doc, kind)


# --- quantile regression -----------------------------------------------------------------------


class QuantileRegression(Estimator, _Linear, DefaultParamsReadable, DefaultParamsWritable):
    """Linear quantile regression of ``labelCol`` on ``inputCols``; ``quantile`` is 0.5 by default."""

    quantile = _param("quantile", "the quantile to fit", TypeConverters.toFloat)

    def __init__(self, **given):
        super().__init__(**{"quantile": 0.5, **given})

    def _fit(self, df: DataFrame) -> "QuantileRegressionModel":
        of = self.getOrDefault
        fitted = quantile_fit(df, of("inputCols"), of("labelCol"), of("quantile"), of("regParam"), of("tol"), of("maxIter"))
        return QuantileRegressionModel(inputCols=of("inputCols"), predictionCol=of("predictionCol"), coefficients=fitted[0], intercept=fitted[1])


class QuantileRegressionModel(Model, HasInputCols, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    coefficients = _param("coefficients", "weight of each column", TypeConverters.toListFloat)
    intercept = _param("intercept", "value where all columns are 0", TypeConverters.toFloat)

    def __init__(self, **given):
        super().__init__()
        self._set(**given)

    def _transform(self, df: DataFrame) -> DataFrame:
        of = self.getOrDefault
        return df.withColumn(of("predictionCol"), linear(of("inputCols"), of("coefficients"), of("intercept")))


# --- interval ----------------------------------------------------------------------------------


class IntervalRegression(Estimator, _Linear, DefaultParamsReadable, DefaultParamsWritable):
    """Two quantile regressions as the bounds of an interval."""

    lower = _param("lower", "quantile of the lower bound", TypeConverters.toFloat)
    upper = _param("upper", "quantile of the upper bound", TypeConverters.toFloat)

    def __init__(self, **given):
        super().__init__(**{"lower": 0.1, "upper": 0.9, **given})

    def _fit(self, df: DataFrame) -> "IntervalRegressionModel":
        of = self.getOrDefault
        sides = [quantile_fit(df, of("inputCols"), of("labelCol"), of(q), of("regParam"), of("tol"), of("maxIter")) for q in ("lower", "upper")]
        return IntervalRegressionModel(
            inputCols=of("inputCols"), lowerCoefficients=sides[0][0], lowerIntercept=sides[0][1], upperCoefficients=sides[1][0], upperIntercept=sides[1][1]
        )


class IntervalRegressionModel(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``lower_bound`` and ``upper_bound``, which never cross."""

    lowerCoefficients = _param("lowerCoefficients", "weights of the lower side", TypeConverters.toListFloat)
    lowerIntercept = _param("lowerIntercept", "constant of the lower side", TypeConverters.toFloat)
    upperCoefficients = _param("upperCoefficients", "weights of the upper side", TypeConverters.toListFloat)
    upperIntercept = _param("upperIntercept", "constant of the upper side", TypeConverters.toFloat)

    def __init__(self, **given):
        super().__init__()
        self._set(**given)

    def _transform(self, df: DataFrame) -> DataFrame:
        of = self.getOrDefault
        low, high = (linear(of("inputCols"), of(f"{s}Coefficients"), of(f"{s}Intercept")) for s in ("lower", "upper"))
        return df.withColumns({"lower_bound": F.least(low, high), "upper_bound": F.greatest(low, high)})


# --- ensemble ----------------------------------------------------------------------------------


class EnsembleRegression(Estimator, HasLabelCol, HasPredictionCol):
    """Fits named estimators, each with a ``prediction`` column, and weighs them by inverse error, equally or as given."""

    def __init__(self, members: Mapping[str, Estimator], labelCol: str, weights: str | Mapping[str, float] = "inverse_mse", predictionCol: str = "pred_Ensemble"):
        super().__init__()
        self._set(labelCol=labelCol, predictionCol=predictionCol)
        self.members, self.weights = dict(members), weights

    def _fit(self, df: DataFrame) -> "EnsembleRegressionModel":
        fitted = {name: estimator.fit(df) for name, estimator in self.members.items()}
        return weighted(fitted, df, self.getLabelCol(), self.weights, self.getPredictionCol())


def weighted(members: Mapping[str, Model], df: DataFrame, target: str, weights: str | Mapping[str, float] = "inverse_mse", out: str = "pred_Ensemble") -> "EnsembleRegressionModel":
    """Fitted members with weights by their errors on ``df`` (or equal, or given ones)."""
    from wearcurve.operators.models import ensemble_weights

    if not members:
        raise ValueError("an ensemble needs at least one model")
    scored = EnsembleRegressionModel(members, [], predictionCol=out).score(df)
    # one row for each member
    found = {r["model"]: float(r["weight"]) for r in ensemble_weights(scored, target, list(members), weights).collect()}
    return EnsembleRegressionModel(members, [found[name] for name in members], predictionCol=out)


class EnsembleRegressionModel(Model, HasPredictionCol, MLWritable, MLReadable):
    """Adds ``pred_<member>`` for every member and their weighted sum."""

    names = _param("names", "names of the members", TypeConverters.toListString)
    weights = _param("weights", "weight of each member", TypeConverters.toListFloat)

    def __init__(self, members: Mapping[str, Model] | None = None, weights: Sequence[float] = (), predictionCol: str = "pred_Ensemble"):
        super().__init__()
        self.members = dict(members or {})
        self._set(names=list(self.members), weights=list(weights), predictionCol=predictionCol)

    def score(self, df: DataFrame) -> DataFrame:
        """Every member's column, without their sum."""
        for name, model in self.members.items():
            df = model.transform(df.drop("prediction")).withColumnRenamed("prediction", f"pred_{name}").drop(FEATURES)
        return df

    def _transform(self, df: DataFrame) -> DataFrame:
        terms = [F.col(f"pred_{n}") * F.lit(w) for n, w in zip(self.members, self.getOrDefault("weights"), strict=True)]
        return self.score(df).withColumn(self.getPredictionCol(), sum(terms[1:], terms[0]))

    def write(self) -> MLWriter:
        return _EnsembleWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _EnsembleReader(cls)


class _EnsembleWriter(MLWriter):
    def __init__(self, instance: EnsembleRegressionModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        for i, model in enumerate(self.instance.members.values()):
            model.write().save(os.path.join(path, "members", str(i)))


class _EnsembleReader(MLReader):
    def __init__(self, kind: type):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> EnsembleRegressionModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        found = self.kind()
        found._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(found, metadata)
        names = found.getOrDefault("names")
        found.members = {n: DefaultParamsReader.loadParamsInstance(os.path.join(path, "members", str(i)), self.sparkSession) for i, n in enumerate(names)}
        return found
