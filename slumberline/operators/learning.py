"""The sleep classifier: assemble, scale, logistic regression; fit, save, load, score.

Readings are 32-bit and hours are 24, so labelled rows repeat. ``feature_cells`` counts them per
distinct (reading, hour, label): one pass over the rows and one shuffle, whose map side already adds
up a hot value. Scaler, regression and metrics all work on those weighted cells, so the rows are
read once however many iterations, models and metrics follow. A cell of weight w adds to moments,
loss and gradient what w equal rows add, so the optimum is the same.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from math import inf, log, sqrt
from operator import add

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slumberline.rules import ModelParams
from slumberline.session import at_once, materialize
from slumberline.sources.schema import FEATURES, LABEL

WEIGHT = "weight"


def assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features_raw")


def scaler() -> StandardScaler:
    """Divide by the sample standard deviation, without centering."""
    return StandardScaler(inputCol="features_raw", outputCol="features", withStd=True, withMean=False)


def regression(params: ModelParams) -> LogisticRegression:
    return LogisticRegression(
        featuresCol="features",
        labelCol=LABEL,
        maxIter=params.max_iter,
        regParam=params.reg_param,
        elasticNetParam=params.elastic_net,
        tol=params.tol,
        threshold=params.threshold,
    )


def build_pipeline(params: ModelParams = ModelParams()) -> Pipeline:
    """The three stages over plain rows; ``fit_model`` gives the same model with fewer passes."""
    return Pipeline(stages=[assembler(), scaler(), regression(params)])


def feature_cells(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows per distinct feature and label values (and ``by`` columns), with their count as ``weight``."""
    return rows.groupBy(*by, *FEATURES, LABEL).agg(F.count(F.lit(1)).alias(WEIGHT))


def fit_scaler(rows: DataFrame) -> StandardScalerModel:
    """The scaler of plain rows, from one aggregation."""
    moments = rows.agg(
        *[F.mean(F.col(name).cast("double")) for name in FEATURES], *[F.stddev_samp(name) for name in FEATURES]
    ).first()
    return _scaler_of(rows.sparkSession, moments[: len(FEATURES)], moments[len(FEATURES) :])


def fit_scaler_cells(cells: DataFrame) -> StandardScalerModel:
    """The scaler of the rows that the cells stand for; the second aggregation is about the mean, so
    that a large mean costs no digits."""
    weight = F.col(WEIGHT)
    total, *sums = cells.agg(F.sum(weight), *[F.sum(weight * F.col(name).cast("double")) for name in FEATURES]).first()
    means = [total and value / total for value in sums]
    distances = [F.col(name).cast("double") - F.lit(mean) for name, mean in zip(FEATURES, means)]
    squares = cells.agg(*[F.sum(weight * distance * distance) for distance in distances]).first()
    deviations = [sqrt((square or 0.0) / max((total or 0) - 1, 1)) for square in squares]
    return _scaler_of(cells.sparkSession, means, deviations)


def _scaler_of(
    spark: SparkSession, means: Sequence[float | None], deviations: Sequence[float | None]
) -> StandardScalerModel:
    """``StandardScaler`` takes neither weights nor moments, so it is fitted on two points: at distance
    d on either side of the mean their sample deviation is d * sqrt(2). A single row deviates by 0."""
    if None in means:
        raise ValueError("no training rows")
    points = [
        tuple(mean + sign * (deviation or 0.0) / sqrt(2) for mean, deviation in zip(means, deviations))
        for sign in (-1, 1)
    ]
    return scaler().fit(assembler().transform(spark.createDataFrame(points, list(FEATURES))))


def fit_cells(cells: DataFrame, scaler_model: StandardScalerModel, params: ModelParams) -> PipelineModel:
    """Fit the regression on weighted cells.

    Scaled features have unit deviation, so the penalty needs no standardization of its own; that
    one would take the weights for reliabilities, not for counts, and change the penalty.
    """
    scaled = scaler_model.transform(assembler().transform(cells))
    estimator = regression(params).setWeightCol(WEIGHT).setStandardization(False)
    model = estimator.fit(scaled.select("features", LABEL, WEIGHT))
    return PipelineModel([assembler(), scaler_model, model])


def fit_each(cells: DataFrame, params: Sequence[ModelParams]) -> list[PipelineModel]:
    """One model per setting from stored cells; they share a scaler."""
    scaler_model = fit_scaler_cells(cells)
    return at_once(cells.sparkSession, lambda setting: fit_cells(cells, scaler_model, setting), params)


def fit_models(train: DataFrame, params: Sequence[ModelParams]) -> list[PipelineModel]:
    """One model per setting, from one pass over the training rows."""
    return fit_each(materialize(feature_cells(train), "training-cells"), params)


def fit_model(train: DataFrame, params: ModelParams = ModelParams()) -> PipelineModel:
    return fit_models(train, [params])[0]


def coefficients(model: PipelineModel) -> tuple[float, float, float]:
    """Intercept, weight of the scaled reading, weight of the scaled hour."""
    fitted: LogisticRegressionModel = model.stages[-1]
    w_pressure, w_hour = fitted.coefficients
    return float(fitted.intercept), float(w_pressure), float(w_hour)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Add the vectors ``rawPrediction`` and ``probability``, and ``prediction``."""
    return model.transform(rows)


def margin(model: PipelineModel) -> Column:
    """The model's raw prediction for label 1 as an expression over the feature columns.

    It takes the steps of the three stages in their order, so it equals ``rawPrediction`` to the last
    bit, but it compiles into the surrounding stage: no vectors, and no model shipped with the tasks.
    """
    _, scaling, fitted = model.stages
    scaled = [
        F.col(name).cast("double") * F.lit(1 / float(deviation) if deviation else 0.0)
        for name, deviation in zip(FEATURES, scaling.std)
    ]
    terms = [value * F.lit(float(weight)) for value, weight in zip(scaled, fitted.coefficients)]
    return reduce(add, terms) + F.lit(float(fitted.intercept))


def predict(model: PipelineModel, margin_of_row: Column) -> Column:
    """1.0 where the margin says that the probability of label 1 is above the model's threshold, else 0.0."""
    threshold = model.stages[-1].getThreshold()
    odds = threshold / (1 - threshold) if threshold < 1 else inf
    return F.when(margin_of_row > F.lit(log(odds) if odds else -inf), 1.0).otherwise(0.0)


def penalty(key: ModelParams | float) -> float:
    return key.reg_param if isinstance(key, ModelParams) else key


def score_each(models: Mapping[ModelParams | float, PipelineModel], rows: DataFrame) -> DataFrame:
    """Score every row with every model in one pass over ``rows``. Each row comes out once per model, with
    ``model`` (its place in the mapping), ``reg`` (its penalty), ``margin`` and ``prediction``."""
    margins = {f"_margin_{i}": margin(model) for i, model in enumerate(models.values())}
    outcomes = [
        F.struct(
            F.lit(i).alias("model"),
            F.lit(penalty(key)).alias("reg"),
            F.col(name).alias("margin"),
            predict(model, F.col(name)).alias("prediction"),
        )
        for i, (name, (key, model)) in enumerate(zip(margins, models.items()))
    ]
    return rows.withColumns(margins).select(*rows.columns, F.inline(F.array(*outcomes)))
