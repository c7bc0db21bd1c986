import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Observation
from pyspark.sql import functions as F

from slumberline.operators.learning import (
    WEIGHT,
    assembler,
    build_pipeline,
    coefficients,
    feature_cells,
    fit_model,
    fit_models,
    fit_scaler,
    fit_scaler_cells,
    load_model,
    margin,
    predict,
    save_model,
    scaler,
    score,
    score_each,
)
from slumberline.operators.metrics import area_under_roc, classification_report, confusion_matrix
from slumberline.rules import ModelParams

SCHEMA = "pressure_value float, hour_of_day int, label double"


def rows(spark, n=600, seed=1):
    """Readings of which a third share one value, and labels that the features explain in part."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        value = 300.0 if i % 3 == 0 else round(rng.uniform(0, 1000), 1)
        hour = rng.randrange(24)
        data.append((value, hour, float(rng.random() < (0.7 if value > 500 and hour < 12 else 0.2))))
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="module")
def train_rows(spark):
    return rows(spark).cache()


@pytest.fixture(scope="module")
def models(train_rows):
    return dict(zip((0.3, 0.0), fit_models(train_rows, [ModelParams(0.3, tol=1e-8), ModelParams(0.0, tol=1e-8)])))


def test_cells_hold_every_row(train_rows):
    cells = feature_cells(train_rows)
    assert cells.agg(F.sum(WEIGHT)).first()[0] == train_rows.count()
    assert cells.count() < train_rows.count()


def test_scaler_equals_the_one_fitted_on_rows(train_rows):
    expected = scaler().fit(assembler().transform(train_rows))
    for fitted in (fit_scaler(train_rows), fit_scaler_cells(feature_cells(train_rows))):
        assert list(fitted.std) == pytest.approx(list(expected.std), rel=1e-12)
        assert list(fitted.mean) == pytest.approx(list(expected.mean), rel=1e-12)


def test_a_constant_feature_scales_to_zero(spark):
    df = spark.createDataFrame([(7.0, 1, 0.0), (7.0, 2, 1.0)], SCHEMA)
    for fitted in (fit_scaler(df), fit_scaler_cells(feature_cells(df))):
        scaled = fitted.transform(assembler().transform(df)).first()["features"]
        assert scaled[0] == 0.0 and scaled[1] > 0


def test_no_training_rows_is_an_error(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    for fit in (fit_scaler, fit_model):
        with pytest.raises(ValueError, match="no training rows"):
            fit(nothing)


@pytest.mark.parametrize("reg", [0.3, 0.0])
def test_fit_on_cells_equals_the_pipeline_on_rows(train_rows, models, reg):
    plain = build_pipeline(ModelParams(reg, tol=1e-8)).fit(train_rows)
    assert coefficients(models[reg]) == pytest.approx(coefficients(plain), abs=1e-6)
    scored = score(models[reg], train_rows).select("prediction", *train_rows.columns)
    assert scored.exceptAll(score(plain, train_rows).select("prediction", *train_rows.columns)).isEmpty()


def test_saved_model_scores_alike(train_rows, models, tmp_path):
    path = str(tmp_path / "model")
    save_model(models[0.3], path)
    save_model(models[0.0], path)  # replaces the first
    again = load_model(path)
    assert coefficients(again) == coefficients(models[0.0])
    wanted = score(models[0.0], train_rows).select("prediction", "rawPrediction")
    assert score(again, train_rows).select("prediction", "rawPrediction").collect() == wanted.collect()


def test_loading_nothing_fails(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)path|exist"):
        load_model(str(tmp_path / "missing"))


def test_each_model_scores_each_row_as_its_stages_do(train_rows, models):
    scored = score_each(models, train_rows)
    assert scored.columns == [*train_rows.columns, "model", "reg", "margin", "prediction"]
    for reg, model in models.items():
        own = scored.filter(F.col("reg") == reg).drop("model", "reg")
        staged = score(model, train_rows).withColumn("margin", vector_to_array("rawPrediction")[1]).select(own.columns)
        assert own.exceptAll(staged).isEmpty() and staged.exceptAll(own).isEmpty()


@pytest.mark.parametrize("label", [0.0, 1.0])
def test_training_rows_of_one_class(spark, label):
    df = spark.createDataFrame([(float(i), i % 24, label) for i in range(50)], SCHEMA)
    scored = score_each({0.3: fit_model(df)}, df)
    assert [tuple(row) for row in confusion_matrix(scored).collect()] == [(label, label, 50)]
    assert area_under_roc(scored) is None


@pytest.mark.parametrize("threshold", [0.0, 0.2, 0.5, 0.9, 1.0])
def test_threshold_of_the_model(train_rows, threshold):
    model = fit_model(train_rows, ModelParams(reg_param=0.0, threshold=threshold))
    own = train_rows.select("*", predict(model, margin(model)).alias("prediction"))
    assert own.exceptAll(score(model, train_rows).select(own.columns)).isEmpty()


def test_a_constant_feature_does_not_count(spark):
    df = spark.createDataFrame([(7.0, hour, float(hour > 11)) for hour in range(24)], SCHEMA)
    model = fit_model(df)
    staged = score(model, df).select("hour_of_day", vector_to_array("rawPrediction")[1].alias("margin"))
    assert df.select("hour_of_day", margin(model).alias("margin")).exceptAll(staged).isEmpty()


# --- metrics ------------------------------------------------------------------------------------


def test_metrics_equal_the_evaluators(train_rows, models):
    scored = score_each({0.0: models[0.0]}, train_rows)
    report = classification_report(confusion_matrix(scored)).first()
    for column, metric in {
        "accuracy": "accuracy",
        "weighted_precision": "weightedPrecision",
        "weighted_recall": "weightedRecall",
        "f1": "f1",
    }.items():
        evaluator = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName=metric)
        assert report[column] == pytest.approx(evaluator.evaluate(scored), abs=1e-12)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="margin", labelCol="label", numBins=0)
    assert area_under_roc(scored) == pytest.approx(evaluator.evaluate(scored), abs=1e-12)


def test_metrics_of_cells_equal_those_of_rows(train_rows, models):
    by_row, by_cell = score_each(models, train_rows), score_each(models, feature_cells(train_rows))
    confusion = confusion_matrix(by_row, by=["reg"])
    assert confusion.exceptAll(confusion_matrix(by_cell, WEIGHT, ["reg"])).isEmpty()
    for reg in models:
        area = area_under_roc(by_row.filter(F.col("reg") == reg))
        assert area_under_roc(by_cell.filter(F.col("reg") == reg), WEIGHT) == pytest.approx(area, abs=1e-12)


def test_area_is_the_share_of_ordered_pairs(spark):
    rng = random.Random(3)
    data = [(rng.randrange(40) / 8, float(rng.random() < 0.4)) for _ in range(300)]
    above = [m for m, label in data if label]
    below = [m for m, label in data if not label]
    pairs = sum((a > b) + (a == b) / 2 for a in above for b in below) / (len(above) * len(below))
    assert area_under_roc(spark.createDataFrame(data, "margin double, label double")) == pytest.approx(pairs, abs=1e-12)


@pytest.mark.parametrize("data", [[], [(0.5, 0.0), (0.7, 0.0)], [(0.5, 1.0)]])
def test_one_class_has_no_area(spark, data):
    assert area_under_roc(spark.createDataFrame(data, "margin double, label double")) is None


def test_a_class_that_is_never_predicted(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 0.0), (1.0, 0.0)], "label double, prediction double")
    report = classification_report(confusion_matrix(df)).first()
    assert report["accuracy"] == pytest.approx(2 / 3)
    assert report["weighted_precision"] == pytest.approx(4 / 9)
    assert report["f1"] == pytest.approx(2 / 3 * 0.8)


def test_three_classes(spark):
    rng = random.Random(5)
    data = [(float(rng.randrange(3)), float(rng.randrange(3))) for _ in range(90)]
    df = spark.createDataFrame(data, "label double, prediction double")
    report = classification_report(confusion_matrix(df)).first()
    evaluator = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="f1")
    assert report["f1"] == pytest.approx(evaluator.evaluate(df), abs=1e-12)


def test_fitting_and_scoring_in_a_session_that_has_observed(spark):
    """A session that has used an ``Observation`` cannot ship a model with its training summary to tasks."""
    session = spark.newSession()
    session.range(3).observe(Observation(), F.count(F.lit(1)).alias("n")).collect()
    df = rows(session, 60)
    assert score_each({0.3: fit_model(df)}, df).count() == 60
