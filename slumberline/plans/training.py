"""Training and evaluation in one pass over the events."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slumberline.operators.features import feature_table, of_sensor
from slumberline.operators.learning import WEIGHT, feature_cells, fit_each, penalty, score_each
from slumberline.operators.metrics import BINS, areas_under_roc, binned_area_under_roc, classification_report, confusion_matrix
from slumberline.operators.reports import label_distribution, split_counts
from slumberline.operators.sampling import hash_split, side
from slumberline.rules import SPLIT_WEIGHTS, ModelParams, SleepRule
from slumberline.session import materialize

BY_MODEL = ("model", "reg")


def split_features(
    events: DataFrame,
    rule: SleepRule,
    key: Sequence[str],
    weights: Sequence[float] = SPLIT_WEIGHTS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Labelled feature rows with their side of the split, which hangs on ``key``, after the ``carry`` columns."""
    split_events = hash_split(of_sensor(events, rule.sensor_id), key, weights)
    return feature_table(split_events, rule, carry=[*carry, "split"])


@dataclass(frozen=True)
class Training:
    """Fitted models by setting, with reports over the stored cells; no report reads the events again. Reports
    tell models by ``model``, the place of the setting, beside their penalty ``reg``."""

    models: Mapping[ModelParams, PipelineModel]
    cells: DataFrame
    scored: DataFrame

    def split_counts(self) -> DataFrame:
        return split_counts(self.cells, WEIGHT)

    def label_distribution(self) -> DataFrame:
        return label_distribution(side(self.cells, "test"), WEIGHT)

    def confusion_matrix(self) -> DataFrame:
        return confusion_matrix(self.scored, WEIGHT, BY_MODEL)

    def report(self) -> DataFrame:
        return classification_report(self.confusion_matrix(), BY_MODEL)

    def metrics(self) -> DataFrame:
        """All quality figures of a model in one row; null where there are no test rows."""
        keys = [(i, float(penalty(key))) for i, key in enumerate(self.models)]
        models = self.cells.sparkSession.createDataFrame(keys, "model int, reg double")
        by = list(BY_MODEL)
        return models.join(self.report(), by, "left").join(self.area_under_roc(), by, "left")

    def area_under_roc(self) -> DataFrame:
        return areas_under_roc(self.scored, WEIGHT, BY_MODEL)

    def binned_area_under_roc(self, bins: int = BINS) -> DataFrame:
        """The areas from bins of margins, with the bound of their error; no margins are stored."""
        areas = []
        for i, key in enumerate(self.models):
            area = binned_area_under_roc(self.scored.filter(F.col("model") == i), WEIGHT, bins)
            areas.append(area.select(F.lit(i).alias("model"), F.lit(float(penalty(key))).alias("reg"), "auc", "bound"))
        return reduce(DataFrame.unionByName, areas)


def train(split_rows: DataFrame, params: Sequence[ModelParams]) -> Training:
    """Fit one model per setting on the train side and score the test side."""
    return train_on_cells(materialize(feature_cells(split_rows, by=["split"]), "cells"), params)


def train_on_cells(cells: DataFrame, params: Sequence[ModelParams]) -> Training:
    """The same from stored cells (split, features, label, weight)."""
    if len(set(params)) < len(params):
        raise ValueError("the same setting is given twice")
    fitted = fit_each(side(cells, "train"), params)
    models = dict(zip(params, fitted))
    return Training(models, cells, score_each(models, side(cells, "test")))
