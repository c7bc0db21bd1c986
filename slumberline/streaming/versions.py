"""Scoring of a stream with models that change while it runs.

A model is published as a row of a small table: its coefficients and from which event time on it holds. Every micro-batch
reads that table anew, so a version published meanwhile is taken up by the next batch without a restart, and each row names
the version that scored it.
"""

from __future__ import annotations

from functools import reduce
from math import inf, log
from operator import add

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from slumberline.rules import SleepRule
from slumberline.sources.schema import FEATURES
from slumberline.streaming.scoring import scorable_rows
from slumberline.streaming.tables import BatchTables, Derived, hourly_counts, start_tables_sink

SCHEMA = "version bigint, valid_from bigint, scales array<double>, weights array<double>, intercept double, bound double"
# The table is broadcast to every task, so it must stay small.
MOST_VERSIONS = 10_000


def coefficients_row(model: PipelineModel, version: int, valid_from: int) -> tuple:
    """What ``learning.margin`` and ``predict`` need of a model, as plain numbers."""
    _, scaling, fitted = model.stages
    threshold = fitted.getThreshold()
    odds = threshold / (1 - threshold) if threshold < 1 else inf
    scales = [1 / float(deviation) if deviation else 0.0 for deviation in scaling.std]
    weights = [float(weight) for weight in fitted.coefficients]
    return version, valid_from, scales, weights, float(fitted.intercept), log(odds) if odds else -inf


class ModelVersions:
    """A table of model versions, a file each; publishing a version again replaces it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def publish(self, model: PipelineModel, version: int, valid_from: int = 0) -> None:
        """``valid_from`` is the first event time in epoch milliseconds that the version scores."""
        row = self.spark.createDataFrame([coefficients_row(model, version, valid_from)], SCHEMA).coalesce(1)
        row.write.mode("overwrite").parquet(f"{self.path}/number={version}")

    def read(self) -> DataFrame:
        """The versions that are published by now, with the event time until which each holds (null: for ever). Of
        versions from the same time on the highest counts."""
        rows = self.spark.read.schema(SCHEMA).parquet(self.path)
        n = rows.count()
        if n > MOST_VERSIONS:
            raise ValueError(f"{n} versions are too many to broadcast; retire old ones")
        latest = rows.groupBy("valid_from").agg(F.max("version").alias("version"))
        rows = rows.select(*[name for name in rows.columns if name != "number"]).join(latest, ["valid_from", "version"])
        return rows.withColumn("valid_to", F.lead("valid_from").over(Window.orderBy("valid_from")))


def _margin() -> Column:
    """``learning.margin`` with the coefficients in columns; the same steps in the same order."""
    terms = [
        F.col(name).cast("double") * F.col("scales")[i] * F.col("weights")[i] for i, name in enumerate(FEATURES)
    ]
    return reduce(add, terms) + F.col("intercept")


def score_versions(rows: DataFrame, versions: DataFrame) -> DataFrame:
    """Scorable rows with the ``version`` that holds at their event time and its prediction; a row before the first
    version has neither."""
    time = F.col("timestamp")
    holds = (time >= F.col("valid_from")) & (F.col("valid_to").isNull() | (time < F.col("valid_to")))
    joined = rows.join(F.broadcast(versions), holds, "left")
    return joined.select(
        F.col("timestamp").alias("Event_Time_ms"),
        *FEATURES,
        "version",
        F.when(F.col("version").isNotNull(), F.when(_margin() > F.col("bound"), 1.0).otherwise(0.0)).alias(
            "Is_Sleeping_Prediction"
        ),
    )


def start_versioned_scoring(
    records: DataFrame,
    rule: SleepRule,
    versions: ModelVersions,
    tables: BatchTables,
    checkpoint: str,
    derived: Derived | None = None,
    available_now: bool = False,
    interval: str | None = None,
) -> StreamingQuery:
    """Score records into the table ``scored``, with hourly counts beside it unless other ``derived`` tables are given."""
    return start_tables_sink(
        scorable_rows(records, rule),
        tables,
        "scored",
        {"hours": hourly_counts} if derived is None else derived,
        checkpoint,
        available_now,
        interval,
        prepare=lambda batch, _: score_versions(batch, versions.read()),
    )
