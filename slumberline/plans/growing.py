"""Reports and training over data that grows: each file is counted once, and the counts add up.

What a file set leaves is its cells: events of the sensor per reading, hour of day and side of the split. They are all
that the reports, the fit and the evaluation need, and the cells of several file sets are merged by adding their counts.
Labels are not stored, so the threshold and the night may change without another pass.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slumberline.operators.features import of_sensor, usable, with_hour, with_label
from slumberline.operators.learning import WEIGHT
from slumberline.operators.reports import hour_distribution_of_hours, pressure_stats_of_hours
from slumberline.operators.sampling import hash_split
from slumberline.plans.training import Training, train_on_cells
from slumberline.rules import SPLIT_WEIGHTS, ModelParams, SleepRule
from slumberline.session import materialize
from slumberline.sources.schema import FEATURES, LABEL
from slumberline.streaming.tables import BATCH, BatchTables

CELL = ("split", *FEATURES)
CELLS_SCHEMA = T.StructType(
    [
        T.StructField("split", T.StringType()),
        T.StructField("pressure_value", T.FloatType()),
        T.StructField("hour_of_day", T.IntegerType()),
        T.StructField(WEIGHT, T.LongType()),
    ]
)
FILES_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
    ]
)
ReadEvents = Callable[[Sequence[str]], DataFrame]


def event_cells(events: DataFrame, rule: SleepRule, key: Sequence[str], weights: Sequence[float] = SPLIT_WEIGHTS) -> DataFrame:
    """The sensor's events per side of the split, reading and hour, unusable readings included."""
    rows = with_hour(hash_split(of_sensor(events, rule.sensor_id), key, weights), rule)
    return rows.groupBy(*CELL).agg(F.count(F.lit(1)).alias(WEIGHT))


def merged_cells(cells: DataFrame) -> DataFrame:
    """One row per cell, of cells of several file sets."""
    return cells.groupBy(*CELL).agg(F.sum(WEIGHT).cast("bigint").alias(WEIGHT))


def hourly_of_cells(cells: DataFrame) -> DataFrame:
    """``reports.hourly_readings`` of the events that cells stand for. Squares are taken about the hour's mean, so that
    large readings cost no digits; the hours, 25 at most, are all that is joined back."""
    value, weight = F.col("pressure_value").cast("double"), F.col(WEIGHT)
    counted = F.when(F.col("pressure_value").isNotNull(), weight)
    hours = cells.groupBy("hour_of_day").agg(
        F.sum(weight).alias("count"),
        F.coalesce(F.sum(counted), F.lit(0)).alias("readings"),
        F.min("pressure_value").alias("least"),
        (F.sum(weight * value) / F.sum(counted)).alias("mean"),
        F.max("pressure_value").alias("greatest"),
    )
    hours = materialize(hours, "hours-of-cells")
    means = hours.select(F.col("hour_of_day").alias("of_hour"), "mean", "readings")
    off = cells.join(F.broadcast(means), F.col("hour_of_day").eqNullSafe(F.col("of_hour")))
    squares = off.groupBy("of_hour").agg(
        (F.sum(weight * F.pow(value - F.col("mean"), 2)) / F.nullif(F.first("readings") - 1, F.lit(0))).alias("variance")
    )
    joined = hours.join(squares, F.col("hour_of_day").eqNullSafe(F.col("of_hour")))
    return joined.select("hour_of_day", "count", "readings", "least", "mean", "variance", "greatest")


class GrowingEvents:
    """Stored cells of an events folder, and the list of files that they count.

    ``update`` reads files that are new; it may fail at any point and be called again, as the part of an update counts only
    once all of it is written. One update at a time: the next number is taken from the complete ones.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        rule: SleepRule,
        key: Sequence[str],
        weights: Sequence[float] = SPLIT_WEIGHTS,
    ):
        self.spark, self.rule, self.key, self.weights = spark, rule, list(key), weights
        self.tables = BatchTables(spark, root)

    def known_files(self) -> DataFrame:
        return self.tables.read("files", FILES_SCHEMA).drop(BATCH)

    def new_files(self, folder: str) -> DataFrame:
        """Path, time and length of the files that no update has counted. A counted file that has changed is an error: its
        old counts can't be taken back."""
        listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
        listed = listed.select(*FILES_SCHEMA.names)
        known = self.known_files()
        fresh = listed.join(known, FILES_SCHEMA.names, "left_anti")
        changed = fresh.join(known, "path", "left_semi").limit(1).collect()
        if changed:
            raise ValueError(f"{changed[0]['path']} has changed since it was counted")
        return fresh

    def update(self, folder: str, read: ReadEvents) -> list[str]:
        """Count the files that have come into ``folder``; ``read`` gives the canonical events of some paths. Returns what was
        read: paths of new files go through the driver, as in any listing of a folder."""
        fresh = materialize(self.new_files(folder), "new-files")
        paths = [row["path"] for row in fresh.select("path").collect()]
        if paths:
            last = self.tables.committed().agg(F.max(BATCH)).first()[0]
            number = 0 if last is None else last + 1
            self.tables.write("cells", event_cells(read(paths), self.rule, self.key, self.weights), number)
            self.tables.write("files", fresh, number)
            self.tables.commit(number)
        return paths

    def cells(self) -> DataFrame:
        return merged_cells(self.tables.read("cells", CELLS_SCHEMA))

    def compact(self, root: str) -> GrowingEvents:
        """The same counts as a single part under another folder, after many small updates."""
        other = GrowingEvents(self.spark, root, self.rule, self.key, self.weights)
        other.tables.write("cells", self.cells(), 0)
        other.tables.write("files", self.known_files(), 0)
        other.tables.commit(0)
        return other

    def describe(self) -> tuple[DataFrame, DataFrame]:
        """``jobs.describe`` of all files counted so far."""
        hourly = hourly_of_cells(self.cells())
        return pressure_stats_of_hours(hourly), hour_distribution_of_hours(hourly)

    def train(self, params: Sequence[ModelParams]) -> Training:
        """``training.train`` of all files counted so far."""
        labelled = with_label(self.cells(), self.rule).filter(usable())
        return train_on_cells(materialize(labelled.select("split", *FEATURES, LABEL, WEIGHT), "cells"), params)
