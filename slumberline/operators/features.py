"""From canonical events to the feature rows of training and serving. Batch and stream share every function."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from math import inf

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slumberline.functions.clock import hour_of_day
from slumberline.functions.readings import sleep_label
from slumberline.rules import SleepRule
from slumberline.sources.schema import FEATURES, LABEL


def of_sensor(events: DataFrame, sensor_id: str) -> DataFrame:
    return events.filter(F.col("sensor_id") == sensor_id)


def of_sensors(events: DataFrame, sensor_ids: Iterable[str]) -> DataFrame:
    return events.filter(F.col("sensor_id").isin(*sensor_ids))


def with_hour(events: DataFrame, rule: SleepRule) -> DataFrame:
    """Name the reading after what it measures and add its hour of day."""
    return events.withColumnRenamed("value", "pressure_value").withColumns(
        {"hour_of_day": hour_of_day(F.col("timestamp"), rule.zone)}
    )


def with_label(featured: DataFrame, rule: SleepRule) -> DataFrame:
    return featured.withColumns({LABEL: sleep_label(F.col("pressure_value"), F.col("hour_of_day"), rule)})


def usable() -> Column:
    """A finite reading and an hour. NaN counts as larger than infinity."""
    return (F.abs("pressure_value") < F.lit(inf)) & F.col("hour_of_day").isNotNull()


def inference_table(events: DataFrame, rule: SleepRule, carry: Sequence[str] = ()) -> DataFrame:
    """Rows of the rule's sensor that can be scored. A row without a finite reading or an hour is left out,
    as it is in training, so that one bad message cannot end a stream."""
    featured = with_hour(of_sensor(events, rule.sensor_id), rule)
    return featured.select(*carry, "timestamp", "sensor_id", *FEATURES).filter(usable())


def feature_table(events: DataFrame, rule: SleepRule, carry: Sequence[str] = ()) -> DataFrame:
    """Labelled feature rows of the rule's sensor, after the ``carry`` columns. Rows with a null
    or non-finite feature go; the label, which is never null, is left out of that check."""
    featured = with_label(with_hour(of_sensor(events, rule.sensor_id), rule), rule)
    return featured.select(*carry, *FEATURES, LABEL).filter(usable())
