"""Expressions over sensor readings: the 32-bit value and the rule label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from slumberline.rules import SleepRule


def reading(col: Column) -> Column:
    """A 32-bit float; text that is no number gives null instead of an error."""
    return col.try_cast("double").cast("float")


def is_night(hour: Column, rule: SleepRule) -> Column:
    after, before = hour >= rule.night_start, hour < rule.night_end
    return (after | before) if rule.night_start > rule.night_end else (after & before)


def sleep_label(value: Column, hour: Column, rule: SleepRule) -> Column:
    """1.0 for a reading above the threshold at night, else 0.0, which is also the label of a null reading."""
    return F.when((value > rule.threshold) & is_night(hour, rule), 1.0).otherwise(0.0)
