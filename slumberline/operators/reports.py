"""Descriptive reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slumberline.sources.schema import LABEL

HOURS_PER_DAY = 24


def reading_stats() -> list[Column]:
    """Count of readings, minimum, mean, sample standard deviation and maximum, as aggregates."""
    value = F.col("pressure_value")
    return [
        F.count(value).alias("Count"),
        F.min(value).alias("Min_Pressure"),
        F.mean(value).alias("Mean_Pressure"),
        F.stddev_samp(value).alias("StdDev_Pressure"),
        F.max(value).alias("Max_Pressure"),
    ]


def pressure_stats(featured: DataFrame) -> DataFrame:
    """The statistics of all readings in one row."""
    return featured.agg(*reading_stats())


def hour_distribution(featured: DataFrame) -> DataFrame:
    """Events per observed hour of day, by hour. At most 24 groups can exist, so the bound cuts nothing;
    it lets Spark order them without a range exchange."""
    hours = featured.filter(F.col("hour_of_day").isNotNull()).groupBy("hour_of_day").count()
    return hours.orderBy("hour_of_day").limit(HOURS_PER_DAY)


def hourly_readings(featured: DataFrame) -> DataFrame:
    """Events and moments of the readings per hour of day: one pass from which both reports above follow."""
    value = F.col("pressure_value")
    return featured.groupBy("hour_of_day").agg(
        F.count(F.lit(1)).alias("count"),
        F.count(value).alias("readings"),
        F.min(value).alias("least"),
        F.mean(value).alias("mean"),
        F.var_samp(value).alias("variance"),
        F.max(value).alias("greatest"),
    )


def pressure_stats_of_hours(hourly: DataFrame) -> DataFrame:
    """``pressure_stats`` from at most 25 hourly rows: deviations within the hours and between them add up."""
    n, whole_day = F.col("readings"), Window.partitionBy()
    overall = F.sum(n * F.col("mean")).over(whole_day) / F.nullif(F.sum(n).over(whole_day), F.lit(0))
    within = F.coalesce((n - 1) * F.col("variance"), F.lit(0.0))
    between = n * F.pow(F.col("mean") - F.col("overall"), 2)
    degrees = F.sum(n) - 1
    return hourly.withColumn("overall", overall).agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("Count"),
        F.min("least").alias("Min_Pressure"),
        F.max("overall").alias("Mean_Pressure"),
        F.when(degrees > 0, F.sqrt(F.sum(within + between) / degrees)).alias("StdDev_Pressure"),
        F.max("greatest").alias("Max_Pressure"),
    )


def hour_distribution_of_hours(hourly: DataFrame) -> DataFrame:
    """``hour_distribution`` from hourly rows."""
    return hourly.filter(F.col("hour_of_day").isNotNull()).select("hour_of_day", "count").orderBy("hour_of_day")


def label_distribution(rows: DataFrame, weight: str | None = None) -> DataFrame:
    return rows.groupBy(LABEL).agg(_count(weight).alias("count"))


def split_counts(rows: DataFrame, weight: str | None = None) -> DataFrame:
    """Rows per side of the split, in one job."""
    return rows.groupBy("split").agg(_count(weight).alias("count"))


def _count(weight: str | None):
    return F.sum(weight) if weight else F.count(F.lit(1))
