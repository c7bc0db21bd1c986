"""The jobs a user runs: report, train, publish, score, peek."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from slumberline.functions.messages import encode_messages
from slumberline.operators.features import of_sensor, of_sensors, with_hour
from slumberline.operators.learning import load_model, save_model
from slumberline.operators.reports import hour_distribution_of_hours, hourly_readings, pressure_stats_of_hours
from slumberline.plans.training import Training, split_features, train
from slumberline.rules import REPLAYED_SENSORS, SPLIT_WEIGHTS, ModelParams, SleepRule
from slumberline.sources.csv_reports import write_csv
from slumberline.sources.schema import MESSAGE_FIELDS
from slumberline.streaming.scoring import score_messages, start_console, start_parquet_sink


def describe(events: DataFrame, rule: SleepRule) -> tuple[DataFrame, DataFrame]:
    """Statistics of the sensor's readings, and its events per hour of day, from one pass over the events.

    The pass runs at once; what it leaves is one row per hour, so showing or writing the reports reads nothing again.
    """
    hourly = hourly_readings(with_hour(of_sensor(events, rule.sensor_id), rule))
    hourly = events.sparkSession.createDataFrame(hourly.collect(), hourly.schema)
    return pressure_stats_of_hours(hourly), hour_distribution_of_hours(hourly)


def write_tables(tables: Mapping[str, DataFrame]) -> None:
    """Write each table to its path as CSV."""
    for path, table in tables.items():
        write_csv(table, path)


def train_and_save(
    events: DataFrame,
    rule: SleepRule,
    model_path: str,
    params: ModelParams = ModelParams(),
    key: Sequence[str] = MESSAGE_FIELDS,
    weights: Sequence[float] = SPLIT_WEIGHTS,
) -> Training:
    """Fit, evaluate on the held-out side, save. ``key`` tells events apart for the split; without an
    event id it is the whole event, so copies of an event fall on the same side."""
    training = train(split_features(events, rule, key, weights), [params])
    save_model(training.models[params], model_path)
    return training


def replay_records(events: DataFrame, sensor_ids: Sequence[str] = REPLAYED_SENSORS) -> DataFrame:
    """The complete events of some sensors as records to publish."""
    complete = events.select(*MESSAGE_FIELDS).na.drop("any")
    return encode_messages(of_sensors(complete, sensor_ids))


def start_scoring(
    spark: SparkSession,
    records: DataFrame,
    rule: SleepRule,
    model_path: str,
    sink: str | None = None,
    checkpoint: str | None = None,
    available_now: bool = False,
    interval: str | None = None,
    audit: bool = False,
) -> StreamingQuery:
    """Score a stream of records with a saved model, into a parquet table or, without one, onto the console."""
    rows = score_messages(records, load_model(model_path), rule, audit)
    if sink is None:
        return start_console(rows, available_now, interval)
    if checkpoint is None:
        raise ValueError("a sink needs a checkpoint folder, or a restart would lose or repeat rows")
    return start_parquet_sink(rows, sink, checkpoint, available_now, interval)
