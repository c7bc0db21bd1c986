"""Scoring of messages with a fitted model: one function for batch and stream, and the streaming query around it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from slumberline.functions.messages import decode_messages, may_concern
from slumberline.operators.features import inference_table
from slumberline.operators.learning import margin, predict
from slumberline.rules import SleepRule
from slumberline.sources.schema import CORRUPT_COLUMN


def counted(df: DataFrame, name: str, *counts: Column) -> DataFrame:
    """Count on the way, in a stream: the names would clash when a batch query uses two such tables."""
    return df.observe(name, *counts) if df.isStreaming else df


def scorable_rows(records: DataFrame, rule: SleepRule, audit: bool = False, carry: Sequence[str] = ()) -> DataFrame:
    """Decode records and keep the rows of the rule's sensor that have all features, after the ``carry`` columns.

    Text that cannot be of the sensor is not parsed, unless ``audit`` asks to count what is malformed.
    What is left out is counted in ``observedMetrics`` of the stream's progress: all ``messages`` under
    ``received``, those ``of_sensor`` and, with ``audit``, the ``malformed`` ones under ``decoded``,
    and the remaining ``rows`` under ``scorable``.
    """
    received = counted(records, "received", F.count(F.lit(1)).alias("messages"))
    counts = [F.count_if(F.col("sensor_id") == rule.sensor_id).alias("of_sensor")]
    if audit:
        decoded = decode_messages(received, carry, keep_corrupt=True)
        counts.append(F.count(CORRUPT_COLUMN).alias("malformed"))
    else:
        decoded = decode_messages(received.filter(may_concern(rule.sensor_id)), carry)
    rows = inference_table(counted(decoded, "decoded", *counts), rule, carry)
    return counted(rows, "scorable", F.count(F.lit(1)).alias("rows"))


def score_messages(records: DataFrame, model: PipelineModel, rule: SleepRule, audit: bool = False) -> DataFrame:
    """One row per scorable message: when it was processed, when it happened, what was measured, the prediction."""
    return scorable_rows(records, rule, audit).select(
        F.current_timestamp().alias("Processing_Time"),
        F.col("timestamp").alias("Event_Time_ms"),
        "pressure_value",
        "hour_of_day",
        predict(model, margin(model)).alias("Is_Sleeping_Prediction"),
    )


def triggered(rows: DataFrame, available_now: bool, interval: str | None) -> DataStreamWriter:
    """A writer in append mode that ends when the input is used up, or starts a batch every ``interval``."""
    writer = rows.writeStream.outputMode("append")
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval) if interval else writer


def start_parquet_sink(
    rows: DataFrame, path: str, checkpoint: str, available_now: bool = False, interval: str | None = None
) -> StreamingQuery:
    """Append a stream to a parquet table. With the same checkpoint a restarted query goes on where the
    last one stopped, without loss or repetition. ``available_now`` ends it when the input is used up."""
    writer = triggered(rows, available_now, interval)
    return writer.format("parquet").option("checkpointLocation", checkpoint).start(path)


def start_console(rows: DataFrame, available_now: bool = False, interval: str | None = None) -> StreamingQuery:
    """Print a stream in full width, to look at it."""
    return triggered(rows, available_now, interval).format("console").option("truncate", False).start()
