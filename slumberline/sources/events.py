"""Event files as canonical events: ``[event_id,] timestamp`` (epoch ms), ``sensor_id``, ``value`` (32-bit)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slumberline.functions.clock import epoch_millis
from slumberline.functions.readings import reading
from slumberline.sources.schema import EVENT_ID, POSITION


@dataclass(frozen=True)
class EventColumns:
    """Where a file keeps the canonical columns, and in which unit its time is."""

    timestamp: str = "timestamp"
    sensor_id: str = "sensor_id"
    value: str = "value"
    event_id: str | None = None
    unit: str = "ms"


# The column names of the replayed export, and of the ``events`` table.
EXPORT_COLUMNS = EventColumns(timestamp="Time", sensor_id="Sensor_ID", value="Value")
EVENTS_TABLE_COLUMNS = EventColumns(
    timestamp="ts", sensor_id="event_type", value="value", event_id="event_id", unit="timestamp_ntz"
)

UTC_NAMES = ("UTC", "Etc/UTC", "Z", "GMT")


def canonical_events(raw: DataFrame, columns: EventColumns = EventColumns(), carry: Sequence[str] = ()) -> DataFrame:
    """Rename and type the columns of ``raw``, before the ``carry`` columns; a sensor id that is text already stays a bare column,
    so that a filter on it still reaches the scan."""
    sensor = F.col(columns.sensor_id)
    if not isinstance(raw.select(sensor).schema[0].dataType, T.StringType):
        sensor = sensor.cast("string")
    kind = raw.select(columns.timestamp).schema[0].dataType
    if columns.unit in ("ms", "s") and isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        raise ValueError(
            f"column {columns.timestamp!r} is a {kind.simpleString()}, not a number in {columns.unit!r}: "
            "set the unit to timestamp or timestamp_ntz"
        )
    in_utc = raw.sparkSession.conf.get("spark.sql.session.timeZone") in UTC_NAMES
    selected = [
        epoch_millis(F.col(columns.timestamp), columns.unit, in_utc).alias("timestamp"),
        sensor.alias("sensor_id"),
        reading(F.col(columns.value)).alias("value"),
    ]
    if columns.event_id:
        selected.insert(0, F.col(columns.event_id).cast("bigint").alias(EVENT_ID))
    return raw.select(*selected, *carry)


def read_csv_events(spark: SparkSession, path: str, columns: EventColumns = EventColumns()) -> DataFrame:
    """Events of a CSV file or folder with a header.

    The header alone gives the column names: every field is read as text and typed by
    ``canonical_events``, so no pass over the data is spent on guessing types and the result does
    not hinge on what the data happens to hold.
    """
    # Without a schema to enforce, a file whose header differs from the first one's is an error, not misread.
    raw = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    return canonical_events(raw, columns)


def read_parquet_events(
    spark: SparkSession, path: str, columns: EventColumns = EventColumns(), positions: bool = False
) -> DataFrame:
    """Events of parquet files; with ``positions`` each with its place there, which tells any two rows apart."""
    raw = spark.read.parquet(path)
    if not positions:
        return canonical_events(raw, columns)
    places = [F.col("_metadata.file_path").alias(POSITION[0]), F.col("_metadata.row_index").alias(POSITION[1])]
    return canonical_events(raw.select("*", *places), columns, carry=POSITION)


def read_events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table of a data folder as canonical events with their id."""
    return read_parquet_events(spark, f"{sf_dir}/events.parquet", EVENTS_TABLE_COLUMNS)


def stream_events_table(spark: SparkSession, sf_dir: str, max_bytes_per_trigger: int | None = None) -> DataFrame:
    """The ``events`` table, one file or a folder of files, as an unbounded source.

    A stream takes a bare path for a folder, which may be partitioned, but only a pattern for one file.
    """
    path = f"{sf_dir}/events.parquet"
    table = spark.read.parquet(path)
    some_file = table.select("_metadata.file_path").first()
    if some_file and some_file[0].endswith("/events.parquet"):
        path = f"{sf_dir}/{{events.parquet}}"
    reader = spark.readStream.schema(table.schema)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return canonical_events(reader.parquet(path), EVENTS_TABLE_COLUMNS)
