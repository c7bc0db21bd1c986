"""Schemas that the jobs share."""

from __future__ import annotations

from pyspark.sql import types as T

# The fields of a message, in the order in which they are written.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.LongType(), True),
        T.StructField("sensor_id", T.StringType(), True),
        T.StructField("value", T.FloatType(), True),
    ]
)
MESSAGE_FIELDS = tuple(MESSAGE_SCHEMA.names)
CORRUPT_COLUMN = "_corrupt_record"

# The same fields plus the text of a message that could not be read in full.
AUDITED_MESSAGE_SCHEMA = T.StructType([*MESSAGE_SCHEMA.fields, T.StructField(CORRUPT_COLUMN, T.StringType(), True)])

# The key of an event: its offset in the topic and the order of a replay.
EVENT_ID = "event_id"

FEATURES = ("pressure_value", "hour_of_day")
LABEL = "label"

# Where a row stands in its source: parquet file and row of it.
POSITION = ("source_file", "source_row")
