"""Message topics: the broker connector when it is deployed, or a folder of message files.

Both give records with a ``value`` column; the rest of the package never asks which one it was.
The connector is not part of PySpark: submit with its package to use the broker functions.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slumberline.functions.messages import decode_messages
from slumberline.rules import PEEK_SIZE

CONNECTOR = "kafka"
FILE_RECORD_SCHEMA = T.StructType([T.StructField("value", T.StringType(), True)])

RECORD_SCHEMA = T.StructType([T.StructField("key", T.BinaryType(), True), T.StructField("value", T.BinaryType(), True)])


@dataclass(frozen=True)
class Topic:
    # The topic of the raw events and the broker's address inside the cluster.
    name: str = "smart_home_events"
    servers: str = "kafka:9092"


def read_options(topic: Topic, starting_offsets: str, max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": topic.servers,
        "subscribe": topic.name,
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def write_options(topic: Topic) -> dict[str, str]:
    return {"kafka.bootstrap.servers": topic.servers, "topic": topic.name}


def stream_topic(
    spark: SparkSession, topic: Topic, starting_offsets: str = "latest", max_offsets_per_trigger: int | None = None
) -> DataFrame:
    """Unbounded read of a topic; ``max_offsets_per_trigger`` limits the pace of a replay."""
    options = read_options(topic, starting_offsets, max_offsets_per_trigger)
    return spark.readStream.format(CONNECTOR).options(**options).load()


def read_topic(spark: SparkSession, topic: Topic) -> DataFrame:
    """Bounded read of all records from the earliest offset; commits nothing."""
    return spark.read.format(CONNECTOR).options(**read_options(topic, "earliest")).load()


def read_partition(spark: SparkSession, topic: Topic, partition: int) -> DataFrame:
    """Bounded read of one partition of a topic from its earliest offset, in the order of its offsets."""
    options = read_options(topic, "earliest")
    del options["subscribe"]
    options["assign"] = json.dumps({topic.name: [partition]})
    return spark.read.format(CONNECTOR).options(**options).load()


def publish(records: DataFrame, topic: Topic) -> None:
    """Write records to a topic from the executors."""
    records.write.format(CONNECTOR).options(**write_options(topic)).save()


def stream_message_files(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None
) -> DataFrame:
    """Unbounded read of a folder of message files, one JSON object per line."""
    reader = spark.readStream.format("text").schema(FILE_RECORD_SCHEMA)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.load(path)


def read_message_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILE_RECORD_SCHEMA).text(path)


def publish_files(records: DataFrame, path: str) -> None:
    """Append records to a folder of message files."""
    records.select(records["value"].cast("string")).write.mode("append").text(path)


def append_records(records: DataFrame, path: str) -> None:
    """Append records (key, value) to a folder that keeps them as a topic does, in binary."""
    columns = [F.col(field.name).cast(field.dataType).alias(field.name) for field in RECORD_SCHEMA]
    records.select(*columns).write.mode("append").parquet(path)


def stream_record_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Unbounded read of a folder of records with keys."""
    reader = spark.readStream.schema(RECORD_SCHEMA)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def peek(
    records: DataFrame, n: int = PEEK_SIZE, position: Sequence[str] = ("offset",), columnar: bool = False
) -> DataFrame:
    """The first ``n`` records by ``position``, decoded; fewer if there are fewer. Waits for none and commits nothing.

    Records in a column format should say ``columnar``: the ``n``-th position is then found from the
    position columns alone, and other columns are read only up to it. Without a position the order
    of the source is taken as it is.
    """
    first, carry = _first(records, n, position, columnar)
    return decode_messages(first, carry)


def _first(records: DataFrame, n: int, position: Sequence[str], columnar: bool) -> tuple[DataFrame, list[str]]:
    """The first records, and the columns that go before what is decoded."""
    if not position:
        return records.limit(n), []
    if columnar:
        first = records.select(*position).orderBy(*position).limit(n)
        last = first.agg(F.max(F.struct(*position)).alias("last")).first()["last"]
        if last is not None:
            records = records.filter(_up_to(dict(zip(position, last))))
    carry = [*position, *(["key"] if "key" in records.columns else [])]
    return records.orderBy(*position).limit(n), carry


def peek_any(
    records: DataFrame, n: int = PEEK_SIZE, position: Sequence[str] = ("offset",), columnar: bool = False
) -> DataFrame:
    """``peek`` without a schema: ``data`` holds whatever JSON a record has, with all its fields and their types, as a
    variant. A record that is no JSON has null there and its ``text``. ``message_fields`` spreads it out."""
    first, carry = _first(records, n, position, columnar)
    text = F.col("value").cast("string")
    data = F.try_parse_json(text)
    return first.select(*carry, data.alias("data"), F.when(data.isNull(), text).alias("text"))


def message_fields(peeked: DataFrame) -> DataFrame:
    """One row per field of each record's object (or element of its array): ``field``, its ``type`` and the ``data`` in it, after
    the columns that tell the record. A record of another kind is one row without a field's name."""
    told = {name: f"_of_{name}" for name in peeked.columns}
    parts = peeked.withColumnsRenamed(told)
    data = F.col(told["data"])
    spread = parts.lateralJoin(peeked.sparkSession.tvf.variant_explode_outer(data.outer()), how="left")
    value = F.coalesce(F.col("value"), data)
    return spread.select(
        *[F.col(new).alias(name) for name, new in told.items() if name not in ("data", "text")],
        F.coalesce("key", F.col("pos").cast("string")).alias("field"),
        F.schema_of_variant(value).alias("type"),
        value.alias("data"),
    )


def peek_topic(
    spark: SparkSession, topic: Topic, n: int = PEEK_SIZE, partitions: Sequence[int] | None = None, any_shape: bool = False
) -> DataFrame:
    """``n`` records from the start of a broker's topic, decoded, by partition and offset; fewer if there are fewer.

    All partitions are looked into, one, then a few, then more, until ``n`` records are found, or the named ones one by one. Records
    of a partition come in the order of their offsets, so a limit right above the scan needs no sort and stops each
    read early, however long the topic is. The driver gets ``n`` records. ``any_shape`` keeps whatever JSON they hold.
    """
    columns = ["partition", "offset", "key", "value"]
    if partitions is None:
        # Spark takes a limit in rounds over ever more partitions, and ends with the round that has enough.
        first = read_topic(spark, topic).select(*columns).limit(n)
        found, schema = first.collect(), first.schema
    else:
        found, schema = [], T.StructType([])
        for partition in sorted(partitions):
            first = read_partition(spark, topic, partition).select(*columns).limit(n - len(found))
            schema = first.schema
            found += first.collect()
            if len(found) >= n:
                break
    found = sorted(found, key=lambda record: (record["partition"], record["offset"]))
    records = spark.createDataFrame(found, schema)
    if any_shape:
        return peek_any(records, n, ("partition", "offset"))
    return decode_messages(records, columns[:-1])


def _up_to(last: dict[str, int]) -> Column:
    """Positions up to ``last``, in lexicographic order, as comparisons that a scan can use."""
    (name, bound), *rest = last.items()
    if not rest:
        return F.col(name) <= bound
    return (F.col(name) < bound) | ((F.col(name) == bound) & _up_to(dict(rest)))
