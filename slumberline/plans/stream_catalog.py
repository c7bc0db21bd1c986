"""Registered queries of streams with state or several tables, and of data that grows; over the whole ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slumberline.functions.messages import encode_messages
from slumberline.operators import learning, sampling
from slumberline.operators.learning import penalty
from slumberline.plans.growing import GrowingEvents
from slumberline.plans.settings import COEFFICIENTS, RULE, STREAM_BATCH, Query, params_of, plain, serving_model, split_rows
from slumberline.session import scratch_path
from slumberline.sources.events import read_events_table, stream_events_table
from slumberline.sources.schema import EVENT_ID
from slumberline.sources.topic import append_records, stream_record_files
from slumberline.streaming import audit, dedup, tables, windows
from slumberline.streaming.scoring import scorable_rows, score_messages, start_parquet_sink
from slumberline.streaming.versions import ModelVersions, score_versions, start_versioned_scoring

# Which messages of the audited stream are cut off, and in which the reading is text: fixed values.
CUT_OFF, NO_NUMBER = 11, 13
# 16 January 2024, in epoch milliseconds.
SECOND_VERSION_FROM = 1_705_363_200_000


def drained(rows: DataFrame, label: str) -> DataFrame:
    """Run a stream over all there is and return the stored result."""
    spark = rows.sparkSession
    sink, checkpoint = scratch_path(spark, label), scratch_path(spark, f"{label}-checkpoint")
    start_parquet_sink(rows, sink, checkpoint, available_now=True).awaitTermination()
    return spark.read.schema(rows.schema).parquet(sink)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_events_table(spark, sf_dir, STREAM_BATCH)


def stream_window_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of all closed windows: one hour each, one after the other or every quarter of an hour."""
    tumbling = drained(windows.window_stats(_events(spark, sf_dir), RULE), "tumbling")
    sliding = drained(windows.sliding_stats(_events(spark, sf_dir), RULE), "sliding")
    kinds = [rows.select(F.lit(kind).alias("kind"), "*") for kind, rows in (("tumbling", tumbling), ("sliding", sliding))]
    return plain(kinds[0].unionByName(kinds[1]), 6)


def stream_sleep_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(drained(windows.sleep_sessions(_events(spark, sf_dir), RULE), "sessions"), 6)


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic into which every record was written twice, the second time by a producer that starts anew."""
    path = scratch_path(spark, "twice")
    records = encode_messages(read_events_table(spark, sf_dir), EVENT_ID)
    records = records.select(F.col(EVENT_ID).cast("string").cast("binary").alias("key"), "value")
    for _ in range(2):
        append_records(records, path)
    return plain(drained(dedup.scorable_once(stream_record_files(spark, path), RULE), "once"))


def stream_two_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored rows and their hourly counts, filled by one stream and read as far as both are complete."""
    rows = score_messages(encode_messages(_events(spark, sf_dir)), serving_model(spark, sf_dir), RULE)
    filled = tables.BatchTables(spark, scratch_path(spark, "two-tables"))
    checkpoint = scratch_path(spark, "two-tables-checkpoint")
    derived = {"hours": tables.hourly_counts}
    tables.start_tables_sink(rows, filled, "scored", derived, checkpoint, available_now=True).awaitTermination()
    by = ["hour_of_day", "Is_Sleeping_Prediction"]
    scored = filled.read("scored", rows.schema)
    counted = filled.read("hours", tables.hourly_counts(scored).schema)
    counted = counted.groupBy(*by).agg(F.sum("rows").alias("counted"))
    listed = scored.groupBy(*by).agg(F.count(F.lit(1)).alias("scored"))
    return plain(listed.join(counted, by, "full").select(*by, "scored", "counted"))


def _damaged(events: DataFrame) -> DataFrame:
    """Messages of which some are cut off and some have text for a reading."""
    text = encode_messages(events, EVENT_ID).withColumn("value", F.col("value").cast("string"))
    value = F.when(F.col(EVENT_ID) % CUT_OFF == 0, F.expr("left(value, length(value) - 1)"))
    value = value.when(F.col(EVENT_ID) % NO_NUMBER == 0, F.regexp_replace("value", '"value":[^}]*', '"value":"ON"'))
    return text.select(value.otherwise(F.col("value")).alias("value"))


def stream_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream of partly damaged messages received and left out, from the table that a listener fills."""
    rows = scorable_rows(_damaged(_events(spark, sf_dir)), RULE, audit=True)
    path = scratch_path(spark, "audit")
    table = audit.ProgressTable(spark, path.rsplit("/", 1)[-1], path)
    sink, checkpoint = scratch_path(spark, "audited"), scratch_path(spark, "audited-checkpoint")

    def start():
        named = rows.writeStream.queryName(table.name).trigger(availableNow=True)
        return named.format("parquet").option("checkpointLocation", checkpoint).start(sink)

    audit.run_audited(start, table)
    names = [name for name in table.read().columns if name != "batch"]
    return table.read().agg(*[F.sum(name).alias(name) for name in names])


def stream_versioned_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of the model, of which the second holds from the middle of the month on."""
    versions = ModelVersions(spark, scratch_path(spark, "versions"))
    fitted = learning.fit_models(sampling.side(split_rows(spark, sf_dir), "train"), params_of())
    for version, (model, valid_from) in enumerate(zip(fitted, (0, SECOND_VERSION_FROM)), 1):
        versions.publish(model, version, valid_from)
    filled = tables.BatchTables(spark, scratch_path(spark, "versioned"))
    checkpoint = scratch_path(spark, "versioned-checkpoint")
    records = encode_messages(_events(spark, sf_dir))
    start_versioned_scoring(records, RULE, versions, filled, checkpoint, available_now=True).awaitTermination()
    return plain(filled.read("scored", score_versions(_no_rows(spark), versions.read()).schema).drop(tables.BATCH))


def _no_rows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "timestamp bigint, sensor_id string, pressure_value float, hour_of_day int")


def _grown(spark: SparkSession, sf_dir: str) -> GrowingEvents:
    """The events in two file sets, the second of which comes after the first was counted."""
    folder = scratch_path(spark, "arrivals")
    growing = GrowingEvents(spark, scratch_path(spark, "counted"), RULE, [EVENT_ID])
    for part in range(2):
        events = read_events_table(spark, sf_dir).filter(F.col(EVENT_ID) % 3 == 0 if part else F.col(EVENT_ID) % 3 != 0)
        events.write.mode("append").parquet(folder)
        growing.update(folder, lambda paths: spark.read.parquet(*paths))
    return growing


def incremental_pressure_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_grown(spark, sf_dir).describe()[0], 6)


def incremental_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_grown(spark, sf_dir).describe()[1])


def incremental_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    training = _grown(spark, sf_dir).train(params_of(tol=1e-7))
    fitted = [(penalty(key), *learning.coefficients(model)) for key, model in training.models.items()]
    return plain(spark.createDataFrame(fitted, COEFFICIENTS), 4, reg=1)


def incremental_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grown(spark, sf_dir).train(params_of()).confusion_matrix().drop("model")


QUERIES: dict[str, Query] = {
    "stream_window_stats": stream_window_stats,
    "stream_sleep_sessions": stream_sleep_sessions,
    "stream_dedup": stream_dedup,
    "stream_two_tables": stream_two_tables,
    "stream_audit": stream_audit,
    "stream_versioned_score": stream_versioned_score,
    "incremental_pressure_stats": incremental_pressure_stats,
    "incremental_hours": incremental_hours,
    "incremental_coefficients": incremental_coefficients,
    "incremental_confusion": incremental_confusion,
}
