"""The registered queries: each operator over the whole ``events`` table of a data folder.

32-bit readings leave as doubles and counts as 64-bit integers, so that any SQL engine can be compared.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slumberline.functions.clock import event_time
from slumberline.functions.messages import decode_messages, encode_messages
from slumberline.operators import learning, reports, sampling
from slumberline.operators.features import feature_table, of_sensor, of_sensors, with_hour, with_label
from slumberline.plans import stream_catalog
from slumberline.plans.jobs import describe, replay_records
from slumberline.plans.settings import (
    COEFFICIENTS,
    REGS,
    REPLAYED,
    RULE,
    STREAM_BATCH,
    Query,
    params_of,
    plain,
    serving_model,
    split_rows,
)
from slumberline.plans.stream_catalog import drained
from slumberline.plans.training import Training, train
from slumberline.rules import PEEK_SIZE
from slumberline.session import at_once, scratch_path
from slumberline.sources.csv_reports import read_csv, write_csv
from slumberline.sources.events import (
    EXPORT_COLUMNS,
    EventColumns,
    read_csv_events,
    read_events_table,
    stream_events_table,
)
from slumberline.sources.inference import infer_types, read_csv_text
from slumberline.sources.schema import EVENT_ID, FEATURES, LABEL
from slumberline.sources.topic import message_fields, peek, peek_any, publish_files, read_message_files
from slumberline.streaming.scoring import scorable_rows, score_messages

# --- scans, filters, features -------------------------------------------------------------------


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "events-csv")
    write_csv(read_events_table(spark, sf_dir), path)
    return plain(read_csv_events(spark, path, EventColumns(event_id=EVENT_ID)))


def projected_scan_dropna(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three columns of an export in CSV, of which two events in seven lack a field."""
    events = read_events_table(spark, sf_dir)
    turn = F.col(EVENT_ID) % 7
    export = events.select(
        F.col("timestamp").alias(EXPORT_COLUMNS.timestamp),
        F.when(turn != 1, F.col("sensor_id")).alias(EXPORT_COLUMNS.sensor_id),
        F.when(turn != 0, F.col("value")).alias(EXPORT_COLUMNS.value),
    )
    path = scratch_path(spark, "export-csv")
    write_csv(export, path)
    return plain(read_csv_events(spark, path, EXPORT_COLUMNS).na.drop("any"))


def sensor_filter_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(of_sensor(read_events_table(spark, sf_dir), RULE.sensor_id))


def sensor_filter_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(of_sensors(read_events_table(spark, sf_dir), REPLAYED))


def _featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_hour(of_sensor(read_events_table(spark, sf_dir), RULE.sensor_id), RULE)


def hour_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_featured(spark, sf_dir).select(EVENT_ID, "timestamp", *FEATURES))


def event_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wall clock in UTC, made from epoch milliseconds."""
    wall = F.date_format(event_time(F.col("timestamp")), "yyyy-MM-dd HH:mm:ss.SSS")
    return read_events_table(spark, sf_dir).select(EVENT_ID, wall.alias("event_time"))


def night_pressure_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(with_label(_featured(spark, sf_dir), RULE).select(EVENT_ID, "hour_of_day", LABEL))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(feature_table(read_events_table(spark, sf_dir), RULE, carry=[EVENT_ID]))


# --- messages -----------------------------------------------------------------------------------


def message_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(decode_messages(encode_messages(read_events_table(spark, sf_dir))))


def replay_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "messages")
    publish_files(replay_records(read_events_table(spark, sf_dir), REPLAYED), path)
    return plain(decode_messages(read_message_files(spark, path)))


def topic_peek(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = encode_messages(read_events_table(spark, sf_dir), EVENT_ID).withColumnRenamed(EVENT_ID, "offset")
    return plain(peek(topic, PEEK_SIZE, columnar=True))


def topic_peek_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields of the first messages of a topic whose producer adds the events' properties and their user."""
    fields = F.to_json(F.struct("event_id", "user_id", "value", F.parse_json("props").alias("props"), F.col("event_type").alias("kind")))
    topic = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("offset"), fields.alias("value"))
    found = message_fields(peek_any(topic, PEEK_SIZE, columnar=True))
    kind = F.regexp_extract("type", "^[A-Z]+", 0)
    number = F.when(kind.isin("BIGINT", "DECIMAL", "DOUBLE"), F.try_variant_get("data", "$", "double"))
    text = F.when(kind.isin("STRING", "OBJECT"), F.col("data").cast("string"))
    kind = F.when(kind == "DOUBLE", "DECIMAL").otherwise(kind)
    return plain(found.select("offset", "field", kind.alias("type"), number.alias("number"), text.alias("text")), 6)


def csv_inferred_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types and missing values of an export whose columns are of several types, two of them with gaps."""
    turn = F.col(EVENT_ID) % 7
    export = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        EVENT_ID,
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("time"),
        F.when(turn != 1, F.col("event_type")).alias("sensor"),
        F.when(turn != 0, F.col("value")).alias("value"),
        F.when(F.col(EVENT_ID) % 5 == 0, F.lit("n/a")).otherwise(F.col("user_id").cast("string")).alias("user"),
        (F.col("value") > 25).alias("high"),
        F.lit(None).cast("string").alias("nothing"),
    )
    path = scratch_path(spark, "typed-csv")
    write_csv(export, path)
    return infer_types(read_csv_text(spark, path))


def every_nth_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    replayed = of_sensors(read_events_table(spark, sf_dir), REPLAYED)
    sampled = sampling.every_nth(replayed.select(EVENT_ID, "sensor_id", "value"), [EVENT_ID], unique=True)
    return plain(sampled.select("idx", EVENT_ID, "sensor_id", "value"))


# --- reports ------------------------------------------------------------------------------------


def pressure_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(reports.pressure_stats(_featured(spark, sf_dir)), 6)


def hour_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(reports.hour_distribution(_featured(spark, sf_dir)))


def _through_csv(table: DataFrame, label: str) -> DataFrame:
    path = scratch_path(table.sparkSession, label)
    write_csv(table, path)
    return read_csv(table.sparkSession, path, table.schema)


def stats_csv_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats, _ = describe(read_events_table(spark, sf_dir), RULE)
    return plain(_through_csv(stats, "stats"), 6)


def hours_csv_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, hours = describe(read_events_table(spark, sf_dir), RULE)
    return plain(_through_csv(hours, "hours"))


# --- split, training, evaluation ----------------------------------------------------------------


def _train(spark: SparkSession, sf_dir: str) -> Training:
    return train(split_rows(spark, sf_dir), params_of())


def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_rows(spark, sf_dir).select(EVENT_ID, "split")


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.split_counts(split_rows(spark, sf_dir))


def _scaler(split_rows: DataFrame):
    return learning.fit_scaler(sampling.side(split_rows, "train"))


def scaler_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    std_pressure, std_hour = _scaler(split_rows(spark, sf_dir)).std
    stats = spark.createDataFrame([(float(std_pressure), float(std_hour))], "std_pressure double, std_hour double")
    return plain(stats, 6)


def scaled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = split_rows(spark, sf_dir)
    scaled = _scaler(rows).transform(learning.assembler().transform(rows))
    vector = vector_to_array("features")
    return plain(scaled.select(EVENT_ID, vector[0].alias("pressure_scaled"), vector[1].alias("hour_scaled")), 6)


def logreg_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = learning.fit_models(sampling.side(split_rows(spark, sf_dir), "train"), params_of(tol=1e-7))
    fitted = [(reg, *learning.coefficients(model)) for reg, model in zip(REGS, models)]
    table = spark.createDataFrame(fitted, COEFFICIENTS)
    return plain(table, 4, reg=1)


def _fit(split_rows: DataFrame) -> dict[float, PipelineModel]:
    models = learning.fit_models(sampling.side(split_rows, "train"), params_of())
    return dict(zip(REGS, models))


def _reloaded(spark: SparkSession, model: PipelineModel) -> PipelineModel:
    path = scratch_path(spark, "model")
    learning.save_model(model, path)
    return learning.load_model(path)


def logreg_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = split_rows(spark, sf_dir)
    scored = learning.score_each(_fit(rows), sampling.side(rows, "test"))
    return scored.select("reg", EVENT_ID, LABEL, "prediction")


def model_reload_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = split_rows(spark, sf_dir)
    fitted = _fit(rows)
    models = at_once(spark, lambda model: _reloaded(spark, model), list(fitted.values()))
    scored = learning.score_each(dict(zip(fitted, models)), sampling.side(rows, "test"))
    return scored.select("reg", EVENT_ID, LABEL, "prediction")


def label_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.label_distribution(sampling.side(split_rows(spark, sf_dir), "test"))


def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _train(spark, sf_dir).confusion_matrix().drop("model")


def eval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_train(spark, sf_dir).metrics().drop("model", "auc"), 6)


def auc_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_train(spark, sf_dir).area_under_roc().drop("model"), 4)


def auc_binned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The areas from a thousand bins; with fewer distinct margins than bins they are the exact ones."""
    return plain(_train(spark, sf_dir).binned_area_under_roc().drop("model", "bound"), 4)


# --- scoring of messages, as a stream and as a batch ----------------------------------------------


def _stream_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_messages(stream_events_table(spark, sf_dir, STREAM_BATCH))


def stream_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(drained(scorable_rows(_stream_records(spark, sf_dir), RULE), "decoded"))


def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = score_messages(_stream_records(spark, sf_dir), serving_model(spark, sf_dir), RULE)
    return plain(drained(rows, "scored").drop("Processing_Time"))


def batch_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = encode_messages(read_events_table(spark, sf_dir))
    return plain(score_messages(records, serving_model(spark, sf_dir), RULE).drop("Processing_Time"))


QUERIES: dict[str, Query] = {
    "csv_scan": csv_scan,
    "projected_scan_dropna": projected_scan_dropna,
    "sensor_filter_eq": sensor_filter_eq,
    "sensor_filter_in": sensor_filter_in,
    "hour_features": hour_features,
    "event_clock": event_clock,
    "night_pressure_label": night_pressure_label,
    "feature_table": features,
    "message_roundtrip": message_roundtrip,
    "replay_messages": replay_messages,
    "topic_peek": topic_peek,
    "topic_peek_any": topic_peek_any,
    "csv_inferred_schema": csv_inferred_schema,
    "every_nth_event": every_nth_event,
    "pressure_stats": pressure_stats,
    "stats_csv_sink": stats_csv_sink,
    "hour_distribution": hour_distribution,
    "hours_csv_sink": hours_csv_sink,
    "train_test_split": train_test_split,
    "split_counts": split_counts,
    "scaler_stats": scaler_stats,
    "scaled_features": scaled_features,
    "logreg_coefficients": logreg_coefficients,
    "logreg_score": logreg_score,
    "model_reload_score": model_reload_score,
    "label_distribution": label_distribution,
    "confusion_matrix": confusion_matrix,
    "eval_metrics": eval_metrics,
    "auc_exact": auc_exact,
    "auc_binned": auc_binned,
    "stream_decode": stream_decode,
    "stream_score": stream_score,
    "batch_score": batch_score,
    **stream_catalog.QUERIES,
}
