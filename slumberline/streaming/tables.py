"""One stream into several tables that agree with each other, whatever fails between them."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from slumberline.streaming.scoring import triggered

BATCH = "batch_id"
COMMITS = "commits"
COMMIT_SCHEMA = T.StructType([T.StructField(BATCH, T.LongType())])
Derived = Mapping[str, Callable[[DataFrame], DataFrame]]


class BatchTables:
    """Parquet tables under one folder, each with a part ``batch_id=N`` per micro-batch.

    A batch that is run again, after a failure, replaces its parts, so nothing is written twice. ``read`` gives the parts
    of those batches of which every table is written; a batch without its commit does not show in any.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def part(self, table: str, batch_id: int) -> str:
        return f"{self.root}/{table}/{BATCH}={batch_id}"

    def write(self, table: str, rows: DataFrame, batch_id: int) -> DataFrame:
        """Replace a part, and give it as it is stored."""
        path = self.part(table, batch_id)
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def commit(self, batch_id: int) -> None:
        self.write(COMMITS, self.spark.range(batch_id, batch_id + 1, 1, 1).select(F.col("id").alias("batch")), batch_id)

    def committed(self) -> DataFrame:
        """``batch_id`` of every batch that is complete."""
        if not self._exists(f"{self.root}/{COMMITS}"):
            return self.spark.createDataFrame([], COMMIT_SCHEMA)
        return self.spark.read.parquet(f"{self.root}/{COMMITS}").select(F.col("batch").alias(BATCH)).distinct()

    def read(self, table: str, schema: T.StructType) -> DataFrame:
        """The rows of all complete batches, with their ``batch_id``."""
        full = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
        if not self._exists(f"{self.root}/{table}"):
            return self.spark.createDataFrame([], full)
        parts = self.spark.read.schema(full).parquet(f"{self.root}/{table}")
        return parts.join(self.committed(), BATCH, "left_semi").select(*full.names)

    def _exists(self, path: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)


def start_tables_sink(
    rows: DataFrame,
    tables: BatchTables,
    main: str,
    derived: Derived,
    checkpoint: str,
    available_now: bool = False,
    interval: str | None = None,
    prepare: Callable[[DataFrame, int], DataFrame] | None = None,
) -> StreamingQuery:
    """Write each micro-batch to the table ``main``, then what the ``derived`` functions make of it to theirs.

    They get the stored part, so a batch is computed once, and what they make agrees with what is stored even if
    a second run of the batch would come out otherwise. ``prepare`` changes a batch before it is written.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        rows_of_batch = prepare(batch, batch_id) if prepare else batch
        stored = tables.write(main, rows_of_batch, batch_id)
        for name, derive in derived.items():
            tables.write(name, derive(stored), batch_id)
        tables.commit(batch_id)

    writer = triggered(rows, available_now, interval)
    return writer.option("checkpointLocation", checkpoint).foreachBatch(write_batch).start()


def hourly_counts(scored: DataFrame) -> DataFrame:
    """Scored rows per hour of day and prediction: what dashboards read instead of the rows."""
    return scored.groupBy("hour_of_day", "Is_Sleeping_Prediction").agg(F.count(F.lit(1)).alias("rows"))
