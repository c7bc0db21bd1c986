"""What each micro-batch of a stream received and left out, as a table."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

AUDIT_SCHEMA = T.StructType(
    [T.StructField(name, T.LongType()) for name in ("batch", "received", "malformed", "of_sensor", "unusable", "scorable")]
)


class ProgressTable(StreamingQueryListener):
    """Stores the counts that ``scorable_rows`` observes, one row per micro-batch of the query called ``name``.

    A batch's row is a part of its own, so the batch that a restarted query runs again replaces it. Attach it with
    ``attached`` before the query starts; ``settled`` waits for the last progress, which comes after the query's end.
    """

    def __init__(self, spark: SparkSession, name: str, path: str):
        super().__init__()
        self.spark, self.name, self.path = spark, name, path.rstrip("/")
        self._run = None
        self._done = threading.Event()
        self.failure: Exception | None = None

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self._run = event.runId
            self._done.clear()

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        observed = progress.observedMetrics
        if progress.runId != self._run or "received" not in observed:
            return
        try:
            self.store(progress.batchId, {part: row.asDict() for part, row in observed.items()})
        except Exception as error:  # an error in a listener would only be logged
            self.failure = error

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.runId == self._run:
            self._done.set()

    def store(self, batch: int, observed: dict[str, dict[str, int]]) -> None:
        received = observed["received"]["messages"]
        if not received:
            return  # a batch that only moves state on
        decoded, scorable = observed["decoded"], observed["scorable"]["rows"]
        of_sensor = decoded["of_sensor"]
        row = (batch, received, decoded.get("malformed"), of_sensor, of_sensor - scorable, scorable)
        table = self.spark.createDataFrame([row], AUDIT_SCHEMA).coalesce(1)
        table.write.mode("overwrite").parquet(f"{self.path}/part={batch}")

    def settled(self, timeout: float = 60) -> bool:
        """Whether the query's end has come through, and with it all its progress."""
        done = self._done.wait(timeout)
        if self.failure:
            raise self.failure
        return done

    def read(self) -> DataFrame:
        """``batch``, messages ``received``, ``malformed`` ones (null unless the stream parses all of them), those ``of_sensor``,
        of these the ``unusable`` ones, and the ``scorable`` rows. ``batch`` is the query's own number."""
        return self.spark.read.schema(AUDIT_SCHEMA).parquet(self.path).select(*AUDIT_SCHEMA.names)


class attached:
    """``with attached(table): ...`` listens to the streams of a session meanwhile."""

    def __init__(self, table: ProgressTable):
        self.table = table

    def __enter__(self) -> ProgressTable:
        self.table.spark.streams.addListener(self.table)
        return self.table

    def __exit__(self, *_) -> None:
        self.table.spark.streams.removeListener(self.table)


def run_audited(query_of, table: ProgressTable, timeout: float | None = None) -> StreamingQuery:
    """Start a query that ends by itself (``query_of`` starts it under the table's name), and wait for it and its audit."""
    with attached(table):
        query = query_of()
        query.awaitTermination(timeout) if timeout else query.awaitTermination()
        if not table.settled():
            raise TimeoutError(f"no end of {table.name!r} came through")
    return query
