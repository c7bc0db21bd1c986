"""Statistics of a stream by window of event time, and sessions of sleep.

Both append a window once the watermark has passed its end, and forget it: the state holds open windows only. The
watermark trails the latest event by ``delay``. An event that comes later than that, for a window that is
closed, is left out; ``LateRows`` counts such events exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from slumberline.operators.features import of_sensor, usable, with_hour, with_label
from slumberline.operators.reports import reading_stats
from slumberline.rules import SleepRule
from slumberline.sources.schema import LABEL
from slumberline.streaming.scoring import counted

EVENT_TIME = "event_time"
DELAY = "10 minutes"
HOUR = "1 hour"
QUARTER = "15 minutes"
SESSION_GAP = "30 minutes"


def with_watermark(rows: DataFrame, delay: str = DELAY) -> DataFrame:
    """Add the event time, with a watermark in a stream; rows without it belong to no window and go."""
    timed = rows.filter(F.col("timestamp").isNotNull()).withColumn(EVENT_TIME, F.timestamp_millis("timestamp"))
    return timed.withWatermark(EVENT_TIME, delay) if timed.isStreaming else timed


def _bounds(window: str = "window") -> list[Column]:
    """Start and end of a window as epoch milliseconds."""
    return [F.unix_millis(f"{window}.{side}").alias(f"window_{side}") for side in ("start", "end")]


def window_stats(events: DataFrame, rule: SleepRule, length: str = HOUR, delay: str = DELAY) -> DataFrame:
    """The statistics of the rule's sensor per tumbling window that has events: ``window_start``, ``window_end`` (epoch
    milliseconds, end exclusive) and the columns of ``reading_stats``. The same in batch, for all windows."""
    rows = with_watermark(with_hour(of_sensor(events, rule.sensor_id), rule), delay)
    rows = counted(rows, "windowed", F.count("pressure_value").alias("readings"))
    return rows.groupBy(F.window(EVENT_TIME, length)).agg(*reading_stats()).select(*_bounds(), *_names())


def sliding_stats(
    events: DataFrame, rule: SleepRule, length: str = HOUR, slide: str = QUARTER, delay: str = DELAY
) -> DataFrame:
    """The same per window of ``length`` that starts every ``slide``, which must divide ``length``.

    An event goes into one pane of ``slide``, not into all windows around it: the moments of a closed pane are added to its
    windows by a second aggregation. So the state is one row per open pane and window, and an event costs
    one update however many windows overlap.
    """
    rows = with_watermark(with_hour(of_sensor(events, rule.sensor_id), rule), delay)
    value = F.col("pressure_value")
    panes = rows.groupBy(F.window(EVENT_TIME, slide).alias("pane")).agg(
        F.count(value).alias("n"),
        F.min(value).alias("least"),
        F.mean(value).alias("mean"),
        F.var_samp(value).alias("variance"),
        F.max(value).alias("greatest"),
    )
    # A window has length / slide panes, so the list is short.
    moments = F.collect_list(F.struct("n", "mean", "variance")).alias("moments")
    windows = panes.groupBy(F.window("pane", length, slide)).agg(
        F.sum("n").alias("Count"), F.min("least").alias("Min_Pressure"), F.max("greatest").alias("Max_Pressure"), moments
    )
    count = F.col("Count")
    total = F.aggregate("moments", F.lit(0.0), lambda done, p: done + F.coalesce(p["n"] * p["mean"], F.lit(0.0)))
    windows = windows.withColumn("Mean_Pressure", F.when(count > 0, total / count))

    def deviation(done: Column, p: Column) -> Column:
        within = F.coalesce((p["n"] - 1) * p["variance"], F.lit(0.0))
        between = F.coalesce(p["n"] * F.pow(p["mean"] - F.col("Mean_Pressure"), 2), F.lit(0.0))
        return done + within + between

    squares = F.aggregate("moments", F.lit(0.0), deviation)
    deviated = F.when(count > 1, F.sqrt(squares / (count - 1))).alias("StdDev_Pressure")
    return windows.withColumn("StdDev_Pressure", deviated).select(*_bounds(), *_names())


def _names() -> list[str]:
    return ["Count", "Min_Pressure", "Mean_Pressure", "StdDev_Pressure", "Max_Pressure"]


def sleep_sessions(events: DataFrame, rule: SleepRule, gap: str = SESSION_GAP, delay: str = DELAY) -> DataFrame:
    """Readings that count as asleep, joined to a session of their sensor while each comes at most ``gap`` after the one
    before: ``sensor_id``, ``session_start`` and ``session_end`` (its first and last reading, epoch milliseconds),
    ``readings``, ``mean_pressure``. All sensors are looked at. A reading between two sessions merges them.
    """
    rows = with_label(with_hour(events, rule), rule).filter(usable() & (F.col(LABEL) == 1.0))
    rows = with_watermark(rows.filter(F.col("sensor_id").isNotNull()), delay)
    session = F.session_window(EVENT_TIME, gap)
    sessions = rows.groupBy("sensor_id", session).agg(
        F.min("timestamp").alias("session_start"),
        F.max("timestamp").alias("session_end"),
        F.count(F.lit(1)).alias("readings"),
        F.mean("pressure_value").alias("mean_pressure"),
    )
    return sessions.select("sensor_id", "session_start", "session_end", "readings", "mean_pressure")


# --- what was late, what is open ----------------------------------------------------------------


@dataclass(frozen=True)
class LateRows:
    """Readings of a windowed stream: all that were received are in a closed window, in an open one, or late."""

    received: int
    closed: int
    open: int

    @property
    def late(self) -> int:
        return self.received - self.closed - self.open


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The windows that a stopped ``window_stats`` stream holds in its state: ``window_start``, ``window_end``, ``Count``."""
    state = spark.read.format("statestore").load(checkpoint)
    # The count is the first of the aggregates; other parts of the state have the same name, so it is taken by place.
    count = F.split(F.to_csv("value"), ",")[0].cast("bigint").alias("Count")
    return state.select("key.window", count).select(*_bounds(), "Count")


def late_rows(received: int, closed: DataFrame, checkpoint: str) -> LateRows:
    """Of the readings a ``window_stats`` stream has received so far (``received_readings`` of all its runs), those that
    came too late for their window."""
    total = F.coalesce(F.sum("Count"), F.lit(0))
    still_open = open_windows(closed.sparkSession, checkpoint)
    return LateRows(received, closed.agg(total).first()[0], still_open.agg(total).first()[0])


def received_readings(query: StreamingQuery) -> int:
    """Readings that the batches of this run have received."""
    observed = [p["observedMetrics"] for p in query.recentProgress if p["numInputRows"]]
    return sum(metrics["windowed"]["readings"] for metrics in observed if "windowed" in metrics)


def state_rows(query: StreamingQuery) -> list[int]:
    """Rows in the state after each batch that the query remembers, over all its operators."""
    return [sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in query.recentProgress]
