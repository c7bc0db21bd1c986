"""Messages that a topic delivers more than once.

Delivery is at least once: after a failure a producer sends records again. Copies of a record share its key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slumberline.rules import SleepRule
from slumberline.streaming.scoring import scorable_rows
from slumberline.streaming.windows import DELAY, EVENT_TIME, with_watermark

RECORD = "record"


def scorable_once(records: DataFrame, rule: SleepRule, delay: str = DELAY, audit: bool = False) -> DataFrame:
    """The scorable rows of records (key, value), each record once.

    A record without a key is told by its value. The state holds a digest of each record until the watermark, which
    trails the latest event by ``delay``, has passed its event; what comes again later than that is older than the
    watermark and goes for that reason. Only rows that can be scored get into the state.
    """
    record = F.sha2(F.coalesce(F.concat(F.lit("k"), F.col("key").cast("string")), F.concat(F.lit("v"), F.col("value").cast("string"))), 256)
    rows = scorable_rows(records.withColumn(RECORD, record), rule, audit, carry=[RECORD])
    if not rows.isStreaming:
        return rows.dropDuplicates([RECORD]).drop(RECORD)
    timed = with_watermark(rows, delay)
    return timed.dropDuplicatesWithinWatermark([RECORD]).drop(RECORD, EVENT_TIME)
