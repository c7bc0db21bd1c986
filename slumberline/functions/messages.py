"""Events as JSON messages, and back."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slumberline.sources.schema import AUDITED_MESSAGE_SCHEMA, CORRUPT_COLUMN, MESSAGE_FIELDS, MESSAGE_SCHEMA


_PLAIN_ID = re.compile(r"(?!-?Infinity$)[A-Za-z0-9_-]+")


def message_value() -> Column:
    """The canonical event columns as one JSON object in UTF-8 bytes, as a topic stores it."""
    return F.to_json(F.struct(*MESSAGE_FIELDS)).cast("binary")


def encode_messages(events: DataFrame, *carry: str) -> DataFrame:
    """One record per event: column ``value``, after the ``carry`` columns."""
    return events.select(*carry, message_value().alias("value"))


def decode_messages(records: DataFrame, carry: Sequence[str] = (), keep_corrupt: bool = False) -> DataFrame:
    """The event columns of each record, after the ``carry`` columns.

    Text that is no JSON object gives nulls in every field, a badly typed field gives null in that
    field only. With ``keep_corrupt`` the text of such a message stays in ``_corrupt_record``.
    """
    schema, options = MESSAGE_SCHEMA, {}
    if keep_corrupt:
        schema, options = AUDITED_MESSAGE_SCHEMA, {"columnNameOfCorruptRecord": CORRUPT_COLUMN}
    data = F.from_json(F.col("value").cast("string"), schema, options)
    # As a generator, unlike as a projection, the parser runs once per record whatever filter or limit surrounds it.
    return records.select(*carry, F.inline(F.array(data)))


def may_concern(sensor_id: str) -> Column:
    """Whether a message can decode to this sensor: false only for text that surely does not, found
    without parsing it.

    A decoded id of letters, digits, ``_`` and ``-`` stands in the message as it is, unless characters
    are escaped, which takes a backslash. Any other id may be written in several ways (100.0 as 1e2),
    so nothing is ruled out for it.
    """
    if not _PLAIN_ID.fullmatch(sensor_id):
        return F.lit(True)
    text = F.col("value").cast("string")
    return F.contains(text, F.lit(sensor_id)) | F.contains(text, F.lit("\\"))
