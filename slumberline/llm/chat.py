"""Chat formatting from an event log.

A conversation is the fold of its events in the order of ``seq``: ``message`` opens a message (role, text),
``delta`` appends to it, ``edit`` replaces its text so far, ``regenerate`` empties it and takes back all
messages opened between it and that event. ``msg`` names the message an event is about. Events are
shuffled once, by conversation; the fold is a sort, running maxima and ordered concatenation.

Rendering: ``<turn:ROLE>TEXT</turn>`` and a line feed per turn. In roles and texts ``&``, ``<`` and ``>``
are written as ``&amp;``, ``&lt;`` and ``&gt;``, so no text can hold a control string, and reading back is
exact (``read_back``). ``loss_mask`` has the code point ranges of the rendered string that hold the
texts of the trained role.

Defined results: null texts are empty, null roles too; events of a message that was never opened are
ignored, as are unknown kinds; a message that is opened twice is opened at its first event, the later one
counts as an edit; null conversations are one conversation, null ``seq`` sorts first; ties in ``seq`` are
ordered by kind (message, edit, regenerate, delta), role and text; a conversation without messages gives
no row; an empty log gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KINDS = ("message", "edit", "regenerate", "delta")
TRAINED_ROLE = "assistant"
OPEN, CLOSE = "<turn:", "</turn>\n"
# Fixed values of the escape: character, written as.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"))


def escaped(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescaped(text: Column) -> Column:
    for plain, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def rows_as_events(rows: DataFrame) -> DataFrame:
    """The log of finished conversations (conv_id, turn, role, text): each row opens a message and
    streams its text as one delta. Rows with equal turns stay apart, in the order of role and text."""
    text = F.coalesce("text", F.lit(""))
    order = Window.partitionBy("conv_id").orderBy("turn", F.coalesce("role", F.lit("")), text)
    numbered = rows.withColumn("msg", F.row_number().over(order).cast("bigint"))
    opened = F.struct((F.col("msg") * 2).alias("seq"), F.lit("message").alias("kind"), "role", F.lit("").alias("text"))
    delta = F.struct((F.col("msg") * 2 + 1).alias("seq"), F.lit("delta").alias("kind"), "role", text.alias("text"))
    return numbered.select("conv_id", "msg", F.inline(F.array(opened, delta)))


def fold(log: DataFrame) -> DataFrame:
    """Final messages (conv_id, place, role, text) of a log (conv_id, msg, seq, kind, role, text)."""
    rank = F.array_position(F.array(*[F.lit(kind) for kind in KINDS]), F.col("kind")).cast("int")
    events = log.select(
        "conv_id",
        "msg",
        "seq",
        rank.alias("rank"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).filter(F.col("rank") > 0)
    in_order = Window.partitionBy("conv_id").orderBy("seq", "rank", "role", "text", "msg")
    events = events.withColumn("at", F.row_number().over(in_order))
    # Per message: the event that opened it, and the last event that set its text anew.
    message = Window.partitionBy("conv_id", "msg")
    opened = F.min(F.when(F.col("rank") == 1, F.col("at"))).over(message)
    reset = F.max(F.when(F.col("rank") <= 3, F.col("at"))).over(message)
    redone = F.max(F.when(F.col("rank") == 3, F.col("at"))).over(message)
    events = events.withColumns({"opened": opened, "reset": reset, "redone": redone})
    live = events.filter((F.col("at") >= F.col("reset")) | (F.col("at") == F.col("opened")))
    texts = F.array_sort(
        F.collect_list(F.when((F.col("at") >= F.col("reset")) & (F.col("rank") != 3), F.struct("at", "text")))
    )
    messages = live.groupBy("conv_id", "msg", "opened", "redone").agg(
        F.max(F.when(F.col("at") == F.col("opened"), F.col("role"))).alias("role"),
        F.array_join(texts["text"], "").alias("text"),
    )
    messages = messages.filter(F.col("opened").isNotNull())
    # Taken back: opened before a regenerate of a message that stands earlier.
    earlier = Window.partitionBy("conv_id").orderBy("opened").rowsBetween(Window.unboundedPreceding, -1)
    messages = messages.withColumn("undone", F.max("redone").over(earlier))
    kept = messages.filter(F.col("undone").isNull() | (F.col("undone") < F.col("opened")))
    return kept.select("conv_id", F.col("opened").alias("place"), "role", "text")


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: ``formatted`` and ``loss_mask`` (array of start, end; end exclusive)."""
    turn = F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(">"))
    pieces = messages.select(
        "conv_id",
        "place",
        (F.col("role") == TRAINED_ROLE).alias("trained"),
        turn.alias("head"),
        escaped(F.col("text")).alias("body"),
    )
    length = F.length("head") + F.length("body") + len(CLOSE)
    upto = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("start", F.coalesce(F.sum(length).over(upto), F.lit(0)) + F.length("head"))
    span = F.struct(F.col("start"), (F.col("start") + F.length("body")).alias("end"))
    turns = F.array_sort(F.collect_list(F.struct("place", F.concat("head", "body", F.lit(CLOSE)).alias("turn"))))
    return pieces.groupBy("conv_id").agg(
        F.array_join(turns["turn"], "").alias("formatted"),
        F.array_sort(F.collect_list(F.when(F.col("trained"), span))).alias("loss_mask"),
    )


def read_back(formatted: Column) -> Column:
    """The turns of a rendered conversation: array of (role, text). ``<`` stands in control strings only."""
    turns = F.split(formatted, CLOSE, -1)
    turns = F.slice(turns, F.lit(1), F.size(turns) - 1)
    return F.transform(
        turns,
        lambda turn: F.struct(
            unescaped(F.substring(F.substring_index(turn, ">", 1), len(OPEN) + 1, 1 << 30)).alias("role"),
            unescaped(turn.substr(F.length(F.substring_index(turn, ">", 1)) + 2, F.lit(1 << 30))).alias("text"),
        ),
    )


def masked_text(formatted: Column, mask: Column) -> Column:
    """All text under the mask, unescaped, nothing between."""
    parts = F.transform(mask, lambda m: unescaped(formatted.substr(m["start"].cast("int") + 1, (m["end"] - m["start"]).cast("int"))))
    return F.array_join(parts, "")


def format_log(log: DataFrame) -> DataFrame:
    return render(fold(log))
