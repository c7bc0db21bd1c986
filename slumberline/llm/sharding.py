"""Shards by a Feistel permutation of the global row number.

The rows are numbered 0 to N - 1 by their key, the number is sent through a keyed permutation of that
range, and its place p gives shard p mod S and slot p div S. So shards differ by one row at most, slots
have no gaps, the shuffle repeats for the same rows, key and seed whatever the layout, and a
row's place can be computed (``place_of``) and undone (``number_at``) without looking at any other row.

The network works on pairs (left, right) in an a-by-b grid with a * b >= N, and adds modulo a or b in
place of the usual exclusive or. A place beyond N is sent through again (cycle walking). Each step of such
a walk visits another of the a * b - N places beyond N, so that many steps always suffice; the sides are
chosen such that there are hardly any.

Numbering takes no global sort: a row's bucket is a hash of its key and ``ties``, buckets are counted, and rows
are numbered within their bucket. So a key that very many rows share, as null may be, is spread over buckets
where the ties tell its rows apart. The number of buckets follows that of the rows. A numeric key also cuts every bucket
into ranges, which changes no number and lets a task sort fewer whole rows at a time; below, a range counts as a bucket. One
row per bucket is broadcast while there are at most 2**20. A bucket of over ``HOT`` rows can only come from rows equal in key and ties:
its groups of such rows are counted, and a large group is numbered in parts.

Defined results: a null key is a key like others; rows with equal keys are told apart by ``ties``, and
rows equal in these too are interchangeable; other columns, long texts among them, are carried through unchanged, whatever their
names, but input columns named ``shard`` or ``slot`` are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slumberline.llm.arithmetic import keys, mixed32, mixed32_py
from slumberline.llm.columns import numbered_copies, put_back, set_aside
from slumberline.session import materialize

SHARDS = 24
SEED = 20240
ROUNDS = 6
ROWS_PER_BUCKET = 1 << 16
RANGES = 8
BROADCAST_BUCKETS = 1 << 20
HOT = 8 * ROWS_PER_BUCKET
RESULT = ("shard", "slot")
# Names that the input's columns may not have meanwhile.
INTERNAL = ("_number", "_bucket", "_size", "_start", "_within", "_left", "_right", "_copy", "_lower", "_hot", "_key_0", "_file", "_row", "_part", "_n", "_first", "_of_0", "_of_part")


def grid(n: int) -> tuple[int, int]:
    """Sides a <= b with the fewest places beyond ``n``, a being no less than half the square root."""
    root = max(isqrt(n), 1)
    tries = range(root, max(root // 2, 1) - 1, -1)
    a = min(tries, key=lambda side: (-n) % side)
    return a, max(-(-n // a), 1)


def place_of(number: int, n: int, seed: int = SEED) -> int:
    a, b = grid(n)
    place = number
    while True:
        left, right = place // b, place % b
        for i, key in enumerate(keys(seed, ROUNDS)):
            if i % 2 == 0:
                left = (left + mixed32_py(right, key)) % a
            else:
                right = (right + mixed32_py(left, key)) % b
        place = left * b + right
        if place < n:
            return place


def number_at(place: int, n: int, seed: int = SEED) -> int:
    """Undo ``place_of``."""
    a, b = grid(n)
    number = place
    while True:
        left, right = number // b, number % b
        for i, key in reversed(list(enumerate(keys(seed, ROUNDS)))):
            if i % 2 == 0:
                left = (left - mixed32_py(right, key)) % a
            else:
                right = (right - mixed32_py(left, key)) % b
        number = left * b + right
        if number < n:
            return number


def permuted(rows: DataFrame, number: str, n: int, seed: int = SEED) -> DataFrame:
    """Replace ``number`` (0 to n - 1) by its place."""
    a, b = grid(n)
    for step in range(a * b - n + 1):
        done = F.col(number) < F.lit(n) if step else F.lit(False)
        rows = rows.withColumn("_left", _quotient(number, b))
        rows = rows.withColumn("_right", F.col(number) - F.col("_left") * F.lit(b))
        for i, key in enumerate(keys(seed, ROUNDS)):
            if i % 2 == 0:
                rows = rows.withColumn("_left", (F.col("_left") + mixed32(F.col("_right"), key)) % F.lit(a))
            else:
                rows = rows.withColumn("_right", (F.col("_right") + mixed32(F.col("_left"), key)) % F.lit(b))
        place = F.col("_left") * F.lit(b) + F.col("_right")
        rows = rows.withColumn(number, F.when(done, F.col(number)).otherwise(place))
    return rows.drop("_left", "_right")


def _quotient(name: str, by: int) -> Column:
    return F.expr(f"`{name}` div {by}L")


def counted(rows: DataFrame, key: str) -> tuple[int, list]:
    """The number of rows, and where a numeric key is cut into about ``RANGES`` equal parts (no number hangs on the places)."""
    shares = [i / RANGES for i in range(1, RANGES)]
    if not shares or not isinstance(rows.schema[key].dataType, T.NumericType):
        return rows.count(), []
    n, cuts = rows.agg(F.count(F.lit(1)), F.percentile_approx(key, shares, 1000)).first()
    return n, sorted(set(cuts or []))


def numbered(rows: DataFrame, key: str, ties: Sequence[str], name: str) -> tuple[DataFrame, int]:
    """Number the rows 0, 1, 2, … by hash bucket (of key and ties), key and ``ties``; gives their count, too."""
    n, cuts = counted(rows, key)
    buckets = n // ROWS_PER_BUCKET + 1
    bucket = F.pmod(F.xxhash64(key, *ties), F.lit(buckets))
    # Rows of a bucket are ordered by the key first, so the ranges of a bucket lie in a row; null is in the first.
    bucket = bucket * F.lit(len(cuts) + 1) + sum((F.when(F.col(key) >= F.lit(cut), 1).otherwise(0) for cut in cuts), F.lit(0))
    sizes = rows.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    if buckets * (len(cuts) + 1) <= BROADCAST_BUCKETS:
        starts = F.broadcast(starts)
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(key, *ties)) - 1
    bucketed = rows.withColumn("_bucket", bucket)
    hot = [row["_bucket"] for row in sizes.filter(F.col("_size") > HOT).select("_bucket").collect()] if n > HOT else []
    if hot:
        # At most n / HOT buckets: their rows, and the others.
        is_hot = F.col("_bucket").isin(hot) if len(hot) < 1000 else F.array_contains(F.lit(hot), F.col("_bucket"))
        placed = bucketed.filter(~is_hot).withColumn("_within", within).unionByName(_in_groups(bucketed.filter(is_hot), [key, *ties]))
    else:
        placed = bucketed.withColumn("_within", within)
    placed = placed.join(starts, "_bucket")
    return placed.withColumn(name, F.col("_start") + F.col("_within")).drop("_bucket", "_within", "_start"), n


def _in_groups(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Number rows within their bucket by ``key``: where a group of equal rows starts, and the row's place in it."""
    # The place of a group among those of its bucket needs their number of rows only.
    named = rows.withColumn("_key_0", F.xxhash64(*key))
    numbered = materialize(numbered_copies(named.withColumn("_hot", F.struct("_bucket", "_key_0", *[F.col(k) for k in key])), ["_hot"], "_copy"), "hot-rows")
    groups = numbered.groupBy("_hot").agg(F.count(F.lit(1)).alias("_size"))
    order = Window.partitionBy("_hot._bucket").orderBy(*[F.col(f"_hot.{k}") for k in key])
    lower = F.coalesce(F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lower = groups.select(F.col("_hot").alias("_of_hot"), lower.alias("_lower"))
    placed = numbered.join(lower, F.col("_hot").eqNullSafe(F.col("_of_hot")))
    return placed.withColumn("_within", F.col("_lower") + F.col("_copy")).select(*rows.columns, "_within")


def shard(
    rows: DataFrame, shards: int = SHARDS, key: str = "doc_id", ties: Sequence[str] = (), seed: int = SEED
) -> DataFrame:
    """Add ``shard`` (int) and ``slot`` (long) to every row."""
    rows, aside = set_aside(rows.drop(*RESULT), INTERNAL)
    placed, n = numbered(rows, aside.get(key, key), [aside.get(tie, tie) for tie in ties], "_number")
    placed = permuted(placed, "_number", n, seed) if n else placed
    placed = placed.select(
        *rows.columns,
        (F.col("_number") % shards).cast("int").alias("shard"),
        F.expr(f"cast(_number div {int(shards)}L as bigint)").alias("slot"),
    )
    return put_back(placed, aside)
