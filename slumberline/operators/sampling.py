"""Systematic sampling and the train/test split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from slumberline.functions.hashing import RANGE, key_hash
from slumberline.rules import EVERY_NTH, SPLIT_SEED, SPLIT_WEIGHTS
from slumberline.session import materialize
from slumberline.sources.schema import POSITION

SPLIT_NAMES = ("train", "test")
# How finely a table is cut into ranges, and how many sampled keys find each cut. Every cut is a comparison in the
# plan, so a small table gets few.
RANGES_PER_PARTITION, ROWS_PER_RANGE, SAMPLE_PER_RANGE = 4, 1 << 16, 20
SAMPLE_SEED = 11


def with_dense_index(rows: DataFrame, *key: str) -> DataFrame:
    """Add ``idx``: 0, 1, 2, … in the order of ``key``; rows with equal keys keep the order of their source.

    A ranking over the whole table would sort it in one task. Here the rows are partitioned by range
    and sorted within, so that a row's place is its partition and its position there. The source
    position is part of the range, or a key that very many rows share would end up in one task. The
    placed rows are stored: cut points come from a sample, and a second run of the same plan could
    place them otherwise. What is added to a position is the count of rows in earlier partitions;
    that table, which is broadcast, has one row per shuffle partition.
    """
    order = [*key, "_source"]
    in_source = rows.withColumn("_source", F.monotonically_increasing_id())
    in_order = in_source.repartitionByRange(*order).sortWithinPartitions(*order).drop("_source")
    generated = {"_partition": F.spark_partition_id(), "_place": F.monotonically_increasing_id()}
    placed = materialize(in_order.withColumns(generated), "placed")
    # Fixed value of the generated id: the partition is added above bit 33. As it is known, the position comes
    # out right even beyond that bit.
    position = F.col("_place") - F.shiftleft(F.col("_partition").cast("bigint"), 33)

    sizes = placed.groupBy("_partition").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_partition", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    indexed = placed.join(F.broadcast(starts), "_partition").withColumn("idx", F.col("_start") + position)
    return indexed.drop("_partition", "_place", "_start")


def cut_points(rows: DataFrame, key: Sequence[str]) -> list[Row]:
    """Keys in order that part the rows into about equal ranges. The number of shuffle partitions bounds theirs
    and that of the sample they come from."""
    n = rows.count()
    most = RANGES_PER_PARTITION * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(n // ROWS_PER_RANGE + 1, most)
    share = min(ranges * SAMPLE_PER_RANGE / max(n, 1), 1.0)
    sample = rows.select(*key).sample(share, SAMPLE_SEED)
    tile = F.ntile(ranges).over(Window.orderBy(*key))
    first = sample.withColumn("_tile", tile).groupBy("_tile").agg(F.min(F.struct(*key)).alias("_cut"))
    return first.select("_cut.*").distinct().orderBy(*key).collect()


def at_least(columns: Sequence[Column], values: Sequence[Column | None]) -> Column:
    """Whether the columns, read as one key with nulls first, are ``values`` or come after them; null for no."""
    column, value = columns[0], values[0]
    above, same = (column.isNotNull(), column.isNull()) if value is None else (column > value, column == value)
    return above | (same & at_least(columns[1:], values[1:]) if len(columns) > 1 else same)


def range_of(cuts: Sequence[Row], rows: DataFrame, key: Sequence[str]) -> Column:
    """How many of the ordered ``cuts`` a row's key is not below, by halving. The halvings are written out as
    one expression, which stays in the generated code of its stage."""
    types = [rows.schema[name].dataType for name in key]
    columns = [F.col(name) for name in key]

    def halve(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        values = [None if v is None else F.lit(v).cast(kind) for v, kind in zip(cuts[middle], types)]
        return F.when(at_least(columns, values), halve(middle + 1, high)).otherwise(halve(low, middle))

    return halve(0, len(cuts))


def with_index_of_key(rows: DataFrame, *key: str) -> DataFrame:
    """Add ``idx`` as ``with_dense_index`` does, for a key that tells the rows apart.

    A row's range then follows from its key and fixed cut points, so counting the ranges, which moves no
    rows, and numbering within them agree without a stored copy of the table. Should keys repeat, the index
    is dense still, the order of rows with equal keys is open, and they stay in one range.
    """
    ranged = rows.withColumn("_range", range_of(cut_points(rows, key), rows, key))
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*key)) - 1
    indexed = ranged.withColumn("_place", place).join(F.broadcast(starts), "_range")
    return indexed.withColumn("idx", F.col("_start") + F.col("_place")).drop("_range", "_place", "_start")


def every_nth(rows: DataFrame, key: Sequence[str], n: int = EVERY_NTH, unique: bool = False) -> DataFrame:
    """Every ``n``-th row by ``key``, starting with the first; ``idx`` is its position among all rows. With
    ``unique`` the key tells the rows apart, and no copy of the table is stored. None is stored either where the rows have their
    position in the source (``read_parquet_events``): it orders rows with equal keys, and spreads a key that very many
    rows share over ranges. The position is not returned."""
    if set(POSITION) <= set(rows.columns):
        indexed = with_index_of_key(rows, *key, *POSITION).drop(*POSITION)
    else:
        indexed = with_index_of_key(rows, *key) if unique else with_dense_index(rows, *key)
    return indexed.filter(F.col("idx") % n == 0)


def hash_split(rows: DataFrame, key: Sequence[str], weights: Sequence[float] = SPLIT_WEIGHTS) -> DataFrame:
    """Add ``split`` (train or test) from a hash of ``key``: the same row falls on the same side whatever
    the layout of the data, and no shuffle is needed. Shares are exact to 2**-32."""
    bound = round(weights[0] / sum(weights) * RANGE)
    if (weights[0] > 0 and bound == 0) or (sum(weights[1:]) > 0 and bound == RANGE):
        raise ValueError(f"weights {tuple(weights)} leave one side without rows")
    in_train = key_hash(rows, key) < F.lit(bound)
    return rows.withColumn("split", F.when(in_train, SPLIT_NAMES[0]).otherwise(SPLIT_NAMES[1]))


def random_split(
    rows: DataFrame, weights: Sequence[float] = SPLIT_WEIGHTS, seed: int = SPLIT_SEED
) -> tuple[DataFrame, DataFrame]:
    """Bernoulli split. It repeats only for the same layout of the data; ``hash_split`` always does."""
    train, test = rows.randomSplit(list(weights), seed=seed)
    return train, test


def side(rows: DataFrame, name: str) -> DataFrame:
    return rows.filter(F.col("split") == name).drop("split")
