"""Columns of the input that have the names an operator uses itself, and numbers for rows that nothing tells apart."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slumberline.session import materialize

ROWS_PER_PART = 1 << 16


def set_aside(rows: DataFrame, names: Iterable[str]) -> tuple[DataFrame, dict[str, str]]:
    """``rows`` with other names for those columns that are called like one of ``names`` (in any case), and the new name of each."""
    wanted = {name.lower() for name in names}
    taken = wanted | {name.lower() for name in rows.columns}
    renamed = {}
    for name in rows.columns:
        if name.lower() in wanted:
            free = f"{name}_"
            while free.lower() in taken:
                free += "_"
            taken.add(free.lower())
            renamed[name] = free
    return (rows.withColumnsRenamed(renamed) if renamed else rows), renamed


def put_back(rows: DataFrame, renamed: dict[str, str]) -> DataFrame:
    """The old names again."""
    return rows.withColumnsRenamed({free: name for name, free in renamed.items()}) if renamed else rows


def numbered_copies(rows: DataFrame, by: Sequence[str], number: str) -> DataFrame:
    """Number rows 0, 1, 2, … within each group of equal ``by``, in any order, for groups of any size.

    The rows are stored, so that their place in the files tells them apart. A group is dealt over parts by a hash of that
    place; parts are counted, and rows numbered within them.
    """
    stored = materialize(rows, "copies")
    parts = stored.count() // ROWS_PER_PART + 1
    stored = stored.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")
    ).withColumn("_part", F.pmod(F.xxhash64("_file", "_row"), F.lit(parts)))
    sizes = stored.groupBy(*by, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*[F.col(name).alias(f"_of_{i}") for i, name in enumerate(by)], F.col("_part").alias("_of_part"),
                          F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    same = F.col("_part") == F.col("_of_part")
    for i, name in enumerate(by):
        same &= F.col(name).eqNullSafe(F.col(f"_of_{i}"))
    within = F.row_number().over(Window.partitionBy(*by, "_part").orderBy("_file", "_row")) - 1
    placed = stored.withColumn("_within", within).join(starts, same)
    return placed.withColumn(number, F.col("_first") + F.col("_within")).select(*rows.columns, number)
