"""Column types of text files, from one pass over the data.

Each value is looked at by itself, and a column's type is the narrowest that all of its values have:
boolean, or bigint below double, or timestamp, or else string. Only counts are gathered, so the result is the same
for any order and division of the files, and the pass also tells how many values are missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Which texts count as a value of a type: fixed values, in any SQL engine's regular expressions.
PATTERNS = {
    "boolean": r"^(true|false|TRUE|FALSE|True|False)$",
    "bigint": r"^[+-]?[0-9]+$",
    "double": r"^([+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?|NaN|[+-]?Infinity)$",
    "timestamp": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?(Z|[+-][0-9]{2}:[0-9]{2})?)?$",
}
STRING = "string"


def _is(value: Column, kind: str) -> Column:
    return F.rlike(value, F.lit(PATTERNS[kind])) & value.try_cast(kind).isNotNull()


def infer_types(raw: DataFrame) -> DataFrame:
    """``column``, ``type``, ``rows`` and ``nulls`` of each column of text. A column without any value is a string."""
    counts, n = [F.count(F.lit(1)).alias("rows")], len(raw.columns)
    columns = [F.col(f"`{name.replace('`', '``')}`") for name in raw.columns]
    for i, value in enumerate(columns):
        counts.append(F.count(value).alias(f"values_{i}"))
        counts += [F.count_if(_is(value, kind)).alias(f"{kind}_{i}") for kind in PATTERNS]
    totals = raw.agg(*counts)

    def found(i: int) -> Column:
        values, kind = F.col(f"values_{i}"), F.lit(STRING)
        for name in reversed(PATTERNS):
            kind = F.when((values > 0) & (F.col(f"{name}_{i}") == values), F.lit(name)).otherwise(kind)
        return F.struct(
            F.lit(raw.columns[i]).alias("column"), kind.alias("type"), "rows", (F.col("rows") - values).alias("nulls")
        )

    return totals.select(F.inline(F.array(*[found(i) for i in range(n)])))


def with_types(raw: DataFrame, types: DataFrame) -> DataFrame:
    """The columns of text with the types that ``infer_types`` found; the driver gets a row per column."""
    kinds = {row["column"]: row["type"] for row in types.select("column", "type").collect()}
    columns = [F.col(f"`{name.replace('`', '``')}`").try_cast(kinds.get(name, STRING)).alias(name) for name in raw.columns]
    return raw.select(*columns)


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file or folder with a header, every column as text; files with another header are an error."""
    return spark.read.option("header", True).option("enforceSchema", False).csv(path)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    raw = read_csv_text(spark, path)
    return with_types(raw, infer_types(raw))
