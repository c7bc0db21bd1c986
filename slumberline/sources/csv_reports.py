"""Result tables as CSV folders with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def write_csv(table: DataFrame, path: str) -> None:
    """Replace the folder at ``path``."""
    table.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)
