"""Types of text columns from counts."""

import pytest
from pyspark.sql import functions as F

from slumberline.sources.csv_reports import write_csv
from slumberline.sources.inference import infer_types, read_csv_inferred, read_csv_text, with_types

CASES = {
    "bigint": [["1", "-2", "+3"], ["9223372036854775807"], ["007", None]],
    "double": [["1", "2.5"], ["1e3", ".5", "5."], ["NaN", "1"], ["-Infinity"], ["9223372036854775808"], ["1.0", None]],
    "boolean": [["true", "FALSE"], [None, "True"]],
    "timestamp": [["2024-01-01", "2024-01-01 10:00:00.123"], ["2024-02-29T10:00:00Z"], ["2024-02-29 10:00:00+02:00"]],
    "string": [["1", "true"], ["1d"], ["0x10"], ["2023-02-29"], ["1", "2024-01-01"], ["", "1"], [" 1"], [None], [], ["1 2"], ["tRuE"]],
}


@pytest.mark.parametrize("kind", CASES)
def test_the_narrowest_type_that_all_values_have(spark, kind):
    for values in CASES[kind]:
        raw = spark.createDataFrame([(v,) for v in values], "text string")
        row = infer_types(raw).first()
        assert (row["column"], row["type"]) == ("text", kind), values
        assert (row["rows"], row["nulls"]) == (len(values), values.count(None))


def test_order_of_rows_and_files_and_odd_names(spark, tmp_path):
    rows = [(str(i), "x" if i == 77 else str(i), None if i % 3 else "1.5", "true") for i in range(100)]
    raw = spark.createDataFrame(rows, "`a.b` string, `type` string, `rows` string, `we``ird` string")
    expected = [("a.b", "bigint", 100, 0), ("type", "string", 100, 0), ("rows", "double", 100, 66), ("we`ird", "boolean", 100, 0)]
    for parts in (1, 7):
        for order in ("a.b", "type"):
            some = raw.orderBy(F.col(f"`{order}`").desc()).repartition(parts)
            assert [tuple(r) for r in infer_types(some).collect()] == expected
    typed = with_types(raw, infer_types(raw))
    assert [kind for _, kind in typed.dtypes] == ["bigint", "string", "double", "boolean"]


def test_csv_of_several_files(spark, tmp_path):
    table = spark.range(0, 50, 1, 5).select("id", (F.col("id") / 4).alias("share"), F.lit("s").alias("name"))
    write_csv(table, str(tmp_path / "csv"))
    read = read_csv_inferred(spark, str(tmp_path / "csv"))
    assert read.dtypes == table.dtypes and read.exceptAll(table).isEmpty() and read.count() == 50
    plan = infer_types(read_csv_text(spark, str(tmp_path / "csv")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_no_columns_or_rows(spark):
    assert infer_types(spark.createDataFrame([], "a string, b string")).collect() == [("a", "string", 0, 0), ("b", "string", 0, 0)]
