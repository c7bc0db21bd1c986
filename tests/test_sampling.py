import random

import pytest
from pyspark.sql import functions as F

from slumberline.sources.events import EventColumns, read_parquet_events
from slumberline.operators import sampling
from slumberline.operators.sampling import (
    every_nth,
    hash_split,
    random_split,
    side,
    with_dense_index,
    with_index_of_key,
)
from slumberline.session import materialize


def keyed(spark, ids, partitions):
    shuffled = list(ids)
    random.Random(7).shuffle(shuffled)
    return spark.createDataFrame([(i, f"row {i}") for i in shuffled], "k long, text string").repartition(partitions)


@pytest.mark.parametrize("index", [with_dense_index, with_index_of_key])
@pytest.mark.parametrize("partitions", [1, 8])
def test_dense_index_is_the_rank(spark, monkeypatch, partitions, index):
    monkeypatch.setattr(sampling, "ROWS_PER_RANGE", 32)
    # Most keys lie close together, a few far away, some below zero.
    ids = [*range(700), *range(10**15, 10**15 + 20), *range(-40, 0)]
    rows = index(keyed(spark, ids, partitions), "k").select("k", "idx").collect()
    assert {row["k"]: row["idx"] for row in rows} == {k: i for i, k in enumerate(sorted(ids))}


@pytest.mark.parametrize("unique", [False, True])
@pytest.mark.parametrize("n, expected", [(0, []), (1, [0]), (3, [0]), (250, [0, 100, 200])])
def test_every_hundredth(spark, n, expected, unique):
    rows = every_nth(keyed(spark, range(10, 10 + n), 3), ["k"], unique=unique)
    assert sorted(row["idx"] for row in rows.collect()) == expected
    assert rows.columns == ["k", "text", "idx"]


def test_index_of_a_unique_key_stores_nothing(spark, monkeypatch):
    monkeypatch.setattr(sampling, "materialize", lambda *args: pytest.fail("a table is stored"))
    monkeypatch.setattr(sampling, "ROWS_PER_RANGE", 64)
    ranges = sampling.RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = keyed(spark, [*range(20000), *range(10**12, 10**12 + 500)], 8)
    assert every_nth(rows, ["k"], unique=True).count() == 205
    cuts = sampling.cut_points(rows, ["k"])
    assert len(cuts) == ranges and cuts == sorted(cuts)
    sizes = rows.groupBy(sampling.range_of(cuts, rows, ["k"]).alias("r")).count()
    assert sizes.agg(F.max("count")).first()[0] < 4 * 20500 / ranges


def test_index_of_keys_with_nulls_copies_and_several_columns(spark, monkeypatch):
    monkeypatch.setattr(sampling, "ROWS_PER_RANGE", 16)
    ids = [None, None, 3, 3, 3, -1, 10**15, *range(500)]
    rows = spark.createDataFrame([(i, f"{j % 7}") for j, i in enumerate(ids)], "k long, text string").repartition(4)
    indexed = with_index_of_key(rows, "k", "text").orderBy("idx").collect()
    assert [row["idx"] for row in indexed] == list(range(len(ids)))
    keys = [(row["k"] is not None, row["k"] or 0, row["text"]) for row in indexed]
    assert keys == sorted(keys)


def test_a_hot_value_is_told_apart_by_the_rest_of_the_key(spark):
    rows = spark.createDataFrame([(0 if i % 3 else i, i) for i in range(3000)], "hot long, k long")
    indexed = with_dense_index(rows.repartition(8), "hot", "k").orderBy("idx").collect()
    assert [row["idx"] for row in indexed] == list(range(3000))
    assert [(row["hot"], row["k"]) for row in indexed] == sorted((0 if i % 3 else i, i) for i in range(3000))


def test_copies_of_one_row_are_spread_over_tasks(spark, monkeypatch):
    """A third of all rows are the same row."""
    stored = []
    monkeypatch.setattr(sampling, "materialize", lambda *args: stored.append(materialize(*args)) or stored[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.createDataFrame([(7 if i % 3 == 0 else i, "x") for i in range(30000)], "k long, text string")
    indexed = with_dense_index(rows.repartition(8), "k")
    assert indexed.agg(F.count_distinct("idx"), F.min("idx"), F.max("idx")).first() == (30000, 0, 29999)
    ordered = [row["k"] for row in indexed.orderBy("idx").select("k").collect()]
    assert ordered == sorted(ordered)
    copies = stored[0].filter("k = 7").groupBy(F.shiftright("_place", 33)).count()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert copies.count() > 1 and copies.agg(F.max("count")).first()[0] < 6000


def test_equal_keys_keep_their_order(spark):
    rows = spark.range(1000, numPartitions=4).select((F.col("id") % 2).alias("k"), "id")
    indexed = with_dense_index(rows, "k").orderBy("idx").collect()
    assert [row["id"] for row in indexed] == [*range(0, 1000, 2), *range(1, 1000, 2)]


def test_hash_split_does_not_depend_on_the_layout(spark):
    rows = spark.range(2000)
    one, eight = (hash_split(rows.repartition(n), ["id"]) for n in (1, 8))
    assert one.exceptAll(eight).isEmpty()
    share = side(one, "train").count() / 2000
    assert 0.66 < share < 0.74
    assert side(one, "train").count() + side(one, "test").count() == 2000


def test_hash_split_over_several_columns_and_weights(spark):
    rows = spark.range(2000).withColumn("b", F.col("id") * 2)
    assert side(hash_split(rows, ["id", "b"], (1, 0)), "test").isEmpty()
    halves = hash_split(rows, ["id", "b"], (2, 2))
    assert 0.45 < side(halves, "train").count() / 2000 < 0.55


def test_random_split_keeps_every_row(spark):
    train, test = random_split(spark.range(1000))
    assert train.union(test).distinct().count() == 1000


def test_small_shares_are_kept_and_lost_ones_refused(spark):
    rows = spark.range(20000)
    assert 40 < side(hash_split(rows, ["id"], (0.996, 0.004)), "test").count() < 130
    assert side(hash_split(rows, ["id"], (0, 1)), "train").isEmpty()
    with pytest.raises(ValueError, match="without rows"):
        hash_split(rows, ["id"], (1, 1e-12))


def test_hash_of_negative_and_null_keys(spark):
    rows = spark.createDataFrame([(None,), (-1,), (-(1 << 63),), ((1 << 63) - 1,)], "id long")
    assert hash_split(rows, ["id"]).count() == 4


@pytest.mark.parametrize("ranges", [16, 1 << 20])
def test_keys_that_repeat_are_numbered_without_a_stored_copy(spark, monkeypatch, tmp_path, ranges):
    """Half of the rows share one key; their place in the files orders them."""
    rows = spark.range(0, 600, 1, 5).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 2 == 0, 77).otherwise(F.col("id")).alias("timestamp"),
        F.lit("click").alias("sensor_id"),
        F.col("id").cast("float").alias("value"),
    )
    rows.write.parquet(str(tmp_path / "events"))
    events = read_parquet_events(spark, str(tmp_path / "events"), EventColumns(event_id="event_id"), positions=True)
    monkeypatch.setattr(sampling, "materialize", lambda *args: pytest.fail("a table is stored"))
    monkeypatch.setattr(sampling, "ROWS_PER_RANGE", ranges)
    found = sampling.every_nth(events, ["timestamp"], 1)
    assert found.columns == ["event_id", "timestamp", "sensor_id", "value", "idx"]
    placed = sorted((r["idx"], r["timestamp"], r["event_id"]) for r in found.collect())
    assert [idx for idx, _, _ in placed] == list(range(600))
    assert [t for _, t, _ in placed] == sorted(t for _, t, _ in placed)
    assert len({i for _, _, i in placed}) == 600
    again = sorted((r["idx"], r["event_id"]) for r in sampling.every_nth(events.repartition(3), ["timestamp"], 7).collect())
    assert again == [(idx, i) for idx, _, i in placed if idx % 7 == 0]
