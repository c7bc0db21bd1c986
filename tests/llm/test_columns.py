"""Columns that happen to have the names operators use themselves; rows that nothing tells apart."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from slumberline.llm import columns, decontaminate, mixing, near_dups, quality, sharding
from slumberline.llm import queries as q

SF_DIR = "/root/testdata/sf0.001"
CLASHING = sorted(
    {*mixing.INTERNAL, *sharding.INTERNAL, *near_dups.INTERNAL, *mixing.RESULT, *quality.RESULT}
    | {"_held", "_digest", "row", "cid", "label", "words", "docs", "prefix", "base", "budget", "place", "cap", "col", "Size", "_FILE", "z"}
    - set(sharding.RESULT)
)


def with_clashes(docs):
    """A column of every such name, with a text that hangs on the row and the name."""
    names = [name for i, name in enumerate(CLASHING) if name.lower() not in {n.lower() for n in CLASHING[:i]}]
    told = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.md5(F.coalesce("text", F.lit(""))))
    for name in names:
        docs = docs.withColumn(name, F.concat(F.lit(f"{name}="), told))
    return docs, names


def check_unchanged(result, names):
    told = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.md5(F.coalesce("text", F.lit(""))))
    wrong = [F.count_if(~F.col(f"`{name}`").eqNullSafe(F.concat(F.lit(f"{name}="), told))).alias(f"n{i}") for i, name in enumerate(names)]
    row = result.agg(F.count(F.lit(1)).alias("rows"), *wrong).first()
    assert row["rows"] > 0 and {name: row[f"n{i}"] for i, name in enumerate(names) if row[f"n{i}"]} == {}


@pytest.fixture(scope="module")
def clashing(spark):
    docs = q.table(spark, SF_DIR, "documents")
    return with_clashes(docs.unionByName(docs.limit(3).withColumn("doc_id", F.lit(None).cast("bigint"))))


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_leave_other_columns_alone(spark, clashing, name, stage):
    docs, names = clashing
    result = stage(spark, docs, SF_DIR)
    assert result.columns[: len(docs.columns)] == docs.columns
    check_unchanged(result, names)


def test_operators_leave_other_columns_alone(spark, clashing):
    docs, names = clashing
    mixed = mixing.mix(docs)
    results = {n.lower() for n in mixing.RESULT}
    check_unchanged(mixed, [name for name in names if name.lower() not in results])
    assert mixed.agg(F.sum("taken")).first()[0] > 0
    check_unchanged(sharding.shard(docs, ties=("text",)), names)
    check_unchanged(near_dups.keep_one(docs), names)
    check_unchanged(decontaminate.clean(docs, q.table(spark, SF_DIR, "benchmark")), names)


def test_a_key_may_have_an_internal_name(documents):
    docs = documents((1, "a"), (2, "b"), (3, None)).withColumnRenamed("doc_id", "_start").withColumnRenamed("text", "_left")
    rows = sharding.shard(docs, shards=2, key="_start", ties=("_left",)).collect()
    assert sorted((r["shard"], r["slot"]) for r in rows) == [(0, 0), (0, 1), (1, 0)] and {r["_start"] for r in rows} == {1, 2, 3}


@pytest.mark.parametrize("part", [3, 1 << 16])
def test_copies_are_numbered_within_their_group(spark, monkeypatch, part):
    monkeypatch.setattr(columns, "ROWS_PER_PART", part)
    rows = spark.createDataFrame([(i % 3 or None, "x") for i in range(50)] + [(7, "x")], "g int, v string").repartition(4)
    found = columns.numbered_copies(rows, ["g"], "n")
    assert found.columns == ["g", "v", "n"]
    groups = {}
    for r in found.collect():
        groups.setdefault(r["g"], []).append(r["n"])
    assert {g: sorted(n) for g, n in groups.items()} == {None: list(range(17)), 1: list(range(17)), 2: list(range(16)), 7: [0]}


# --- mixing: ids that repeat ----------------------------------------------------------------------


def taken(docs, **how):
    return mixing.mix(docs, **how).agg(F.sum("taken"), F.first("target")).first()


@pytest.mark.parametrize("n_null", [0, 60, 80, 100])
def test_null_ids_do_not_move_the_mix_off_its_target(documents, n_null):
    rng = random.Random(n_null)
    rows = [(None if i < n_null else i, " ".join(rng.choices("abcdefgh", k=10)), "s") for i in range(100)]
    words, target = taken(documents(*rows))
    assert target == 1500 and abs(words - target) <= 5


@pytest.mark.parametrize("n_equal", [34, 67, 100])
def test_copies_at_the_edge_are_taken_one_by_one(documents, n_equal):
    rows = [(None, "one and the same text of nine words here", "s") for _ in range(n_equal)]
    rows += [(i, f"another text {i} of nine words in all here", "s") for i in range(100 - n_equal)]
    words, target = taken(documents(*rows))
    assert target == 1350 and abs(words - target) <= 4.5
    rows += [(None, None, None), (None, None, None), (5, "a b", None), (5, "a b", None)]
    result = mixing.mix(documents(*rows))
    again = mixing.mix(documents(*rows, partitions=1))
    columns_ = ["doc_id", "size", "source_size", "target", "taken"]
    one, other = result.select(columns_), again.select(columns_)
    assert result.count() == 104 and one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()
    for row in result.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("size").alias("size")).collect():
        assert abs(row["taken"] - row["target"]) <= row["size"] / 2


# --- sharding: rows equal in key and ties ---------------------------------------------------------


@pytest.mark.parametrize("n_equal", [0, 200, 600])
def test_a_hot_group_is_numbered_in_parts(spark, documents, monkeypatch, n_equal):
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", 20)
    monkeypatch.setattr(sharding, "HOT", 100)
    monkeypatch.setattr(columns, "ROWS_PER_PART", 30)
    rows = [(None, "same") for _ in range(n_equal)] + [(i % 300, f"text {i}") for i in range(600)]
    made = []
    for partitions in (1, 5):
        result = sharding.shard(documents(*rows, partitions=partitions), ties=("text",))
        places = [(r["shard"], r["slot"]) for r in result.select("shard", "slot").collect()]
        assert len(set(places)) == len(rows)
        for shard in range(24):
            slots = sorted(slot for s, slot in places if s == shard)
            assert slots == list(range(len(slots))) and len(slots) in (len(rows) // 24, len(rows) // 24 + 1)
        made.append(sorted((r["doc_id"] or -1, r["text"], r["shard"], r["slot"]) for r in result.collect()))
    assert made[0] == made[1]
