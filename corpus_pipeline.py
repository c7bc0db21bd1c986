"""From raw documents to training shards: five stages, each an operator of ``slumberline.llm``.

Every stage gets all that the one before kept, as a stored table, and returns the columns of ``documents``;
the last one adds the shard and the slot.

Defined results: columns besides those of ``documents`` go through every stage unchanged, whatever their names (``shard`` and
``slot`` are replaced at the end). A null text has no words and goes with the quality rules; null and repeated ids are ids like
others; rows equal in id and text are one document from the second stage on; very long texts are worked on whole, as the operators
say; ties are broken by the operators' rules, the same in every run. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slumberline.llm import decontaminate, mixing, near_dups, quality, sharding
from slumberline.llm.columns import put_back, set_aside
from slumberline.session import materialize


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules and the classifier."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    named, aside = set_aside(docs, quality.RESULT)
    return put_back(quality.assess(named, model).filter("kept").select(*named.columns), aside)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies."""
    return near_dups.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights take them: a document taken twice is two rows."""
    named, aside = set_aside(docs, mixing.RESULT)
    taken = mixing.mix(named).filter(F.col("copies") > 0)
    rows = taken.select(*named.columns, F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copies"))
    return put_back(rows.select(*named.columns), aside)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard and slot, in a reproducible shuffle."""
    return sharding.shard(docs, ties=("text",))


STAGES = [
    ("quality", good_quality),
    ("near_dups", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("sharding", sharded),
]

# The classifier and the similarity of texts have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
