"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")
R = TypeVar("R")

# The paths made inside each open ``cleared_scratch``; helper threads of a job append to them, too.
_open_scratch: list[list[str]] = []

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the zone pinned to UTC. ``master`` is left to spark-submit when not given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    Only a local session may fall back to a temporary folder: on a cluster the executors could not
    see each other's files there, so a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="slumberline-")
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; ``cleared_scratch`` deletes those made inside it."""
    path = f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    for made in _open_scratch:
        made.append(path)
    return path


@contextmanager
def cleared_scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch tables of a job when the block ends, also on an error. What reads them must have
    been shown, written or collected by then."""
    made: list[str] = []
    _open_scratch.append(made)
    try:
        yield
    finally:
        _open_scratch.remove(made)
        for name in made:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the stored table.

    Unlike a cached table it survives lost executors, and a later filter or projection reaches its scan.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def at_once(spark: SparkSession, work: Callable[[T], R], items: Sequence[T]) -> list[R]:
    """Run independent Spark actions side by side: the short jobs of one fill the gaps of the other."""
    with ThreadPoolExecutor(max(len(items), 1)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), items))
