"""Durable working folders and lineage cuts.

A cut is a written Parquet table in the folder the cluster shares between its
executors, so losing an executor loses nothing, and both readers of a result that
is used twice scan the file instead of recomputing it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


def shared_root(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary folder only on a single machine."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="playmart-"))
    return context.getCheckpointDir()


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path under the shared root that nothing has used before."""
    root = _scratch.get() or shared_root(spark)
    return f"{root}/playmart-{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Folders made inside the block lie under one folder that goes away at its end.

    For jobs that store their results elsewhere; frames built on a cut must be written
    before the block ends.
    """
    root = fresh_dir(spark, "scratch")
    token = _scratch.set(root)
    try:
        yield root
    finally:
        _scratch.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame, label: str = "cut", **options) -> DataFrame:
    """Write ``df`` once, with the writer's ``options``, and read it back: later plans start from the file."""
    path = fresh_dir(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Shared:
    """Named intermediate results of one build, each computed and written once.

    Steps that need the same result ask for it by name, so their common source is read once,
    in whichever order they run.
    """

    def __init__(self) -> None:
        self.held: dict[str, DataFrame] = {}

    def get(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if name not in self.held:
            self.held[name] = cut(make(), name)
        return self.held[name]
