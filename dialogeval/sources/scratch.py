"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Paths given out since the innermost scope of this thread was opened.
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach, as the cluster names it in `spark.checkpoint.dir`.

    Only when the setting is missing and the session is local is a temporary folder made.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    return _local_folder()


_LOCAL: list[str] = []


def _local_folder() -> str:
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="dialogeval-"))
    return _LOCAL[0]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; a rerun never meets the files of an earlier one."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    made = _MADE.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Remove the intermediate tables that are made inside, at its end and also after an error.

    What was computed from them must be written or collected by then: plans that read them fail afterwards. Tables made
    before stay, and so do those of other threads.
    """
    token = _MADE.set([])
    try:
        yield
    finally:
        made = _MADE.get() or []
        _MADE.reset(token)
        for path in made:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def finished(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """What `build` returns, as a stored table; the tables that it made on the way are removed."""
    path = scratch_path(spark, name)
    with scope(spark):
        df = build()
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def through_table(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts the lineage of a table that several later stages read: lost executors cost a re-read of files
    and not a recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
