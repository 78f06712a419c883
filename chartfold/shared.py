"""Storage that every executor can reach."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

# The paths that the innermost open scope owns.
_OWNED: ContextVar[list[str] | None] = ContextVar("owned", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The session's `spark.checkpoint.dir`.

    Only a session that names none (a test on one machine) gets a fresh local
    folder; a cluster must name a shared one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    own = tempfile.mkdtemp(prefix="chartfold-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def new_shared_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used yet; an open scope owns it."""
    path = f"{scratch(spark)}/{label}-{uuid.uuid4().hex}"
    if (owned := _OWNED.get()) is not None:
        owned.append(path)
    return path


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Whatever is settled in this block is deleted at its end, also if it fails.

    Plans made in the block must have run by then. Scopes nest; a path belongs
    to the innermost one.
    """
    mark = _OWNED.set([])
    try:
        yield
    finally:
        owned = _OWNED.get()
        _OWNED.reset(mark)
        for path in owned:
            delete(spark, path)


def settled_from(spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
    """What `build` returns, settled; the tables settled on the way are deleted."""
    path = new_shared_path(spark, "table")
    with scope(spark):
        df = build()
        df.write.parquet(path)
        schema = df.schema
    return spark.read.schema(schema).parquet(path)


def settled(df: DataFrame) -> DataFrame:
    """Write `df` once and read it back, so later plans do not recompute it."""
    path = new_shared_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder on any file system that Spark reaches."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def scratch(spark: SparkSession) -> str:
    """Where settled tables of this application are kept."""
    return f"{shared_dir(spark).rstrip('/')}/chartfold-{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete all settled tables of this application: at the end of a job, when
    no plan reads them any more."""
    delete(spark, scratch(spark))


def send_by_value(module: str) -> None:
    """Send a module's functions to the tasks whole, so that executors need not
    have this package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
