"""Helpers that several of these operators share."""

from __future__ import annotations

import ctypes
import gc
import math
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartfold.shared import send_by_value, settled

send_by_value(__name__)

# Rows that one sorting task ranks, and the least number of such tasks.
RANK_ROWS = 1_000_000
RANK_TASKS = 64


def whole_text(column: str = "text"):
    """The text, empty where it is NULL."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def release() -> None:
    """Hands memory that is free back to the system. Python workers are kept, so
    what stages before left free in them would count beside this one's."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not glibc
        pass


def released(work: Callable[..., Iterator[Any]], *given: Any) -> Iterator[Any]:
    """What `work` yields; free memory is handed back before its first batch and,
    when its own is free again, after its last."""
    release()
    try:
        yield from work(*given)
    finally:
        release()


def numbered(df: DataFrame, into: str = "_row") -> DataFrame:
    """`df` written once with a row number that no later run changes."""
    return settled(df.withColumn(into, F.monotonically_increasing_id()))


def ranked(df: DataFrame, group: Sequence[str], row: str = "_row", into: str = "_rank") -> DataFrame:
    """Gapless ranks from 0 within each group, for groups of any size.

    `row` must be unique and fixed (see `numbered`). A group is dealt into
    buckets by it; rows are ranked in their bucket and shifted by the sizes of
    the buckets before, so a hot group is sorted by many tasks. NULL is a group
    of its own.
    """
    buckets = max(RANK_TASKS, math.ceil(df.count() / RANK_ROWS))
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(row), F.lit(buckets)).cast("int"))
    keys = [*group, "_bucket"]
    sizes = dealt.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *(F.col(c).alias(f"_of_{c}") for c in keys),
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"),
    )
    inside = dealt.withColumn("_in", F.row_number().over(Window.partitionBy(*keys).orderBy(row)))
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return (
        inside.join(starts, same)
        .withColumn(into, F.col("_start") + F.col("_in") - 1)
        .drop("_bucket", "_in", "_start", *(f"_of_{c}" for c in keys))
    )
