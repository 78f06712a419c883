"""Left joins of a base table with per-key tables, lookups and fan-out."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartfold.operators.heavy import PAGE_ROWS
from chartfold.operators.rollup import rollup
from chartfold.shared import send_by_value, settled

send_by_value(__name__)

# Fixed value: Spark's default limit for automatic broadcasts.
BROADCAST_BYTES = 10 * 1024 * 1024
# Rows in memory take several times their text, and some bytes each.
_TIMES_TEXT, _ROW_BYTES = 4, 64
# Keys that rows without a key are spread over in a join.
_SPREAD = 4096


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """`df` settled, with a broadcast hint if it measures no more than `max_bytes`.

    The stored rows are measured, so `df` runs once. Without the hint the
    runtime planner still broadcasts a side whose shuffled size is below its
    own limit.
    """
    stored = settled(df)
    row = F.octet_length(F.to_json(F.struct("*"))).cast("bigint") * _TIMES_TEXT + _ROW_BYTES
    small = stored.agg(F.coalesce(F.sum(row), F.lit(0))).first()[0] <= max_bytes
    return F.broadcast(stored) if small else stored


def spread_key(df: DataFrame, key: str) -> Column:
    """The key as text; where it is NULL, one of many values that match nothing."""
    rest = F.concat(F.lit("\0no key "), F.pmod(F.xxhash64(*df.columns), F.lit(_SPREAD)).cast("string"))
    return F.coalesce(F.col(key), rest)


def left_join_all(base: DataFrame, per_key: Sequence[DataFrame], key: str) -> DataFrame:
    """Left join tables of one row per key onto `base`; every base row is kept.

    Tables already partitioned by the key are not shuffled again, and the base
    is shuffled once for the whole chain. Rows without a key match nothing and
    are spread, not sent to one task.
    """
    joined = base.withColumn("join_key", spread_key(base, key))
    for i, side in enumerate(per_key):
        renamed = side.withColumnRenamed(key, f"side_key_{i}")
        joined = joined.join(renamed, F.col("join_key") == F.col(f"side_key_{i}"), "left")
    return joined.drop("join_key", *(f"side_key_{i}" for i in range(len(per_key))))


def lookup(
    keys: DataFrame,
    rows: DataFrame,
    key: str,
    fields: Sequence[str],
    into: str,
    page_rows: int = PAGE_ROWS,
) -> DataFrame:
    """The rows of each wanted key as a list, empty for an unknown key.

    Returns (key, page, list): all pages for every row of `keys`, also for a
    repeated one. Only rows of wanted keys are grouped.
    """
    keys = keys.select(key)
    wanted = settled(keys.distinct())
    found = rollup(rows.join(wanted, key, "left_semi"), key, fields, into, "rows", page_rows=page_rows)
    # Settled, so that a key asked for very often is a skew that can be split.
    stored = settled(found.select(key, "page", into))
    empty = F.array().cast(found.schema[into].dataType)
    answers = left_join_all(keys, [stored], key)
    return answers.select(key, F.coalesce("page", F.lit(0)).alias("page"), F.coalesce(into, empty).alias(into))


def smallest_keys(rows: DataFrame, key: str, n: int) -> DataFrame:
    """The `n` smallest different text keys, settled. Every task hands on no more
    than `n`, so the keys of all rows are not shuffled."""

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = pa.array([], pa.string())
        for batch in batches:
            found = pc.unique(pa.concat_arrays([kept, batch.column(0).cast(pa.string())])).drop_null()
            kept = found.take(pc.sort_indices(found)[:n])
        yield pa.RecordBatch.from_arrays([kept], [key])

    few = rows.select(F.col(key).cast("string").alias(key)).mapInArrow(least, f"`{key}` string")
    return settled(few.distinct().orderBy(key).limit(n))


def fanout(counts: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Rows per key that an inner join of all tables would give, without running it.

    `counts` has a count per key and table; only keys present in all of them
    would survive the join.
    """
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return counts.where(present).select(key, *columns, _product([F.col(c) for c in columns]).alias("naive_rows"))


def _product(columns: Sequence[Column]) -> Column:
    # Exact up to 38 digits; a product of bigints would overflow under ANSI.
    wide = [c.cast("decimal(38,0)") for c in columns]
    return reduce(lambda a, b: (a * b).cast("decimal(38,0)"), wide)


