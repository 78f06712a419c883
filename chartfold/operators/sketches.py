"""Distinct counts that can be stored and merged: HyperLogLog sketches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sketches of 2^LOG_SIZE registers err by about 1.04 / sqrt(2^LOG_SIZE), 1.6 %.
LOG_SIZE = 12


def sketch(rows: DataFrame, by: Sequence[str], columns: Mapping[str, str], log_size: int = LOG_SIZE) -> DataFrame:
    """A row per `by` with a sketch of the different values of each column, named
    by `columns` (sketch name to column). NULLs do not count.

    The sketches are merged on the map side, so a hot key sends one row a task.
    Stored once, they answer for any coarser grouping, and sketches of new rows
    can be added to them (`merged`) without reading the old rows.
    """
    return rows.groupBy(*by).agg(
        *(F.hll_sketch_agg(F.col(column), F.lit(log_size)).alias(name) for name, column in columns.items())
    )


def merged(sketches: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """The sketches of a coarser grouping, or of several tables of sketches."""
    return sketches.groupBy(*by).agg(*(F.hll_union_agg(name).alias(name) for name in names))


def estimates(sketches: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """The estimated number of different values, by any of the sketches' columns;
    a sketch that is NULL counts nothing."""
    joined = merged(sketches, by, names)
    zero = F.lit(0).cast("bigint")
    return joined.select(*by, *(F.coalesce(F.hll_sketch_estimate(name), zero).alias(name) for name in names))
