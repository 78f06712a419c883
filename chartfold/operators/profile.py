"""Null profiles and load summaries: one aggregation per table."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartfold.functions.fields import percent
from chartfold.schemas import CORRUPT


def _data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != CORRUPT]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def null_profile(df: DataFrame, first_columns: int | None = None) -> DataFrame:
    """(column, total_rows, null_count, null_pct) of the columns that hold nulls.

    All columns are profiled, or with `first_columns` only so many.
    """
    columns = _data_columns(df)[:first_columns]
    counted = df.agg(
        F.count("*").alias("total_rows"),
        *[F.count_if(F.col(_quoted(c)).isNull()).alias(f"nulls_{i}") for i, c in enumerate(columns)],
    )
    rows = [
        F.struct(F.lit(c).alias("column"), F.col(f"nulls_{i}").alias("null_count"))
        for i, c in enumerate(columns)
    ]
    return (
        counted.select("total_rows", F.inline(F.array(*rows)))
        .where(F.col("null_count") > 0)
        .select(
            "column",
            "total_rows",
            "null_count",
            percent(F.col("null_count"), F.col("total_rows"), 2).alias("null_pct"),
        )
    )


def raw_quality(tables: Mapping[str, DataFrame], first_columns: int | None = None) -> DataFrame:
    """Null profile of every table, with its name and column count."""
    profiles = [
        null_profile(df, first_columns)
        .withColumn("table", F.lit(name))
        .withColumn("total_columns", F.lit(len(_data_columns(df))))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, profiles).select(
        "table", "total_rows", "total_columns", "column", "null_count", "null_pct"
    )


def load_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(resource, rows, columns, corrupt_rows) of every loaded table."""
    return reduce(DataFrame.unionByName, [_summary_row(n, df) for n, df in tables.items()])


def _summary_row(name: str, df: DataFrame) -> DataFrame:
    data = _data_columns(df)
    if CORRUPT in df.columns:
        # Spark refuses to read the corrupt column of raw JSON on its own, so
        # the condition also touches a data column.
        anything = F.coalesce(F.col(CORRUPT), F.col(_quoted(data[0])).cast("string"))
        corrupt = F.count_if(F.col(CORRUPT).isNotNull() & anything.isNotNull())
    else:
        corrupt = F.lit(0).cast("bigint")
    return df.agg(F.count("*").alias("rows"), corrupt.alias("corrupt_rows")).select(
        F.lit(name).alias("resource"), "rows", F.lit(len(data)).alias("columns"), "corrupt_rows"
    )
