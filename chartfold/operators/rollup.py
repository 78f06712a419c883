"""Roll the rows of each key up to lists and counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartfold.operators.heavy import PAGE_ROWS, cut_pages, dealt_from, hot_keys, only, pages, without
from chartfold.shared import settled


def rollup(
    rows: DataFrame,
    key: str,
    fields: Sequence[str],
    into: str,
    count_as: str,
    distinct: bool = False,
    counted: str | None = None,
    page_rows: int = PAGE_ROWS,
    counts: DataFrame | None = None,
) -> DataFrame:
    """List the `fields` of each key's rows as structs, in sorted order.

    One row per key and page: key, `page`, `list_pages`, list, count and
    `row_count`. This is the only layout of a list, whatever its size. A page
    holds about `page_rows` items; most keys have page 0 only. The counts
    cover all pages and stand on each.

    With `distinct` the list is a set and `count_as` counts the distinct
    non-NULL values of the `counted` field; otherwise the list keeps duplicates
    and `count_as` counts rows. `row_count` counts rows in both cases. Rows
    with a NULL key are left out.

    `counts` (key, `row_count`) tells which keys are hot, if it is known; else
    the keys alone are counted first.
    """
    rows = rows.where(F.col(key).isNotNull()).select(key, *fields)
    if counts is None:
        counts = rows.groupBy(key).agg(F.count("*").alias("row_count"))
    hot = hot_keys(counts, key, ["row_count"], dealt_from(page_rows))
    gathered = lists(without(rows, hot, key), key, fields, into, count_as, distinct, counted)
    whole = cut_pages(gathered, [into], page_rows).select(key, "page", "list_pages", into, count_as, "row_count")
    if hot is None:
        return whole
    own = only(rows, hot, key)
    paged = pages(own, key, fields, distinct, page_rows, into)
    total = paged.groupBy(key).agg(F.count("*").cast("int").alias("list_pages"))
    told = settled(_hot_counts(own, key, count_as, counted if distinct else None).join(total, key))
    return whole.unionByName(paged.join(told, key).select(whole.columns))


def _hot_counts(rows: DataFrame, key: str, count_as: str, counted: str | None) -> DataFrame:
    """(key, `count_as`, `row_count`), counted by value first, so that a hot key
    is a row per value."""
    value = F.lit(None).cast("string") if counted is None else F.col(counted)
    per_value = rows.groupBy(key, value.alias("value")).agg(F.count("*").alias("n"))
    rows_of = F.sum("n")
    return per_value.groupBy(key).agg(
        (rows_of if counted is None else F.count("value")).alias(count_as), rows_of.alias("row_count")
    )


def lists(
    rows: DataFrame,
    key: str,
    fields: Sequence[str],
    into: str,
    count_as: str,
    distinct: bool,
    counted: str | None,
) -> DataFrame:
    """(key, list, count, `row_count`) of keys that none is hot among: a single
    aggregation with a single shuffle on the key, which a join can reuse."""
    collect = F.collect_set if distinct else F.collect_list
    gathered = rows.groupBy(key).agg(
        F.sort_array(collect(F.struct(*fields))).alias(into), F.count("*").alias("row_count")
    )
    # The distinct values are in the list already; a distinct count next to
    # the set would shuffle all rows a second time.
    count = _distinct_values(F.col(into)[counted]) if distinct else F.col("row_count")
    return gathered.select(key, into, count.cast("bigint").alias(count_as), "row_count")


def whole_lists(paged: DataFrame) -> DataFrame:
    """The rows without page numbers; raises if any list has several pages."""
    if not paged.where(F.col("list_pages") > 1).isEmpty():
        raise ValueError("some lists have more than one page; read them page by page")
    return paged.drop("page", "list_pages")


def _distinct_values(values: Column) -> Column:
    return F.array_size(F.array_compact(F.array_distinct(values)))
