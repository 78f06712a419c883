"""Keys with too many rows for one list.

One patient may own a large share of all rows. Gathering those rows into one
array, or even sending them to one task, does not scale. Counts per key, which
are combined on the map side and cost a hot key one row per map task, tell
which keys these are; the counts are settled and serve as output as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartfold.shared import settled

# Rows of a key that a page of its list holds, about.
PAGE_ROWS = 50_000
# Keys of up to so many rows are listed whole and cut into pages, however small
# the pages are; dealing them over pages by a hash would shuffle them twice more.
GATHER_ROWS = 50
# Copies of one row are spread in runs of this fraction of a page.
RUNS_PER_PAGE = 8


def hot_keys(counts: DataFrame, key: str, columns: Sequence[str], page_rows: int) -> DataFrame | None:
    """The keys with more than `page_rows` in any of the count columns, settled;
    None if there are none.

    There are at most (all rows / `page_rows`) of them, and none is collected.
    """
    over = [F.coalesce(c, F.lit(0)) > page_rows for c in columns]
    hot = over[0]
    for more in over[1:]:
        hot = hot | more
    found = settled(counts.where(hot).select(F.col(key).alias("hot_key")))
    return None if found.isEmpty() else found


def dealt_from(page_rows: int) -> int:
    """The rows above which a key is dealt over pages, and not gathered."""
    return max(page_rows, GATHER_ROWS)


def cut_pages(df: DataFrame, lists: Sequence[str], page_rows: int) -> DataFrame:
    """`df`, a row per key with sorted lists, with a row for each page of the
    longest list: `page`, `list_pages`, and of each list the items that are on
    this page, NULL if there are none on a later page.

    A page depends on the list alone. No list is copied: each row gets its
    page's items only.
    """
    if page_rows >= GATHER_ROWS:
        return df.withColumns({"page": F.lit(0), "list_pages": F.lit(1)})
    sizes = [F.coalesce(F.size(name), F.lit(0)) for name in lists]
    total = F.ceil(F.greatest(F.lit(1), *sizes) / page_rows).cast("int")

    def of_page(i: Column) -> Column:
        start = i * page_rows
        items = (F.when((i == 0) | (start < F.size(n)), F.slice(n, start + 1, page_rows)).alias(n) for n in lists)
        return F.struct(i.alias("page"), total.alias("list_pages"), *items)

    kept = [c for c in df.columns if c not in lists]
    paged = df.select(*kept, F.inline(F.transform(F.sequence(F.lit(0), total - 1), of_page)))
    return paged.select(*df.columns, "page", "list_pages")


def without(df: DataFrame, hot: DataFrame | None, key: str) -> DataFrame:
    """The rows whose key is not hot; NULL keys are not."""
    return df if hot is None else df.join(hot, F.col(key) == F.col("hot_key"), "left_anti")


def only(df: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """The rows of the hot keys, settled: the small part of a table that many
    steps work on, apart from the rest."""
    return settled(df.join(hot, F.col(key) == F.col("hot_key"), "left_semi"))


def pages(rows: DataFrame, key: str, fields: Sequence[str], distinct: bool, page_rows: int, into: str) -> DataFrame:
    """(key, page, list) of hot keys: their rows, or distinct rows, dealt over
    pages of about `page_rows` and sorted in each.

    Rows are counted under a key that includes the row itself, so no task sees
    a hot key whole; copies of one row are dealt out in runs. The page is a
    hash of the row and its run and depends on nothing else: a task that runs
    again after a loss puts every row where it was. Pages that the hash leaves
    empty are skipped in the numbering, so the numbers have no gaps.
    """
    copies = F.lit(1).cast("bigint") if distinct else F.count("*")
    items = settled(rows.groupBy(key, *fields).agg(copies.alias("copies")))
    sizes = settled(
        items.groupBy(F.col(key).alias("sized_key")).agg(
            F.ceil(F.sum("copies") / page_rows).cast("int").alias("in_pages")
        )
    )
    run_rows = max(1, page_rows // RUNS_PER_PAGE)
    run = F.sequence(F.lit(0).cast("bigint"), F.expr(f"(copies - 1) div {run_rows}"))
    dealt = items.join(sizes, F.col(key) == F.col("sized_key")).withColumn("run", F.explode(run))
    times = F.least(F.lit(run_rows).cast("bigint"), F.col("copies") - F.col("run") * run_rows).cast("int")
    page = F.pmod(F.xxhash64(*fields, "run"), F.col("in_pages")).cast("int")
    listed = dealt.select(key, page.alias("page"), F.struct(F.struct(*fields).alias("item"), times.alias("times")).alias("i"))
    found = settled(
        listed.groupBy(key, "page").agg(F.collect_list("i").alias("items")).select(key, "page", _expanded("items").alias(into))
    )
    # Numbered apart from the lists, which stay where they are.
    nth = F.row_number().over(Window.partitionBy(key).orderBy("page")) - 1
    numbers = found.select(F.col(key).alias("of_key"), F.col("page").alias("hashed"), nth.alias("nth"))
    same = (F.col(key) == F.col("of_key")) & (F.col("page") == F.col("hashed"))
    return found.join(numbers, same).select(key, F.col("nth").alias("page"), into)


def _expanded(items: str) -> Column:
    repeated = F.transform(items, lambda p: F.array_repeat(p["item"], p["times"]))
    return F.sort_array(F.flatten(repeated))
