"""Clinical tables clustered by patient: rollups, joins and lookups without a
shuffle.

The flat rows of each kind are stored once, bucketed and sorted by patient, and
so are the patients and their tally. All tables have the same buckets, so what
groups or joins by patient reads its buckets side by side. A patient with more
than `page_rows` rows of a kind would make one bucket large; the rows of such
patients are stored apart, unbucketed, and paged when they are listed.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from chartfold.operators.heavy import PAGE_ROWS, hot_keys
from chartfold.operators.rollup import lists, rollup
from chartfold.plans.master import KINDS, clinical_rows, joined_master, patient_tally
from chartfold.plans.records import KEY, patient_base
from chartfold.shared import delete

# Up to so many wanted patients, a lookup names them in the scan's filter; more
# are joined.
NAMED_KEYS = 1_000
_LAYOUT = "name string, columns string, buckets int, page_rows int"
_BASE, _TALLY = "patients", "tally"
# 1 for the rows of hot patients, where rows are stored by it.
_APART = "_apart"


@dataclass(frozen=True)
class Clustered:
    """Tables by name: `patients`, `tally` and the kinds. `even` ones are bucketed
    and hold no hot patient, `hot` ones hold the others (None if there are
    none), `unkeyed` the patients without an id."""

    even: Mapping[str, DataFrame]
    hot: Mapping[str, DataFrame] | None
    unkeyed: DataFrame
    page_rows: int


def cluster(
    tables: Mapping[str, DataFrame], path: str, buckets: int, page_rows: int = PAGE_ROWS, absolute: bool = False
) -> Clustered:
    """Store the tables under `path`, an unused folder, and open them.

    About one bucket per 200 MB of rows is right; the buckets are what later
    plans run in parallel. Every table is shuffled once, here. Where there are
    hot patients, one pass parts each table; the rows of the others are then
    bucketed from what it stored.
    """
    path = path.rstrip("/")
    spark = tables["patient"].sparkSession
    tally = patient_tally(tables, absolute=absolute)
    hot = hot_keys(tally, KEY, ["patient_rows", *(f"{k}_rows" for k in KINDS)], page_rows)
    base = patient_base(tables["patient"])
    base.where(F.col(KEY).isNull()).write.parquet(f"{path}/unkeyed")
    parts = {_BASE: base.where(F.col(KEY).isNotNull()), _TALLY: tally, **clinical_rows(tables, absolute=absolute)}
    for name, rows in parts.items():
        even = (rows if hot is None else _parted(rows, hot, f"{path}/hot/{name}")).repartition(buckets, KEY)
        # One task writes a bucket, so a bucket is one sorted file.
        writer = even.write.format("parquet").bucketBy(buckets, KEY).sortBy(KEY).option("path", f"{path}/even/{name}")
        writer.saveAsTable(_table(path, name))
        if hot is not None:
            delete(spark, f"{path}/hot/{name}/{_APART}=0")
    layout = [(name, rows.schema.json(), buckets, page_rows) for name, rows in parts.items()]
    spark.createDataFrame(layout, _LAYOUT).coalesce(1).write.json(f"{path}/layout")
    return opened(spark, path)


def opened(spark: SparkSession, path: str) -> Clustered:
    """The tables that `cluster` completed under `path`, in any session."""
    path = path.rstrip("/")
    layout = spark.read.schema(_LAYOUT).json(f"{path}/layout").collect()
    schemas = {r["name"]: StructType.fromJson(json.loads(r["columns"])) for r in layout}
    for r in layout:
        # The buckets are in the files' names; the catalog only needs telling.
        spark.sql(
            f"create table if not exists {_table(path, r['name'])} ({schemas[r['name']].toDDL()}) using parquet "
            f"clustered by ({KEY}) sorted by ({KEY}) into {r['buckets']} buckets location '{path}/even/{r['name']}'"
        )
    even = {r["name"]: spark.table(_table(path, r["name"])) for r in layout}
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/hot")
    hot = None
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        hot = {name: _apart(spark, f"{path}/hot/{name}", schema, 1) for name, schema in schemas.items()}
    unkeyed = spark.read.schema(schemas[_BASE]).parquet(f"{path}/unkeyed")
    return Clustered(even, hot, unkeyed, layout[0]["page_rows"])


def _parted(rows: DataFrame, hot: DataFrame, path: str) -> DataFrame:
    """Stores the rows by whether their patient is hot, in one pass; the others'."""
    flagged = rows.join(hot.withColumn(_APART, F.lit(1)), F.col(KEY) == F.col("hot_key"), "left")
    flagged.select(*rows.columns, F.coalesce(_APART, F.lit(0)).alias(_APART)).write.partitionBy(_APART).parquet(path)
    return _apart(rows.sparkSession, path, rows.schema, 0)


def _apart(spark: SparkSession, path: str, schema: StructType, value: int) -> DataFrame:
    stored = spark.read.schema(StructType([*schema, StructField(_APART, IntegerType())])).parquet(path)
    return stored.where(F.col(_APART) == value).drop(_APART)


def _table(path: str, name: str) -> str:
    return f"clustered_{hashlib.md5(path.encode()).hexdigest()}_{name}"


def _lists(rows: DataFrame, kind: str) -> DataFrame:
    k = KINDS[kind]
    return lists(rows, KEY, k.fields, kind, k.count_as, k.counted is not None, k.counted)


def clustered_rollup(tables: Clustered, kind: str) -> DataFrame:
    """What `clinical_rollup` gives, without an exchange but for hot patients."""
    return _rolled_up(tables.even[kind], tables.hot and tables.hot[kind], kind, tables.page_rows)


def _rolled_up(even: DataFrame, hot: DataFrame | None, kind: str, page_rows: int) -> DataFrame:
    k = KINDS[kind]
    whole = _lists(even, kind).select(
        KEY, F.lit(0).alias("page"), F.lit(1).alias("list_pages"), kind, k.count_as, "row_count"
    )
    if hot is None:
        return whole
    return whole.unionByName(
        rollup(hot, KEY, k.fields, kind, k.count_as, k.counted is not None, k.counted, page_rows)
    )


def clustered_master(tables: Clustered) -> DataFrame:
    """What `patient_master` gives, without an exchange but for hot patients."""
    base = tables.even[_BASE]
    joined = reduce(
        lambda left, kind: left.join(_lists(tables.even[kind], kind).drop("row_count"), KEY, "left"), KINDS, base
    )
    blank = tables.unkeyed
    for kind, k in KINDS.items():
        blank = blank.withColumns(
            {kind: F.lit(None).cast(joined.schema[kind].dataType), k.count_as: F.lit(None).cast("bigint")}
        )
    master = joined.unionByName(blank).withColumns({"page": F.lit(0), "list_pages": F.lit(1)})
    if tables.hot is not None:
        rows = {kind: tables.hot[kind] for kind in KINDS}
        apart = joined_master(tables.hot[_BASE], rows, tables.hot[_TALLY], tables.page_rows)
        master = master.unionByName(apart.select(master.columns))
    return master.select(*base.columns, *(c for k, v in KINDS.items() for c in (k, v.count_as)), "page", "list_pages")


def clustered_counts(tables: Clustered) -> DataFrame:
    """What `patient_counts` gives, without an exchange."""
    counts = [v.count_as for v in KINDS.values()]

    def joined(parts: Mapping[str, DataFrame]) -> DataFrame:
        return parts[_BASE].select(KEY, "birthDate", "gender").join(parts[_TALLY].select(KEY, *counts), KEY, "left")

    found = joined(tables.even)
    if tables.hot is not None:
        found = found.unionByName(joined(tables.hot))
    return found.unionByName(tables.unkeyed.select(KEY, "birthDate", "gender"), allowMissingColumns=True)


def clustered_lookup(tables: Clustered, keys: DataFrame, kind: str, named_keys: int = NAMED_KEYS) -> DataFrame:
    """(key, page, list) of each row of `keys`, like `lookup`: an empty list on
    page 0 for an unknown patient.

    Up to `named_keys` different patients are named in the filter of the scan,
    which then opens their buckets only, and in these the row groups that can
    hold them. More are joined: the keys are sent to the buckets, the rows stay.
    """
    some = keys.select(KEY).where(F.col(KEY).isNotNull()).distinct()
    first = [r[KEY] for r in some.limit(named_keys + 1).collect()]

    def wanted(rows: DataFrame) -> DataFrame:
        if len(first) <= named_keys:
            return rows.where(F.col(KEY).isin(first)) if first else rows.limit(0)
        return rows.join(some, KEY, "left_semi")

    hot = None if tables.hot is None else wanted(tables.hot[kind])
    found = _rolled_up(wanted(tables.even[kind]), hot, kind, tables.page_rows).select(KEY, "page", kind)
    empty = F.array().cast(found.schema[kind].dataType)
    answers = keys.select(KEY).join(found, KEY, "left")
    return answers.select(KEY, F.coalesce("page", F.lit(0)).alias("page"), F.coalesce(kind, empty).alias(kind))
