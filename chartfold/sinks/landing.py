"""Landing by content: only files that are new or changed are read again.

A landed table is a set of Parquet folders, a batch of source files each, and a
manifest with a row for every source file: its size and stamp, the folder of
its rows, how many there are, and whether they still hold. Rows carry the
source they came from, so those of a changed or vanished file are left out when
the table is read, without rewriting the others; a batch that is mostly dead is
landed again.

A new manifest is written first and a marker that names it is added last. What
the manifest before it needs is kept, so that plans made from it still run.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

from chartfold.schemas import CORRUPT
from chartfold.shared import delete, settled
from chartfold.sources.ndjson import merged

SOURCE = "_source"
# A batch with a smaller share of bytes that still hold is landed again.
LEAST_ALIVE = 0.5
FILES = "source string, name string, bytes bigint, stamp string"
_MANIFEST = f"{FILES}, folder string, alive boolean, rows bigint, corrupt_rows bigint"
_MARKER = "number bigint, manifest string, folders array<string>, columns string, request string"


@dataclass(frozen=True)
class Source:
    """Where a table comes from.

    `files` lists what there is now (`FILES`); `source` names a file together
    with its stamp, so it changes with the content. `scan` reads some of the
    listed files, given as a table of them, with their `source` in `SOURCE`.
    Files landed under another `request`, such as another schema, do not count.
    """

    files: DataFrame
    scan: Callable[[DataFrame], DataFrame]
    request: str


def land_sources(sources: Mapping[str, Source], path: str) -> dict[str, DataFrame]:
    """The tables of the sources, landed under `path` as Parquet.

    A file is read if it is new, or if its size or stamp differ from when it
    was landed. If nothing changed, no source file is opened. Fields that only
    new files have are NULL for older ones; where a field's type does not fit
    the landed one, all files are landed again under one schema.
    """
    return {name: _land(source, f"{path.rstrip('/')}/{name}") for name, source in sources.items()}


def landed(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The table `name` as `land_sources` last completed it under `path`."""
    place = f"{path.rstrip('/')}/{name}"
    marker = _marker(spark, place)
    if marker is None:
        raise FileNotFoundError(f"no table has been landed in {place}")
    return _read(spark, place, marker)


def manifest(spark: SparkSession, path: str, name: str) -> DataFrame:
    """(source, name, bytes, stamp, folder, rows, corrupt_rows) of the files whose
    rows the landed table holds."""
    place = f"{path.rstrip('/')}/{name}"
    marker = _marker(spark, place)
    if marker is None:
        raise FileNotFoundError(f"no table has been landed in {place}")
    return _entries(spark, place, marker).where("alive").drop("alive")


def landed_summary(spark: SparkSession, path: str, names) -> DataFrame:
    """(resource, rows, columns, corrupt_rows) like `load_summary`, from the
    manifests alone: the tables are not read."""
    found = None
    for name in names:
        columns = len([c for c in landed(spark, path, name).columns if c != CORRUPT])
        zero = F.lit(0).cast("bigint")
        row = manifest(spark, path, name).agg(
            F.coalesce(F.sum("rows"), zero).alias("rows"), F.coalesce(F.sum("corrupt_rows"), zero).alias("corrupt_rows")
        )
        row = row.select(F.lit(name).alias("resource"), "rows", F.lit(columns).alias("columns"), "corrupt_rows")
        found = row if found is None else found.unionByName(row)
    return found


def fits(landed_type: DataType, new: DataType) -> bool:
    """Can both types be read as one, where each may have fields of its own?"""
    if isinstance(landed_type, StructType) and isinstance(new, StructType):
        own = {f.name: f.dataType for f in landed_type}
        return all(fits(own[f.name], f.dataType) for f in new if f.name in own)
    if isinstance(landed_type, ArrayType) and isinstance(new, ArrayType):
        return fits(landed_type.elementType, new.elementType)
    return landed_type == new


def _land(source: Source, place: str) -> DataFrame:
    spark = source.files.sparkSession
    now = settled(source.files)
    marker = _marker(spark, place)
    known = marker is not None and marker.request == source.request
    old = _entries(spark, place, marker) if known else spark.createDataFrame([], _MANIFEST)
    held = old.where("alive")
    fresh = now.join(held.select("source"), "source", "left_anti")
    stays = F.col("alive") & F.col("here").isNotNull()
    here = now.select(F.col("source").alias("now"), F.lit(True).alias("here"))
    told = settled(old.join(here, F.col("source") == F.col("now"), "left").withColumn("alive", stays).drop("now", "here"))
    gone = held.join(now.select("source"), "source", "left_anti")
    if known and fresh.isEmpty() and gone.isEmpty():
        return _read(spark, place, marker)

    # Batches that are mostly dead go; what still holds of them is read again.
    alive = F.coalesce(F.sum(F.when(F.col("alive"), F.col("bytes") + 1)), F.lit(0))
    share = told.groupBy("folder").agg((alive / F.sum(F.col("bytes") + 1)).alias("share"))
    kept = settled(told.join(share.where(F.col("share") >= LEAST_ALIVE).select("folder"), "folder", "left_semi"))
    wanted = settled(now.join(kept.where("alive").select("source"), "source", "left_anti"))
    if known and wanted.isEmpty():
        return _complete(spark, place, marker, kept, StructType.fromJson(json.loads(marker.columns)), source.request)
    rows = source.scan(wanted)
    columns = StructType([f for f in rows.schema if f.name != SOURCE])
    if known:
        before = StructType.fromJson(json.loads(marker.columns))
        if not fits(before, columns):
            kept, wanted = kept.limit(0), now
            rows = source.scan(now)
            columns = StructType([f for f in rows.schema if f.name != SOURCE])
        else:
            columns = merged(before, columns)
    folder = f"batch-{uuid.uuid4().hex}"
    rows.write.mode("error").parquet(f"{place}/{folder}")
    # Counted from the stored rows, which also shows whether they came from
    # the files that were listed.
    stored = spark.read.schema(rows.schema).parquet(f"{place}/{folder}")
    corrupt = F.count(CORRUPT) if CORRUPT in rows.columns else F.lit(0).cast("bigint")
    counts = settled(stored.groupBy(F.col(SOURCE).alias("from")).agg(F.count("*").alias("rows"), corrupt.alias("corrupt_rows")))
    strange = counts.join(wanted, F.col("from") == F.col("source"), "left_anti").select("from").first()
    if strange is not None:
        raise RuntimeError(f"changed while it was landed: {strange['from']}")
    zero = F.lit(0).cast("bigint")
    added = wanted.join(counts, F.col("source") == F.col("from"), "left").select(
        "source", "name", "bytes", "stamp", F.lit(folder).alias("folder"), F.lit(True).alias("alive"),
        F.coalesce("rows", zero).alias("rows"), F.coalesce("corrupt_rows", zero).alias("corrupt_rows"),
    )
    return _complete(spark, place, marker, kept.select(added.columns).unionByName(added), columns, source.request)


def _complete(
    spark: SparkSession, place: str, before: Row | None, entries: DataFrame, columns: StructType, request: str
) -> DataFrame:
    """Write the manifest and then the marker; delete what neither this manifest
    nor the one before needs."""
    name = f"manifest-{uuid.uuid4().hex}"
    entries.write.parquet(f"{place}/{name}")
    folders = sorted(r["folder"] for r in spark.read.parquet(f"{place}/{name}").select("folder").distinct().collect())
    row = (before.number + 1 if before else 1, name, folders, columns.json(), request)
    older = _markers(spark, place, 2)
    spark.createDataFrame([row], _MARKER).coalesce(1).write.mode("append").json(f"{place}/markers")
    if len(older) > 1:
        needed = {name, *folders, older[0].manifest, *older[0].folders}
        for unused in {older[1].manifest, *older[1].folders} - needed:
            delete(spark, f"{place}/{unused}")
    return _read(spark, place, _marker(spark, place))


def _read(spark: SparkSession, place: str, marker: Row) -> DataFrame:
    columns = StructType.fromJson(json.loads(marker.columns))
    stored = StructType([*columns, StructField(SOURCE, StringType())])
    if not marker.folders:
        return spark.createDataFrame([], columns)
    rows = spark.read.schema(stored).parquet(*(f"{place}/{f}" for f in marker.folders))
    dead = _entries(spark, place, marker).where(~F.col("alive")).select(F.col("source").alias(SOURCE))
    if not dead.isEmpty():
        rows = rows.join(dead, SOURCE, "left_anti")
    return rows.select(*(f"`{c}`" for c in columns.names))


def _entries(spark: SparkSession, place: str, marker: Row) -> DataFrame:
    return spark.read.schema(_MANIFEST).parquet(f"{place}/{marker.manifest}")


def _marker(spark: SparkSession, place: str) -> Row | None:
    return next(iter(_markers(spark, place, 1)), None)


def _markers(spark: SparkSession, place: str, n: int) -> list[Row]:
    """The newest `n` markers, newest first."""
    try:
        return spark.read.schema(_MARKER).json(f"{place}/markers").orderBy(F.desc("number")).limit(n).collect()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
