"""Sources that tell which of their files are new or changed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartfold.schemas import CORRUPT, DEFAULT_RESOURCES, RESOURCES
from chartfold.shared import settled
from chartfold.sinks.landing import SOURCE, Source
from chartfold.sources.archives import archive_lines, entries_of, list_archives
from chartfold.sources.ndjson import files_of, read_files


def _named(name: Column, *stamp: Column) -> Column:
    return F.concat_ws("#", name, *(s.cast("string") for s in stamp))


def ndjson_source(
    spark: SparkSession,
    path: str,
    resource: str,
    schema: str | None = None,
    prefix: bool = False,
    widen: bool = False,
    sampling_ratio: float = 1.0,
) -> Source | None:
    """The NDJSON files of a resource, told apart by size and modification time;
    None if there is none. The options are those of `scan_resource`.

    Only the names of files that must be read reach the driver, which lists
    the folder anyway.
    """
    name, bytes_, modified = (F.col(f"_metadata.file_{c}") for c in ("path", "size", "modification_time"))
    identity = _named(name, bytes_, F.unix_micros(modified))
    try:
        # The content column is not selected, so Spark only lists the files.
        listed = spark.read.format("binaryFile").load(files_of(path, resource, prefix))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    files = listed.select(
        identity.alias("source"), name.alias("name"), bytes_.alias("bytes"), F.unix_micros(modified).cast("string").alias("stamp")
    )

    def scan(wanted: DataFrame) -> DataFrame:
        names = [r["name"] for r in wanted.select("name").collect()]
        rows = read_files(spark, names, resource, schema, False, sampling_ratio, widen)
        return rows.select("*", identity.alias(SOURCE))

    return Source(files, scan, f"{schema or RESOURCES.get(resource.strip().lower())} widen={widen}")


def archive_source(
    spark: SparkSession, path: str, resource: str, schema: str | None = None, entries: DataFrame | None = None
) -> Source:
    """The entries of a resource in ZIP archives, told apart by the checksums in
    the archives' directories, so an archive written anew with the same entries
    is not read again.

    `entries` is a settled listing of the archives, if there is one already.
    """
    if entries is None:
        entries = settled(list_archives(spark, path))
    pinned = schema or RESOURCES[resource.strip().lower()]
    name = F.concat_ws("!", "archive", "entry")
    own = entries_of(entries, resource).withColumn(SOURCE, _named(name, F.col("bytes"), F.col("checksum")))
    files = own.select(F.col(SOURCE).alias("source"), name.alias("name"), "bytes", F.col("checksum").cast("string").alias("stamp"))

    def scan(wanted: DataFrame) -> DataFrame:
        some = settled(own.join(wanted.select(F.col("source").alias(SOURCE)), SOURCE, "left_semi"))
        lines = archive_lines(spark, path, resource, entries=some.select(*entries.columns))
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
        record = F.from_json("line", f"{pinned}, {CORRUPT} string", options)
        # An entry has one checksum; its name leads back to it.
        told = some.select(F.col("archive").alias("of_archive"), F.col("entry").alias("of_entry"), SOURCE)
        same = (F.col("archive") == F.col("of_archive")) & (F.col("entry") == F.col("of_entry"))
        return lines.join(told, same).select(record.alias("record"), SOURCE).select("record.*", SOURCE)

    return Source(files, scan, pinned)


def resource_sources(
    spark: SparkSession, path: str, names: Sequence[str] = DEFAULT_RESOURCES, archives: bool = False, **options
) -> Mapping[str, Source]:
    """Sources of the named resources by lower-case name; a folder's absent ones
    are left out."""
    make = archive_source if archives else ndjson_source
    found = {name.strip().lower(): make(spark, path, name, **options) for name in names}
    return {name: source for name, source in found.items() if source is not None}
