"""Resource tables from NDJSON files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

from chartfold.schemas import CORRUPT, DEFAULT_RESOURCES, RESOURCES


def scan_resource(
    spark: SparkSession,
    path: str,
    resource: str,
    schema: str | None = None,
    prefix: bool = False,
    infer: bool = False,
    sampling_ratio: float = 1.0,
    widen: bool = False,
) -> DataFrame | None:
    """All NDJSON files of one resource in a folder as one table.

    Reads `Name.ndjson` and `Name<.-_><part>.ndjson`; with `prefix` every file
    whose name starts with `Name`. Returns None if there is no file. The
    schema is `schema`, or the pinned one of the resource; it is inferred if
    there is neither, or with `infer`. With `widen` it is the pinned one and
    all fields besides that the data is inferred to have. Lines that are no
    JSON object keep a row, with the text in `_corrupt_record` (not with
    `infer`).
    """
    return read_files(spark, files_of(path, resource, prefix), resource, schema, infer, sampling_ratio, widen)


def files_of(path: str, resource: str, prefix: bool = False) -> str:
    """The glob of the files of a resource."""
    name = resource.strip()
    pattern = f"{name}*.ndjson" if prefix else f"{name}{{.ndjson,[._-]*.ndjson}}"
    return f"{path.rstrip('/')}/{pattern}"


def read_files(
    spark: SparkSession,
    files: str | Sequence[str],
    resource: str,
    schema: str | None = None,
    infer: bool = False,
    sampling_ratio: float = 1.0,
    widen: bool = False,
) -> DataFrame | None:
    """`scan_resource` of the files named, by a glob or one by one."""
    files = files if isinstance(files, str) else list(files)
    pinned = schema or RESOURCES.get(resource.strip().lower())
    reader = spark.read
    if pinned and not infer:
        reader = reader.schema(f"{pinned}, {CORRUPT} string")
    else:
        reader = reader.option("samplingRatio", sampling_ratio)
    try:
        if widen and pinned and not infer:
            seen = spark.read.option("samplingRatio", sampling_ratio).json(files).schema
            wide = merged(StructType.fromDDL(pinned), StructType([f for f in seen if f.name != CORRUPT]))
            reader = spark.read.schema(StructType([*wide, StructField(CORRUPT, StringType())]))
        return reader.json(files)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def merged(pinned: DataType, seen: DataType) -> DataType:
    """`pinned` and, at the end of each struct, the fields that only `seen` has."""
    if isinstance(pinned, StructType) and isinstance(seen, StructType):
        also = {f.name: f for f in seen}
        fields = [
            StructField(f.name, merged(f.dataType, also[f.name].dataType) if f.name in also else f.dataType)
            for f in pinned
        ]
        return StructType(fields + [f for f in seen if f.name not in pinned.names])
    if isinstance(pinned, ArrayType) and isinstance(seen, ArrayType):
        return ArrayType(merged(pinned.elementType, seen.elementType))
    return pinned


def load_resources(
    spark: SparkSession, path: str, names: Sequence[str] = DEFAULT_RESOURCES, views: bool = True, **options
) -> dict[str, DataFrame]:
    """Tables of the named resources by lower-case name; absent ones are left out.

    Each is also registered as a temporary view under that name.
    """
    loaded = {}
    for name in names:
        df = scan_resource(spark, path, name, **options)
        if df is not None:
            loaded[name.strip().lower()] = df
    if views:
        register_views(loaded)
    return loaded


def merge_resources(chosen: Mapping[str, DataFrame], defaults: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Both sets of tables; a default replaces a chosen table of the same name."""
    return {**chosen, **defaults}


def register_views(tables: Mapping[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name.lower())


@contextmanager
def cached(*frames: DataFrame):
    """Keep tables that several outputs read, in memory and on disk, for a block."""
    for df in frames:
        df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield frames[0] if len(frames) == 1 else frames
    finally:
        for df in frames:
            df.unpersist()
