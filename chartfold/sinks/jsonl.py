"""JSON Lines out and back, and landing of parsed tables.

Whatever is stored under a name is written to a new folder first; a marker that
names the folder is added last. A write that breaks off leaves what was there.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from chartfold.schemas import MASTER
from chartfold.shared import delete

_MARKER = "number bigint, folder string, source string"


def write_json_lines(
    df: DataFrame, path: str, mode: str = "overwrite", compression: str = "gzip", file_rows: int | None = None
) -> None:
    """One JSON object per row, NULL fields included. Executors write in parallel,
    with `file_rows` at most so many rows to a file."""
    writer = df.write.mode(mode).option("ignoreNullFields", "false")
    if file_rows is not None:
        writer = writer.option("maxRecordsPerFile", file_rows)
    writer.json(path, compression=compression)


def _marker(spark: SparkSession, path: str) -> Row | None:
    """The newest marker under `path`: the folder that holds, and its source."""
    try:
        rows = spark.read.schema(_MARKER).json(f"{path}/markers").orderBy(F.desc("number")).limit(1).collect()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return rows[0] if rows else None


def _replace(df: DataFrame, path: str, form: str, source: str = "") -> str:
    """Write a new version of `path` and then its marker; returns the folder.

    Markers are only added, so the old version holds until the new one is
    complete. The version before is deleted afterwards.
    """
    spark = df.sparkSession
    old = _marker(spark, path)
    folder = f"{path}/version-{uuid.uuid4().hex}"
    if form == "json":
        write_json_lines(df, folder, "error")
    else:
        df.write.mode("error").format(form).save(folder)
    row = [(old.number + 1 if old else 1, folder.rsplit("/", 1)[1], source)]
    spark.createDataFrame(row, _MARKER).coalesce(1).write.mode("append").json(f"{path}/markers")
    if old:
        delete(spark, f"{path}/{old.folder}")
    return folder


def write_master(master: DataFrame, path: str) -> None:
    """The whole master table under `path`: a line per patient and page, gzipped,
    as field names and ids make most of the text."""
    _replace(master, path.rstrip("/"), "json")


def read_master(spark: SparkSession, path: str) -> DataFrame:
    """What `write_master` last completed there."""
    path = path.rstrip("/")
    marker = _marker(spark, path)
    if marker is None:
        raise FileNotFoundError(f"no master table has been written to {path}")
    return spark.read.schema(MASTER).json(f"{path}/{marker.folder}")


def _source(df: DataFrame) -> str:
    """Tells tables of other files or another schema apart."""
    digest = hashlib.sha256(df.schema.json().encode())
    for name in sorted(df.inputFiles()):
        digest.update(name.encode() + b"\n")
    return digest.hexdigest()


def land(tables: Mapping[str, DataFrame], path: str, again: bool = False) -> dict[str, DataFrame]:
    """Store parsed tables as Parquet and return them read back.

    JSON text has to be parsed whole for any one field; Parquet is read by
    column. A table that was landed here completely, from files of the same
    names and with the same schema, is kept, and its source is not read again,
    unless `again` (for files that changed under their names).
    """
    landed = {}
    for name, df in tables.items():
        target, source = f"{path.rstrip('/')}/{name}", _source(df)
        marker = _marker(df.sparkSession, target)
        if again or marker is None or marker.source != source:
            folder = _replace(df, target, "parquet", source)
        else:
            folder = f"{target}/{marker.folder}"
        landed[name] = df.sparkSession.read.schema(df.schema).parquet(folder)
    return landed
