"""NDJSON inside ZIP archives, read in parallel without unpacking to disk.

Only the directory at the end of an archive is read to list it. Reading is
split by entry, and stored (uncompressed) entries also by byte range, so a
large archive is shared by many tasks. A compressed entry is one deflate
stream, which only a single reader can follow; it is streamed in small batches
and never held whole.
"""

from __future__ import annotations

import math
import re
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote, urlparse

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartfold.schemas import CORRUPT, RESOURCES
from chartfold.shared import send_by_value, settled

send_by_value(__name__)

# Largest byte range of a stored entry that one read covers.
SPLIT_BYTES = 128 * 1024 * 1024
# A batch of lines handed to Spark ends after so many bytes or lines.
_BATCH_BYTES = 4 * 1024 * 1024
_BATCH_LINES = 10_000
_BLOCK_BYTES = 1024 * 1024

_ENTRY = "archive string, entry string, bytes bigint, compressed_bytes bigint, stored boolean, checksum bigint"
_LINE = "archive string, entry string, start bigint, line_no bigint, line string"


@contextmanager
def _open(path: str):
    """Open a path that Spark listed, local or on any file system Arrow knows."""
    parsed = urlparse(path)
    if parsed.scheme in ("", "file"):
        with open(unquote(parsed.path), "rb") as f:
            yield f
    else:
        from pyarrow import fs

        # Spark's names of the S3 connector; Arrow knows one.
        if parsed.scheme in ("s3a", "s3n"):
            path = "s3" + path[3:]
        system, inner = fs.FileSystem.from_uri(path)
        with system.open_input_file(inner) as f:
            yield f


def list_archives(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """(archive, entry, bytes, compressed_bytes, stored, checksum) of every archive
    entry, from the directories of the archives; the checksum is the entry's crc32.

    `path` is a ZIP file, a folder of them, or a glob.
    """
    # The content column is not selected, so Spark only lists the files.
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path")
    return files.repartition(_parallel(spark, partitions), "path").mapInPandas(_list_entries, _ENTRY)


def _list_entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["archive", "entry", "bytes", "compressed_bytes", "stored", "checksum"]
    for batch in batches:
        for path in batch["path"]:
            with _open(path) as f, zipfile.ZipFile(f) as z:
                rows = [
                    (path, i.filename, i.file_size, i.compress_size, i.compress_type == zipfile.ZIP_STORED, i.CRC)
                    for i in z.infolist()
                    if not i.is_dir()
                ]
            yield pd.DataFrame(rows, columns=columns)


def archive_lines(
    spark: SparkSession,
    path: str,
    resource: str | None = None,
    partitions: int | None = None,
    split_bytes: int = SPLIT_BYTES,
    entries: DataFrame | None = None,
) -> DataFrame:
    """(archive, entry, start, line_no, line) of the NDJSON entries, or of one
    resource's entries; `line_no` counts from 1 within each `start`.

    `entries` is a settled listing of the archives, if there is one already.
    There are as many tasks as there are `SPLIT_BYTES` to read, or at least as
    many as the session's shuffle partitions.

    The lines of compressed entries above `split_bytes` are dealt out over all
    partitions once they are unpacked, so that the work on them is shared.
    """
    if entries is None:
        entries = settled(list_archives(spark, path, partitions))
    wanted = entries_of(entries, resource)
    read = F.coalesce(F.sum(F.col("compressed_bytes")), F.lit(0))
    size = wanted.agg(read.alias("read")).first()["read"]
    tasks = partitions or max(_parallel(spark, None), math.ceil(size / SPLIT_BYTES))
    long_stream = ~F.col("stored") & (F.col("compressed_bytes") > split_bytes)
    lines = _read(wanted.where(~long_stream), split_bytes, tasks)
    dealt = _read(wanted.where(long_stream), split_bytes, tasks).repartition(
        tasks, "archive", "entry", F.expr(f"line_no div {_BATCH_LINES}")
    )
    return lines.unionByName(dealt)


def entries_of(entries: DataFrame, resource: str | None) -> DataFrame:
    """The NDJSON entries of a listing, or those of one resource."""
    file = F.element_at(F.split("entry", "/"), -1)
    if resource is None:
        return entries.where(file.endswith(".ndjson"))
    return entries.where(file.rlike(f"^{re.escape(resource.strip())}([._-].*)?[.]ndjson$"))


def _read(entries: DataFrame, split_bytes: int, tasks: int) -> DataFrame:
    last_start = F.when(F.col("stored") & (F.col("bytes") > 0), F.col("bytes") - 1).otherwise(F.lit(0))
    step = F.lit(split_bytes).cast("bigint")
    ranges = (
        entries.withColumn("start", F.explode(F.sequence(F.lit(0).cast("bigint"), last_start, step)))
        .withColumn("stop", F.when(F.col("stored"), F.col("start") + step).otherwise(F.col("bytes")))
        .select("archive", "entry", "start", "stop")
    )
    # A stated number of partitions also keeps the runtime planner from
    # merging these few small rows, each of which stands for a long read.
    spread = ranges.repartition(tasks, "archive", "entry", "start")
    return spread.mapInPandas(_read_ranges, _LINE)


def _read_ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for r in batch.itertuples(index=False):
            with _open(r.archive) as f, zipfile.ZipFile(f) as z, z.open(r.entry) as stream:
                numbered, size = [], 0
                for number, line in enumerate(_lines_from(stream, r.start, r.stop), 1):
                    numbered.append((number, line))
                    size += len(line)
                    if size >= _BATCH_BYTES or len(numbered) >= _BATCH_LINES:
                        yield _line_frame(r, numbered)
                        numbered, size = [], 0
                if numbered:
                    yield _line_frame(r, numbered)


def _lines_from(stream, start: int, stop: int) -> Iterator[str]:
    """Non-blank lines that begin in [start, stop), read in blocks."""
    at = start
    rest = b""
    if start > 0:
        # The line that reaches into this range belongs to the one before it.
        stream.seek(start - 1)
        at += len(stream.readline()) - 1
    # `at` is where `rest` begins; lines that begin at `stop` or later are not ours.
    while at < stop:
        block = stream.read(_BLOCK_BYTES)
        ended = not block
        *lines, rest = (rest + block).split(b"\n")
        if ended and rest:
            lines, rest = [*lines, rest], b""
        for raw in lines:
            if at >= stop:
                return
            at += len(raw) + 1
            text = raw.decode("utf-8", "replace").rstrip("\r")
            if text.strip():
                yield text
        if ended:
            return


def _line_frame(r, numbered: list[tuple[int, str]]) -> pd.DataFrame:
    frame = pd.DataFrame(numbered, columns=["line_no", "line"])
    frame.insert(0, "archive", r.archive)
    frame.insert(1, "entry", r.entry)
    frame.insert(2, "start", r.start)
    return frame


def scan_archives(
    spark: SparkSession,
    path: str,
    resource: str,
    schema: str | None = None,
    partitions: int | None = None,
    split_bytes: int = SPLIT_BYTES,
    entries: DataFrame | None = None,
) -> DataFrame:
    """One resource's table straight from the archives."""
    lines = archive_lines(spark, path, resource, partitions, split_bytes, entries)
    ddl = f"{schema or RESOURCES[resource.strip().lower()]}, {CORRUPT} string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return lines.select(F.from_json("line", ddl, options).alias("record")).select("record.*")


def _parallel(spark: SparkSession, partitions: int | None) -> int:
    return partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
