"""Records of any shape, from folders and archives alike: nothing is pinned."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartfold.operators.types import path_types, variants
from chartfold.schemas import RESOURCES
from chartfold.sources.archives import archive_lines
from chartfold.sources.ndjson import files_of


def resource_lines(spark: SparkSession, path: str, resource: str, archives: bool = False) -> DataFrame | None:
    """(line): the text of a resource's files, or of its entries in archives;
    None if a folder has no file of it."""
    if archives:
        return archive_lines(spark, path, resource).select("line")
    try:
        return spark.read.text(files_of(path, resource)).select(F.col("value").alias("line"))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def scan_variants(spark: SparkSession, path: str, resource: str, archives: bool = False) -> DataFrame | None:
    """(record, line): every record as a VARIANT, whatever fields it has."""
    lines = resource_lines(spark, path, resource, archives)
    return None if lines is None else variants(lines, "line")


def resource_types(
    spark: SparkSession, path: str, resource: str, schema: str | None = None, archives: bool = False
) -> DataFrame | None:
    """`path_types` of a resource, compared with `schema` or its pinned one: what
    reading it with that schema would lose."""
    lines = resource_lines(spark, path, resource, archives)
    return None if lines is None else path_types(lines, "line", schema or RESOURCES.get(resource.strip().lower()))
