"""The event log of a bulk export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartfold.sources.ndjson import scan_resource


def scan_export_log(spark: SparkSession, path: str) -> DataFrame | None:
    return scan_resource(spark, path, "log")


def flatten_log(log: DataFrame) -> DataFrame:
    """One flat row per event; details of other event kinds are NULL."""
    return log.select(
        "exportId",
        "eventId",
        F.to_timestamp("timestamp").alias("at"),
        "eventDetail.*",
    )
