"""Clinical tables derived from the star-schema test tables.

The test data has no clinical records, so customers stand in for patients,
orders for encounters, shipped line items for medication requests, returned
ones for conditions and events for observations. Every row of these tables is
used. Conditions of known patients grow with age by construction, medications
do not; some references and codes are left out, and some references point to
patients that are not in the table.
"""

from __future__ import annotations

import math
import os
import zipfile
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chartfold.schemas import RESOURCES
from chartfold.shared import new_shared_path, send_by_value, settled
from chartfold.sinks.jsonl import write_json_lines

send_by_value(__name__)

AS_OF = "2023-02-28"
# Stands in for the studied disease.
DISEASE = "PROMO"


# The columns of the test tables that are read here.
_COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "supplier": "s_suppkey bigint",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, "
        "o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    # A stated schema saves the job that reads the file footers.
    return spark.read.schema(_COLUMNS[table]).parquet(f"{sf_dir}/{table}.parquet")


_NONE = "cast(null as string)"
_PERIOD = f"named_struct('start', '2001-01-01', 'end', {_NONE})"
_NAME = (
    "named_struct('use', 'official', 'text', concat('Dr. ', c_name), 'family', c_name, "
    "'given', array(concat('G', c_custkey % 10)), 'prefix', array('Dr.'), 'suffix', cast(array() as array<string>), "
    f"'period', {_PERIOD})"
)
_ADDRESS = (
    f"named_struct('use', 'home', 'type', {_NONE}, 'text', {_NONE}, 'line', array(concat(c_custkey % 97, ' Main St')), "
    "'city', n_name, 'district', cast(null as string), 'state', concat('S', n_nationkey), "
    f"'postalCode', lpad(cast(c_custkey % 100000 as string), 5, '0'), 'country', r_name, 'period', {_PERIOD})"
)
_MARITAL = (
    f"named_struct('coding', array(named_struct('system', 'urn:marital', 'version', {_NONE}, 'code', "
    "case c_custkey % 3 when 0 then 'M' when 1 then 'S' else 'D' end, 'display', "
    "case c_custkey % 3 when 0 then 'Married' when 1 then 'Single' else 'Divorced' end, "
    f"'userSelected', c_custkey % 2 = 0)), 'text', {_NONE})"
)


def _patient(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = StructType.fromDDL(RESOURCES["patient"])
    places = read(spark, sf_dir, "nation").join(
        read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    joined = read(spark, sf_dir, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.selectExpr(
        "cast(c_custkey as string) id",
        "date_format(date_add(date'1930-01-01', cast((c_custkey * 7919) % 29220 as int)), 'yyyy-MM-dd') birthDate",
        "case when c_custkey % 2 = 0 then 'female' else 'male' end gender",
        f"cast(array({_NAME}) as {fields['name'].dataType.simpleString()}) name",
        f"cast(array({_ADDRESS}) as {fields['address'].dataType.simpleString()}) address",
        f"cast(case when c_custkey % 10 = 0 then null else {_MARITAL} end as "
        f"{fields['maritalStatus'].dataType.simpleString()}) maritalStatus",
    )


# Returned line items are conditions, all others medication requests.
_RETURNED = "coalesce(l_returnflag = 'R', false)"
# Line items that one task joins with their orders, and then with their parts,
# about: what a task sorts stays the same however many line items there are.
LINES_PER_TASK = 500_000
# Up to so many parts may be sent to every task, so line items stay where they are.
SENT_PARTS = 1_000_000


def _items(spark: SparkSession, sf_dir: str, kept: str, columns: Sequence[str], stored: bool) -> DataFrame:
    """The `columns` of the line items that are `kept`, with their orders and
    parts; `stored`, they are joined once and read as often as they are asked for."""
    lines = read(spark, sf_dir, "lineitem")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    tasks = math.ceil(lines.count() / LINES_PER_TASK)
    lines = lines.where(kept)
    many = tasks > 2 * spark.sparkContext.defaultParallelism
    if many:
        lines, orders = lines.repartition(tasks, "l_orderkey"), orders.repartition(tasks, "o_orderkey")
    lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if many and parts.count() > SENT_PARTS:
        lines, parts = lines.repartition(tasks, "l_partkey"), parts.repartition(tasks, "p_partkey")
    items = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(*columns)
    return settled(items) if stored else items


def _condition(spark: SparkSession, sf_dir: str, stored: bool) -> DataFrame:
    # A part's size is the age from which a patient has it; for younger ones the
    # reference points nowhere.
    old_enough = "p_size * 8 <= 80 - cast((o_custkey * 7919) % 29220 as int) / 365.25D"
    coding = "array(named_struct('code', p_brand, 'display', p_type))"
    columns = ("l_orderkey", "l_linenumber", "l_partkey", "o_custkey", "p_partkey", "p_brand", "p_type", "p_size")
    return _items(spark, sf_dir, _RETURNED, columns, stored).selectExpr(
        "concat('c', l_orderkey, '-', l_linenumber) id",
        "case when l_partkey % 53 = 0 then null "
        f"else named_struct('reference', concat('Patient/', case when {old_enough} then '' else 'x' end, o_custkey)) "
        "end subject",
        f"named_struct('coding', case when p_partkey % 89 = 0 then null when p_partkey % 97 = 0 "
        f"then filter({coding}, x -> false) else {coding} end) code",
    )


def _medicationrequest(spark: SparkSession, sf_dir: str, stored: bool) -> DataFrame:
    columns = (
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate", "o_custkey", "p_partkey", "p_name"
    )
    known = "l_linestatus = 'O' and l_shipdate >= timestamp_ntz'2001-01-01'"
    return _items(spark, sf_dir, f"not ({_RETURNED})", columns, stored).selectExpr(
        "concat('m', l_orderkey, '-', l_linenumber) id",
        "l_returnflag status",
        "'order' intent",
        "date_format(l_shipdate, 'yyyy-MM-dd') authoredOn",
        "named_struct('coding', array(named_struct('code', cast(p_partkey as string), 'display', p_name))) "
        "medicationCodeableConcept",
        f"named_struct('reference', concat('Patient/', case when {known} then '' else 'x' end, o_custkey)) subject",
        "named_struct('reference', concat('Encounter/e', l_orderkey)) encounter",
    )


def _encounter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").selectExpr(
        "concat('e', o_orderkey) id",
        "o_orderstatus status",
        "named_struct('code', o_orderpriority) class",
        "array(named_struct('coding', array(named_struct('code', left(o_orderpriority, 1), "
        "'display', substring(o_orderpriority, 3))))) type",
        "named_struct('start', date_format(o_orderdate, 'yyyy-MM-dd'), 'end', case when o_orderstatus = 'P' "
        "then null else date_format(date_add(cast(o_orderdate as date), 1), 'yyyy-MM-dd') end) period",
        "named_struct('reference', concat('Patient/', case when o_custkey % 7 = 0 then 'x' else '' end, o_custkey)) subject",
        "named_struct('reference', concat('Organization/o', o_custkey % 25)) serviceProvider",
    )


def _observation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").selectExpr(
        "concat('ob', event_id) id",
        "named_struct('reference', concat('Patient/', user_id)) subject",
        "named_struct('coding', array(named_struct('code', event_type, 'display', event_type))) code",
        "named_struct('value', value) valueQuantity",
        "cast(ts as string) effectiveDateTime",
    )


_BUILDERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "patient": _patient,
    "encounter": _encounter,
    "observation": _observation,
}
# Those that take joins of the test tables, which may be stored.
_JOINED: dict[str, Callable[[SparkSession, str, bool], DataFrame]] = {
    "condition": _condition,
    "medicationrequest": _medicationrequest,
}
# Resource names as files carry them.
FILE_NAMES = {
    "patient": "Patient",
    "condition": "Condition",
    "encounter": "Encounter",
    "observation": "Observation",
    "medicationrequest": "MedicationRequest",
}
CLINICAL = ("patient", "condition", "medicationrequest", "encounter")


def clinical_tables(
    spark: SparkSession, sf_dir: str, names: Sequence[str] = CLINICAL, stored: bool = False
) -> dict[str, DataFrame]:
    """The named tables; with `stored`, for plans that read them several times,
    what they join of the test tables is joined once."""
    return {
        name: _JOINED[name](spark, sf_dir, stored) if name in _JOINED else _BUILDERS[name](spark, sf_dir)
        for name in names
    }


def export_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export log with one line per test event; the event kinds vary, and
    so do the fields of their details."""
    return read(spark, sf_dir, "events").selectExpr(
        "concat('export-', user_id) exportId",
        "concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\"), '-04:00') timestamp",
        "case event_id % 3 when 0 then 'kickoff' when 1 then 'manifest_complete' else 'export_complete' end eventId",
        "named_struct("
        "'exportUrl', case when event_id % 3 = 0 then concat('https://example.com/', event_type) end, "
        "'totalOutputFileCount', case when event_id % 3 = 1 then event_id end, "
        "'files', case when event_id % 3 = 2 then user_id end, "
        "'duration', case when event_id % 3 = 2 then event_id % 1000 end) eventDetail",
    )


# Rows of a gzipped file, which only one reader can follow.
GZIPPED_ROWS = 500_000


def write_ndjson(tables: dict[str, DataFrame], gzipped: bool = False) -> str:
    """Write tables as `Name.<part>.ndjson` folders in the shared folder; `gzipped`,
    for all of an export, whose text takes many times the room of its tables."""
    spark = next(iter(tables.values())).sparkSession
    path = new_shared_path(spark, "ndjson")
    form = {"compression": "gzip", "file_rows": GZIPPED_ROWS} if gzipped else {"compression": "none"}
    for name, df in tables.items():
        write_json_lines(df, f"{path}/{FILE_NAMES.get(name, name)}.000.ndjson", **form)
    return path


def write_archives(df: DataFrame, entry_name: str, stored: bool = False) -> str:
    """Write a table as ZIP archives in the shared folder, one per partition."""
    path = new_shared_path(df.sparkSession, "archives")
    method = zipfile.ZIP_STORED if stored else zipfile.ZIP_DEFLATED

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get()
        part = f"{task.partitionId():05d}"
        target = f"{path}/part-{part}.zip"
        with _replacing(target, task.taskAttemptId()) as f, zipfile.ZipFile(f, "w", method) as z:
            lines = 0
            with z.open(f"export/{entry_name}.{part}.ndjson", "w", force_zip64=True) as entry:
                for batch in batches:
                    for line in batch["line"]:
                        entry.write(line.encode() + b"\n")
                    lines += len(batch)
        yield pd.DataFrame({"archive": [target], "lines": [lines]})

    lines = df.select(F.to_json(F.struct("*")).alias("line"))
    lines.mapInPandas(pack, "archive string, lines bigint").agg(F.sum("lines")).collect()
    return path


class _replacing:
    """Write a file under another name and move it into place at the end, so
    that a lost or repeated task never leaves a partial archive."""

    def __init__(self, target: str, attempt: int):
        from pyarrow import fs

        if "://" in target:
            self.system, self.target = fs.FileSystem.from_uri(target)
        else:
            self.system, self.target = fs.LocalFileSystem(), target.removeprefix("file:")
        self.partial = f"{self.target}.{attempt}.partial"

    def __enter__(self):
        self.system.create_dir(os.path.dirname(self.target), recursive=True)
        self.stream = self.system.open_output_stream(self.partial)
        return self.stream

    def __exit__(self, failed, *_):
        self.stream.close()
        if failed is None:
            self.system.move(self.partial, self.target)
