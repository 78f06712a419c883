"""One query per operator over the clinical tables of the test bed.

Lists are turned into sorted text and doubles rounded, so that results can be
compared by value with another engine's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartfold.functions.fields import first, first_coding, ref_id
from chartfold.operators import sketches
from chartfold.operators.heavy import PAGE_ROWS
from chartfold.operators.joins import lookup
from chartfold.operators.profile import load_summary as summarise
from chartfold.operators.profile import null_profile as profile_nulls
from chartfold.operators.profile import raw_quality as profile_tables
from chartfold.operators.regression import fit_lines, line_points, predict_rows
from chartfold.operators.regression import scatter_counts as count_points
from chartfold.operators.rollup import rollup, whole_lists
from chartfold.plans import analysis, clustered, master
from chartfold.plans.clustered import cluster
from chartfold.plans.records import KEY, condition_rows, encounter_rows, patient_flat
from chartfold.plans.testbed import (
    AS_OF,
    DISEASE,
    FILE_NAMES,
    clinical_tables,
    export_events,
    read,
    write_archives,
    write_ndjson,
)
from chartfold.shared import new_shared_path, settled
from chartfold.sinks.jsonl import land, read_master, write_json_lines, write_master
from chartfold.sinks.landing import land_sources, landed_summary
from chartfold.sources.archives import list_archives, scan_archives
from chartfold.sources.content import resource_sources
from chartfold.sources.export_log import flatten_log, scan_export_log
from chartfold.sources.ndjson import load_resources, merge_resources, scan_resource
from chartfold.sources.untyped import resource_types

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DISEASES = ["PROMO", "STANDARD", "ECONOMY", "NOT A DISEASE"]
AGES = [0, 18, 30, 50, 65, 100]


def _query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _text(items: str, fields) -> Column:
    joined = F.transform(
        items, lambda i: F.concat_ws("|", *[F.coalesce(i[f], F.lit("")) for f in fields])
    )
    return F.array_join(F.array_sort(joined), ";")


def _r6(*columns: str) -> list[Column]:
    return [F.round(c, 6).alias(c) for c in columns]


def _number(*columns: str) -> list[Column]:
    """Whole numbers that may be NULL, as doubles: frames on the comparing
    side hold NULL integers in different ways."""
    return [F.col(c).cast("double").alias(c) for c in columns]


# --- projections -------------------------------------------------------------


@_query
def patient_base(spark, sf_dir):
    return patient_flat(clinical_tables(spark, sf_dir, ["patient"])["patient"])


@_query
def ref_ids(spark, sf_dir):
    t = clinical_tables(spark, sf_dir)

    def ids(name: str, encounter: Column) -> DataFrame:
        return t[name].select("id", ref_id("subject.reference").alias(KEY), encounter.alias("encounter_id"))

    none = F.lit(None).cast("string")
    return (
        ids("condition", none)
        .unionByName(ids("medicationrequest", ref_id("encounter.reference")))
        .unionByName(ids("encounter", F.col("id")))
    )


@_query
def encounter_flat(spark, sf_dir):
    t = clinical_tables(spark, sf_dir, ["encounter"])
    return encounter_rows(t["encounter"]).drop("encounter_status", KEY)


@_query
def coding_paths(spark, sf_dir):
    """First codings, also of NULL and of empty lists."""
    t = clinical_tables(spark, sf_dir, ["condition"])
    coding = first_coding("code")
    return t["condition"].select(
        "id",
        coding["code"].alias("code"),
        coding["display"].alias("display"),
        F.array_size("code.coding").cast("double").alias("codings"),
    )


# --- rollups -----------------------------------------------------------------

# A page size at which many patients of the test tables have several pages.
SMALL_PAGE = 5
CLUSTER_BUCKETS = 8


@_query
def rows_used(spark, sf_dir):
    """The test bed drops no row: line items are conditions or medications."""
    t = clinical_tables(spark, sf_dir)
    counts = [
        t[name].agg(F.count("*").alias("n")).select(F.lit(table).alias("table"), "n")
        for name, table in (("condition", "lineitem"), ("medicationrequest", "lineitem"), ("encounter", "orders"))
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).groupBy("table").agg(F.sum("n").alias("n"))


@_query
def conditions_per_patient(spark, sf_dir):
    t = clinical_tables(spark, sf_dir, ["condition"])
    pages = master.clinical_rollup("conditions", t)
    return pages.select(
        KEY, "page", _text("conditions", master.CONDITION_FIELDS).alias("conditions"), "condition_count"
    )


@_query
def conditions_paged(spark, sf_dir):
    """The same with small pages, item by item."""
    pages = master.clinical_rollup("conditions", clinical_tables(spark, sf_dir, ["condition"]), SMALL_PAGE)
    return pages.select(KEY, F.inline("conditions"), "condition_count", "row_count")


@_query
def conditions_row_count(spark, sf_dir):
    t = clinical_tables(spark, sf_dir, ["condition"])
    pages = master.clinical_rollup("conditions", t)
    return pages.select(
        KEY, "page", F.col("row_count").alias("condition_row_count"), F.array_size("conditions").alias("listed")
    )


@_query
def medications_per_patient(spark, sf_dir):
    t = clinical_tables(spark, sf_dir, ["medicationrequest"])
    pages = master.clinical_rollup("medications", t)
    return pages.select(
        KEY, "page", _text("medications", master.MEDICATION_FIELDS).alias("medications"), "medication_count"
    )


@_query
def medications_paged(spark, sf_dir):
    """The same with small pages, item by item."""
    pages = master.clinical_rollup("medications", clinical_tables(spark, sf_dir, ["medicationrequest"]), SMALL_PAGE)
    return pages.select(KEY, F.inline("medications"), "medication_count")


@_query
def encounters_per_patient(spark, sf_dir):
    t = clinical_tables(spark, sf_dir, ["encounter"])
    pages = master.clinical_rollup("encounters", t)
    return pages.select(
        KEY, "page", _text("encounters", master.ENCOUNTER_FIELDS).alias("encounters"), "encounter_count"
    )


@_query
def sample_row(spark, sf_dir):
    """All items of the first patient, in pages."""
    t = clinical_tables(spark, sf_dir, ["condition"])
    return master.sample_rollup("conditions", t, 1, SMALL_PAGE).select(
        KEY, F.inline("conditions"), "condition_count"
    )


# --- master table ------------------------------------------------------------


def _base_text(rows: DataFrame) -> DataFrame:
    """The structs of the patient, item by item."""
    name, address = first(F.col("name")), first(F.col("address"))
    marital = first_coding("maritalStatus")
    return rows.withColumns(
        {
            "name_text": F.concat_ws(
                "|", name["use"], name["text"], name["family"], F.array_join(name["given"], "+"),
                F.array_join(name["prefix"], "+"), F.array_join(name["suffix"], "+"), name["period"]["start"],
            ),
            "address_text": F.concat_ws(
                "|", address["use"], F.array_join(address["line"], "+"), address["city"], address["state"],
                address["postalCode"], address["country"], address["period"]["start"],
            ),
            "marital_text": F.when(
                marital.isNotNull(),
                F.concat_ws("|", marital["system"], marital["code"], marital["display"], marital["userSelected"].cast("string")),
            ),
        }
    )


def _master_columns(rows: DataFrame) -> DataFrame:
    return _base_text(rows).select(
        KEY,
        "page",
        "birthDate",
        "gender",
        "name_text",
        "address_text",
        "marital_text",
        _text("conditions", master.CONDITION_FIELDS).alias("conditions"),
        F.array_size("medications").cast("double").alias("medications_listed"),
        F.array_size("encounters").cast("double").alias("encounters_listed"),
        *_number("condition_count", "medication_count", "encounter_count"),
        "list_pages",
    )


def _items(rows: DataFrame) -> DataFrame:
    """A row per patient, list and item, whatever page it is on."""
    lists = {"conditions": ("condition_code", "condition_name"), "medications": ("medication_id", "medication_code"),
             "encounters": ("encounter_id", "encounter_status")}
    empty = F.array().cast("array<struct<list:string,a:string,b:string>>")

    def named(kind: str, a: str, b: str) -> Column:
        item = lambda i: F.struct(F.lit(kind).alias("list"), i[a].alias("a"), i[b].alias("b"))
        return F.coalesce(F.transform(kind, item), empty)

    every = F.concat(*(named(kind, *fields) for kind, fields in lists.items()))
    return rows.select(KEY, *_number("condition_count", "medication_count", "encounter_count"), F.inline(every))


def _count_columns(rows: DataFrame) -> DataFrame:
    counts = _number("condition_count", "medication_count", "encounter_count")
    return rows.select(KEY, "birthDate", "gender", *counts)


@_query
def patient_master(spark, sf_dir):
    return _master_columns(master.patient_master(clinical_tables(spark, sf_dir, stored=True)))


@_query
def patient_master_paged(spark, sf_dir):
    """The master table with small pages, item by item."""
    return _items(master.patient_master(clinical_tables(spark, sf_dir, stored=True), SMALL_PAGE))


@_query
def patient_master_whole(spark, sf_dir):
    """One row per patient, which whole lists allow."""
    whole = whole_lists(master.patient_master(clinical_tables(spark, sf_dir, stored=True)))
    return whole.select(KEY, F.size(F.coalesce("medications", F.array())).alias("listed"))


@_query
def patient_master_broadcast(spark, sf_dir):
    """The same with a size-checked broadcast of each aggregate."""
    t = clinical_tables(spark, sf_dir, stored=True)
    return _master_columns(master.patient_master(t, broadcast_bytes=10 * 1024 * 1024))


@_query
def patient_counts(spark, sf_dir):
    return _count_columns(master.patient_counts(clinical_tables(spark, sf_dir)))


@_query
def master_invariants(spark, sf_dir):
    """The check of a master table that was written, with small pages."""
    t = clinical_tables(spark, sf_dir, stored=True)
    tally = master.patient_tally(t)
    path = new_shared_path(spark, "master")
    write_master(master.patient_master(t, SMALL_PAGE, tally=tally), path)
    return master.master_invariants(t["patient"], read_master(spark, path), tally)


@_query
def join_fanout(spark, sf_dir):
    per_patient = master.join_fanout(clinical_tables(spark, sf_dir))
    return per_patient.select(
        KEY, "condition_rows", "medicationrequest_rows", "encounter_rows", F.col("naive_rows").cast("string")
    )


@_query
def join_fanout_total(spark, sf_dir):
    per_patient = master.join_fanout(clinical_tables(spark, sf_dir))
    return per_patient.agg(F.sum("naive_rows").cast("string").alias("naive_rows"), F.count("*").alias("patients"))


@_query
def key_lookup(spark, sf_dir):
    """Condition names of every customer, and of suppliers, who have none."""
    rows = condition_rows(clinical_tables(spark, sf_dir, ["condition"])["condition"])
    known = read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias(KEY))
    unknown = read(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias(KEY))
    return lookup(known.unionByName(unknown), rows, KEY, ["condition_name"], "names").select(
        KEY, "page", _text("names", ["condition_name"]).alias("names"), F.array_size("names").alias("listed")
    )


@_query
def distinct_codes_estimated(spark, sf_dir):
    """Condition codes by gender and in all: exact, and whether the estimate from
    one stored sketch per patient is within 5 % of it."""
    t = clinical_tables(spark, sf_dir, ["patient", "condition"])
    rows = condition_rows(t["condition"])
    people = t["patient"].select(F.col("id").alias(KEY), "gender")
    stored = settled(sketches.sketch(rows, [KEY], {"codes": "condition_code"})).join(people, KEY)
    every = stored.withColumn("gender", F.lit(None).cast("string"))
    told = sketches.estimates(stored.unionByName(every), ["gender"], ["codes"]).select("gender", F.col("codes").alias("about"))
    known = rows.join(people, KEY)
    known = known.unionByName(known.withColumn("gender", F.lit(None).cast("string")))
    exact = known.groupBy(F.col("gender").alias("of")).agg(F.countDistinct("condition_code").alias("codes"))
    close = F.abs(F.col("about") - F.col("codes")) <= 0.05 * F.col("codes")
    return told.join(exact, F.col("gender").eqNullSafe(F.col("of"))).select("gender", "codes", close.alias("close"))


# --- quality -----------------------------------------------------------------


@_query
def null_profile(spark, sf_dir):
    t = clinical_tables(spark, sf_dir, ["patient"])["patient"]
    return profile_nulls(patient_flat(t))


@_query
def null_profile_first(spark, sf_dir):
    """Only the first columns, on request."""
    return profile_nulls(read(spark, sf_dir, "lineitem").selectExpr("null a", "l_orderkey b", "null c"), 2)


@_query
def raw_quality(spark, sf_dir):
    return profile_tables(clinical_tables(spark, sf_dir, list(FILE_NAMES)))


@_query
def load_summary(spark, sf_dir):
    return summarise(clinical_tables(spark, sf_dir, list(FILE_NAMES)))


@_query
def master_quality(spark, sf_dir):
    return master.master_quality(master.patient_counts(clinical_tables(spark, sf_dir)))


# --- features ----------------------------------------------------------------


@_query
def patient_age(spark, sf_dir):
    return analysis.patient_age(clinical_tables(spark, sf_dir, ["patient"])["patient"], AS_OF)


@_query
def disease_flag(spark, sf_dir):
    t = clinical_tables(spark, sf_dir, ["patient", "condition"])
    return analysis.disease_flag(t["patient"], t["condition"], DISEASE)


@_query
def disease_flag_from_lists(spark, sf_dir):
    """The same, read off the lists of a master table, page by page."""
    return master.with_flag(master.patient_master(clinical_tables(spark, sf_dir, stored=True), SMALL_PAGE), DISEASE)


@_query
def disease_hits(spark, sf_dir):
    """Which patients have which of all conditions that a part is named after."""
    t = clinical_tables(spark, sf_dir, ["patient", "condition"])
    names = read(spark, sf_dir, "part").select(F.col("p_type").alias("disease")).distinct().where("disease > 'M'")
    return analysis.condition_hits(t["patient"], t["condition"], names)


@_query
def pages_have_no_gaps(spark, sf_dir):
    """Pages of orders' priorities, which are copies of few rows, by customer."""
    rows = read(spark, sf_dir, "orders").selectExpr("cast(o_custkey as string) k", "o_orderpriority item")
    paged = rollup(rows, "k", ["item"], "items", "n", page_rows=SMALL_PAGE)
    return paged.groupBy("k").agg(
        (F.max("page") + 1 == F.max("list_pages")).alias("gapless"),
        (F.count("*") == F.max("list_pages")).alias("complete"),
        F.sum(F.array_size("items")).cast("bigint").alias("listed"),
        F.max("n").alias("n"),
    )


@_query
def disease_flags(spark, sf_dir):
    t = clinical_tables(spark, sf_dir, ["patient", "condition"])
    return analysis.condition_flags(t["patient"], t["condition"], DISEASES)


# --- regressions -------------------------------------------------------------

_FIT = ("slope", "intercept", "r", "r2", "stderr", "t", "p")


_STUDIED = ("patient", "condition", "medicationrequest")


def _fits(spark, sf_dir, measures=tuple(analysis.MEASURES), **options) -> DataFrame:
    t = clinical_tables(spark, sf_dir, _STUDIED)
    return analysis.age_regressions(t, AS_OF, DISEASE, measures=measures, **options)


def _one_fit(spark, sf_dir, measure: str, **options) -> DataFrame:
    return _fits(spark, sf_dir, [measure], **options).select("n", *_r6(*_FIT), "significant")


@_query
def regress_medications(spark, sf_dir):
    return _one_fit(spark, sf_dir, "medication_count")


@_query
def regress_disease(spark, sf_dir):
    return _one_fit(spark, sf_dir, "disease")


@_query
def regress_conditions(spark, sf_dir):
    return _one_fit(spark, sf_dir, "condition_count")


@_query
def regress_conditions_zero(spark, sf_dir):
    """Patients without conditions count as 0 instead of being left out."""
    return _one_fit(spark, sf_dir, "condition_count", fill_zero=True)


@_query
def regression_summary(spark, sf_dir):
    return _fits(spark, sf_dir).select("measure", *_r6("r2", "p"), "significant")


@_query
def regression_by_group(spark, sf_dir):
    return _fits(spark, sf_dir, by=["gender"]).select("gender", "measure", "n", *_r6("slope", "r2", "p"))


@_query
def predict_at_ages(spark, sf_dir):
    columns = ("medications", "disease_probability", "conditions", "disease_percent")
    return analysis.predictions_by_age(_fits(spark, sf_dir), AGES).select("age", *_r6(*columns))


@_query
def predict_patients(spark, sf_dir):
    """Predicted disease probability of every patient."""
    frame = analysis.age_frame(clinical_tables(spark, sf_dir, _STUDIED), AS_OF, DISEASE, ["disease"])
    fits = fit_lines(frame, "age", {"disease": "disease"})
    rows = predict_rows(frame.select(KEY, "age"), "age", fits, ["disease"], ["disease"])
    return rows.select(KEY, "age", "measure", *_r6("predicted"))


@_query
def regression_line(spark, sf_dir):
    return line_points(_fits(spark, sf_dir)).select("measure", "i", *_r6("x", "y"))


@_query
def scatter_counts(spark, sf_dir):
    frame = analysis.age_frame(clinical_tables(spark, sf_dir, _STUDIED), AS_OF, DISEASE)
    return count_points(frame, "age", analysis.MEASURES)


# --- files -------------------------------------------------------------------


@_query
def jsonl_roundtrip(spark, sf_dir):
    path = new_shared_path(spark, "master")
    write_master(master.patient_master(clinical_tables(spark, sf_dir, stored=True)), path)
    return _master_columns(read_master(spark, path))


@_query
def jsonl_paged(spark, sf_dir):
    """A master file with small pages, item by item."""
    path = new_shared_path(spark, "master")
    write_master(master.patient_master(clinical_tables(spark, sf_dir, stored=True), SMALL_PAGE), path)
    return _items(read_master(spark, path))


@_query
def regression_from_jsonl(spark, sf_dir):
    """The regressions from a master table that was written and read back."""
    path = new_shared_path(spark, "master")
    write_master(master.patient_master(clinical_tables(spark, sf_dir, stored=True)), path)
    fits = analysis.fit_ages(analysis.master_age_frame(read_master(spark, path), AS_OF, DISEASE))
    return fits.select("measure", *_r6("r2", "p"), "significant")


@_query
def ndjson_scan(spark, sf_dir):
    """Write the resources as NDJSON and load them by name."""
    path = write_ndjson(clinical_tables(spark, sf_dir, list(FILE_NAMES)), gzipped=True)
    chosen = load_resources(spark, path, ["Observation ", "Absent"], views=False)
    tables = merge_resources(chosen, load_resources(spark, path, views=False))
    return summarise(tables)


@_query
def ndjson_master(spark, sf_dir):
    """Counts per patient straight from NDJSON, through a landed copy."""
    path = write_ndjson(clinical_tables(spark, sf_dir), gzipped=True)
    tables = land(load_resources(spark, path, views=False), new_shared_path(spark, "landed"))
    return _count_columns(master.patient_counts(tables))


def _halves(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    first = F.pmod(F.xxhash64("id"), F.lit(2)) == 0
    return df.where(first), df.where(~first)


def _landed_again(spark, sf_dir) -> tuple[str, dict[str, DataFrame]]:
    """Conditions that came as files in two goes, landed after each."""
    early, late = _halves(clinical_tables(spark, sf_dir, ["condition"])["condition"])
    path, out = write_ndjson({"condition": early}), new_shared_path(spark, "landed")
    land_sources(resource_sources(spark, path, ["Condition"]), out)
    write_json_lines(late, f"{path}/Condition.001.ndjson", compression="none")
    return out, land_sources(resource_sources(spark, path, ["Condition"]), out)


def _coded(table: DataFrame) -> DataFrame:
    coding = first_coding("code")
    return table.select(
        "id", ref_id("subject.reference").alias(KEY), coding["code"].alias("code"), coding["display"].alias("display")
    )


@_query
def landed_again(spark, sf_dir):
    """A table of which the second landing read the new files only."""
    return _coded(_landed_again(spark, sf_dir)[1]["condition"])


@_query
def landed_again_summary(spark, sf_dir):
    """Its summary, from the manifest."""
    out, tables = _landed_again(spark, sf_dir)
    return landed_summary(spark, out, tables)


@_query
def landed_archives(spark, sf_dir):
    """A table landed from archives; the second landing opens no entry."""
    path = write_archives(clinical_tables(spark, sf_dir, ["condition"])["condition"], "Condition")
    out = new_shared_path(spark, "landed")
    for _ in range(2):
        tables = land_sources(resource_sources(spark, path, ["Condition"], archives=True), out)
    return _coded(tables["condition"])


def _mixed_conditions(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Conditions as pinned, and those without codings in another shape."""
    table = clinical_tables(spark, sf_dir, ["condition"])["condition"]
    bare = F.col("code.coding").isNull()
    odd = table.where(bare).select("id", "subject", F.lit("none").alias("code"), F.lit(1).alias("weight"))
    return table.where(~bare), odd


@_query
def types_by_path(spark, sf_dir):
    """Types and pinned types of a folder whose files differ in shape."""
    plain, odd = _mixed_conditions(spark, sf_dir)
    path = write_ndjson({"condition": plain})
    write_json_lines(odd, f"{path}/Condition.001.ndjson", compression="none")
    return resource_types(spark, path, "Condition")


@_query
def types_by_path_archives(spark, sf_dir):
    """The same of archives that no pinned schema fits."""
    return resource_types(spark, write_archives(_mixed_conditions(spark, sf_dir)[1], "Condition"), "Condition", archives=True)


def _clustered(spark, sf_dir, page_rows: int = PAGE_ROWS):
    tables = clinical_tables(spark, sf_dir, stored=True)
    return cluster(tables, new_shared_path(spark, "clustered"), CLUSTER_BUCKETS, page_rows)


@_query
def clustered_master(spark, sf_dir):
    """The master table from tables clustered by patient."""
    return _master_columns(clustered.clustered_master(_clustered(spark, sf_dir)))


@_query
def clustered_master_paged(spark, sf_dir):
    """The same with small pages, so that many patients are stored apart."""
    return _items(clustered.clustered_master(_clustered(spark, sf_dir, SMALL_PAGE)))


@_query
def clustered_counts(spark, sf_dir):
    return _count_columns(clustered.clustered_counts(_clustered(spark, sf_dir, SMALL_PAGE)))


@_query
def clustered_medications(spark, sf_dir):
    pages = clustered.clustered_rollup(_clustered(spark, sf_dir), "medications")
    return pages.select(
        KEY, "page", _text("medications", master.MEDICATION_FIELDS).alias("medications"), "medication_count"
    )


@_query
def clustered_lookup(spark, sf_dir):
    """Conditions of every customer, and of suppliers, who have none."""
    known = read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias(KEY))
    unknown = read(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias(KEY))
    found = clustered.clustered_lookup(_clustered(spark, sf_dir), known.unionByName(unknown), "conditions", 100)
    return found.select(KEY, "page", _text("conditions", master.CONDITION_FIELDS).alias("conditions"))


def _with_more(spark, sf_dir) -> DataFrame:
    """Patients with fields that no pinned schema knows."""
    key = F.col("id").cast("int")
    more = {f"extra_{i}": F.when(key % (i + 2) == 0, F.concat(F.lit("v"), F.col("id"))) for i in range(8)}
    return clinical_tables(spark, sf_dir, ["patient"])["patient"].withColumns(more)


@_query
def ndjson_widened(spark, sf_dir):
    """The null profile of all fields that NDJSON files have."""
    path = write_ndjson({"patient": _with_more(spark, sf_dir)})
    return profile_tables(load_resources(spark, path, ["Patient"], views=False, widen=True))


@_query
def ndjson_widened_summary(spark, sf_dir):
    path = write_ndjson({"patient": _with_more(spark, sf_dir)})
    return summarise(load_resources(spark, path, ["Patient"], views=False, widen=True))


@_query
def resource_views(spark, sf_dir):
    """SQL over the views that loading registers."""
    path = write_ndjson(clinical_tables(spark, sf_dir, ["encounter"]))
    load_resources(spark, path, ["Encounter"])
    return spark.sql("select status, count(*) n, min(period.start) first_start from encounter group by status")


@_query
def ndjson_inferred(spark, sf_dir):
    path = write_ndjson(clinical_tables(spark, sf_dir, ["observation"]))
    found = scan_resource(spark, path, "Observation", infer=True)
    return found.select(
        "id", ref_id("subject.reference").alias(KEY), first_coding("code")["code"].alias("code"),
        F.round("valueQuantity.value", 6).alias("value"),
    )


@_query
def export_log(spark, sf_dir):
    path = write_ndjson({"log": export_events(spark, sf_dir)})
    return flatten_log(scan_export_log(spark, path)).select(
        "exportId",
        "eventId",
        F.unix_seconds("at").alias("at_seconds"),
        "exportUrl",
        "attachments",
        *_number("totalOutputFileCount", "files", "duration"),
    )


@_query
def archive_inventory(spark, sf_dir):
    """Name and size of the entry of each nation's archived customers."""
    customers = read(spark, sf_dir, "customer")
    found = None
    nations = read(spark, sf_dir, "nation").select("n_nationkey").orderBy("n_nationkey")
    for (nation,) in nations.collect():
        own = customers.where(F.col("c_nationkey") == nation).selectExpr("cast(c_custkey as string) id", "c_name name")
        listed = list_archives(spark, write_archives(own.coalesce(1), f"Nation{nation}"))
        found = listed if found is None else found.unionByName(listed)
    return found.select("entry", "bytes", "stored")


def _ingested(spark, sf_dir, split_bytes: int, stored: bool) -> DataFrame:
    condition = clinical_tables(spark, sf_dir, ["condition"])["condition"]
    path = write_archives(condition, "Condition", stored)
    table = scan_archives(spark, path, "Condition", split_bytes=split_bytes)
    coding = first_coding("code")
    return table.select(
        "id", ref_id("subject.reference").alias(KEY), coding["code"].alias("code"), coding["display"].alias("display")
    )


@_query
def archive_ingest(spark, sf_dir):
    return _ingested(spark, sf_dir, 128 * 1024 * 1024, False)


@_query
def archive_ingest_ranges(spark, sf_dir):
    """Stored entries, read by many byte ranges."""
    return _ingested(spark, sf_dir, 64 * 1024, True)


@_query
def archive_ingest_streams(spark, sf_dir):
    """Compressed entries above the split size, whose lines are dealt out."""
    return _ingested(spark, sf_dir, 1024, False)
