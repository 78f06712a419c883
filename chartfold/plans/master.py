"""The patient master table: one row per patient with lists and counts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartfold.functions.features import has_condition
from chartfold.functions.fields import percent
from chartfold.operators.heavy import PAGE_ROWS, cut_pages, dealt_from, hot_keys, only, pages, without
from chartfold.operators.joins import broadcast_if_small, fanout, left_join_all, smallest_keys, spread_key
from chartfold.operators.rollup import lists, rollup
from chartfold.plans.records import (
    CONDITION_FIELDS,
    ENCOUNTER_FIELDS,
    KEY,
    MEDICATION_FIELDS,
    condition_rows,
    encounter_rows,
    medication_rows,
    patient_base,
)
from chartfold.shared import settled


@dataclass(frozen=True)
class _Kind:
    resource: str
    rows: Callable[[DataFrame, bool], DataFrame]
    fields: Sequence[str]
    count_as: str
    counted: str | None = None  # set: list without duplicates, counted by this field


KINDS = {
    "conditions": _Kind("condition", condition_rows, CONDITION_FIELDS, "condition_count", "condition_code"),
    "medications": _Kind("medicationrequest", medication_rows, MEDICATION_FIELDS, "medication_count"),
    "encounters": _Kind("encounter", encounter_rows, ENCOUNTER_FIELDS, "encounter_count"),
}


def clinical_rows(
    tables: Mapping[str, DataFrame], kinds: Sequence[str] = tuple(KINDS), absolute: bool = False
) -> dict[str, DataFrame]:
    return {k: KINDS[k].rows(tables[KINDS[k].resource], absolute) for k in kinds}


def clinical_rollup(
    kind: str,
    tables: Mapping[str, DataFrame],
    page_rows: int = PAGE_ROWS,
    absolute: bool = False,
    tally: DataFrame | None = None,
) -> DataFrame:
    """Rollup of one kind: `conditions`, `medications` or `encounters`. With the
    tally of the patients, their rows are not counted again."""
    k = KINDS[kind]
    rows = clinical_rows(tables, [kind], absolute)[kind]
    counts = None if tally is None else tally.select(KEY, F.col(f"{kind}_rows").alias("row_count"))
    return rollup(rows, KEY, k.fields, kind, k.count_as, k.counted is not None, k.counted, page_rows, counts)


def patient_tally(
    tables: Mapping[str, DataFrame], kinds: Sequence[str] = tuple(KINDS), absolute: bool = False
) -> DataFrame:
    """Rows per patient of the patient table (`patient_rows`) and of each kind
    (`<kind>_rows`), and the counts of the master table; NULL where there are
    none. Settled, from one pass that reads the keys and the counted fields.

    Several plans over the same tables can share it: the counts of reports, the
    choice of hot patients and the check of the master table all come from it.
    """
    none = F.lit(None).cast("string")
    parts = [tables["patient"].select(F.col("id").alias(KEY), F.lit("patient").alias("kind"), none.alias("value"))]
    for k, rows in clinical_rows(tables, kinds, absolute).items():
        value = F.col(KINDS[k].counted) if KINDS[k].counted else none
        parts.append(rows.select(KEY, F.lit(k).alias("kind"), value.alias("value")))
    # Counted by value first, so that a hot patient is one row per value.
    per_value = (
        reduce(DataFrame.unionByName, parts)
        .where(F.col(KEY).isNotNull())
        .groupBy(KEY, "kind", "value")
        .agg(F.count("*").alias("n"))
    )
    aggregates = []
    for k in ("patient", *kinds):
        here = F.col("kind") == k
        rows = F.sum(F.when(here, F.col("n")))
        aggregates.append(rows.alias(f"{k}_rows"))
        if k in KINDS:
            distinct = F.when(rows.isNotNull(), F.count(F.when(here & F.col("value").isNotNull(), 1)))
            aggregates.append((distinct if KINDS[k].counted else rows).alias(KINDS[k].count_as))
    return settled(per_value.groupBy(KEY).agg(*aggregates))


def patient_master(
    tables: Mapping[str, DataFrame],
    page_rows: int = PAGE_ROWS,
    broadcast_bytes: int | None = None,
    tally: DataFrame | None = None,
    absolute: bool = False,
) -> DataFrame:
    """Patients left-joined with their conditions, medications and encounters:
    schema `schemas.MASTER`, one row per patient and page.

    Every list is aggregated before the join, so no row is multiplied. Absent
    data gives a NULL list and a NULL count. Almost all patients have page 0
    alone (`list_pages` 1); one with more than `page_rows` rows of a kind has
    further rows with the later pages of the lists, and the same base fields
    and whole counts on each. `whole_lists` gives one row per patient.

    Hot patients, also ids that very many patient rows share, are planned
    apart, on a settled copy of their rows; the plan of all others is the same
    with and without them. Patients of up to `GATHER_ROWS` rows never are; with
    smaller pages their lists are cut. `broadcast_bytes` offers each aggregate for a
    broadcast if it measures no more than that; by default the runtime planner
    decides.
    """
    if tally is None:
        tally = patient_tally(tables, absolute=absolute)
    base = patient_base(tables["patient"])
    return joined_master(base, clinical_rows(tables, absolute=absolute), tally, page_rows, broadcast_bytes)


def joined_master(
    base: DataFrame,
    rows: Mapping[str, DataFrame],
    tally: DataFrame,
    page_rows: int = PAGE_ROWS,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """The master table of flat rows and their tally."""
    counted = ["patient_rows", *(f"{k}_rows" for k in KINDS)]
    hot = hot_keys(tally, KEY, counted, dealt_from(page_rows))
    sides = []
    for name, k in KINDS.items():
        kept = without(rows[name], hot, KEY)
        side = lists(kept, KEY, k.fields, name, k.count_as, k.counted is not None, k.counted).drop("row_count")
        sides.append(side if broadcast_bytes is None else broadcast_if_small(side, broadcast_bytes))
    master = cut_pages(left_join_all(without(base, hot, KEY), sides, KEY), list(KINDS), page_rows)
    if hot is not None:
        master = master.unionByName(_hot_master(base, rows, tally, hot, page_rows))
    return master.select(*base.columns, *(c for k, v in KINDS.items() for c in (k, v.count_as)), "page", "list_pages")


def _hot_master(
    base: DataFrame, rows: Mapping[str, DataFrame], tally: DataFrame, hot: DataFrame, page_rows: int
) -> DataFrame:
    paged = {}
    for name, k in KINDS.items():
        kept = only(rows[name].select(KEY, *k.fields), hot, KEY)
        paged[name] = pages(kept, KEY, k.fields, k.counted is not None, page_rows, name)
    # Every page of any list, and page 0 of all.
    numbers = [hot.select(F.col("hot_key").alias(KEY), F.lit(0).alias("page"))]
    numbers += [p.select(KEY, "page") for p in paged.values()]
    every = reduce(DataFrame.unionByName, numbers).distinct()
    for p in paged.values():
        every = every.join(p, [KEY, "page"], "left")
    every = settled(every)
    total = every.groupBy(KEY).agg(F.count("*").cast("int").alias("list_pages"))
    counts = tally.select(KEY, *(k.count_as for k in KINDS.values())).join(total, KEY)
    told = settled(every.join(counts, KEY))
    return only(base, hot, KEY).join(told, KEY)


def with_flag(master: DataFrame, disease: str, name: str = "flag", keep: Sequence[str] = ()) -> DataFrame:
    """Patients (patient_id, `keep`) and a 0/1 column: does any page of their
    conditions name the disease? One row per patient row."""
    rows = master.select(KEY, *keep, "page", has_condition("conditions", disease).alias("here"))
    by = rows.withColumn("flag_key", spread_key(rows, KEY))
    any_page = F.max("here").over(Window.partitionBy("flag_key"))
    return by.withColumn(name, any_page).where(F.col("page") == 0).select(KEY, *keep, name)


def patient_counts(
    tables: Mapping[str, DataFrame],
    kinds: Sequence[str] = tuple(KINDS),
    extra: Sequence[DataFrame] = (),
    tally: DataFrame | None = None,
    absolute: bool = False,
) -> DataFrame:
    """The master table without its lists: base fields and the chosen counts.

    Reports and regressions need no more than this, and it never gathers the
    rows of a patient. `extra` are further tables of one row per patient.
    """
    base = patient_base(tables["patient"]).select(KEY, "birthDate", "gender")
    if kinds and tally is None:
        tally = patient_tally(tables, kinds, absolute)
    sides = [tally.select(KEY, *(KINDS[k].count_as for k in kinds))] if kinds else []
    return left_join_all(base, [*sides, *extra], KEY)


def master_invariants(patient: DataFrame, master: DataFrame, tally: DataFrame) -> DataFrame:
    """One row that tells whether a master table holds what it should.

    `patients` must equal `master_rows` (its rows of page 0); `doubled_pages`,
    patients and pages that occur more often than the patient, must be 0, and
    so must `missing_pages`, patients with fewer or more pages than `list_pages`;
    `<kind>_listed` must equal `<kind>_rows`, what the clinical tables have for
    known patients (distinct lists are left out: these merge rows).
    `duplicate_keys` only tells how many ids the patient table repeats.
    """
    full = [k for k, v in KINDS.items() if v.counted is None]
    sizes = [F.coalesce(F.size(k), F.lit(0)).alias(f"{k}_size") for k in full]
    seen = master.select(KEY, "page", "list_pages", *sizes).groupBy(KEY, "page").agg(
        F.count("*").alias("n"), F.max("list_pages").alias("list_pages"), *(F.sum(f"{k}_size").alias(f"{k}_size") for k in full)
    )
    own = tally.where("patient_rows is not null").withColumnRenamed(KEY, "own")
    compared = seen.join(own.select("own", "patient_rows"), F.col(KEY) == F.col("own"), "left")
    zero = F.lit(0).cast("bigint")
    after = compared.agg(
        F.coalesce(F.sum(F.when(F.col("page") == 0, F.col("n"))), zero).alias("master_rows"),
        F.count_if(F.col("n") > F.col("patient_rows")).alias("doubled_pages"),
        *(F.coalesce(F.sum(f"{k}_size"), zero).alias(f"{k}_listed") for k in full),
    )
    paged = seen.groupBy(KEY).agg(F.count("*").alias("here"), F.max("list_pages").alias("told"))
    whole = paged.agg(F.count_if(F.col("here") != F.col("told")).alias("missing_pages"))
    known = own.agg(
        F.count_if(F.col("patient_rows") > 1).alias("duplicate_keys"),
        *(F.coalesce(F.sum(F.col("patient_rows") * F.col(f"{k}_rows")), zero).alias(f"{k}_rows") for k in full),
    )
    before = patient.agg(F.count("*").alias("patients"))
    # Tables of one row each, laid over one another.
    parts = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (before, after, whole, known))
    return parts.agg(*(F.max(c).alias(c) for c in parts.columns))


def check_master(invariants: DataFrame) -> None:
    """Raises if a master table fails its invariants."""
    row = invariants.first()
    pairs = [("patients", "master_rows"), *((f"{k}_rows", f"{k}_listed") for k, v in KINDS.items() if v.counted is None)]
    wrong = [f"{a} {row[a]} but {b} {row[b]}" for a, b in pairs if row[a] != row[b]]
    if row["doubled_pages"]:
        wrong.append(f"{row['doubled_pages']} doubled pages")
    if row["missing_pages"]:
        wrong.append(f"{row['missing_pages']} patients without all their pages")
    if wrong:
        raise ValueError("the master table is wrong: " + ", ".join(wrong))


def join_fanout(tables: Mapping[str, DataFrame], tally: DataFrame | None = None) -> DataFrame:
    """Rows per patient of the naive inner join of patients and all resources."""
    if tally is None:
        tally = patient_tally(tables)
    names = {"patient_rows": "patient_rows", **{f"{k}_rows": f"{v.resource}_rows" for k, v in KINDS.items()}}
    return fanout(tally.select(KEY, *(F.col(a).alias(b) for a, b in names.items())), KEY, list(names.values()))


def master_quality(master: DataFrame) -> DataFrame:
    """Completeness and averages in one row.

    A patient has data of a kind if its count is not NULL. Averages are over
    those patients only, 0 if there are none.
    """
    counts = {k: F.col(v.count_as) for k, v in KINDS.items()}
    counted = master.agg(
        F.count("*").alias("total_patients"),
        *[F.count(c).alias(f"with_{k}") for k, c in counts.items()],
        *[F.avg(c).alias(f"mean_{k}") for k, c in counts.items()],
    )
    total = F.col("total_patients")
    return counted.select(
        "total_patients",
        *[f"with_{k}" for k in KINDS],
        *[percent(F.col(f"with_{k}"), total, 1).alias(f"{k}_pct") for k in KINDS],
        *[
            F.round(F.coalesce(f"mean_{k}", F.lit(0.0)), 2).alias(f"avg_{k}")
            for k in KINDS
        ],
    )


def sample_rollup(
    kind: str, tables: Mapping[str, DataFrame], n: int = 1, page_rows: int = PAGE_ROWS, absolute: bool = False
) -> DataFrame:
    """All pages of the first `n` patients by id, and of no others."""
    k = KINDS[kind]
    rows = clinical_rows(tables, [kind], absolute)[kind]
    chosen = rows.join(smallest_keys(rows.where(F.col(KEY) != ""), KEY, n), KEY, "left_semi")
    return rollup(chosen, KEY, k.fields, kind, k.count_as, k.counted is not None, k.counted, page_rows)
