"""The whole batch job: from an export to the master table and its reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from chartfold.operators.heavy import PAGE_ROWS
from chartfold.operators.profile import raw_quality
from chartfold.operators.regression import line_points, scatter_counts
from chartfold.plans import analysis
from chartfold.plans.master import (
    KINDS,
    check_master,
    master_invariants,
    master_quality,
    patient_counts,
    patient_master,
    patient_tally,
)
from chartfold.schemas import DEFAULT_RESOURCES
from chartfold.shared import clear_scratch, settled
from chartfold.sinks.jsonl import read_master, write_json_lines, write_master
from chartfold.sinks.landing import land_sources, landed_summary
from chartfold.sources.archives import list_archives
from chartfold.sources.content import resource_sources
from chartfold.sources.ndjson import register_views

_NEEDED = ("patient", *(k.resource for k in KINDS.values()))


def run(
    spark: SparkSession,
    source: str,
    output: str,
    resources: Sequence[str] = (),
    archives: bool = False,
    as_of: str | None = None,
    disease: str = analysis.DISEASE,
    age: float = 50,
    page_rows: int = PAGE_ROWS,
    absolute: bool = False,
    sampling_ratio: float = 1.0,
    keep_scratch: bool = False,
) -> dict[str, DataFrame]:
    """Build everything under `output` and return the reports by name.

    `source` is a folder of NDJSON files, or of ZIP archives with `archives`.
    The default resources are always loaded, `resources` besides. Files of a
    folder are landed with all fields they have, inferred from the share
    `sampling_ratio` of their lines; archives with the pinned fields. Tables go
    to `output/tables`; a later run reads only the files, or archive entries,
    that are new or changed, and leaves out the rows of those that are gone.
    The master table goes to `output/master`, the reports to
    `output/reports`; the job raises if the master table written fails its
    check. `absolute` takes ids from the end of references that are URLs.

    At the end the scratch tables of the whole application are deleted, unless
    `keep_scratch`.
    """
    extra = [r for r in resources if r.strip().lower() not in {d.lower() for d in DEFAULT_RESOURCES}]
    inventory = None
    if archives:
        inventory = settled(list_archives(spark, source))
        options = {"entries": inventory}
    else:
        options = {"widen": True, "sampling_ratio": sampling_ratio}
    found = resource_sources(spark, source, [*extra, *DEFAULT_RESOURCES], archives, **options)
    absent = [name for name in _NEEDED if name not in found]
    if absent:
        raise ValueError(f"no files for: {', '.join(absent)}")
    tables = land_sources(found, f"{output}/tables")
    register_views(tables)

    tally = patient_tally(tables, absolute=absolute)
    write_master(patient_master(tables, page_rows, tally=tally, absolute=absolute), f"{output}/master")
    written = read_master(spark, f"{output}/master")

    stored = {}

    def store(name: str, report: DataFrame) -> DataFrame:
        path = f"{output}/reports/{name}"
        write_json_lines(report, path, compression="none")
        stored[name] = spark.read.schema(report.schema).json(path)
        return stored[name]

    check_master(store("master_invariants", master_invariants(tables["patient"], written, tally)))
    store("load_summary", landed_summary(spark, f"{output}/tables", tables))
    store("raw_quality", raw_quality(tables))
    store("master_quality", master_quality(patient_counts(tables, tally=tally, absolute=absolute)))
    frame = settled(analysis.age_frame(tables, as_of, disease, tally=tally, absolute=absolute))
    # What follows from the fits is read from the stored ones.
    fits = store("regressions", analysis.fit_ages(frame))
    store("predictions", analysis.predictions_by_age(fits, [age]))
    store("line_points", line_points(fits))
    store("scatter_counts", scatter_counts(frame, "age", analysis.MEASURES))
    if inventory is not None:
        store("archive_inventory", inventory)
    if not keep_scratch:
        clear_scratch(spark)
    return stored
