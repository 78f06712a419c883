"""Analyses of age against medications, conditions and one disease."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartfold.functions.features import age_years
from chartfold.operators.joins import left_join_all
from chartfold.operators.regression import fit_lines, predict
from chartfold.plans.master import patient_counts, with_flag
from chartfold.plans.records import KEY, condition_rows, patient_base

# Fixed value: the disease studied unless another is named.
DISEASE = "Diabetes mellitus type 2 (disorder)"

MEASURES = {
    "medication_count": "medication_count",
    "disease": "disease",
    "condition_count": "condition_count",
}
# Measures whose predictions are probabilities.
UNIT_MEASURES = ("disease",)
_NEEDS = {"medication_count": "medications", "condition_count": "conditions"}


def patient_age(patient: DataFrame, as_of=None) -> DataFrame:
    return patient.select(F.col("id").alias(KEY), age_years("birthDate", as_of).alias("age"))


def patients_with(condition: DataFrame, disease: str, absolute: bool = False) -> DataFrame:
    """(patient_id, disease=1) of the patients who have it, each once."""
    hits = condition_rows(condition, absolute).where(F.col("condition_name") == disease)
    return hits.select(KEY).distinct().withColumn("disease", F.lit(1))


def disease_flag(patient: DataFrame, condition: DataFrame, disease: str, absolute: bool = False) -> DataFrame:
    """(patient_id, flag): 1 for the patients who have the disease, else 0. Reads
    the conditions alone, of which no more than one row per patient and task is
    shuffled."""
    flagged = left_join_all(patient_base(patient).select(KEY), [patients_with(condition, disease, absolute)], KEY)
    return flagged.select(KEY, F.coalesce("disease", F.lit(0)).alias("flag"))


def condition_hits(
    patient: DataFrame, condition: DataFrame, names: DataFrame, absolute: bool = False
) -> DataFrame:
    """(patient_id, disease) for each patient and each of their conditions that
    `names` (disease) has, and nothing for the others.

    `names` may be of any size: the planner broadcasts it if it measures small
    and else joins by name, after the conditions were made distinct.
    """
    wanted = names.select(F.col("disease")).where(F.col("disease").isNotNull()).distinct()
    had = condition_rows(condition, absolute).select(KEY, F.col("condition_name").alias("disease")).distinct()
    known = patient_base(patient).select(KEY)
    return had.join(wanted, "disease", "left_semi").join(known, KEY, "left_semi").select(KEY, "disease")


def condition_flags(
    patient: DataFrame, condition: DataFrame, diseases: Sequence[str], absolute: bool = False
) -> DataFrame:
    """(patient_id, disease, flag): one row per patient and named disease.

    Only rows of the named diseases are shuffled, at most one per patient,
    disease and map task; the set per patient is no longer than `diseases`.
    """
    hits = condition_rows(condition, absolute).where(F.col("condition_name").isin(list(diseases)))
    found = hits.groupBy(KEY).agg(F.collect_set("condition_name").alias("found"))
    base = patient_base(patient).select(KEY)
    flagged = left_join_all(base, [found], KEY)
    has = F.coalesce(F.array_contains("found", F.col("disease")), F.lit(False))
    names = F.array(*[F.lit(d) for d in diseases])
    return flagged.withColumn("disease", F.explode(names)).select(
        KEY, "disease", has.cast("int").alias("flag")
    )


def age_frame(
    tables: Mapping[str, DataFrame],
    as_of: str | Column | None = None,
    disease: str = DISEASE,
    measures: Sequence[str] = tuple(MEASURES),
    tally: DataFrame | None = None,
    absolute: bool = False,
) -> DataFrame:
    """(patient_id, gender, age, measures...): the input of the regressions.

    Only the named measures are computed. The disease flag is 0 for patients
    without conditions; counts stay NULL for patients without data.
    """
    kinds = [_NEEDS[m] for m in measures if m in _NEEDS]
    extra = [patients_with(tables["condition"], disease, absolute)] if "disease" in measures else []
    counts = patient_counts(tables, kinds, extra, tally, absolute)
    columns = [F.coalesce(m, F.lit(0)).alias(m) if m == "disease" else F.col(m) for m in measures]
    return counts.select(KEY, "gender", age_years("birthDate", as_of).alias("age"), *columns)


def master_age_frame(
    master: DataFrame, as_of: str | Column | None = None, disease: str = DISEASE
) -> DataFrame:
    """The same frame from a master table, such as one read back from a file."""
    keep = ["birthDate", "gender", *(m for m in MEASURES if m != "disease")]
    return with_flag(master, disease, "disease", keep).select(
        KEY, "gender", age_years("birthDate", as_of).alias("age"), *MEASURES
    )


def age_regressions(
    tables: Mapping[str, DataFrame],
    as_of: str | Column | None = None,
    disease: str = DISEASE,
    measures: Sequence[str] = tuple(MEASURES),
    by: Sequence[str] = (),
    fill_zero: bool = False,
    alpha: float = 0.05,
    tally: DataFrame | None = None,
    absolute: bool = False,
) -> DataFrame:
    """Regress each measure on age, overall or per `by` (such as `gender`)."""
    frame = age_frame(tables, as_of, disease, measures, tally, absolute)
    return fit_ages(frame, measures, by, fill_zero, alpha)


def fit_ages(
    frame: DataFrame,
    measures: Sequence[str] = tuple(MEASURES),
    by: Sequence[str] = (),
    fill_zero: bool = False,
    alpha: float = 0.05,
) -> DataFrame:
    """Regress the measures of an age frame on age."""
    return fit_lines(frame, "age", {m: MEASURES[m] for m in measures}, by, fill_zero, alpha)


def predictions_by_age(fits: DataFrame, ages: Sequence[float]) -> DataFrame:
    """One row per age: the three predictions, and the probability in percent."""
    long = predict(fits, ages, UNIT_MEASURES)
    pick = lambda m: F.max(F.when(F.col("measure") == m, F.col("predicted")))
    return (
        long.groupBy(F.col("x").alias("age"))
        .agg(
            pick("medication_count").alias("medications"),
            pick("disease").alias("disease_probability"),
            pick("condition_count").alias("conditions"),
        )
        .withColumn("disease_percent", F.col("disease_probability") * 100)
    )
