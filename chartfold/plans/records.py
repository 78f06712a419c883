"""Flat rows of the nested clinical resources, keyed by patient."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartfold.functions.fields import first, first_code, first_coding, first_display, ref_id

KEY = "patient_id"

CONDITION_FIELDS = ("condition_code", "condition_name")
MEDICATION_FIELDS = (
    "medication_id", "medication_code", "medication_name", "medication_status",
    "intent", "authoredOn", "encounter_id",
)
ENCOUNTER_FIELDS = (
    "encounter_id", "encounter_status", "encounter_type_code", "encounter_type_name",
    "start_date", "end_date", "class_code", "organization_id",
)


def patient_base(patient: DataFrame) -> DataFrame:
    """One row per patient resource with the fields of the master table."""
    return patient.select(
        F.col("id").alias(KEY), "name", "address", "birthDate", "gender", "maritalStatus"
    )


def patient_flat(patient: DataFrame) -> DataFrame:
    """Patient with marital status and first city as plain text."""
    return patient.select(
        F.col("id").alias(KEY),
        "birthDate",
        "gender",
        first_code("maritalStatus").alias("marital_status"),
        first("address")["city"].alias("city"),
    )


def _with_subject(df: DataFrame, absolute: bool) -> DataFrame:
    keyed = df.where(F.col("subject.reference").isNotNull()).withColumn(
        KEY, ref_id("subject.reference", absolute)
    )
    return keyed.where(F.col(KEY).isNotNull())


def condition_rows(condition: DataFrame, absolute: bool = False) -> DataFrame:
    return _with_subject(condition, absolute).select(
        KEY, first_code("code").alias("condition_code"), first_display("code").alias("condition_name")
    )


def medication_rows(medicationrequest: DataFrame, absolute: bool = False) -> DataFrame:
    concept = "medicationCodeableConcept"
    return _with_subject(medicationrequest, absolute).select(
        KEY,
        F.col("id").alias("medication_id"),
        first_code(concept).alias("medication_code"),
        first_display(concept).alias("medication_name"),
        F.col("status").alias("medication_status"),
        "intent",
        "authoredOn",
        ref_id("encounter.reference", absolute).alias("encounter_id"),
    )


def encounter_rows(encounter: DataFrame, absolute: bool = False) -> DataFrame:
    coding = first_coding(first("type"))
    return _with_subject(encounter, absolute).select(
        KEY,
        F.col("id").alias("encounter_id"),
        F.col("status").alias("encounter_status"),
        coding["code"].alias("encounter_type_code"),
        coding["display"].alias("encounter_type_name"),
        F.col("period.start").alias("start_date"),
        F.col("period.end").alias("end_date"),
        F.col("class.code").alias("class_code"),
        ref_id("serviceProvider.reference", absolute).alias("organization_id"),
    )
