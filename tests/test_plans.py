"""Shapes of physical plans: what is scanned, shuffled and broadcast."""

import re

import pytest

import __spark_entry__ as contract
from chartfold.plans import analysis
from chartfold.plans import master as m
from chartfold.plans.testbed import clinical_tables
from chartfold.shared import settled
from chartfold.sinks.jsonl import land, read_master, write_master

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    return land(clinical_tables(spark, SF_DIR), str(tmp_path_factory.mktemp("landed")))


def read_schema(plan, table):
    found = [s for s in re.findall(r"Location[^\n]*", plan) if f"/{table}/" in s]
    assert found, plan
    return [re.search(r"ReadSchema: (.*)", s)[1] for s in found]


@pytest.fixture
def full_text(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    spark.conf.unset("spark.sql.debug.maxToStringFields")


def test_scans_read_only_what_counts_need(landed, full_text, monkeypatch):
    plans = []
    monkeypatch.setattr(m, "settled", lambda df: plans.append(plan_of(df)) or settled(df))
    counts = plan_of(m.patient_counts(landed))
    assert read_schema(counts, "patient") == ["struct<id:string,birthDate:string,gender:string>"]
    (tally,) = plans
    assert read_schema(tally, "patient") == ["struct<id:string>"]
    assert read_schema(tally, "condition") == [
        "struct<subject:struct<reference:string>,code:struct<coding:array<struct<code:string>>>>"
    ]
    assert read_schema(tally, "medicationrequest") == ["struct<subject:struct<reference:string>>"]
    assert read_schema(tally, "encounter") == ["struct<subject:struct<reference:string>>"]
    assert tally.count("PushedFilters: [IsNotNull(subject.reference)]") == 3


def test_one_measure_reads_one_resource(landed, full_text, monkeypatch):
    plans = []
    monkeypatch.setattr(m, "settled", lambda df: plans.append(plan_of(df)) or settled(df))
    plans.append(plan_of(analysis.age_regressions(landed, "2023-02-28", measures=["medication_count"])))
    assert not any("/condition/" in p or "/encounter/" in p for p in plans)
    assert any("/medicationrequest/" in p for p in plans)


def test_one_hot_patient_adds_no_scan_and_no_exchange(landed, spark):
    """Beyond the anti-joins, the plan of all other patients stays the same."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def size(page_rows):
            plan = plan_of(m.patient_master(landed, page_rows))
            hot = plan.count("Union") > 0
            scans = sum(plan.count(f"/{name}/version-") for name in landed)
            return hot, scans, plan.count("Exchange hashpartitioning(side_key"), plan.count("ObjectHashAggregate")

        cold, paged = size(50_000), size(40)
        assert not cold[0] and paged[0]
        assert cold[1:2] == paged[1:2]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_invariants_read_what_was_written_and_the_tables(landed, spark, tmp_path, full_text, monkeypatch):
    plans = []
    monkeypatch.setattr(m, "settled", lambda df: plans.append(plan_of(df)) or settled(df))
    tally = m.patient_tally(landed)
    write_master(m.patient_master(landed, tally=tally), str(tmp_path / "master"))
    written = read_master(spark, str(tmp_path / "master"))
    plan = plan_of(m.master_invariants(landed["patient"], written, tally))
    assert str(tmp_path / "master") in plan
    assert all(f"/{name}/" in plans[0] for name in landed)


def test_selected_counts_drop_the_lists(landed):
    rows = m.patient_master(landed)
    assert "collect_list" in plan_of(rows)
    assert "collect_list" not in plan_of(rows.select("patient_id", "medication_count", "encounter_count"))


@pytest.mark.parametrize("name", sorted(contract.QUERIES))
def test_no_query_multiplies_rows_or_runs_row_wise_python(spark, name):
    plan = plan_of(contract.queries()[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in plan
