"""Pages of small keys, and what is stored of hot ones."""

import os

from chartfold.operators.heavy import GATHER_ROWS
from chartfold.operators.rollup import rollup
from chartfold.plans.clustered import cluster, clustered_counts
from chartfold.plans.master import patient_master
from chartfold.shared import scratch
from chartfold.sinks.jsonl import read_master, write_master

TABLES = {
    "patient": "id string, birthDate string, gender string, name string, address string, maritalStatus string",
    "condition": "subject struct<reference:string>, code struct<coding:array<struct<code:string,display:string>>>",
    "medicationrequest": (
        "id string, status string, intent string, authoredOn string, subject struct<reference:string>, "
        "medicationCodeableConcept struct<coding:array<struct<code:string,display:string>>>, "
        "encounter struct<reference:string>"
    ),
    "encounter": (
        "id string, status string, class struct<code:string>, type array<struct<coding:array<struct<code:string,"
        "display:string>>>>, period struct<start:string,end:string>, subject struct<reference:string>, "
        "serviceProvider struct<reference:string>"
    ),
}


def clinical(spark, medications):
    """Patients with so many medication requests each."""
    rows = [(f"m{p}-{i}", None, None, None, (f"Patient/{p}",), None, None) for p, n in medications.items() for i in range(n)]
    data = {"patient": [(p, "1990-01-01", None, None, None, None) for p in medications], "medicationrequest": rows}
    return {name: spark.createDataFrame(data.get(name, []), ddl) for name, ddl in TABLES.items()}


def test_keys_that_a_task_can_gather_are_not_dealt(spark):
    n = {"a": 1, "b": 5, "c": 6, "d": GATHER_ROWS, "e": GATHER_ROWS + 1}
    rows = spark.createDataFrame([(k, i) for k, m in n.items() for i in range(m)], "k string, i int")
    some = rollup(rows.where("k < 'e'"), "k", ["i"], "l", "n", page_rows=5)
    assert "Union" not in some._jdf.queryExecution().optimizedPlan().toString()
    every = rollup(rows, "k", ["i"], "l", "n", page_rows=5).collect()
    for k, m in n.items():
        own = sorted((r for r in every if r.k == k), key=lambda r: r.page)
        assert [r.page for r in own] == list(range(len(own))) and {r.list_pages for r in own} == {len(own)}
        assert sorted(x.i for r in own for x in r.l) == list(range(m)) and {r.n for r in own} == {m}
        if m <= GATHER_ROWS:
            assert [len(r.l) for r in own] == [5] * (m // 5) + [m % 5] * (m % 5 > 0)


def test_pages_of_a_master_table(spark, tmp_path):
    tables = clinical(spark, {"1": 12, "2": 5, "3": 0, "4": GATHER_ROWS + 1})
    write_master(patient_master(tables, 5), str(tmp_path / "master"))
    names = [f for _, _, files in os.walk(tmp_path / "master") for f in files if f.startswith("part") and ".json" in f]
    assert any(f.endswith(".json.gz") for f in names)
    rows = read_master(spark, str(tmp_path / "master")).collect()
    sizes = {k: [len(r.medications or []) for r in sorted(rows, key=lambda r: r.page) if r.patient_id == k] for k in "123"}
    assert sizes == {"1": [5, 5, 2], "2": [5], "3": [0]}
    assert sum(len(r.medications) for r in rows if r.patient_id == "4") == GATHER_ROWS + 1


def test_rows_of_hot_patients_are_stored_once(spark, tmp_path):
    tables = clinical(spark, {"1": 12, "2": 5, "3": 0})
    before = {d for d, _, _ in os.walk(scratch(spark).removeprefix("file:"))}
    found = cluster(tables, str(tmp_path / "clustered"), 2, page_rows=5)
    assert [r.patient_id for r in found.hot["patients"].collect()] == ["1"]
    assert (found.hot["medications"].count(), found.even["medications"].count()) == (12, 5)
    assert found.hot["conditions"].count() == 0
    assert not [d for d, _, _ in os.walk(tmp_path / "clustered") if d.endswith("=0")]
    # No second copy in the scratch folder.
    copies = 0
    for d, _, files in os.walk(scratch(spark).removeprefix("file:")):
        if d in before:
            continue
        parquet = [os.path.join(d, f) for f in files if f.endswith(".parquet")]
        copies += bool(parquet) and "medication_id" in spark.read.parquet(*parquet).columns
    assert copies == 0
    assert clustered_counts(found).count() == 3
