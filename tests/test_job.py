"""The job end to end, from files and from archives."""

import json
import shutil
from pathlib import Path

import pytest

from chartfold.plans import job
from chartfold.plans.testbed import AS_OF, CLINICAL, DISEASE, FILE_NAMES, clinical_tables, write_archives, write_ndjson
from chartfold.sinks.jsonl import read_master

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def reports(spark, tmp_path_factory):
    source = write_ndjson(clinical_tables(spark, SF_DIR, list(FILE_NAMES)))
    output = str(tmp_path_factory.mktemp("out"))
    return output, job.run(spark, source, output, as_of=AS_OF, disease=DISEASE, keep_scratch=True)


def test_reports(spark, reports):
    output, got = reports
    rows = {r.resource: r.rows for r in got["load_summary"].collect()}
    assert rows["patient"] == 150 and set(rows) == set(FILE_NAMES)
    check = got["master_invariants"].first()
    assert check.patients == check.master_rows == read_master(spark, f"{output}/master").where("page = 0").count()
    assert got["line_points"].count() == 300
    assert {r.measure for r in got["scatter_counts"].collect()} == {"medication_count", "disease", "condition_count"}
    assert got["raw_quality"].where("table = 'patient' and column = 'maritalStatus'").count() == 1
    assert got["master_quality"].first().total_patients == 150
    assert {r.measure for r in got["regressions"].collect()} == {"medication_count", "disease", "condition_count"}
    prediction = got["predictions"].collect()
    assert [r.age for r in prediction] == [50.0] and 0 <= prediction[0].disease_probability <= 1
    assert spark.sql("select count(*) from medicationrequest").first()[0] == rows["medicationrequest"]


def test_archives_give_the_same(spark, reports, tmp_path):
    folder = tmp_path / "zips"
    folder.mkdir()
    for name in CLINICAL:
        made = write_archives(clinical_tables(spark, SF_DIR, [name])[name], FILE_NAMES[name])
        for i, part in enumerate(sorted(Path(made).glob("*.zip"))):
            shutil.copy(part, folder / f"{name}-{i}.zip")
    again = job.run(spark, str(folder), str(tmp_path / "out"), archives=True, as_of=AS_OF, disease=DISEASE, keep_scratch=True)
    assert again["archive_inventory"].where("entry like '%Patient%'").count() > 0
    for name in ("master_quality", "master_invariants"):
        assert again[name].collect() == reports[1][name].collect()

    def rounded(df):
        return sorted((r.measure, r.n, round(r.slope, 9), round(r.p, 9)) for r in df.collect())

    assert rounded(again["regressions"]) == rounded(reports[1]["regressions"])


def test_missing_resources_are_named(spark, tmp_path):
    (tmp_path / "Patient.ndjson").write_text(json.dumps({"id": "1"}) + "\n")
    with pytest.raises(ValueError, match="condition, medicationrequest, encounter"):
        job.run(spark, str(tmp_path), str(tmp_path / "out"))


def test_a_second_export_is_not_taken_for_the_first(spark, tmp_path):
    out = str(tmp_path / "out")
    for n in (2, 5):
        source = tmp_path / f"export{n}"
        source.mkdir()
        for name in ("Patient", "Condition", "MedicationRequest", "Encounter"):
            rows = [{"id": f"{name[0]}{i}", "subject": {"reference": f"https://h/fhir/Patient/P{i}"}} for i in range(n)]
            (source / f"{name}.ndjson").write_text("".join(json.dumps(r) + "\n" for r in rows))
        got = job.run(spark, str(source), out, as_of=AS_OF, absolute=True, keep_scratch=True)
        quality = got["master_quality"].first()
        assert quality.total_patients == n and quality.with_encounters == n
