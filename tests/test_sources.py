"""Files in and out: NDJSON, archives, the export log, JSON Lines."""

import gzip
import json
import zipfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from chartfold.checks import queries
from chartfold.operators.profile import load_summary, null_profile
from chartfold.plans import master as m
from chartfold.plans import testbed
from chartfold.plans.testbed import clinical_tables, write_ndjson
from chartfold.schemas import CORRUPT, RESOURCES
from chartfold.shared import new_shared_path, scope, scratch, settled, settled_from
from chartfold.sinks.jsonl import land, read_master, write_json_lines, write_master
from chartfold.sources.archives import archive_lines, list_archives, scan_archives
from chartfold.sources.export_log import flatten_log, scan_export_log
from chartfold.sources.ndjson import cached, load_resources, merge_resources, scan_resource

SF_DIR = "/root/testdata/sf0.001"


def put(path, *rows):
    path.write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows))


@pytest.fixture
def folder(tmp_path):
    put(tmp_path / "Patient.ndjson", {"id": "p1", "gender": "male"}, "not json", {"id": "p2", "extra": {"a": 1}})
    put(tmp_path / "MedicationRequest.000.ndjson", {"id": "m1"})
    put(tmp_path / "MedicationRequest.001.ndjson", {"id": "m2"})
    put(tmp_path / "Medication.000.ndjson", {"id": "trap"})
    put(tmp_path / "Device.ndjson", {"id": "d1", "udi": {"carrier": "x"}})
    return str(tmp_path)


def ids(df):
    return sorted(r.id for r in df.select("id").collect() if r.id)


def test_exact_and_prefix_names(spark, folder):
    assert ids(scan_resource(spark, folder, "MedicationRequest")) == ["m1", "m2"]
    assert ids(scan_resource(spark, folder, "Medication", schema="id string")) == ["trap"]
    assert ids(scan_resource(spark, folder, "Medication", schema="id string", prefix=True)) == ["m1", "m2", "trap"]
    assert scan_resource(spark, folder, "Absent") is None
    assert scan_resource(spark, folder + "/nowhere", "Patient") is None


def test_corrupt_lines_are_counted_and_kept(spark, folder):
    tables = load_resources(spark, folder, [" Patient ", "Encounter", "MedicationRequest"])
    assert list(tables) == ["patient", "medicationrequest"]
    got = {r.resource: tuple(r)[1:] for r in load_summary(tables).collect()}
    assert got == {"patient": (3, 6, 1), "medicationrequest": (2, 7, 0)}
    assert spark.sql("select count(*) from patient where id is not null").first()[0] == 2
    nulls = {(r.column, r.null_count) for r in null_profile(tables["patient"].select("id", CORRUPT)).collect()}
    assert nulls == {("id", 1)}
    bad = tables["patient"].select("id", CORRUPT).where(F.col("id").isNull()).collect()
    assert [r[CORRUPT] for r in bad] == ["not json"]


def test_unknown_resource_is_inferred(spark, folder):
    device = scan_resource(spark, folder, "Device")
    assert device.select("udi.carrier").first()[0] == "x"
    assert "extra" in scan_resource(spark, folder, "Patient", infer=True).columns


def test_defaults_win_the_merge(spark):
    a, b, c = (spark.range(n) for n in (1, 2, 3))
    merged = merge_resources({"patient": a, "device": c}, {"patient": b})
    assert merged["patient"] is b and merged["device"] is c


def test_export_log(spark, tmp_path):
    put(
        tmp_path / "log.ndjson",
        {"exportId": "made-up", "timestamp": "2031-01-02T23:30:00.250+02:00", "eventId": "kickoff",
         "eventDetail": {"exportUrl": "https://h/export"}},
        {"exportId": "made-up", "timestamp": "2031-01-03T01:00:01.000+02:00", "eventId": "export_complete",
         "eventDetail": {"files": 12, "resources": 340, "bytes": 5600, "attachments": None, "duration": 77}},
    )
    rows = flatten_log(scan_export_log(spark, str(tmp_path))).orderBy("at").collect()
    assert [r.eventId for r in rows] == ["kickoff", "export_complete"]
    assert rows[0].at.isoformat() == "2031-01-02T21:30:00.250000"
    assert rows[0].files is None and rows[1].files == 12 and rows[1].duration == 77 and rows[1].attachments is None


@pytest.fixture
def archives(tmp_path):
    lines = [json.dumps({"id": f"c{i}", "subject": {"reference": f"Patient/{i % 7}"}, "pad": "é" * (i % 50)}) for i in range(500)]
    with zipfile.ZipFile(tmp_path / "a b.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("export/Condition.000.ndjson", "\n".join(lines[:200]) + "\n\n")
        z.writestr("export/ConditionOther.000.ndjson", lines[0])
        z.writestr("export/notes.txt", "not read")
    with zipfile.ZipFile(tmp_path / "b.zip", "w", zipfile.ZIP_STORED) as z:
        z.writestr("Condition.ndjson", "\r\n".join(lines[200:]))
        z.writestr("Condition.001.ndjson", "")
        z.writestr("Condition.002.ndjson", "not json\n")
    return str(tmp_path)


def test_archive_listing(spark, archives):
    got = {r.entry: (r.bytes, r.stored) for r in list_archives(spark, archives).collect()}
    assert set(got) == {
        "export/Condition.000.ndjson", "export/ConditionOther.000.ndjson", "export/notes.txt",
        "Condition.ndjson", "Condition.001.ndjson", "Condition.002.ndjson",
    }
    assert got["export/notes.txt"] == (8, False) and got["Condition.001.ndjson"] == (0, True)


@pytest.mark.parametrize("split_bytes", [7, 1000, 2**27])
def test_archive_lines_are_read_once_whatever_the_split(spark, archives, split_bytes):
    table = scan_archives(spark, archives, "Condition", split_bytes=split_bytes)
    assert ids(table) == sorted(f"c{i}" for i in range(500))
    assert table.select("id", CORRUPT).where(F.col(CORRUPT).isNotNull()).count() == 1
    assert archive_lines(spark, archives, split_bytes=split_bytes).count() == 502


def test_json_lines_keep_nulls_and_types(spark, tmp_path):
    tables = clinical_tables(spark, SF_DIR)
    master = m.patient_master(tables)
    path = str(tmp_path / "master")
    write_master(master, path)
    back = read_master(spark, path)
    assert back.schema.simpleString() == master.schema.simpleString()
    assert sorted(map(str, back.collect())) == sorted(map(str, master.collect()))
    lines = spark.read.text(f"{path}/version-*")
    first = json.loads(lines.where("value like '%\"conditions\":null%'").first()[0])
    assert first["condition_count"] is None and list(first)[:2] == ["patient_id", "name"]


def test_pages_are_in_the_one_file(spark, tmp_path):
    tables = clinical_tables(spark, SF_DIR)
    master = m.patient_master(tables, page_rows=5)
    path = str(tmp_path / "master")
    write_master(master, path)
    back = read_master(spark, path)
    assert sorted(map(str, back.collect())) == sorted(map(str, master.collect()))
    # Written again with larger pages, nothing of the old pages is left.
    write_master(m.patient_master(tables), path)
    assert read_master(spark, path).where("page > 0").count() == 0


class Broken(Exception):
    pass


def breaking(spark, rows):
    """A table whose write fails after some rows."""
    return spark.range(rows).select(F.when(F.col("id") >= 0, F.raise_error(F.lit("lost"))).cast("bigint").alias("id"))


def test_master_that_broke_off_leaves_the_old_one(spark, tmp_path, monkeypatch):
    from chartfold.sinks import jsonl

    tables = clinical_tables(spark, SF_DIR)
    path = str(tmp_path / "master")
    with pytest.raises(FileNotFoundError):
        read_master(spark, path)
    write_master(m.patient_master(tables), path)
    before = sorted(map(str, read_master(spark, path).collect()))

    def write_and_fail(df, folder, mode):
        df.limit(3).write.mode(mode).json(folder)
        raise Broken

    monkeypatch.setattr(jsonl, "write_json_lines", write_and_fail)
    with pytest.raises(Broken):
        write_master(m.patient_master(tables, page_rows=5), path)
    assert sorted(map(str, read_master(spark, path).collect())) == before


def test_landing_is_done_once(spark, tmp_path):
    put(tmp_path / "Patient.ndjson", {"id": "1"}, {"id": "2"})
    table = lambda: {"t": scan_resource(spark, str(tmp_path), "Patient", schema="id string")}
    out = str(tmp_path / "out")
    assert land(table(), out)["t"].count() == 2
    # The same names with other content are only read on request.
    put(tmp_path / "Patient.ndjson", {"id": "1"}, {"id": "2"}, {"id": "3"})
    assert land(table(), out)["t"].count() == 2
    assert land(table(), out, again=True)["t"].count() == 3
    # Another file or another schema is another source.
    put(tmp_path / "Patient.001.ndjson", {"id": "4", "gender": "x"})
    assert land(table(), out)["t"].count() == 4
    wide = land({"t": scan_resource(spark, str(tmp_path), "Patient", schema="id string, gender string")}, out)["t"]
    assert wide.where("gender = 'x'").count() == 1


def test_landing_again_that_breaks_keeps_the_table(spark, tmp_path):
    out = str(tmp_path)
    assert land({"t": spark.range(1000)}, out)["t"].count() == 1000
    with pytest.raises(Exception, match="lost"):
        land({"t": breaking(spark, 10)}, out, again=True)
    assert land({"t": spark.range(1000)}, out)["t"].count() == 1000


def test_landing_that_broke_off_is_repeated(spark, tmp_path):
    (tmp_path / "t" / "version-x" / "_temporary").mkdir(parents=True)
    assert land({"t": spark.range(4)}, str(tmp_path))["t"].count() == 4


def test_fields_nobody_pinned_are_kept(spark, tmp_path):
    put(
        tmp_path / "Patient_2.ndjson",
        {"id": "p", "name": [{"family": "F", "extension": [{"url": "u"}]}], "active": True, "birthDate": 1990},
        "not json",
    )
    table = scan_resource(spark, str(tmp_path), "Patient", widen=True)
    row = table.where("id = 'p'").first()
    assert row.active is True and row.name[0].family == "F" and row.name[0].extension[0].url == "u"
    assert row.birthDate == "1990" and row.maritalStatus is None
    assert [r[CORRUPT] for r in table.select("id", CORRUPT).collect() if r[CORRUPT]] == ["not json"]


def test_names_with_other_separators(spark, tmp_path):
    for k, name in enumerate(("Condition.ndjson", "Condition.0.ndjson", "Condition_2.ndjson", "Condition-1.ndjson")):
        put(tmp_path / name, {"id": f"c{k}"})
    put(tmp_path / "ConditionOther.ndjson", {"id": "trap"})
    assert ids(scan_resource(spark, str(tmp_path), "Condition")) == ["c0", "c1", "c2", "c3"]
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        for f in sorted(tmp_path.glob("*.ndjson")):
            z.write(f, f"x/{f.name}")
    assert ids(scan_archives(spark, str(tmp_path), "Condition")) == ["c0", "c1", "c2", "c3"]


def test_scratch_can_be_cleared(spark):
    kept = settled(spark.range(3))
    assert kept.inputFiles()[0].startswith(scratch(spark).replace("file:", "")) or scratch(spark) in kept.inputFiles()[0]


def folders(spark):
    return set(Path(scratch(spark).removeprefix("file:")).glob("*"))


def test_a_scope_deletes_what_it_settled(spark):
    settled(spark.range(1))
    before = folders(spark)
    with scope(spark):
        assert settled(spark.range(3)).count() == 3
        with scope(spark):
            m.patient_tally(clinical_tables(spark, SF_DIR)).count()
            assert len(folders(spark)) == len(before) + 2
        assert len(folders(spark)) == len(before) + 1
    with pytest.raises(Broken), scope(spark):
        settled(spark.range(3))
        raise Broken
    assert folders(spark) == before
    kept = settled_from(spark, lambda: settled(spark.range(5)).where("id > 1"))
    assert kept.count() == 3 and len(folders(spark)) == len(before) + 1


def test_cached_block_releases(spark):
    df = spark.range(5)
    with cached(df) as kept:
        assert kept.is_cached and kept.count() == 5
    assert not df.is_cached


def test_shared_paths_come_from_the_session(spark):
    assert new_shared_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert settled(spark.range(4)).count() == 4


def test_gzipped_exports_are_short_files_with_the_same_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(testbed, "GZIPPED_ROWS", 7)
    ids = spark.range(40).select(F.col("id").cast("string").alias("id"))
    reference = F.when(F.col("id") % 3 != 0, F.struct(F.concat(F.lit("Patient/é"), "id").alias("reference")))
    table = ids.withColumns({"subject": reference, "code": F.lit(None).cast("struct<coding:array<struct<code:string,display:string>>>")})
    table = table.unionByName(table.limit(3)).repartition(2)
    plain, gzipped = (write_ndjson({"condition": table}, gzipped=g) for g in (False, True))
    read = [sorted(map(str, scan_resource(spark, p, "Condition").collect())) for p in (plain, gzipped)]
    assert read[0] == read[1] and len(read[0]) == 43
    files = [gzip.decompress(f.read_bytes()).splitlines() for f in Path(gzipped.removeprefix("file:")).rglob("part-*.gz")]
    assert sum(map(len, files)) == 43 and max(map(len, files)) == 7


@pytest.mark.parametrize("name", ["ndjson_master", "ndjson_scan"])
def test_queries_of_whole_exports_write_no_plain_text(spark, monkeypatch, name):
    written = []

    def write(*tables, **options):
        written.append(write_ndjson(*tables, **options))
        return written[-1]

    monkeypatch.setattr(queries, "write_ndjson", write)
    assert queries.QUERIES[name](spark, SF_DIR).count()
    files = [f.name for f in Path(written[0].removeprefix("file:")).rglob("part-*")]
    assert len(written) == 1 and files and all(f.endswith(".json.gz") for f in files)


def test_empty_table_writes_and_reads(spark, tmp_path):
    empty = spark.createDataFrame([], RESOURCES["condition"])
    write_json_lines(empty, str(tmp_path / "Condition.ndjson"))
    assert scan_resource(spark, str(tmp_path), "Condition").count() == 0
