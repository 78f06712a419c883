"""Landing by content: which files are read, and whose rows the table holds."""

import json
import os
import zipfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from chartfold.schemas import CORRUPT
from chartfold.sinks import landing
from chartfold.sources.content import archive_source, ndjson_source, resource_sources


def put(path, *rows):
    path.write_text("".join(json.dumps(r) + "\n" if isinstance(r, dict) else r + "\n" for r in rows))


def land(spark, folder, out, name="Patient", **options):
    source = ndjson_source(spark, str(folder), name, **options)
    return landing.land_sources({"t": source}, str(out))["t"]


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def batches(out):
    return sorted(p.name for p in Path(out, "t").glob("batch-*"))


@pytest.fixture
def places(tmp_path):
    folder, out = tmp_path / "in", tmp_path / "out"
    folder.mkdir()
    return folder, out


def test_only_new_and_changed_files_are_read(spark, places, monkeypatch):
    folder, out = places
    for k in range(4):
        put(folder / f"Patient.{k}.ndjson", {"id": f"{k}a"}, {"id": f"{k}b"})
    assert len(ids(land(spark, folder, out))) == 8
    first = batches(out)
    read = []

    def scanned(source, inner=ndjson_source):
        made = inner(spark, str(folder), "Patient")

        def scan(wanted):
            read.append(sorted(Path(r["name"]).name for r in wanted.collect()))
            return made.scan(wanted)

        return landing.Source(made.files, scan, made.request)

    def again():
        return landing.land_sources({"t": scanned(None)}, str(out))["t"]

    # Nothing changed: nothing is read and nothing is written.
    assert len(ids(again())) == 8 and not read and batches(out) == first
    # A new file.
    put(folder / "Patient.new.ndjson", {"id": "n", "gender": "x"})
    assert "n" in ids(again()) and read.pop() == ["Patient.new.ndjson"]
    # A changed file under its old name: its old rows go.
    put(folder / "Patient.2.ndjson", {"id": "2a"}, {"id": "2c"}, {"id": "2d"})
    assert ids(again()) == ["0a", "0b", "1a", "1b", "2a", "2c", "2d", "3a", "3b", "n"]
    assert read.pop() == ["Patient.2.ndjson"] and set(first) <= set(batches(out))
    # A file of the same size and another time.
    put(folder / "Patient.3.ndjson", {"id": "3a"}, {"id": "3z"})
    os.utime(folder / "Patient.3.ndjson", ns=(1, 10**18))
    assert "3z" in ids(again()) and "3b" not in ids(landing.landed(spark, str(out), "t"))
    read.clear()
    # A file that is gone; the first batch is now mostly dead and is landed again.
    (folder / "Patient.0.ndjson").unlink()
    assert ids(again()) == ["1a", "1b", "2a", "2c", "2d", "3a", "3z", "n"]
    assert read == [["Patient.1.ndjson"]]
    told = {Path(r["name"]).name: r["rows"] for r in landing.manifest(spark, str(out), "t").collect()}
    assert told == {"Patient.1.ndjson": 2, "Patient.2.ndjson": 3, "Patient.3.ndjson": 2, "Patient.new.ndjson": 1}
    # No file at all but an empty one.
    for f in folder.glob("*.ndjson"):
        put(f)
    assert ids(again()) == []


def test_a_plan_of_the_version_before_still_runs(spark, places):
    folder, out = places
    put(folder / "Patient.ndjson", {"id": "1"})
    old = land(spark, folder, out)
    put(folder / "Patient.ndjson", {"id": "2"}, {"id": "3"})
    assert ids(land(spark, folder, out)) == ["2", "3"] and ids(old) == ["1"]
    put(folder / "Patient.ndjson", {"id": "4"}, {"id": "5"}, {"id": "6"})
    assert ids(land(spark, folder, out)) == ["4", "5", "6"]
    assert len(batches(out)) == 2


def test_fields_and_types_that_come_later(spark, places):
    folder, out = places
    put(folder / "Patient.0.ndjson", {"id": "1", "extra": {"a": 1}})
    assert land(spark, folder, out, widen=True).first().extra.a == 1
    put(folder / "Patient.1.ndjson", {"id": "2", "extra": {"b": "x"}, "more": True})
    table = land(spark, folder, out, widen=True)
    rows = {r.id: r for r in table.collect()}
    assert rows["1"].extra.a == 1 and rows["1"].extra.b is None and rows["1"].more is None
    assert rows["2"].extra.b == "x" and rows["2"].more is True and len(batches(out)) == 2
    # A type that does not fit: one schema for all.
    put(folder / "Patient.2.ndjson", {"id": "3", "extra": {"a": "text"}})
    rows = {r.id: r for r in land(spark, folder, out, widen=True).collect()}
    assert rows["1"].extra.a == "1" and rows["3"].extra.a == "text" and rows["2"].more is True


def test_another_schema_is_another_table(spark, places):
    folder, out = places
    put(folder / "Patient.ndjson", {"id": "1", "gender": "x"})
    assert land(spark, folder, out, schema="id string").columns == ["id", CORRUPT]
    assert land(spark, folder, out, schema="id string, gender string").first().gender == "x"


def test_summary_needs_no_table(spark, places):
    folder, out = places
    put(folder / "Patient.0.ndjson", {"id": "1"}, "not json", {"id": "2"})
    put(folder / "Patient.1.ndjson")
    put(folder / "Condition.ndjson", {"id": "c"})
    tables = landing.land_sources(resource_sources(spark, str(folder)), str(out))
    assert set(tables) == {"patient", "condition"}
    summary = landing.landed_summary(spark, str(out), tables)
    assert {(r.resource, r.rows, r.corrupt_rows) for r in summary.collect()} == {("patient", 3, 1), ("condition", 1, 0)}
    assert not any("batch-" in f for f in summary.inputFiles())


def test_a_write_that_breaks_keeps_the_table(spark, places):
    folder, out = places
    put(folder / "Patient.0.ndjson", {"id": "1"})
    land(spark, folder, out)
    put(folder / "Patient.1.ndjson", {"id": "2"})
    source = ndjson_source(spark, str(folder), "Patient")

    def broken(wanted):
        return source.scan(wanted).withColumn("id", F.raise_error(F.lit("lost")).cast("string"))

    with pytest.raises(Exception, match="lost"):
        landing.land_sources({"t": landing.Source(source.files, broken, source.request)}, str(out))
    assert ids(landing.landed(spark, str(out), "t")) == ["1"]
    assert ids(land(spark, folder, out)) == ["1", "2"]


def test_a_file_that_changes_meanwhile_is_told(spark, places):
    folder, out = places
    put(folder / "Patient.0.ndjson", {"id": "1"})
    source = ndjson_source(spark, str(folder), "Patient")

    def late(wanted):
        return source.scan(wanted).withColumn(landing.SOURCE, F.lit("another"))

    with pytest.raises(RuntimeError, match="changed while it was landed: another"):
        landing.land_sources({"t": landing.Source(source.files, late, source.request)}, str(out))


def zipped(path, kind, **entries):
    with zipfile.ZipFile(path, "w", kind) as z:
        for name, rows in entries.items():
            z.writestr(f"x/{name}.ndjson", "".join(json.dumps(r) + "\n" for r in rows))


def test_archives_are_read_once(spark, places):
    folder, out = places
    one = folder / "one.zip"
    zipped(one, zipfile.ZIP_DEFLATED, Patient=[{"id": f"p{i}"} for i in range(50)], Condition=[{"id": "c"}])

    def again():
        return landing.land_sources({"t": archive_source(spark, str(folder), "Patient")}, str(out))["t"]

    assert len(ids(again())) == 50
    # A body that cannot be unpacked, behind the same directory, is not noticed.
    data, info = bytearray(one.read_bytes()), zipfile.ZipFile(one).infolist()[0]
    begin = info.header_offset + 30 + len(info.filename)
    data[begin : begin + info.compress_size] = b"\xff" * info.compress_size
    one.write_bytes(data)
    assert len(ids(again())) == 50 and len(batches(out)) == 1
    # An archive beside it is read alone.
    zipped(folder / "two.zip", zipfile.ZIP_STORED, **{"Patient_1": [{"id": "q"}], "Patient_2": [{"id": "r"}]})
    assert ids(again())[-2:] == ["q", "r"] and len(ids(again())) == 52
    # Another entry of the same size: only its own rows change.
    zipped(folder / "two.zip", zipfile.ZIP_STORED, **{"Patient_1": [{"id": "q"}], "Patient_2": [{"id": "s"}]})
    assert ids(again())[-2:] == ["q", "s"] and len(ids(again())) == 52
