"""Types by path: variants against a walk over parsed JSON."""

import json
import random
import zipfile
from collections import Counter

from chartfold.operators.types import path_types, variants
from chartfold.sources.untyped import resource_types, scan_variants

KINDS = {str: "STRING", bool: "BOOLEAN", int: "BIGINT", float: "DECIMAL", type(None): "VOID", dict: "OBJECT", list: "ARRAY"}


def brute(lines):
    """(path, type): n by walking the records; absent fields are those that some
    other parent on the path has."""
    records, bad = [], 0
    for line in lines:
        if not line.strip():
            continue
        try:
            record = json.loads(line)
        except ValueError:
            record = None
        if isinstance(record, dict):
            records.append(record)
        else:
            bad += 1
    fields, counts, parents = {}, Counter(), Counter()

    def walk(value, path):
        if path:
            counts[path, KINDS[type(value)]] += 1
        if isinstance(value, dict):
            parents[path] += 1
            for name, inner in value.items():
                below = f"{path}.{name}" if path else name
                fields[below] = path
                walk(inner, below)
        if isinstance(value, list):
            for inner in value:
                walk(inner, f"{path}[]")

    for record in records:
        walk(record, "")
    for path, parent in fields.items():
        missing = parents[parent] - sum(n for (p, _), n in counts.items() if p == path)
        if missing:
            counts[path, "ABSENT"] = missing
    if bad:
        counts["", "CORRUPT"] = bad
    return counts


def made(choose, depth=0):
    kind = choose.randrange(9 if depth < 2 else 6)
    if kind >= 7:
        return {choose.choice(["a", "b", "c d", "x.y", "OBJECT<"]): made(choose, depth + 1) for _ in range(choose.randrange(4))}
    if kind == 6:
        return [made(choose, depth + 1) for _ in range(choose.randrange(3))]
    return [None, True, 7, "text", 1.5, "2020-01-01"][kind]


def test_against_a_walk(spark):
    choose = random.Random(5)
    lines = [json.dumps({name: made(choose) for name in choose.sample("pqrst", 3)}) for _ in range(120)]
    lines += ["not json", "[1, 2]", "   ", "", "{}"]
    df = spark.createDataFrame([(x,) for x in lines], "line string").repartition(3)
    got = {(r.path, r.type): r.n for r in path_types(df, "line").collect()}
    assert got == dict(brute(lines))
    assert variants(df, "line").where("record is null").count() == 2


def test_what_a_pinned_type_loses(spark):
    lines = ['{"id": 1, "on": "yes", "of": {"n": 2}, "l": [1, "x"], "more": 3}', '{"id": "a", "on": true, "of": "text", "l": {}}']
    pinned = "id string, on boolean, of struct<n:double>, l array<bigint>"
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    lost = {(r.path, r.type) for r in path_types(df, "line", pinned).collect() if r.lost}
    assert lost == {("on", "STRING"), ("of", "STRING"), ("l", "OBJECT"), ("l[]", "STRING"), ("more", "BIGINT")}
    # These are the values that the reader makes NULL.
    read = spark.read.schema(pinned).json(df.rdd.map(lambda r: r.line)).collect()
    assert [(r.id, r.on, r.of and r.of.n, r.l) for r in read][1] == ("a", True, None, None) and read[0].on is None


def test_folders_and_archives(spark, tmp_path):
    rows = [{"id": "1", "code": {"coding": []}}, {"id": "2", "code": "text", "stage": {"n": 1}}]
    text = "".join(json.dumps(r) + "\n" for r in rows) + "broken\n"
    (tmp_path / "Condition.ndjson").write_text(text)
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x/Condition.ndjson", text)
    told = [
        Counter(tuple(r) for r in resource_types(spark, str(tmp_path), "Condition", archives=archives).collect())
        for archives in (False, True)
    ]
    assert told[0] == told[1]
    assert {(p, t): (n, lost) for p, t, n, _, lost in told[0]} == {
        ("", "CORRUPT"): (1, True), ("id", "STRING"): (2, False), ("code", "OBJECT"): (1, False),
        ("code", "STRING"): (1, True), ("code.coding", "ARRAY"): (1, False), ("stage", "OBJECT"): (1, True),
        ("stage", "ABSENT"): (1, False), ("stage.n", "BIGINT"): (1, True),
    }
    found = scan_variants(spark, str(tmp_path), "Condition")
    assert sorted(r[0] for r in found.selectExpr("variant_get(record, '$.id', 'string')").collect() if r[0]) == ["1", "2"]
    assert scan_variants(spark, str(tmp_path), "Patient") is None and resource_types(spark, str(tmp_path), "Log") is None


def test_nothing(spark):
    assert path_types(spark.createDataFrame([], "line string"), "line", "id string").count() == 0
