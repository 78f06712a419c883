"""Edge rows, heavy keys and plan shapes of the rollups and the master table."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from chartfold.functions.features import has_condition
from chartfold.operators.joins import broadcast_if_small, left_join_all, lookup, smallest_keys
from chartfold.operators.rollup import rollup, whole_lists
from chartfold.plans import master as m
from chartfold.schemas import MASTER, RESOURCES
from chartfold.shared import settled

DIABETES = "Diabetes mellitus type 2 (disorder)"


def coding(*pairs):
    return {"coding": [{"code": c, "display": d} for c, d in pairs]}


def sub(ref):
    return {"reference": ref}


PATIENTS = [
    {"id": i, "birthDate": b, "gender": "female", "name": None, "address": None, "maritalStatus": None}
    for i, b in [("p1", "1990-05-01"), ("p2", "1990-05"), ("p3", None), ("dup", "2000-02-29"), ("dup", "2000-02-29")]
]
CONDITIONS = [
    {"id": "c1", "subject": sub("Patient/p1"), "code": coding(("44054006", DIABETES))},
    {"id": "c2", "subject": sub("Patient/p1"), "code": coding(("44054006", DIABETES))},
    {"id": "c3", "subject": sub("Patient/p1"), "code": coding(("44054006", "T2DM"))},
    {"id": "c4", "subject": sub("Patient/p2"), "code": {"coding": None}},
    {"id": "c5", "subject": sub("Patient/p2"), "code": {"coding": []}},
    {"id": "c6", "subject": None, "code": coding(("1", "x"))},
    {"id": "c7", "subject": sub("urn:uuid:1"), "code": coding(("1", "x"))},
    {"id": "c8", "subject": sub("Patient/ghost"), "code": coding(("1", "x"))},
    {"id": "c9", "subject": sub("https://h/fhir/Patient/p3"), "code": coding(("1", "x"))},
]
MEDICATIONS = [
    {"id": i, "status": "active", "intent": "order", "authoredOn": "2020-01-01", "subject": sub(s),
     "encounter": e, "medicationCodeableConcept": coding(("7", "seven"))}
    for i, s, e in [("m1", "Patient/p1", sub("Encounter/e1")), ("m2", "Patient/p1", None), ("m3", "Patient/dup", None)]
]
ENCOUNTERS = [
    {"id": "e1", "status": "done", "class": {"code": "AMB"}, "type": [coding(("t", "T"))],
     "period": {"start": "2020", "end": None}, "subject": sub("Patient/p1"),
     "serviceProvider": sub("Organization/o1")},
    {"id": "e2", "status": "done", "class": None, "type": None, "period": None,
     "subject": sub("Patient/p1"), "serviceProvider": None},
]


@pytest.fixture(scope="module")
def tables(spark):
    rows = {"patient": PATIENTS, "condition": CONDITIONS, "medicationrequest": MEDICATIONS, "encounter": ENCOUNTERS}
    return {name: spark.createDataFrame(data, RESOURCES[name]) for name, data in rows.items()}


def many_encounters(tables):
    """The same with a patient whose encounters fill several pages, however
    they are dealt."""
    more = tables["encounter"].where("id = 'e2'").selectExpr("explode(sequence(1, 12)) i", "*")
    more = more.withColumn("id", F.concat(F.lit("x"), "i")).drop("i")
    return {**tables, "encounter": tables["encounter"].unionByName(more)}


def exchanges(df):
    # Reading the plan of a run needs the final adaptive plan.
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return plan.count("Exchange hashpartitioning")


def test_master_edges(tables, spark):
    master = m.patient_master(tables)
    expected = spark.createDataFrame([], MASTER).schema
    assert [(f.name, f.dataType.simpleString()) for f in master.schema] == [
        (f.name, f.dataType.simpleString()) for f in expected
    ]
    rows = master.collect()
    assert sorted(r.patient_id for r in rows) == ["dup", "dup", "p1", "p2", "p3"]
    by_id = {r.patient_id: r for r in rows}
    p1 = by_id["p1"]
    assert p1.condition_count == 1
    assert [tuple(c) for c in p1.conditions] == [("44054006", DIABETES), ("44054006", "T2DM")]
    assert p1.medication_count == 2 and [x.medication_id for x in p1.medications] == ["m1", "m2"]
    assert [x.encounter_id for x in p1.medications] == ["e1", None]
    assert p1.encounter_count == 2
    assert tuple(p1.encounters[0]) == ("e1", "done", "t", "T", "2020", None, "AMB", "o1")
    assert tuple(p1.encounters[1])[2:] == (None,) * 6
    p2 = by_id["p2"]
    assert p2.condition_count == 0 and [tuple(c) for c in p2.conditions] == [(None, None)]
    p3 = by_id["p3"]
    assert p3.conditions is None and p3.condition_count is None and p3.list_pages == 1
    flags = {r.patient_id: r.f for r in master.select("patient_id", has_condition("conditions", DIABETES).alias("f")).collect()}
    assert flags == {"p1": 1, "p2": 0, "p3": 0, "dup": 0}
    check = m.master_invariants(tables["patient"], master, m.patient_tally(tables))
    row = check.first()
    assert (row.patients, row.master_rows, row.duplicate_keys, row.doubled_pages) == (5, 5, 1, 0)
    m.check_master(check)


def test_a_wrong_master_is_caught(tables):
    tables = many_encounters(tables)
    tally, master = m.patient_tally(tables), m.patient_master(tables, page_rows=1)
    m.check_master(m.master_invariants(tables["patient"], master, tally))
    doubled = master.unionAll(master.where("patient_id = 'p1' and page = 1"))
    short = master.where("not (patient_id = 'p1' and page = 1)")
    lost = master.where("patient_id <> 'p2'")
    for wrong in (doubled, short, lost):
        with pytest.raises(ValueError, match="master table is wrong"):
            m.check_master(m.master_invariants(tables["patient"], wrong, tally))


def test_aggregates_keep_dangling_patients(tables):
    counts = {r.patient_id: r.condition_count for r in m.clinical_rollup("conditions", tables).collect()}
    # The second part of an absolute URL is empty.
    assert counts == {"p1": 1, "p2": 0, "ghost": 1, "": 1}
    robust = m.condition_rows(tables["condition"], absolute=True)
    assert robust.where("patient_id = 'p3'").count() == 1


def test_counts_agree_with_lists(tables):
    lists = m.patient_master(tables)
    counts = m.patient_counts(tables)
    columns = ["patient_id", "condition_count", "medication_count", "encounter_count"]
    assert Counter(map(tuple, lists.select(columns).collect())) == Counter(map(tuple, counts.select(columns).collect()))
    assert m.master_quality(lists).collect() == m.master_quality(counts).collect()


def test_quality_of_nothing(tables):
    empty = {k: df.limit(0) for k, df in tables.items()}
    q = m.master_quality(m.patient_counts(empty)).first()
    assert q.total_patients == 0 and q.conditions_pct == 0 and q.avg_conditions == 0


def test_one_exchange_per_rollup(tables, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for kind in m.KINDS:
            assert exchanges(m.clinical_rollup(kind, tables)) == 1
        # One per rollup and one for the patients; the joins add none.
        assert exchanges(m.patient_master(tables)) == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_broadcast_only_when_small(tables):
    rows = m.clinical_rollup("conditions", tables)
    assert "hint" in broadcast_if_small(rows)._jdf.queryExecution().logical().toString().lower()
    assert "hint" not in broadcast_if_small(rows, 10)._jdf.queryExecution().logical().toString().lower()
    hinted = m.patient_master(tables, broadcast_bytes=10**6)
    assert Counter(map(str, hinted.collect())) == Counter(map(str, m.patient_master(tables).collect()))


def skewed_rows(spark):
    rng = random.Random(5)
    rows = [("hot", f"c{rng.randrange(40)}", f"d{rng.randrange(3)}") for _ in range(300)]
    rows += [("hot", "same", "copy")] * 150 + [("hot", None, f"free{i % 25}") for i in range(50)]
    rows += [("onecopy", "x", "y")] * 120
    rows += [(f"k{i % 30}", f"c{rng.randrange(5)}", None) for i in range(100)] + [(None, "n", "n")] * 40
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "k string, code string, name string").repartition(5)


@pytest.mark.parametrize("distinct", [False, True])
def test_heavy_keys_are_paged_whole(spark, distinct):
    rows, df = skewed_rows(spark)
    page_rows = 16
    result = rollup(df, "k", ["code", "name"], "items", "n", distinct, "code" if distinct else None, page_rows)
    got = defaultdict(Counter)
    pages = defaultdict(list)
    want = defaultdict(Counter)
    for k, code, name in rows:
        if k is not None:
            want[k][(code, name)] += 1
    n_rows = Counter(k for k, _, _ in rows)
    if distinct:
        want = {k: Counter(dict.fromkeys(c, 1)) for k, c in want.items()}
    for r in result.collect():
        got[r.k].update(tuple(i) for i in r["items"])
        pages[r.k].append(r.page)
        assert len(r["items"]) <= 4 * page_rows
        key = lambda i: tuple(("" if v is None else "v" + v) for v in i)
        assert [key(i) for i in r["items"]] == sorted(key(i) for i in r["items"])
        n = len({c for c, _ in want[r.k] if c is not None}) if distinct else n_rows[r.k]
        assert (r.n, r.row_count) == (n, n_rows[r.k]), r.k
    assert got == want
    assert all(sorted(p) == list(range(len(p))) for p in pages.values())
    told = {r.k: r.list_pages for r in result.collect()}
    assert told == {k: len(p) for k, p in pages.items()}
    assert told["hot"] > 1 and told["k1"] == 1 and (told["onecopy"] == 1) == distinct
    assert Counter(map(str, result.collect())) == Counter(map(str, result.collect()))
    with pytest.raises(ValueError, match="more than one page"):
        whole_lists(result)
    assert "page" not in whole_lists(result.where("k = 'k1'")).columns


def test_left_join_spreads_rows_without_a_key(spark):
    base_rows = [("hot", "same")] * 60 + [("hot", f"v{i}") for i in range(20)] + [(None, "z")] * 30
    base_rows += [(f"k{i}", "o") for i in range(10)]
    base = spark.createDataFrame(base_rows, "k string, v string").repartition(4)
    one = spark.createDataFrame([("hot", 1), ("k1", 2), (None, 9)], "k string, a int")
    two = spark.createDataFrame([("hot", 3), ("k2", 4)], "k string, b int")
    joined = left_join_all(base, [one, two], "k")
    plain = base.join(one, "k", "left").join(two, "k", "left")
    assert joined.columns == plain.columns == ["k", "v", "a", "b"]
    assert Counter(map(tuple, joined.collect())) == Counter(map(tuple, plain.collect()))


def listed(master, kind):
    """Items by patient over all pages, of one row of each id."""
    got = defaultdict(Counter)
    seen = set()
    for r in master.collect():
        if (r.patient_id, r.page) not in seen:
            seen.add((r.patient_id, r.page))
            got[r.patient_id].update(map(str, r[kind] or []))
    return got


def test_master_with_heavy_patients_is_whole(tables):
    tables = many_encounters(tables)
    whole = m.patient_master(tables)
    paged = m.patient_master(tables, page_rows=1)
    counts = ["patient_id", "condition_count", "medication_count", "encounter_count", "birthDate"]
    first = paged.where("page = 0")
    assert Counter(map(tuple, first.select(counts).collect())) == Counter(map(tuple, whole.select(counts).collect()))
    for kind in m.KINDS:
        assert listed(paged, kind) == listed(whole, kind)
    pages = defaultdict(set)
    for r in paged.collect():
        pages[r.patient_id].add(r.page)
        assert r.list_pages >= 1
    assert len(pages["p1"]) > 1 and pages["p3"] == {0}


def test_lookup(spark):
    rows, df = skewed_rows(spark)
    wanted = ["k1", "hot", "nobody"] + ["k2"] * 40
    keys = spark.createDataFrame([(k,) for k in wanted], "k string").repartition(3)
    got = lookup(keys, df, "k", ["code"], "codes", 16).collect()
    found, answers = Counter(), Counter()
    for r in got:
        found[r.k] += len(r.codes)
        answers[r.k] += 1
    have = Counter(k for k, _, _ in rows)
    assert set(answers) == set(wanted) and answers["k2"] == 40 and answers["nobody"] == 1 and answers["hot"] > 1
    assert found == {"k1": have["k1"], "hot": 500, "nobody": 0, "k2": 40 * have["k2"]}


def test_flag_sees_all_pages(tables):
    paged = m.patient_master(tables, page_rows=1)
    for disease in (DIABETES, "T2DM"):
        rows = m.with_flag(paged, disease).collect()
        assert Counter(r.patient_id for r in rows) == Counter({"p1": 1, "p2": 1, "p3": 1, "dup": 2})
        assert {r.patient_id: r.flag for r in rows} == {"p1": 1, "p2": 0, "p3": 0, "dup": 0}


def test_counts_add_up(spark):
    from chartfold.plans.testbed import clinical_tables

    t = clinical_tables(spark, "/root/testdata/sf0.001")
    tally = m.patient_tally(t)
    for page_rows in (50_000, 4):
        master = m.patient_master(t, page_rows, tally=tally)
        total = master.where("page = 0").agg(F.sum("medication_count"), F.sum("encounter_count")).first()
        items = master.agg(F.sum(F.size("medications")), F.sum(F.size("encounters"))).first()
        assert tuple(total) == tuple(items)
        m.check_master(m.master_invariants(t["patient"], master, tally))


def test_fanout(tables):
    got = {r.patient_id: int(r.naive_rows) for r in m.join_fanout(tables).collect()}
    assert got == {"p1": 1 * 3 * 2 * 2}


def test_sample(tables):
    rows = m.sample_rollup("conditions", tables, 1).collect()
    assert [r.patient_id for r in rows] == ["ghost"]


def test_sample_of_a_heavy_patient_is_whole(spark):
    code = F.struct(F.array(F.struct(F.concat(F.lit("k"), F.col("id")).alias("code"), F.lit("d").alias("display"))).alias("coding"))
    many = spark.range(60_000).select(
        F.col("id").cast("string").alias("id"), F.struct(F.lit("Patient/a").alias("reference")).alias("subject"), code.alias("code")
    )
    rows = m.sample_rollup("conditions", {"condition": many}).collect()
    assert len(rows) > 1 and sum(len(r.conditions) for r in rows) == 60_000
    assert {r.condition_count for r in rows} == {60_000}


def test_sample_of_urls_and_of_many_keys(spark):
    rows = [(f"c{i}", (f"https://h/fhir/Patient/{i % 700:03d}",), ([("k", "n")],)) for i in range(3000)]
    condition = spark.createDataFrame(rows, RESOURCES["condition"]).repartition(7)
    got = m.sample_rollup("conditions", {"condition": condition}, 3, absolute=True).collect()
    assert sorted((r.patient_id, r.row_count) for r in got) == [("000", 5), ("001", 5), ("002", 5)]
    keys = smallest_keys(spark.range(5000).selectExpr("cast(id % 90 as string) k").repartition(6), "k", 4)
    assert sorted(r.k for r in keys.collect()) == ["0", "1", "10", "11"]
    assert smallest_keys(spark.createDataFrame([], "k string"), "k", 4).count() == 0


def test_rollup_counts_narrowly_or_not_at_all(spark, tables, monkeypatch):
    from chartfold.operators import heavy

    plans = []
    monkeypatch.setattr(heavy, "settled", lambda df: plans.append(df) or settled(df))
    stored = {k: settled(v) for k, v in tables.items()}
    plain = m.clinical_rollup("conditions", stored)
    (counted,) = plans
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<subject:struct<reference:string>>" in plan
    tally = m.patient_tally(stored)
    known = m.clinical_rollup("conditions", stored, tally=tally)
    assert "subject" not in plans[1]._jdf.queryExecution().executedPlan().toString()
    assert Counter(map(str, known.collect())) == Counter(map(str, plain.collect()))
