from collections import Counter

from pyspark.sql import functions as F

from chartfold.functions.features import age_years, has_condition
from chartfold.functions.fields import first, first_coding, ref_id
from chartfold.operators import sketches
from chartfold.operators.profile import null_profile, raw_quality
from chartfold.plans import analysis
from chartfold.schemas import RESOURCES


def column(spark, values, ddl, expr):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {ddl}").select("i", expr.alias("out"))
    return [r.out for r in df.orderBy("i").collect()]


def test_age(spark):
    births = ["2000-02-29", "2000-03-01", "1990-05", "1990", None, "junk", "2001-02-28", "1990-13-01"]
    assert column(spark, births, "string", age_years("v", "2001-02-28")) == [0, 0, None, None, None, None, 0, None]
    assert column(spark, births[:2], "string", age_years("v", "2001-03-01")) == [1, 1]
    assert column(spark, ["2000-6-5", "20000-06-05"], "string", age_years("v", "2001-06-05")) == [1, None]
    assert column(spark, ["2000-06-15"], "string", age_years("v", "2020-06-15")) == [20]
    assert column(spark, ["2000-06-15"], "string", age_years("v", F.lit("2020-06-14").cast("date"))) == [19]
    assert column(spark, ["1900-01-01"], "string", age_years("v"))[0] > 120


def test_reference_ids(spark):
    refs = ["Patient/p1", "urn:uuid:1", "https://h/fhir/Patient/1", None, "", "Patient/1/_history/2"]
    assert column(spark, refs, "string", ref_id("v")) == ["p1", None, "", None, None, "1"]
    assert column(spark, refs[:4], "string", ref_id("v", absolute=True)) == ["p1", "urn:uuid:1", "1", None]


def test_first_elements(spark):
    assert column(spark, [["a", "b"], [], None, [None]], "array<string>", first("v")) == ["a", None, None, None]
    concepts = [{"coding": [{"code": "x"}, {"code": "y"}]}, {"coding": []}, {"coding": None}, None]
    got = column(spark, concepts, "struct<coding:array<struct<code:string>>>", first_coding("v")["code"])
    assert got == ["x", None, None, None]


def test_has_condition_is_exact(spark):
    lists = [
        [("1", "Diabetes")], [("1", "diabetes")], [("1", "Diabetes type")], [("1", None), ("2", "Diabetes")], [], None,
    ]
    ddl = "array<struct<condition_code:string,condition_name:string>>"
    assert column(spark, lists, ddl, has_condition("v", "Diabetes")) == [1, 0, 0, 1, 0, 0]


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, None), (3, "y", None)], "`a b` int, b string, c string")
    got = [tuple(r) for r in null_profile(df).orderBy("column").collect()]
    assert got == [("b", 3, 2, 66.67), ("c", 3, 2, 66.67)]
    assert [r.column for r in null_profile(df, 2).collect()] == ["b"]
    assert null_profile(df.limit(0)).collect() == []
    both = raw_quality({"one": df, "two": df.select("a b")}).collect()
    assert {(r.table, r.column, r.total_columns) for r in both} == {("one", "b", 3), ("one", "c", 3)}
    wide = spark.range(1).select(*[F.lit(None).cast("int").alias(f"c{i}") for i in range(12)])
    assert null_profile(wide).count() == 12 and null_profile(wide, 10).count() == 10


def test_flags_need_no_conditions(spark):
    patient = spark.createDataFrame(
        [("1", None, None, None, None, None), ("2", None, None, None, None, None)],
        RESOURCES["patient"],
    )
    condition = spark.createDataFrame(
        [("c", ("Patient/1",), ([("k", "A")],)), ("d", ("Patient/1",), ([("k", "A")],))],
        "id string, subject struct<reference:string>, code struct<coding:array<struct<code:string,display:string>>>",
    )
    got = analysis.condition_flags(patient, condition, ["A", "B"]).collect()
    assert sorted(map(tuple, got)) == [("1", "A", 1), ("1", "B", 0), ("2", "A", 0), ("2", "B", 0)]


def test_hits_and_flags_of_urls(spark):
    patient = spark.createDataFrame([(i, *[None] * 5) for i in ("1", "2", None)], RESOURCES["patient"])
    condition = spark.createDataFrame(
        [("c", ("https://h/fhir/Patient/1",), ([("k", "A")],)), ("d", ("https://h/fhir/Patient/1",), ([("k", "A")],)),
         ("e", ("https://h/fhir/Patient/2",), ([("k", "B")],)), ("f", ("https://h/fhir/Patient/ghost",), ([("k", "A")],)),
         ("g", ("https://h/fhir/Patient/2",), ([("k", None)],))],
        RESOURCES["condition"],
    )
    names = spark.range(10_000).selectExpr("if(id = 7, 'A', if(id = 8, null, concat('n', id))) disease")
    got = analysis.condition_hits(patient, condition, names, absolute=True).collect()
    assert sorted(map(tuple, got)) == [("1", "A")]
    assert analysis.condition_hits(patient, condition, names).count() == 0
    flags = analysis.condition_flags(patient, condition, ["A", "B"], absolute=True).collect()
    assert {(r[0], r[1]) for r in flags if r.flag} == {("1", "A"), ("2", "B")} and len(flags) == 6
    flag = analysis.disease_flag(patient, condition, "A", absolute=True).collect()
    assert Counter(map(tuple, flag)) == Counter([("1", 1), ("2", 0), (None, 0)])


def test_sketches_merge(spark):
    rows = spark.range(20_000).selectExpr("id % 50 k", "id % 4000 v", "cast(null as string) nothing")
    first, second = (sketches.sketch(rows.where(f"k % 2 = {i}"), ["k"], {"v": "v", "nothing": "nothing"}) for i in (0, 1))
    both = first.unionByName(second)
    got = sketches.estimates(both, [], ["v", "nothing"]).first()
    assert abs(got.v - 4000) <= 0.05 * 4000 and got.nothing == 0
    assert sketches.merged(both, ["k"], ["v"]).count() == 50
