"""Types by path: how often lines are read and values told."""

from chartfold.operators.types import path_types


def test_types_are_counted_in_one_scan_and_told_once_for_each_value(spark):
    lines = ['{"a": {"b": {"c": [1, "x"]}}, "d": 1}', "broken"]
    found = path_types(spark.createDataFrame([(x,) for x in lines], "line string"), "line")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1
    # The paths are a, a.b, a.b.c, a.b.c[] and d.
    assert plan.count("SchemaOfVariant") == 5
    assert {(r.path, r.type, r.n) for r in found.collect()} == {
        ("", "CORRUPT", 1), ("a", "OBJECT", 1), ("a.b", "OBJECT", 1), ("a.b.c", "ARRAY", 1),
        ("a.b.c[]", "BIGINT", 1), ("a.b.c[]", "STRING", 1), ("d", "BIGINT", 1),
    }
