"""The test bed's joins: tasks follow the rows."""

from chartfold.plans import testbed


def test_tasks_that_join_line_items_follow_their_number(spark, tmp_path, monkeypatch):
    ids = spark.range(1000)
    ids.selectExpr("id o_orderkey", "id % 10 o_custkey", "'F' o_orderstatus").write.parquet(str(tmp_path / "orders.parquet"))
    ids.selectExpr("id p_partkey", "'n' p_name", "'b' p_brand", "'t' p_type", "1 p_size").write.parquet(str(tmp_path / "part.parquet"))
    lines = ids.selectExpr("id l_orderkey", "id l_partkey", "cast(1 as int) l_linenumber", "'R' l_returnflag", "'F' l_linestatus")
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    few = testbed.clinical_tables(spark, str(tmp_path), ["condition"])["condition"]
    monkeypatch.setattr(testbed, "LINES_PER_TASK", 50)
    many = testbed.clinical_tables(spark, str(tmp_path), ["condition"])["condition"]
    assert many._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression") == 2
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect())) and many.count() == 1000


def small_tables(spark, path):
    ids = spark.range(300)
    ids.selectExpr("id o_orderkey", "id % 10 o_custkey").write.parquet(f"{path}/orders.parquet")
    parts = ids.selectExpr("id % 200 p_partkey", "concat('n', id) p_name", "concat('b', id) p_brand", "'t' p_type", "1 p_size")
    parts.write.parquet(f"{path}/part.parquet")
    # Parts occur once or twice; some line items have no part, some no order.
    lines = ids.selectExpr(
        "if(id % 50 = 0, null, id + 5) l_orderkey", "if(id % 41 = 0, null, id % 220) l_partkey", "cast(id as int) l_linenumber",
        "case when id % 3 = 0 then 'R' when id % 3 = 1 then 'N' end l_returnflag", "'O' l_linestatus",
        "timestamp_ntz'2002-02-03' l_shipdate",
    )
    lines.write.parquet(f"{path}/lineitem.parquet")


def test_tasks_that_join_parts_follow_the_line_items(spark, tmp_path, monkeypatch):
    small_tables(spark, tmp_path)
    for name in ("condition", "medicationrequest"):
        before = testbed.clinical_tables(spark, str(tmp_path), [name])[name].collect()
        with monkeypatch.context() as m:
            m.setattr(testbed, "LINES_PER_TASK", 10)
            m.setattr(testbed, "SENT_PARTS", 100)
            many = testbed.clinical_tables(spark, str(tmp_path), [name])[name]
        # Both sides of both joins have their tasks told, 30 each.
        assert many._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression") == 4
        assert before and sorted(map(str, before)) == sorted(map(str, many.collect()))


def test_stored_tables_are_joined_once(spark, tmp_path):
    small_tables(spark, tmp_path)
    for name in ("condition", "medicationrequest"):
        asked = testbed.clinical_tables(spark, str(tmp_path), [name])[name]
        stored = testbed.clinical_tables(spark, str(tmp_path), [name], stored=True)[name]
        assert "Join" not in stored._jdf.queryExecution().optimizedPlan().toString()
        assert asked.schema == stored.schema and sorted(map(str, asked.collect())) == sorted(map(str, stored.collect()))
