"""Every registered query against its SQL, over whole tables, by value."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return con


def test_registry():
    assert set(contract.QUERIES) == set(contract.ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def normal(value):
    # The sign of a zero and a float holding a whole number are no difference.
    if isinstance(value, float):
        return value + 0.0
    return value


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query(spark, duck, name):
    got = contract.queries()[name](spark, SF_DIR)
    cursor = duck.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(got.columns) == sorted(columns)
    want = Counter(tuple(map(normal, row)) for row in cursor.fetchall())
    rows = Counter(tuple(map(normal, row)) for row in got.select(*[f"`{c}`" for c in columns]).collect())
    assert sum(want.values()) > 0
    missing, surplus = want - rows, rows - want
    assert not missing and not surplus, (list(missing.items())[:3], list(surplus.items())[:3])


def test_entry(spark):
    assert contract.entry(spark).count() == 150
