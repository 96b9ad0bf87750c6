"""Every registered query against its SQL, on ORACLE_SF (default the smallest tables)."""

import datetime
import os
import time
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from eventloom.plans.catalog import QUERIES
from eventloom.plans.oracle import ORACLE

FOLDER = f"/root/testdata/sf{os.environ.get('ORACLE_SF', '0.001')}"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    started = time.time()
    got = contract.queries()[name](spark, FOLDER)
    columns = sorted(got.columns)
    got = got.select(*columns)
    rows = Counter(tuple(row) for row in got.collect())
    took = time.time() - started

    sql = f"select {', '.join(columns)} from ({contract.oracle_sql()[name]})"
    described = duck.execute(f"describe {contract.oracle_sql()[name]}").fetchall()
    kinds = {row[0]: row[1] for row in described}
    expected = Counter(duck.execute(sql).fetchall())
    assert kinds == {c: KINDS[t] for c, t in got.dtypes}
    assert sum(rows.values()) == sum(expected.values())
    assert rows == expected
    assert rows
    print(f"{name}: {sum(rows.values())} rows, {took:.2f} s")
