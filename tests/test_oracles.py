"""Every registered query against SQL on another engine, over whole tables."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from cartlane.testbed.oracles import ORACLES
from cartlane.testbed.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages benchmark
    labels conversations""".split()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_query_of_the_tables_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    want = duck.sql(entry.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    kinds = dict(zip(want.columns, map(str, want.types)))
    got_kinds = {c: TYPES.get(t, t.upper()) for c, t in df.dtypes}
    assert {c: k.replace(" ", "") for c, k in got_kinds.items()} == {c: k.replace(" ", "") for c, k in kinds.items()}
    got = Counter(tuple(r) for r in df.select(*columns).collect())
    expected = Counter(want.project(", ".join(f'"{c}"' for c in columns)).fetchall())
    assert sum(expected.values()) > 0
    if got != expected:
        extra, missing = list((got - expected).items())[:3], list((expected - got).items())[:3]
        raise AssertionError(f"{sum(got.values())} rows, {sum(expected.values())} expected\n{columns}\n+ {extra}\n- {missing}")
