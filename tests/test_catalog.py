"""Every catalog query against its SQL twin on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from rollmark.plans.catalog import QUERIES
from rollmark.plans.twins import SQL

TABLES = Path("/root/testdata/sf0.001")
NAMES = "region nation customer supplier orders lineitem events".split()
TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
    "double": "DOUBLE", "boolean": "BOOLEAN",
}

pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = pytest.importorskip("duckdb").connect()
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TABLES}/{name}.parquet'")
    return con


def comparable(rows, order):
    return sorted(repr([row[i] for i in order]) for row in rows)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_twin(spark, duck, name):
    df = QUERIES[name](spark, str(TABLES))
    twin = duck.execute(SQL[name])
    columns = {d[0]: str(d[1]) for d in twin.description}
    assert sorted(df.columns) == sorted(columns)
    assert {c: TYPES[t] for c, t in df.dtypes} == columns
    ordered = sorted(columns)
    got = comparable(df.collect(), [df.columns.index(c) for c in ordered])
    assert got == comparable(twin.fetchall(), [list(columns).index(c) for c in ordered])
    assert got or name in ("missing_lookup_ids",)


def test_entry(spark):
    assert contract.entry(spark).columns == ["group_short_title", "attendance_mark", "marks"]
    assert set(SQL) == set(QUERIES) <= set(contract.queries())
