"""Every registered query against its SQL in DuckDB on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as registry

SF_DIR = "/root/testdata/sf0.001"
QUERIES = {name: query for area in registry.AREAS for name, query in area.QUERIES.items()}
ORACLES = {name: registry.oracle_sql()[name] for name in QUERIES if name in registry.oracle_sql()}
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _canonical(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)

    def value(v):
        return None if isinstance(v, float) and math.isnan(v) else round(v, 9) if isinstance(v, float) else v

    return sorted((tuple(value(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = duck.sql(ORACLES[name])
    assert sorted(result.columns) == sorted(expected.columns)
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {f.name: TYPES[f.dataType.simpleString()] for f in result.schema} == types
    got = _canonical(result.columns, [tuple(r) for r in result.collect()])
    want = _canonical(expected.columns, expected.fetchall())
    assert got == want
    assert got


def test_entry(spark):
    rows = registry.entry(spark).collect()
    assert len(rows) == 15 and len({r.platform for r in rows}) == 5
