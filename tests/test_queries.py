"""Every registered query against its SQL on the smallest test tables."""

from __future__ import annotations

import os

import pytest
from conftest import SF_SMALL

import __spark_entry__ as entry_module
from riskweave.plans.oracle import ORACLE
from riskweave.plans.queries import QUERIES

duckdb = pytest.importorskip("duckdb")
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF_SMALL):
        pytest.skip("test tables are not here")
    con = duckdb.connect()
    for file in os.listdir(SF_SMALL):
        con.execute(f"create view {file.split('.')[0]} as select * from '{SF_SMALL}/{file}'")
    return con


def canonical(rows):
    cells = [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows]
    return sorted(cells, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    df = entry_module.queries()[name](spark, SF_SMALL)
    columns = sorted(df.columns)
    result = con.execute(entry_module.oracle_sql()[name])
    described = {d[0]: str(d[1]) for d in result.description}
    rows = result.fetchall()
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == described
    at = [list(described).index(c) for c in columns]
    expected = canonical([[r[i] for i in at] for r in rows])
    assert canonical(df.select(*columns).collect()) == expected


def test_entry(spark, con):
    assert entry_module.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
