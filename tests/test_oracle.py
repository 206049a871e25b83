"""Every registered query against its DuckDB SQL over the sf0.01 tables."""

import os

import duckdb
import pytest

from conftest import SF01
import tools.check_oracle as checker
from tools.check_oracle import DUCK_TYPES, TABLES, _rows

import __spark_entry__ as entry
from storepulse.plans import oracle, registry

QUERIES = registry.QUERIES
SQL = oracle.oracle_sql()
checker.EXACT = True   # floats compared bit for bit, not to 9 digits


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        path = f"{SF01}/{t}.parquet"
        if os.path.exists(path):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return c


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    sdf = QUERIES[name](spark, SF01)
    srows = [r.asDict() for r in sdf.collect()]
    rel = con.sql(SQL[name])
    drows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert sorted(sdf.columns) == sorted(rel.columns)
    stypes = {f.name: DUCK_TYPES.get(f.dataType.simpleString()) for f in sdf.schema.fields}
    assert stypes == dict(zip(rel.columns, (str(t) for t in rel.types)))
    assert len(srows) == len(drows)
    cols = sorted(sdf.columns)
    assert _rows(srows, cols) == _rows(drows, cols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["window_seq", "window_name"]
    assert df.count() == 3


def test_fixture_exercises_labels_names_and_nulls(spark):
    years = {r.fiscal_year for r in QUERIES["lot_fiscal_year"](spark, SF01).collect()}
    assert len(years) >= 5 and "None" in years
    model = QUERIES["lot_model"](spark, SF01)
    assert model.filter("first_store_name = store").isEmpty()
    for column in ("status", "expirydate"):
        assert not model.filter(f"{column} IS NULL").isEmpty()
    assert not QUERIES["lot_values"](spark, SF01).filter("territory IS NULL").isEmpty()
