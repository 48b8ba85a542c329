"""Every registered plan against its DuckDB SQL oracle on the smallest
driver tables (row count, column names, order-insensitive values)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tidewater.plans import registry
from tidewater.session import apply_defaults
from tidewater.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def _canon(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return str(v)


def _rows(tbl):
    cols = sorted(tbl.column_names)
    return cols, sorted("|".join(_canon(r[c]) for c in cols) for r in tbl.select(cols).to_pylist())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for name in TABLES:
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return c


def test_every_plan_has_an_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(registry.queries()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_plan_matches_oracle(spark, con, name):
    apply_defaults(spark)
    got = registry.queries()[name](spark, SF).toArrow()
    exp = con.sql(registry.oracle_sql()[name]).to_arrow_table()
    gc, gr = _rows(got)
    ec, er = _rows(exp)
    assert gc == ec
    assert len(gr) == len(er)
    assert gr == er


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
