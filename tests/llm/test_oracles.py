"""Corpus queries against their SQL on the smallest tables."""

import duckdb
import pytest

from tidewater.llm.queries import ORACLES, QUERIES
from tidewater.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def _rows(table):
    cols = sorted(table.column_names)
    return cols, sorted("|".join("" if v is None else repr(v) if isinstance(v, float) else str(v) for v in (r[c] for c in cols))
                        for r in table.select(cols).to_pylist())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    assert _rows(QUERIES[name](spark, SF).toArrow()) == _rows(con.sql(ORACLES[name]).to_arrow_table())


def test_queries_are_those_of_the_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
