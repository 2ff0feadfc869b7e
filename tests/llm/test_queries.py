"""Queries with SQL against DuckDB, on the smallest tables."""

from collections import Counter

import duckdb
import pytest

from ambry.llm import queries as q
from ambry.sources.tables import TABLES

SF_SMALL = "/root/testdata/sf0.001"


def test_entry_registers_all():
    import __spark_entry__ as E
    assert {*q.QUERIES, "pipeline"} <= set(E.queries())
    assert set(q.ORACLE) <= set(E.oracle_sql())


def _value(v):
    return round(v, 6) if isinstance(v, float) else tuple(v) if isinstance(v, list) else v


@pytest.mark.parametrize("name", sorted(q.ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = q.QUERIES[name](spark, SF_SMALL)
    rel = con.sql(q.ORACLE[name])
    assert sorted(df.columns) == sorted(rel.columns)
    mine = Counter(tuple(_value(v) for v in r) for r in df.select(*rel.columns).collect())
    assert mine == Counter(tuple(_value(v) for v in r) for r in rel.fetchall())
