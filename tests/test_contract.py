"""Driver contract: entry() smoke and every registered query against its DuckDB oracle (sf0.001)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from citymotion.plans import registry
from tools.check_oracle import TABLES, rows

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "route_id" in df.columns


def test_every_query_has_oracle():
    assert set(registry.ORACLE) == set(registry.QUERIES)


def test_queries_match_oracle(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    bad = []
    for name, fn in registry.QUERIES.items():
        c1, r1 = rows(fn(spark, SF).toPandas())
        c2, r2 = rows(con.execute(E.oracle_sql()[name]).df())
        if c1 != c2 or r1 != r2:
            bad.append(name)
    assert bad == []
