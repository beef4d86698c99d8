"""Driver contract: entry runs; every registered query matches its DuckDB oracle at sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and "pass_pct" in df.columns


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
def test_queries_match_oracle(spark):
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    bad = []
    for name, fn in qs.items():
        df = fn(spark, SF)
        rows = [tuple(r) for r in df.collect()]
        if name not in sqls:
            continue
        res = con.execute(sqls[name])
        ocols = [d[0] for d in res.description]
        orows = res.fetchall()
        if sorted(df.columns) != sorted(ocols) or digest(rows, df.columns) != digest(orows, ocols):
            bad.append(name)
    assert not bad
