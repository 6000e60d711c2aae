"""Driver contract: keys, oracle SQL validity, entry schema."""

from __future__ import annotations

import os

import duckdb

import __spark_entry__ as contract
from conftest import SF_SMALL
from vigil.schemas import REPORT


def test_keys_match():
    assert set(contract.QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())
    assert len(contract.QUERIES) >= 36


def test_oracle_sql_runs_in_duckdb():
    con = duckdb.connect()
    for t in sorted(f.removesuffix(".parquet") for f in os.listdir(SF_SMALL)):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for name, sql in contract.oracle_sql().items():
        cols = [d[0] for d in con.execute(sql).description]
        assert len(cols) == len(set(cols)), name  # every column named once


def test_entry_schema(spark):
    df = contract.entry(spark)
    assert [(f.name, f.dataType) for f in df.schema.fields] == \
        [(f.name, f.dataType) for f in REPORT.fields]
    assert df.count() > 0
    assert os.path.isdir(SF_SMALL)
