"""The driver contract: entry runs, every query has a name, oracles name
only registered queries, columns match the oracle's."""

import duckdb
import pytest

import __spark_entry__ as entry
from eddy.session import TABLES

from .conftest import SF_SMALL


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"window_start", "window_end", "event_type", "n"}


def test_oracles_are_registered():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_columns_match_oracle(spark, duck, name):
    sql = entry.oracle_sql()[name]
    cols = [d[0] for d in duck.execute(f"SELECT * FROM ({sql}) LIMIT 0").description]
    assert sorted(cols) == sorted(entry.queries()[name](spark, SF_SMALL).columns)


def test_entry_schema_is_stable(spark):
    a = entry.entry(spark).schema.simpleString()
    b = entry.entry(spark).schema.simpleString()
    assert a == b == ("struct<window_start:timestamp_ntz,window_end:timestamp_ntz,"
                      "event_type:string,n:bigint>")
