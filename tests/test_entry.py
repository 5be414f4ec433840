"""Driver contract: entry() runs, every query has a name, the oracles run and match at sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from bazaar.plans.registry import QUERIES as BASE
from tools.oracle_check import TABLES, rows_key, type_diffs

SF = "/root/testdata/sf0.001"
REFERENCE = {k: v for k, v in E.oracle_sql().items() if k in BASE}  # the corpus queries have tests of their own


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["market_date", "total_estimated_trade_volume_usd", "total_active_supply",
                          "total_units_sold", "market_turnover_rate", "avg_bid_ask_spread_pct"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    from bazaar.plans.registry import ORACLE, QUERIES
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(ORACLE) == set(QUERIES) <= set(q)
    assert len(QUERIES) == 98


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(REFERENCE))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert type_diffs(df.schema, cur.description) == []
    assert rows_key(df.columns, [tuple(r) for r in df.collect()]) == rows_key(ocols, cur.fetchall())
