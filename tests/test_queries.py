"""Every registered query against its DuckDB oracle on the smallest data,
plus plan checks (no Python UDF, filters pushed to the scan)."""

import duckdb
import pytest

import __spark_entry__ as E
from tavola.plans import catalog
from tools.check import TABLES, rows_of

SF = "/root/testdata/sf0.001"
NAMES = sorted(catalog.QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"store_id", "concept", "store", "item", "uofm", "amount", "base_uofm", "base_amount"}


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.queries()) and set(NAMES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    s = E.queries()[name](spark, SF).toPandas()
    d = con.execute(E.oracle_sql()[name]).fetchdf()
    assert sorted(s.columns) == sorted(d.columns)
    assert rows_of(s) == rows_of(d)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_in_plans(spark):
    for name in ["menu_engineering", "weekly_base_cost_all", "product_mix_nested", "upsert_full"]:
        plan = _plan(E.queries()[name](spark, SF))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


@pytest.mark.parametrize("name, bound", [("weekly_item_base_cost", "LessThan"), ("weekly_base_cost_year", "LessThan"),
                                         ("stock_purchases", "GreaterThan"), ("theoretical_usage", "GreaterThan")])
def test_date_bound_reaches_scan(spark, name, bound):
    scans = [x for x in _plan(E.queries()[name](spark, SF)).splitlines() if "FileScan" in x and "o_orderdate" in x]
    assert scans
    for scan in scans:
        if "o_orderstatus,O" not in scan.replace(" ", "") or name != "stock_purchases":  # the tracked list has no date
            assert bound in scan.split("PushedFilters")[1].split("ReadSchema")[0], scan
