"""The registered queries against their SQL twins.

The smallest data set and a cross-section by default; ``ORDERLENS_ALL=1`` runs every query.
"""

import os
from datetime import datetime
from decimal import Decimal

import pytest

import __spark_entry__ as entry_points
from registry.oracle import ORACLE
from registry.queries import QUERIES

duckdb = pytest.importorskip("duckdb")

BASE = "/root/testdata/sf0.001"
TABLES = ["customer", "part", "orders", "lineitem"]
SAMPLE = [
    "orders_enriched", "customer_clv_daily", "customer_rfm_segments", "customer_churn_indicators",
    "sales_trends", "loyalty_comparison", "location_performance", "discount_effectiveness",
    "serve_home_kpis", "serve_rfm_p95_points", "serve_hist_gap", "serve_basket_box",
    "dq_numeric_summary", "dq_join_quality_dates", "src_csv_typed", "observe_counts",
]
NAMES = sorted(QUERIES) if os.environ.get("ORDERLENS_ALL") else SAMPLE


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{BASE}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    return value.isoformat() if isinstance(value, datetime) else value


def _sorted(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in records]
    return sorted(columns), sorted(plain, key=lambda r: [(x is not None, str(x)) for x in r])


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, database, name):
    df = entry_points.queries()[name](spark, BASE)
    result = database.execute(entry_points.oracle_sql()[name])
    expected = _sorted([c[0] for c in result.description], result.fetchall())
    assert _sorted(df.columns, df.collect()) == expected


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() == 25
