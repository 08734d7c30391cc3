from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderlens.config import Config
from orderlens.plans import customers

from conftest import rows

SCHEMA = (
    "user_id string, order_id string, restaurant_id string, order_date date, is_loyalty boolean,"
    " gross_revenue decimal(18,4), is_bulk_order_candidate boolean"
)
DAY = date(2024, 1, 1)
CFG = Config("Test")


def orders(spark, *entries):
    """Entries of (user, order, day offset, revenue[, loyalty[, bulk]])."""
    data = []
    for user, order, offset, revenue, *rest in entries:
        loyalty, bulk = (list(rest) + [False, False])[:2]
        day = None if offset is None else DAY + timedelta(days=offset)
        amount = None if revenue is None else Decimal(str(revenue))
        data.append((user, order, "R", day, loyalty, amount, bulk))
    return spark.createDataFrame(data, SCHEMA)


def test_running_totals_count_orders_and_bulk_orders(spark):
    df = orders(
        spark,
        ("u", "o1", 0, 10), ("u", "o1", 0, 5, False, True), ("u", "o2", 0, 1),
        ("u", "o3", 2, 4, False, True),
    )
    got = customers.customer_clv_daily(df, CFG)
    assert rows(
        got, "snapshot_date", "daily_revenue", "total_revenue_to_date", "orders_to_date",
        "avg_order_value", "bulk_orders_to_date", "has_bulk_order_candidate",
    ) == [
        (DAY, Decimal("16.0000"), Decimal("16.00"), 2, Decimal("8.00"), 1, True),
        (date(2024, 1, 3), Decimal("4.0000"), Decimal("20.00"), 3, Decimal("6.67"), 2, True),
    ]


def test_both_flags_on_one_day_are_two_rows_non_member_first(spark):
    df = orders(spark, ("u", "o1", 0, 10, True), ("u", "o2", 0, 1, False))
    got = customers.customer_clv_daily(df, CFG)
    assert rows(got, "is_loyalty", "total_revenue_to_date") == [
        (False, Decimal("1.00")), (True, Decimal("11.00")),
    ]


def test_tier_uses_the_highest_running_total_weighted_by_snapshots(spark):
    # "a" peaks at 100 and falls to 10; its two snapshots both count.
    df = orders(
        spark, ("a", "1", 0, 100), ("a", "2", 1, -90), ("b", "3", 0, 50), ("c", "4", 0, 50),
        ("d", "5", 0, 5),
    )
    got = customers.customer_clv_daily(df, CFG).select("user_id", "clv_tier").distinct()
    # Percent ranks over five rows: d 0, b and c 0.25, a 0.75.
    assert rows(got) == [("a", "Medium"), ("b", "Medium"), ("c", "Medium"), ("d", "Low")]
    by_customer = customers.customer_clv_daily(df, Config("Test", clv_population="customers"))
    # Over four customers: d 0, b and c 1/3, a 1.
    assert rows(by_customer.select("user_id", "clv_tier").distinct()) == [
        ("a", "High"), ("b", "Medium"), ("c", "Medium"), ("d", "Low"),
    ]


def test_rfm_window_is_inclusive_and_ties_go_by_user(spark):
    df = orders(
        spark,
        ("a", "1", 0, 1), ("edge", "2", -180, 1), ("out", "3", -181, 1), ("b", "4", 0, 1),
        ("c", "5", 0, 1), ("d", "6", 0, 1),
    )
    got = customers.customer_rfm_segments(df, CFG)
    assert rows(got, "user_id", "recency_days", "r_score", "f_score", "m_score", "rfm_segment") == [
        ("a", 0, 4, 1, 1, "New Customer"),
        ("b", 0, 4, 1, 1, "New Customer"),
        ("c", 0, 3, 2, 2, "New Customer"),
        ("d", 0, 2, 3, 3, "Regular"),
        ("edge", 180, 1, 4, 4, "Regular"),
    ]


def test_churn_windows_and_nulls(spark):
    df = orders(
        spark,
        ("now", "0", 0, 1),
        ("w", "1", -90, 30), ("w", "2", -91, 10), ("w", "3", -180, 10), ("w", "4", -181, 1000),
        ("lapsed", "5", -100, 10),
        ("zero", "6", -100, 0), ("zero", "7", -1, 5),
        ("d45", "8", -45, 1), ("d46", "9", -46, 1),
    )
    got = customers.customer_churn_indicators(df, CFG)
    assert rows(got, "user_id", "spend_last_90", "spend_prior_90", "spend_change_pct") == [
        ("d45", Decimal("1.00"), None, None),
        ("d46", Decimal("1.00"), None, None),
        ("lapsed", None, Decimal("10.00"), None),
        ("now", Decimal("1.00"), None, None),
        ("w", Decimal("30.00"), Decimal("20.00"), Decimal("50.00")),
        ("zero", Decimal("5.00"), Decimal("0.00"), None),
    ]
    flags = dict(rows(got, "user_id", "churn_risk_flag"))
    assert (flags["d45"], flags["d46"], flags["lapsed"]) == (False, True, True)
    gaps = dict(rows(got, "user_id", "avg_order_gap_days"))
    assert (gaps["w"], gaps["now"]) == (Decimal("30.3"), None)


def test_reference_day_can_be_fixed(spark):
    df = orders(spark, ("u", "1", 0, 1))
    cfg = Config("Test", reference_day=DAY + timedelta(days=50))
    got = customers.customer_churn_indicators(df, cfg).first()
    assert (got["days_since_last_order"], got["churn_risk_flag"]) == (50, True)


def test_loyalty_counts_mixed_users_twice_and_skips_null_users_in_the_count(spark):
    df = orders(
        spark,
        ("a", "1", 0, 10, True), ("a", "2", 1, 20, True), ("a", "3", 1, 6, False),
        ("b", "4", 0, 4, False), (None, "5", 0, 2, False),
    )
    got = customers.loyalty_comparison(df, CFG)
    assert rows(got) == [
        (False, 2, Decimal("4.00"), Decimal("1.00"), Decimal("4.00"), Decimal("0.00")),
        (True, 1, Decimal("30.00"), Decimal("2.00"), Decimal("15.00"), Decimal("100.00")),
    ]


@pytest.mark.parametrize(
    "build",
    [
        customers.customer_clv_daily,
        customers.customer_rfm_segments,
        customers.customer_churn_indicators,
        customers.loyalty_comparison,
    ],
)
def test_order_facts_give_the_same_tables_and_a_hot_user_is_no_exception(spark, build):
    # A third of all rows belong to one user, some orders span two days, some ids are missing.
    n = F.col("id")
    lines = spark.range(3000).select(
        F.when(n % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), n % 50)).alias("user_id"),
        F.when(n % 97 != 0, F.concat(F.lit("o"), n % 700)).alias("order_id"),
        F.lit("R").alias("restaurant_id"),
        F.date_add(F.lit(DAY), (n % 211).cast("int")).alias("order_date"),
        (n % 5 == 0).alias("is_loyalty"),
        ((n % 89) * 1.25).cast("decimal(18,4)").alias("gross_revenue"),
        (n % 41 == 0).alias("is_bulk_order_candidate"),
    )
    assert rows(build(lines, CFG)) == rows(build(customers.order_facts(lines), CFG))


def test_last_running_total_is_the_sum_of_the_days(spark):
    df = orders(spark, *[("u", str(i), i % 7, i) for i in range(40)])
    got = customers.customer_clv_daily(df, CFG)
    last, total = got.agg(F.max("total_revenue_to_date"), F.sum("daily_revenue")).first()
    assert last == total == sum(range(40))
