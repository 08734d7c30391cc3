from datetime import date
from decimal import Decimal

import pytest

from orderlens.plans.serve import churn, clv, locations, loyalty, overview, promo, rfm, sales

from conftest import rows

CHURN = (
    "user_id string, days_since_last_order int, avg_order_gap_days decimal(20,1),"
    " total_orders bigint, total_spend decimal(20,2), spend_change_pct decimal(20,2),"
    " churn_risk_flag boolean"
)


def churners(spark, *entries):
    return spark.createDataFrame(list(entries), CHURN)


def test_spend_buckets_are_right_closed_and_show_empty_bins(spark):
    changes = ["-200", "-199.99", "-50", "-10", "10", "50", "200", "201"]
    df = churners(spark, *[(c, 1, None, 1, Decimal(1), Decimal(c), False) for c in changes])
    assert rows(churn.serve_spend_buckets(df), "position", "customers") == [
        (0, 2), (1, 1), (2, 1), (3, 1), (4, 1), (5, 2),
    ]
    assert len(rows(churn.serve_spend_buckets(df, False))) == 5
    none = df.where("user_id = 'nobody'")
    assert rows(churn.serve_spend_buckets(none), "customers") == [(0,)] * 6


def test_rethreshold(spark):
    df = churners(
        spark, ("a", 10, None, 1, Decimal(1), None, True), ("b", 11, None, 5, Decimal(1), None, False)
    )
    assert rows(churn.serve_churn_rethreshold(df, 10), "user_id", "churn_risk_flag") == [
        ("a", False), ("b", True),
    ]
    assert rows(churn.serve_churn_rethreshold(df, 5, 2, True), "user_id") == [("b",)]


def test_churn_kpis_without_any_risk(spark):
    df = churners(spark, ("a", 1, Decimal("2.5"), 3, Decimal(9), None, False))
    got = churn.serve_churn_kpis(df).first()
    assert got["at_risk_customers"] == 0 and got["avg_days_inactive_at_risk"] is None
    assert got["median_order_gap_days"] == Decimal("2.5")


def test_histogram_counts_every_row(spark):
    df = churners(
        spark, *[(str(i), i * 3, Decimal(i), 1, Decimal(1), None, i % 2 == 0) for i in range(100)]
    )
    got = churn.serve_hist_inactivity(df, 10)
    assert sum(r["customers"] for r in got.collect()) == 100
    assert {r["bin_width"] for r in got.collect()} == {Decimal("50.0000")}
    one = churn.serve_hist_inactivity(df.where("user_id = '7'"))
    assert [(r["bin_start"], r["customers"]) for r in one.collect()] == [(21, 1)]


CLV = (
    "user_id string, snapshot_date date, total_revenue_to_date decimal(20,2), clv_tier string,"
    " is_loyalty boolean"
)


def snapshots(spark):
    d = [date(2024, 1, x) for x in (1, 2, 3)]
    return spark.createDataFrame(
        [
            ("a", d[0], Decimal(1), "High", True), ("a", d[2], Decimal(9), "High", False),
            ("b", d[1], Decimal(5), "Low", False), ("b", d[1], Decimal(6), "Low", True),
            (None, d[0], Decimal(99), "High", True),
        ],
        CLV,
    )


def test_latest_snapshot_takes_the_member_row_on_ties(spark):
    assert rows(clv.latest_snapshots(snapshots(spark)), "user_id", "total_revenue_to_date") == [
        ("a", Decimal("9.00")), ("b", Decimal("6.00")),
    ]


def test_clv_filter_keeps_all_snapshots_of_passing_users(spark):
    got = clv.serve_clv_filter(snapshots(spark), tier="High", start=date(2024, 1, 2))
    assert rows(got, "user_id", "snapshot_date") == [("a", date(2024, 1, 3))]
    assert clv.serve_clv_filter(snapshots(spark)).count() == 5
    assert rows(clv.serve_clv_filter(snapshots(spark), loyalty=True), "user_id") == [("b",), ("b",)]


def test_filter_domains(spark):
    got = overview.serve_filter_domains(snapshots(spark), ["snapshot_date"], ["clv_tier"])
    assert [tuple(r) for r in got.collect()] == [
        ("clv_tier", "value", "High"), ("clv_tier", "value", "Low"),
        ("snapshot_date", "max", "2024-01-03"), ("snapshot_date", "min", "2024-01-01"),
    ]


TRENDS = (
    "order_date date, is_holiday boolean, holiday_name string, restaurant_id string,"
    " item_category string, total_revenue decimal(20,2), order_count bigint, is_weekend boolean,"
    " day_of_week string, year int"
)


def trends(spark):
    d1, d2, d3 = date(2024, 1, 1), date(2024, 1, 7), date(2024, 1, 8)
    return spark.createDataFrame(
        [
            (d1, True, "New Year", "R1", "a", Decimal(10), 1, False, "Monday", 2024),
            (d1, True, "New Year", "R1", "b", Decimal(20), 1, False, "Monday", 2024),
            (d2, False, None, "R1", "a", Decimal(5), 2, True, "Sunday", 2024),
            (d3, True, "", "R2", None, Decimal(7), 3, False, "Monday", 2024),
            (d3, None, None, "R2", "a", Decimal(8), 4, False, None, 2024),
        ],
        TRENDS,
    )


def test_named_holidays_skip_empty_names(spark):
    assert rows(sales.serve_named_holidays(trends(spark))) == [("New Year", Decimal("30.00"), 2)]


def test_holiday_impact_gives_both_means(spark):
    got = {r["is_holiday"]: r for r in sales.serve_holiday_impact(trends(spark)).collect()}
    assert set(got) == {True, False}
    assert (got[True]["avg_row_revenue"], got[True]["avg_daily_revenue"]) == (
        Decimal("12.33"), Decimal("18.50"),
    )


def test_weeks_start_on_monday(spark):
    got = sales.serve_sales_by_period(trends(spark), "weekly")
    assert rows(got) == [
        (date(2024, 1, 1), Decimal("35.00"), 4), (date(2024, 1, 8), Decimal("15.00"), 7),
    ]


def test_null_keys_are_left_out_and_empty_frames_give_zero(spark):
    assert rows(sales.serve_category_share(trends(spark)), "item_category", "pct") == [
        ("a", Decimal("53.5")), ("b", Decimal("46.5")),
    ]
    empty = sales.serve_sales_kpis(trends(spark).where("year = 1999")).first()
    assert (empty["avg_daily_revenue"], empty["weekend_pct"]) == (0, 0)


def test_month_year_matrix_fills_gaps(spark):
    got = sales.serve_month_year_matrix(trends(spark), [2023, 2024])
    assert rows(got) == [(1, "Jan", Decimal("0.00"), Decimal("50.00"))]
    assert sales.serve_month_year_matrix(trends(spark)).columns[2:] == ["revenue_2024"]
    with pytest.raises(ValueError):
        sales.serve_month_year_matrix(trends(spark), [2023])


def test_loyalty_without_members(spark):
    df = spark.createDataFrame(
        [(False, 3, Decimal("4"), Decimal("2"), Decimal("2"), Decimal("50"))],
        "is_loyalty boolean, total_customers bigint, avg_clv decimal(20,2),"
        " avg_orders_per_customer decimal(20,2), avg_order_value decimal(20,2),"
        " repeat_purchase_rate_pct decimal(20,2)",
    )
    got = loyalty.serve_loyalty_overview(df).first()
    assert (got["loyalty_customers"], got["clv_lift_pct"], got["loyalty_pct"]) == (0, -100, 0)
    assert loyalty.serve_loyalty_index(df).count() == 8
    only_members = loyalty.serve_loyalty_overview(df.selectExpr("true is_loyalty", "* except (is_loyalty)"))
    assert only_members.first()["clv_lift_pct"] == 0


PLACES = (
    "revenue_rank int, restaurant_id string, total_revenue decimal(20,2), total_orders bigint,"
    " unique_customers bigint, avg_order_value decimal(20,2), avg_daily_revenue decimal(20,2),"
    " performance_tier string"
)


def places(spark, n):
    return spark.createDataFrame(
        [(i + 1, f"R{i:02d}", Decimal(100 - i), i, 1, Decimal(1), Decimal(1), "Mid Tier") for i in range(n)],
        PLACES,
    )


def test_extremes_always_list_five(spark):
    got = locations.serve_location_extremes(places(spark, 6))
    assert got.groupBy("side").count().where("count = 5").count() == 2


def test_all_chosen_locations_are_compared(spark):
    sold = spark.createDataFrame(
        [(date(2024, 1, 1), f"R{i:02d}", Decimal(1)) for i in range(45)],
        "order_date date, restaurant_id string, total_revenue decimal(20,2)",
    )
    df = places(spark, 45)
    assert locations.serve_location_monthly(sold, df).count() == 10
    assert locations.serve_location_monthly(sold, df, first=3).count() == 3
    got = locations.serve_location_monthly(sold, df, ["R39", "R40", "R44"])
    assert rows(got, "restaurant_id", "location_label") == [
        ("R39", "#40 Loc-R39"), ("R40", "#41 Loc-R40"), ("R44", "#45 Loc-R44"),
    ]


def test_histograms_take_any_span(spark):
    from orderlens.operators.binning import histogram

    df = spark.createDataFrame([(True, Decimal(0)), (True, Decimal("9e14")), (False, Decimal(7))], "g boolean, v decimal(20,4)")
    got = histogram(df, "v", "g")
    assert {r["bin_width"] for r in got.collect()} == {Decimal("5e13")}
    assert sum(r["customers"] for r in got.collect()) == 3


def test_basket_lift_needs_both_kinds(spark):
    schema = (
        "order_id string, is_promotional_order boolean, gross_revenue decimal(20,2),"
        " total_estimated_discount decimal(20,2)"
    )
    full = ("1", False, Decimal(10), Decimal(0))
    offer = ("2", True, Decimal(15), Decimal(3))
    lift = promo.serve_promo_kpis(spark.createDataFrame([full, offer], schema)).first()
    assert lift["basket_lift_pct"] == 50
    assert promo.serve_promo_kpis(spark.createDataFrame([full], schema)).first()["basket_lift_pct"] is None


def test_action_guide_lists_absent_segments(spark):
    df = spark.createDataFrame([("VIP",), ("VIP",)], "rfm_segment string")
    got = rfm.serve_rfm_action_guide(df)
    assert [r["customers"] for r in got.collect()] == [2, 0, 0, 0]
