from datetime import date
from decimal import Decimal

import pytest

from orderlens.config import Config
from orderlens.plans import promotions, sales

from conftest import rows

CFG = Config("Test")
ORDERS = "restaurant_id string, order_id string, user_id string, order_date date, gross_revenue decimal(18,4)"


def places(spark, revenues):
    day = date(2024, 1, 1)
    return spark.createDataFrame(
        [(f"R{i}", f"o{i}", "u", day, Decimal(r)) for i, r in enumerate(revenues)], ORDERS
    )


@pytest.mark.parametrize(
    ("revenues", "tiers"),
    [
        # With three locations everybody is at the top.
        ([30, 20, 10], {1: "Top Performer", 2: "Top Performer", 3: "Top Performer"}),
        # Seven locations: ranks 5 and below stay at the top, 6 and 7 need attention.
        (
            [70, 60, 50, 40, 30, 20, 10],
            {5: "Top Performer", 6: "Needs Attention", 7: "Needs Attention"},
        ),
        # Nine with a tie: dense ranks end at 8, the bottom starts at 7.
        (
            [90, 80, 70, 60, 50, 50, 40, 30, 20],
            {5: "Top Performer", 6: "Mid Tier", 7: "Needs Attention", 8: "Needs Attention"},
        ),
    ],
)
def test_location_tiers(spark, revenues, tiers):
    got = sales.location_performance(places(spark, revenues), CFG)
    by_rank = dict(rows(got, "revenue_rank", "performance_tier"))
    assert {k: by_rank[k] for k in tiers} == tiers
    assert got.count() == len(revenues)


def test_location_figures(spark):
    d1, d2 = date(2024, 1, 1), date(2024, 1, 2)
    df = spark.createDataFrame(
        [("R", "1", "a", d1, Decimal("10")), ("R", "1", "a", d1, Decimal("5")),
         ("R", "2", "b", d2, Decimal("5.01")), ("R", "3", "b", d2, None)],
        ORDERS,
    )
    assert rows(sales.location_performance(df, CFG)) == [
        (1, "R", Decimal("20.01"), 3, 2, Decimal("6.67"), Decimal("10.01"), "Top Performer")
    ]


LINES = (
    "order_id string, user_id string, restaurant_id string, order_date date, is_loyalty boolean,"
    " lineitem_id string, item_name string, item_category string, item_price decimal(18,4),"
    " item_quantity int, gross_revenue decimal(18,4)"
)


def lines(spark, *entries):
    data = []
    for i, (order, category, price, quantity) in enumerate(entries):
        amount = None if price is None else Decimal(price)
        data.append(
            (order, "u", "R", date(2024, 2, 3), True, f"l{i}", f"n{i % 2}", category, amount,
             quantity, Decimal("1"))
        )
    return spark.createDataFrame(data, LINES)


def test_signals(spark):
    # Category "c": prices 10, 10, 4 and 8 -> average 8, sample deviation 2.8284.
    df = lines(
        spark,
        ("o1", "c", "10", 1), ("o1", "c", "10", 1), ("o2", "c", "4", 3), ("o3", "c", "8", 1),
        ("o4", "c", "0", 2), ("o5", None, "0", 5), ("o6", None, "3", 1), ("o7", "single", "1", 1),
        ("o8", "c", "-1", 1), ("o9", "c", None, 1),
    )
    got = promotions.promo_item_signals(df, CFG)
    assert rows(got, "order_id", "is_free_item", "is_below_avg_price", "estimated_discount") == [
        ("o1", False, False, Decimal("0.00")),
        ("o1", False, False, Decimal("0.00")),
        ("o2", False, True, Decimal("12.00")),
        ("o3", False, False, Decimal("0.00")),
        ("o4", True, False, Decimal("16.00")),
        ("o5", True, False, Decimal("0.00")),  # no statistics for a null category
        ("o6", False, False, Decimal("0.00")),
        ("o7", False, False, Decimal("0.00")),
        ("o8", False, False, Decimal("0.00")),
        ("o9", False, False, Decimal("0.00")),
    ]


def test_price_exactly_at_the_floor_is_not_below(spark):
    # Prices 1 and 3: average 2, deviation 1.4142, floor 0.5858.
    df = lines(spark, ("o", "c", "1", 1), ("o", "c", "3", 1))
    stats = promotions.category_price_stats(df).first()
    assert (stats["category_avg_price"], stats["category_stddev_price"]) == (2, Decimal("1.4142"))
    single = promotions.category_price_stats(lines(spark, ("o", "s", "5", 1))).first()
    assert single["category_stddev_price"] == 0


def test_order_grain(spark):
    # Positive prices 4, 10, 10, 8, 4: average 7.2, deviation 3.0332, so 4 lies below the floor.
    df = lines(
        spark,
        ("o1", "c", "0", 2), ("o1", "c", "4", 3), ("o2", "c", "10", 1), ("o3", "c", "10", 1),
        ("o3", "c", "8", 1), ("o4", "c", "4", 1),
    )
    got = promotions.discount_effectiveness(df, CFG)
    assert rows(got, "order_id", "order_type", "free_item_count", "below_avg_price_item_count",
                "total_line_items", "unique_items", "year", "month") == [
        ("o1", "free_item+below_avg", 2, 3, 2, 2, 2024, 2),
        ("o2", "full_price", 0, 0, 1, 1, 2024, 2),
        ("o3", "full_price", 0, 0, 2, 2, 2024, 2),
        ("o4", "below_avg_price", 0, 1, 1, 1, 2024, 2),
    ]
    totals = promotions.promo_totals(got).first()
    assert (totals["total_orders"], totals["promotional_orders"], totals["promo_pct"]) == (4, 2, 50)
