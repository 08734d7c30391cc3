from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from orderlens.config import Config
from orderlens.plans import silver
from orderlens.schemas import DATE_DIM, ORDER_ITEM_OPTIONS, ORDER_ITEMS, SILVER

from conftest import rows

CFG = Config(test_app_name="T", calendar_start=date(2023, 1, 1), calendar_end=date(2023, 1, 31))


def item(spark, *entries):
    base = dict(
        app_name="S", restaurant_id="R", creation_time_utc="2023-01-05T10:00:00Z", order_id="o",
        user_id="u", printed_card_number="4111", is_loyalty=True, currency="USD", lineitem_id="l",
        item_category="Salads", item_name="n", item_price=Decimal("10"), item_quantity=2,
    )
    data = [tuple({**base, **e}[c] for c in ORDER_ITEMS.names) for e in entries]
    return spark.createDataFrame(data, ORDER_ITEMS)


def option(spark, *entries):
    base = dict(
        order_id="o", lineitem_id="l", option_group_name="g", option_name="n",
        option_price=Decimal("1.5"), option_quantity=2,
    )
    data = [tuple({**base, **e}[c] for c in ORDER_ITEM_OPTIONS.names) for e in entries]
    return spark.createDataFrame(data, ORDER_ITEM_OPTIONS)


def calendar(spark, *entries):
    data = [(key, None, None, None, None, None, flag, name) for key, flag, name in entries]
    return spark.createDataFrame(data, DATE_DIM)


def test_options_are_deduplicated_and_do_not_fan_out(spark):
    items = item(spark, {}, {"lineitem_id": "bare"})
    options = option(
        spark, {}, {}, {"option_group_name": "other group"}, {"lineitem_id": "orphan"}
    )
    got = silver.orders_enriched(items, options, calendar(spark), CFG)
    assert got.schema == SILVER or [f.name for f in got.schema] == SILVER.names
    assert rows(got, "lineitem_id", "option_revenue", "option_row_count", "gross_revenue") == [
        ("bare", Decimal("0.0000"), 0, Decimal("20.0000")),
        ("l", Decimal("6.0000"), 2, Decimal("26.0000")),
    ]
    orphans = silver.orphan_options(silver.dedup_rows(options), silver.clean_items(items, CFG))
    assert rows(orphans, "lineitem_id") == [("orphan",)]


def test_options_of_a_dropped_test_item_are_orphans(spark):
    items = silver.clean_items(item(spark, {"app_name": "T"}), CFG)
    assert silver.orphan_options(option(spark, {}), items).count() == 1


def test_null_and_negative_option_prices(spark):
    items = item(spark, {}, {"lineitem_id": "m"})
    options = option(
        spark, {"option_price": None}, {"lineitem_id": "m", "option_price": Decimal("-2")}
    )
    got = silver.orders_enriched(items, options, calendar(spark), CFG)
    assert rows(got, "lineitem_id", "option_revenue", "option_row_count") == [
        ("l", Decimal("0.0000"), 1),
        ("m", Decimal("-4.0000"), 1),
    ]


def test_items_with_null_keys_are_kept(spark):
    items = item(spark, {"order_id": None}, {"lineitem_id": None})
    options = option(spark, {"order_id": None})
    got = silver.orders_enriched(items, options, calendar(spark), CFG)
    assert rows(got, "option_row_count") == [(0,), (0,)]


def test_bulk_flags(spark):
    cfg = Config(test_app_name="T", bulk_price=Decimal("100"), bulk_quantity=10)
    cases = [
        ("a", "100", 1), ("b", "99.99", 10), ("c", "100", 10), ("d", None, 50), ("e", None, 5),
        ("f", "100", None), ("g", "1", 1),
    ]
    items = item(
        spark,
        *[
            {"lineitem_id": i, "item_price": p and Decimal(p), "item_quantity": q}
            for i, p, q in cases
        ],
    )
    got = silver.orders_enriched(items, option(spark, {}), calendar(spark), cfg)
    assert rows(got, "lineitem_id", "is_bulk_order_candidate", "bulk_flag_reason") == [
        ("a", True, "high_item_price"),
        ("b", True, "high_item_quantity"),
        ("c", True, "high_item_price_and_quantity"),
        ("d", True, "high_item_quantity"),
        ("e", False, None),
        ("f", True, "high_item_price"),
        ("g", False, None),
    ]


def test_spine_and_holidays(spark):
    source = calendar(
        spark,
        ("02-01-2023", True, "New Year"),
        ("02-01-2023", False, None),
        ("03-01-2023", None, None),
        ("2023-01-04", True, "wrong format"),
        ("05-02-2023", True, "outside"),
    )
    spine = silver.date_spine(source, CFG.calendar_start, CFG.calendar_end)
    assert spine.count() == 31
    assert rows(spine.where("is_holiday"), "date_key", "holiday_name") == [
        (date(2023, 1, 2), "New Year")
    ]
    assert spine.where(F.col("is_holiday").isNull()).count() == 0
    assert silver.date_spine(source, date(2020, 1, 1), date(2024, 12, 31)).count() == 1827


def test_days_outside_the_calendar_keep_null_attributes(spark):
    items = item(spark, {"creation_time_utc": "2024-03-01T00:00:00Z"}, {"creation_time_utc": "bad"})
    got = silver.orders_enriched(items, option(spark, {}), calendar(spark), CFG)
    assert rows(got, "order_date", "year", "month", "week", "is_holiday") == [
        (None, None, None, None, None),
        (date(2024, 3, 1), 2024, 3, None, None),
    ]


def test_items_are_not_deduplicated_and_revenue_is_conserved(spark):
    items = item(spark, {}, {}, {"lineitem_id": "m", "item_quantity": None})
    got = silver.orders_enriched(items, option(spark, {}), calendar(spark), CFG)
    assert rows(got, "lineitem_id", "gross_revenue") == [
        ("l", Decimal("23.0000")), ("l", Decimal("23.0000")), ("m", None),
    ]
    assert "printed_card_number" not in got.columns
    assert got.first()["creation_time_utc"] == datetime(2023, 1, 5, 10)
