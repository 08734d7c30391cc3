from datetime import date
from decimal import Decimal

from orderlens.plans import quality

from conftest import rows


def items(spark):
    return spark.createDataFrame(
        [
            ("o1", "l1", "a", True, Decimal("-1"), "2023-01-01T00:00:00Z"),
            ("o1", "l1", "a", True, Decimal("-1"), "2023-01-01T00:00:00Z"),
            ("o2", "l2", None, None, Decimal("4"), "2023-01-03T23:00:00.5Z"),
            ("o3", None, "b", False, None, "bad"),
        ],
        "order_id string, lineitem_id string, item_category string, is_loyalty boolean,"
        " item_price decimal(18,4), creation_time_utc string",
    )


def options(spark):
    return spark.createDataFrame(
        [("o1", "l1", Decimal("-2")), ("o1", "l1", Decimal("3")), ("o9", "l9", Decimal("1")),
         ("o3", None, Decimal("1"))],
        "order_id string, lineitem_id string, option_price decimal(18,4)",
    )


def test_null_report(spark):
    got = quality.dq_null_report(items(spark)).collect()
    assert [tuple(r) for r in got] == [
        ("is_loyalty", 1, Decimal("25.00")), ("item_category", 1, Decimal("25.00")),
        ("item_price", 1, Decimal("25.00")), ("lineitem_id", 1, Decimal("25.00")),
    ]
    assert quality.dq_null_report(items(spark).select("order_id")).count() == 0


def test_duplicates(spark):
    assert quality.dq_row_duplicates(items(spark)).first()[0] == 1
    assert quality.dq_key_duplicates(options(spark), ["order_id", "lineitem_id"]).first()[0] == 1
    assert quality.dq_row_duplicates(items(spark).where("false")).first()[0] == 0


def test_cardinality_ignores_nulls_and_absent_columns(spark):
    got = quality.dq_cardinality(items(spark), ["order_id", "item_category", "absent"])
    assert rows(got) == [("item_category", 2), ("order_id", 3)]


def test_numeric_summary(spark):
    got = quality.dq_numeric_summary(items(spark), ["item_price"]).first()
    assert (got["n"], got["min"], got["q50"], got["max"]) == (3, -1, -1, 4)
    assert (got["mean"], got["std"]) == (Decimal("0.6667"), 2.8868)


def test_negative_values(spark):
    assert rows(quality.dq_negative_values(items(spark), options(spark))) == [
        ("item_price", 2), ("option_price", 1),
    ]


def test_date_range(spark):
    calendar = spark.createDataFrame([("31-01-2023",), ("02-02-2023",)], "date_key string")
    got = quality.dq_date_range(items(spark), calendar).first()
    assert (got["first_order_day"], got["last_order_day"], got["order_span_days"]) == (
        date(2023, 1, 1), date(2023, 1, 3), 2,
    )
    assert (got["calendar_min_key"], got["calendar_first_day"]) == ("02-02-2023", date(2023, 1, 31))


def test_join_quality(spark):
    got = quality.dq_join_quality_options(items(spark), options(spark)).first()
    assert tuple(got) == (3, 2, 1, Decimal("66.67"))
    calendar = spark.createDataFrame([("2023-01-01",), ("03-01-2023",)], "date_key string")
    days = quality.dq_join_quality_dates(items(spark).where("lineitem_id is not null"), calendar)
    assert tuple(days.first()) == (2, 1, 1, Decimal("50.00"), "2023-01-03")


def test_flag_distribution_and_top_values(spark):
    assert rows(quality.dq_flag_distribution(items(spark))) == [
        (None, 1, Decimal("25.00")), (False, 1, Decimal("25.00")), (True, 2, Decimal("50.00")),
    ]
    assert rows(quality.dq_top_values(items(spark), ["item_category", "order_id"], 1)) == [
        ("item_category", "a", 2), ("order_id", "o1", 2),
    ]
