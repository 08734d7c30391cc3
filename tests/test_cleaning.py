from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderlens.config import CATEGORY_CORRECTIONS, Config
from orderlens.functions import dates, numbers, text
from orderlens.operators import tables
from orderlens.plans import silver
from orderlens.schemas import ORDER_ITEM_OPTIONS

from conftest import rows


@pytest.mark.parametrize(
    ("raw", "clean"),
    [
        ("Salads https://a.b/c", "Salads"),
        ("Sandwiches`1", "Sandwiches"),
        ("Sqalads", "Salads"),
        ("Salads1 ", "Salads1"),  # the trailing blank shields the digit
        ("Salads1", "Salads"),
        ("Café", "Caf"),
        ("Kids' Menu (v2)", "Kids' Menu (v"),
        ("https://x.y 12", ""),
        ("Half & Half", "Half & Half"),
        (None, None),
    ],
)
def test_clean_category(spark, raw, clean):
    df = spark.createDataFrame([(raw,)], "c string")
    assert df.select(text.clean_category(F.col("c"), CATEGORY_CORRECTIONS)).first()[0] == clean


def test_iso_timestamps(spark):
    raw = ["2023-01-05T10:20:30.123Z", "2023-01-05T10:20:30Z", "garbage", None]
    df = spark.createDataFrame([(r,) for r in raw], "c string")
    got = [r[0] for r in df.select(dates.parse_iso_timestamp(F.col("c"))).collect()]
    assert got == [datetime(2023, 1, 5, 10, 20, 30, 123000), datetime(2023, 1, 5, 10, 20, 30), None, None]


def test_date_key(spark):
    df = spark.createDataFrame([("31-12-2023",), ("2023-12-31",), (None,)], "c string")
    got = [r[0] for r in df.select(dates.parse_date_key(F.col("c"))).collect()]
    assert got == [date(2023, 12, 31), None, None]


def test_test_platform_and_null_platform_are_dropped(spark):
    df = spark.createDataFrame([("Store",), ("T",), (None,)], "app_name string")
    assert rows(silver.drop_test_orders(df, Config(test_app_name="T"))) == [("Store",)]


def test_calendar_attributes(spark):
    df = spark.createDataFrame([(date(2021, 1, 1),), (date(2021, 1, 3),)], "d date")
    got = df.select(*dates.calendar_attributes(F.col("d")).values()).collect()
    assert tuple(got[0]) == (2021, "January", 53, "Friday", False)
    assert tuple(got[1]) == (2021, "January", 53, "Sunday", True)


@pytest.mark.parametrize(
    ("num", "den", "places", "expected"),
    [
        ("10.02", 4, 2, "2.51"),  # 2.505, a tie
        ("0.03", 6, 2, "0.01"),  # 0.005, a tie
        ("-0.03", 6, 2, "-0.01"),
        ("1", 3, 1, "0.3"),
        ("1", 0, 2, None),
        (None, 2, 2, None),
    ],
)
def test_safe_ratio(spark, num, den, places, expected):
    value = None if num is None else Decimal(num)
    df = spark.createDataFrame([(value, den)], "n decimal(18,4), d int")
    got = df.select(numbers.safe_ratio(F.col("n"), F.col("d"), places)).first()[0]
    assert got == (None if expected is None else Decimal(expected))


def test_labels(spark):
    df = spark.createDataFrame([("abcdef123456789", 3, True), ("x", 123, None)], "id string, k int, b boolean")
    got = df.select(
        text.location_label(F.col("id")),
        text.ranked_location_label(F.col("k"), F.col("id")),
        text.mask_id(F.col("id")),
        text.loyalty_label(F.col("b")),
    ).collect()
    assert tuple(got[0]) == ("Loc-456789", "#03 Loc-456789", "abcdef123456...", "Loyalty Members")
    assert tuple(got[1]) == ("Loc-x", "#123 Loc-x", "x...", None)


def test_conform_casts_adds_and_orders_columns(spark):
    df = spark.createDataFrame(
        [("1.23456", "2.0", "extra", "o1"), ("bad", "x", "extra", "o2")],
        "Option_Price string, OPTION_QUANTITY string, other string, order_id string",
    )
    got = tables.conform(tables.lower_columns(df), ORDER_ITEM_OPTIONS)
    assert got.schema == ORDER_ITEM_OPTIONS
    assert rows(got) == [
        ("o1", None, None, None, Decimal("1.2346"), 2),
        ("o2", None, None, None, None, None),
    ]
