"""Steps whose work must grow no faster than their input."""

import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderlens.functions import text
from orderlens.operators.tables import conform
from orderlens.plans import changes, customers, promotions, sales, silver
from orderlens.retail import CONFIG
from orderlens.schemas import SOURCES
from orderlens.session import lying_together
from registry.queries import QUERIES, Frames

from conftest import rows

BASE = "/root/testdata/sf0.001"


def explained(df):
    utils = df.sparkSession.sparkContext._jvm.PythonSQLUtils
    return utils.explainString(df._jdf.queryExecution(), "formatted")


def items_frame(spark, items):
    columns = "app_name string, order_id string, creation_time_utc string, lineitem_id string, item_price decimal(18,4)"
    made = [("Store", order, created, "l", Decimal(price)) for order, created, price in items]
    return conform(spark.createDataFrame(made, columns), SOURCES["order_items"])


def test_months_are_looked_up_at_once_and_only_those_of_changed_lines_count(spark):
    items = items_frame(spark, [("o1", "2023-05-01T10:00:00Z", 1), ("o1", "2023-06-01T10:00:00Z", 2), ("o2", "soon", 3)])
    other = items_frame(spark, [("o1", "2023-05-01T10:00:00Z", 9), ("o1", "2023-06-01T10:00:00Z", 2), ("o2", "soon", 3)])
    empty = {"order_item_options": spark.createDataFrame([], SOURCES["order_item_options"]),
             "date_dim": spark.createDataFrame([], SOURCES["date_dim"])}
    days = [{"order_items": df, **empty} for df in (items, other)]
    assert changes.touched_months(*days) == [(2023, 5)]
    late = spark.createDataFrame([("o1", "l", "g", "n", None, 1)], SOURCES["order_item_options"])
    touched = changes.touched_months(days[0], {**days[0], "order_item_options": late})
    assert sorted(touched) == [(2023, 5), (2023, 6)]

    many = [(y, m) for y in range(2020, 2025) for m in range(1, 13)] + [(None, None)]
    found = changes.in_months(items, many)
    assert found.count() == 3
    assert rows(changes.in_months(items, [(2023, 6), (None, None)]), "order_id") == [("o1",), ("o2",)]
    assert changes.in_months(items, many[:-1]).count() == 2
    # The text is searched as often for sixty months as for one.
    plans = [changes.in_months(items, some)._jdf.queryExecution().optimizedPlan().toString() for some in (many, many[:1])]
    assert plans[0].count("RLIKE") == plans[1].count("RLIKE") > 0


@pytest.fixture(scope="module")
def frames(spark):
    return Frames(spark, BASE)


def exchanges(df, kind="Exchange"):
    return df._jdf.queryExecution().executedPlan().toString().count(f"{kind} hashpartitioning")


def test_options_move_once_to_their_order_lines(frames):
    joined = silver.join_options(frames.cleaned, silver.option_rollup(frames.options))
    assert exchanges(frames.silver) == exchanges(joined) + 1  # one for the calendar


def test_what_follows_from_other_columns_does_not_move_to_be_written(frames):
    text = explained(frames.silver_by_month)
    moved = text.split("REBALANCE_PARTITIONS_BY_COL")[0].rsplit("Input [", 1)[1].splitlines()[0]
    assert "item_name" in moved and "gross_revenue" not in moved and "holiday_name" not in moved
    written = silver.orders_enriched(frames.items, frames.options, frames.date_dim, CONFIG, by_month=True)
    assert written.schema == frames.silver.schema
    assert rows(written) == rows(frames.silver)


def test_discounts_move_lines_once(frames):
    stored = frames.spark.createDataFrame(frames.silver.limit(50).collect(), frames.silver.schema)
    assert exchanges(promotions.discount_effectiveness(stored, CONFIG)) == 1


def test_trends_are_dealt_finely_and_their_revenue_is_the_same(spark, frames):
    assert f"{4 * sales.FINER}), REPARTITION_BY_NUM" in explained(frames.trends).replace("\n", "")
    columns = ["order_date", "restaurant_id", "item_category", "total_revenue"]
    assert rows(frames.revenue, *columns) == rows(frames.trends, *columns)
    assert rows(frames.stored.trends) == rows(frames.trends)


def test_locations_and_trends_of_a_page_build_silver_once(spark, frames):
    page = explained(QUERIES["serve_location_monthly"](spark, BASE))
    assert "lineitem.parquet" not in page and "is_bulk_order_candidate" not in page


def test_order_facts_find_lines_and_options_by_order(spark, frames):
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    with lying_together(spark):
        facts = customers.order_facts(frames.silver_by_order)
        # Lines, their orders and options move by order once each, and nothing by order line.
        plan = facts._jdf.queryExecution().executedPlan().toString()
        moves = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
        assert sum(m.startswith("order_id") for m in moves) == 3 and not any("lineitem_id" in m for m in moves)
    assert spark.conf.get(key) == before
    assert rows(facts) == rows(customers.order_facts(frames.silver))
    assert rows(frames.orders) == rows(facts)


def test_promotional_orders_are_folded_where_their_lines_lie_and_names_that_end_well_meet_no_pattern(spark, frames):
    assert "lineitem.parquet" not in explained(QUERIES["serve_promo_top50"](spark, BASE))
    columns = frames.promotional_orders.columns
    assert rows(frames.promotional_orders) == rows(frames.discounts.where("is_promotional_order"), *columns)

    ends = ["", "a", "Z", " ", "7", "`1", "é", "-", "'", "&", "\n", "1\n", "\t", "a\n", "{", "@", "z9 "]
    raw = spark.createDataFrame([(f"x{a}{b}",) for a in ends for b in ends] + [(e,) for e in ends] + [(None,)], "c string")
    c = F.col("c")
    cleaned = text.clean_category(c, {})
    plain = F.trim(F.regexp_replace(c, text.TRAILING_NOISE, ""))
    assert raw.where(~cleaned.eqNullSafe(plain)).count() == 0
    plan = raw.select(cleaned)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("CASE WHEN") < plan.index("regexp_replace")
