"""What the physical plans must and must not contain."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderlens.config import Config
from orderlens.plans import customers, promotions, sales, silver
from orderlens.session import broadcast_if_small
from orderlens.sources import files
from registry.queries import QUERIES, Frames

BASE = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def explained(df):
    utils = df.sparkSession.sparkContext._jvm.PythonSQLUtils
    return utils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def frames(spark):
    return Frames(spark, BASE)


@pytest.mark.parametrize("name", ["sales_trends", "discount_effectiveness", "customer_rfm_segments"])
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, BASE))
    for word in ("Python", "CartesianProduct", "NestedLoop"):
        assert word not in text


def test_calendar_is_broadcast_and_options_are_not(frames):
    text = plan(frames.silver)
    assert "BroadcastHashJoin [order_date" in text
    assert "SortMergeJoin [order_id" in text


def test_line_level_tables_never_meet_in_one_partition(spark, frames):
    for df in (frames.silver, frames.trends, customers.daily_customers(frames.silver)):
        assert "SinglePartition" not in plan(df)


def test_rfm_reads_only_the_months_of_its_window(spark, frames, tmp_path):
    files.write_silver(frames.silver, str(tmp_path))
    stored = files.read_silver(spark, str(tmp_path))
    cfg = Config("Test", reference_day=date(1997, 12, 31))
    text = customers.customer_recency(stored, cfg)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(order_date), GreaterThanOrEqual(order_date,1997-07-04)" in text
    assert "make_date(year" in text.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    read = text.split("ReadSchema: struct<")[1].split(">")[0]
    assert "item_name" not in read and "gross_revenue" in read


def test_sales_trends_reads_only_its_columns(spark, frames, tmp_path):
    files.write_silver(frames.silver, str(tmp_path))
    text = sales.sales_trends(files.read_silver(spark, str(tmp_path)), Config("Test"))
    read = text._jdf.queryExecution().toString().split("ReadSchema: struct<")[1]
    assert "item_name" not in read and "lineitem_id" not in read


def test_broadcast_depends_on_the_count(spark):
    small = broadcast_if_small(spark.range(10), 10)
    large = broadcast_if_small(spark.range(11), 10)
    marks = [d._jdf.queryExecution().logical().toString() for d in (small, large)]
    assert "broadcast" in marks[0] and "broadcast" not in marks[1]


def test_a_long_category_list_is_joined_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(promotions, "broadcast_if_small", lambda df: broadcast_if_small(df, 3))
    lines = spark.range(40).select(
        F.concat(F.lit("c"), F.col("id") % 8).alias("item_category"),
        F.lit(Decimal("2")).cast("decimal(18,4)").alias("item_price"),
        F.lit(1).alias("item_quantity"),
    )
    got = promotions.promo_item_signals(lines, Config("Test"))
    assert got.count() == 40
    assert got.agg(F.min("category_avg_price")).first()[0] == 2


def test_silver_write_splits_by_month_through_a_rebalance(frames):
    text = plan(frames.silver.hint("rebalance", "year", "month"))
    assert "REBALANCE_PARTITIONS_BY_COL" in text


def test_spine_is_not_built_on_the_driver(spark):
    calendar = spark.createDataFrame([], "date_key string, is_holiday boolean, holiday_name string")
    spine = silver.date_spine(calendar, date(2020, 1, 1), date(2020, 12, 31))
    assert spine.count() == 366


def test_distinct_counts_do_not_expand_rows(spark, frames):
    for df in (frames.trends, sales.location_totals(frames.orders), frames.locations):
        assert "Expand" not in plan(df)
    # Lines move once, and all folds that follow find their rows together.
    moves = [plan(df).count("Exchange hashpartitioning") for df in (frames.silver, frames.trends)]
    assert moves[1] == moves[0] + 1


def test_gold_reads_stored_order_facts_by_column_and_month(spark, frames, tmp_path):
    facts = files.store_by_month(customers.order_facts(frames.silver), str(tmp_path))
    recent = customers.customer_recency(facts, Config("Test"))
    text = explained(recent)
    # The first month wanted is only known at run time.
    scan = text.split("PartitionFilters: [")[1].split("ReadSchema")[0]
    assert "make_date(year" in scan and "Subquery" in scan
    read = text.split("ReadSchema: struct<")[1].split(">")[0]
    assert "restaurant_id" not in read and "is_bulk_order_candidate" not in read
    read = explained(customers.loyalty_comparison(facts, Config("Test"))).split("ReadSchema: struct<")[1]
    assert "restaurant_id" not in read.split(">")[0]
