"""Sales trends."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.dates import period_start
from orderlens.functions.numbers import mean, money, percent, safe_ratio, zero_if_null
from orderlens.functions.text import bool_label
from orderlens.operators.tables import with_share
from orderlens.session import reliable


def serve_sales_filter(
    trends: DataFrame,
    start: date | None = None,
    end: date | None = None,
    categories: Sequence[str] = (),
    restaurants: Sequence[str] = (),
) -> DataFrame:
    if start is not None:
        trends = trends.where(F.col("order_date") >= F.lit(start))
    if end is not None:
        trends = trends.where(F.col("order_date") <= F.lit(end))
    if categories:
        trends = trends.where(F.col("item_category").isin(list(categories)))
    if restaurants:
        trends = trends.where(F.col("restaurant_id").isin(list(restaurants)))
    return trends


def serve_sales_kpis(trends: DataFrame) -> DataFrame:
    revenue = F.sum("total_revenue")
    weekend = zero_if_null(F.sum(F.when(F.col("is_weekend"), F.col("total_revenue"))))
    return trends.agg(
        money(revenue).alias("total_revenue"),
        F.sum("order_count").alias("total_orders"),
        F.count_distinct("order_date").alias("days"),
        safe_ratio(revenue, F.count_distinct("order_date")).alias("avg_daily_revenue"),
        F.when(revenue > 0, percent(weekend, revenue, 1)).alias("weekend_pct"),
    ).fillna({"avg_daily_revenue": 0, "weekend_pct": 0})


def serve_sales_by_period(trends: DataFrame, granularity: str = "monthly") -> DataFrame:
    """Revenue and summed orders per day, week or month.

    An order with several categories counts once for each; see :func:`serve_exact_orders`.
    """
    return (
        trends.where(F.col("order_date").isNotNull())
        .groupBy(period_start(F.col("order_date"), granularity).alias("period"))
        .agg(
            money(F.sum("total_revenue")).alias("total_revenue"),
            F.sum("order_count").alias("order_count"),
        )
    )


def serve_exact_orders(orders: DataFrame, granularity: str = "monthly") -> DataFrame:
    """Distinct orders per period, from Silver rows or order facts."""
    return (
        orders.where(F.col("order_date").isNotNull())
        .groupBy(period_start(F.col("order_date"), granularity).alias("period"))
        .agg(F.count_distinct("order_id").alias("orders"))
    )


def serve_category_share(trends: DataFrame) -> DataFrame:
    per_category = (
        trends.where(F.col("item_category").isNotNull())
        .groupBy("item_category")
        .agg(money(F.sum("total_revenue")).alias("total_revenue"))
    )
    share = percent(F.col("total_revenue"), F.col("grand_total"), 1)
    return with_share(per_category, "total_revenue", "pct", share).orderBy(
        "total_revenue", "item_category"
    )


def serve_revenue_by_weekday(trends: DataFrame) -> DataFrame:
    """Monday first."""
    return (
        trends.where(F.col("day_of_week").isNotNull())
        .groupBy("day_of_week")
        .agg(
            money(F.sum("total_revenue")).alias("total_revenue"),
            (F.min(F.weekday("order_date")) + 1).alias("weekday_number"),
        )
        .orderBy("weekday_number")
    )


def serve_month_year_matrix(trends: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """Revenue by calendar month and year.

    The years are those of the data. A given list fixes the columns; a year of the data that it
    leaves out is an error, not a loss.
    """
    day = F.col("order_date")
    # Twelve rows a year.
    folded = reliable(
        trends.where(day.isNotNull())
        .groupBy(
            F.month(day).alias("month_number"), F.date_format(day, "MMM").alias("month_name"), "year"
        )
        .agg(F.sum("total_revenue").alias("revenue"))
    )
    found = {r["year"] for r in folded.select("year").distinct().collect()}
    years = sorted(found if years is None else years)
    if missing := found.difference(years):
        raise ValueError(f"years without a column: {sorted(missing)}")
    return (
        folded.groupBy("month_number", "month_name")
        .pivot("year", years)
        .agg(money(F.sum("revenue")))
        .fillna(0)
        .withColumnsRenamed({str(y): f"revenue_{y}" for y in years})
        .orderBy("month_number")
    )


def serve_holiday_impact(trends: DataFrame) -> DataFrame:
    """Per holiday flag; ``avg_row_revenue`` is the mean per Gold row, next to the mean per day."""
    revenue, days = F.sum("total_revenue"), F.count_distinct("order_date")
    label = bool_label(F.col("is_holiday"), "Holiday", "Regular Day")
    return (
        trends.where(F.col("is_holiday").isNotNull())
        .groupBy("is_holiday")
        .agg(
            money(revenue).alias("total_revenue"),
            mean("total_revenue").alias("avg_row_revenue"),
            F.sum("order_count").alias("order_count"),
            days.alias("days"),
            safe_ratio(revenue, days).alias("avg_daily_revenue"),
        )
        .withColumn("label", label)
    )


def serve_named_holidays(trends: DataFrame) -> DataFrame:
    return (
        trends.where(F.col("is_holiday") & (F.col("holiday_name") != ""))
        .groupBy("holiday_name")
        .agg(
            money(F.sum("total_revenue")).alias("total_revenue"),
            F.sum("order_count").alias("order_count"),
        )
        .orderBy(F.col("total_revenue").desc(), "holiday_name")
    )
