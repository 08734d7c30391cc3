"""Promotion effectiveness."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.dates import month_start
from orderlens.functions.numbers import mean, money, percent, safe_ratio, share_of
from orderlens.functions.text import bool_label, location_label, loyalty_label, mask_id
from orderlens.operators.ordering import box_stats
from orderlens.operators.selection import fold, up_to_percentile
from orderlens.operators.tables import top


def serve_promo_filter(
    discounts: DataFrame,
    start: date | None = None,
    end: date | None = None,
    order_type: str | None = None,
    loyalty: bool | None = None,
) -> DataFrame:
    if start is not None:
        discounts = discounts.where(F.col("order_date") >= F.lit(start))
    if end is not None:
        discounts = discounts.where(F.col("order_date") <= F.lit(end))
    if order_type is not None:
        discounts = discounts.where(F.col("order_type") == order_type)
    if loyalty is not None:
        discounts = discounts.where(F.col("is_loyalty") == loyalty)
    return discounts


def _promo_rate() -> Column:
    return percent(F.count_if("is_promotional_order"), F.count("order_id"))


def serve_promo_kpis(discounts: DataFrame) -> DataFrame:
    """The basket lift is null unless both kinds of orders exist and the base is positive."""
    promo = F.col("is_promotional_order")
    base = F.col("avg_full_basket")
    return discounts.agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(promo).alias("promo_orders"),
        share_of(promo, 1).alias("promo_pct"),
        money(F.sum("total_estimated_discount")).alias("estimated_value"),
        mean(F.when(promo, F.col("gross_revenue")), 4).alias("avg_promo_basket"),
        mean(F.when(~promo, F.col("gross_revenue")), 4).alias("avg_full_basket"),
    ).withColumn(
        "basket_lift_pct",
        F.when(base > 0, percent(F.col("avg_promo_basket") - base, base)),
    )


def serve_order_type_breakdown(discounts: DataFrame) -> DataFrame:
    return discounts.groupBy("order_type").agg(F.count(F.lit(1)).alias("orders"))


def serve_promo_rate_monthly(discounts: DataFrame) -> DataFrame:
    return (
        discounts.where(F.col("order_date").isNotNull())
        .groupBy(month_start(F.col("order_date")).alias("month_start"))
        .agg(
            F.count("order_id").alias("total"),
            F.count_if("is_promotional_order").alias("promo"),
            _promo_rate().alias("promo_rate"),
        )
    )


def _baskets(discounts: DataFrame) -> DataFrame:
    label = bool_label(F.col("is_promotional_order"), "Promotional", "Full Price")
    return discounts.select(label.alias("basket"), "gross_revenue")


def serve_basket_compare(discounts: DataFrame) -> DataFrame:
    """Mean basket per kind, outliers above the 95th percentile left out."""
    usual = up_to_percentile(fold(_baskets(discounts), "gross_revenue", ["basket"]), 95)
    total = F.sum(F.col("_value") * F.col("_n"))
    return (
        usual.groupBy("basket")
        .agg(safe_ratio(total, F.sum("_n")).alias("avg_basket"))
        .orderBy("basket")
    )


def serve_basket_box(discounts: DataFrame) -> DataFrame:
    return box_stats(_baskets(discounts), "gross_revenue", ["basket"], cap_percent=95)


def serve_promo_by_location(discounts: DataFrame, n: int = 15) -> DataFrame:
    rates = (
        discounts.where(F.col("restaurant_id").isNotNull())
        .groupBy("restaurant_id")
        .agg(
            F.count("order_id").alias("total"),
            F.count_if("is_promotional_order").alias("promo"),
            _promo_rate().alias("promo_rate"),
        )
    )
    label = location_label(F.col("restaurant_id")).alias("location_label")
    return top(
        rates,
        "promo_rate",
        "restaurant_id",
        n,
        ["restaurant_id", label, "total", "promo", "promo_rate"],
    )


def serve_promo_by_loyalty(discounts: DataFrame) -> DataFrame:
    return (
        discounts.where(F.col("is_loyalty").isNotNull())
        .groupBy("is_loyalty")
        .agg(
            F.count("order_id").alias("total"),
            F.count_if("is_promotional_order").alias("promo"),
            _promo_rate().alias("promo_rate"),
            mean("total_estimated_discount").alias("avg_discount"),
        )
        .withColumn("group_label", loyalty_label(F.col("is_loyalty")))
        .orderBy("is_loyalty")
    )


def serve_promo_top50(discounts: DataFrame) -> DataFrame:
    return top(
        discounts.where("is_promotional_order"),
        "total_estimated_discount",
        "order_id",
        50,
        [
            mask_id(F.col("order_id")).alias("order"),
            "order_date",
            location_label(F.col("restaurant_id")).alias("location_label"),
            "is_loyalty",
            "gross_revenue",
            "order_type",
            "free_item_count",
            "below_avg_price_item_count",
            "total_estimated_discount",
        ],
    )
