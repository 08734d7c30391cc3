"""Gold table on promotions, inferred from free and unusually cheap items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.config import Config
from orderlens.functions.dates import year_and_month
from orderlens.functions.numbers import deviation, mean, money, share_of, zero_if_null
from orderlens.schemas import GOLD
from orderlens.session import broadcast_if_small, reliable


def category_price_stats(silver: DataFrame) -> DataFrame:
    """Average and deviation of the positive prices of each category, to four places."""
    return (
        silver.where(F.col("item_price") > 0)
        .groupBy("item_category")
        .agg(
            mean("item_price", 4).alias("category_avg_price"),
            zero_if_null(deviation("item_price")).alias("category_stddev_price"),
            F.count("item_price").alias("priced_item_count"),
        )
    )


def promo_item_signals(silver: DataFrame, cfg: Config, items: DataFrame | None = None) -> DataFrame:
    """Silver rows with the two promotion signals and the discount they suggest.

    Prices can be read from the cleaned ``items`` of the same lines, where Silver is not stored.
    """
    # Free-text categories have no known bound: count them before choosing the join.
    stats = broadcast_if_small(reliable(category_price_stats(silver if items is None else items)))
    priced = silver.join(stats, "item_category", "left").withColumns(
        {
            c: zero_if_null(F.col(c))
            for c in ("category_avg_price", "category_stddev_price", "priced_item_count")
        }
    )
    price, average = F.col("item_price"), F.col("category_avg_price")
    floor = average - F.col("category_stddev_price")
    free = F.coalesce(price == 0, F.lit(False))
    below = F.coalesce((price > 0) & (price < floor), F.lit(False))
    discount = F.when(free, F.round(average * F.col("item_quantity"), 2)).when(
        below, F.round((average - price) * F.col("item_quantity"), 2)
    )
    return priced.withColumns(
        {
            "is_free_item": free,
            "is_below_avg_price": below,
            "estimated_discount": F.when(free | below, discount)
            .otherwise(F.lit(0))
            .cast("decimal(18,2)"),
        }
    )


def _sum_where(condition: str, amount: str) -> Column:
    return F.sum(F.when(F.col(condition), F.col(amount)).otherwise(F.lit(0)))


_ORDER = ["order_id", "user_id", "restaurant_id", "order_date", "is_loyalty"]
_OF_LINES = [
    "lineitem_id", "item_name", "item_category", "item_price", "item_quantity", "gross_revenue",
]


def discount_effectiveness(
    silver: DataFrame, cfg: Config, items: DataFrame | None = None
) -> DataFrame:
    """Promotion signals and basket value per order.

    Lines move once, by order and without what is derived from them: the fold that counts different
    items and the one by order both find them together. Silver as it is built lies so already.
    """
    together = silver.select(*_ORDER, *_OF_LINES).repartition("order_id")
    signals = promo_item_signals(together, cfg, silver if items is None else items)
    orders = signals.groupBy(*_ORDER).agg(
        money(F.sum("gross_revenue")).alias("gross_revenue"),
        F.count("lineitem_id").alias("total_line_items"),
        F.count_distinct("item_name").alias("unique_items"),
        _sum_where("is_free_item", "item_quantity").alias("free_item_count"),
        _sum_where("is_free_item", "estimated_discount").alias("free_item_revenue_loss"),
        _sum_where("is_below_avg_price", "item_quantity").alias("below_avg_price_item_count"),
        _sum_where("is_below_avg_price", "estimated_discount").alias("below_avg_discount_amt"),
        F.sum("estimated_discount").alias("total_estimated_discount"),
    )
    has_free = F.coalesce(F.col("free_item_count") > 0, F.lit(False))
    has_below = F.coalesce(F.col("below_avg_price_item_count") > 0, F.lit(False))
    return orders.withColumns(
        {
            **year_and_month(F.col("order_date")),
            "has_free_item": has_free,
            "has_below_avg_item": has_below,
            "is_promotional_order": has_free | has_below,
            "order_type": F.when(has_free & has_below, "free_item+below_avg")
            .when(has_free, "free_item")
            .when(has_below, "below_avg_price")
            .otherwise("full_price"),
        }
    ).select(*GOLD["discount_effectiveness"])


def order_type_counts(discounts: DataFrame) -> DataFrame:
    return discounts.groupBy("order_type").agg(F.count(F.lit(1)).alias("orders"))


def promo_totals(discounts: DataFrame) -> DataFrame:
    return discounts.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if("is_promotional_order").alias("promotional_orders"),
        share_of(F.col("is_promotional_order"), 1).alias("promo_pct"),
        F.sum("total_estimated_discount").alias("total_discount"),
    )
