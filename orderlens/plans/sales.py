"""Gold tables about sales and locations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.config import Config
from orderlens.functions.numbers import money, safe_ratio
from orderlens.operators.tables import distinct_counts
from orderlens.schemas import GOLD

FINER = 4


def sales_trends(silver: DataFrame, cfg: Config) -> DataFrame:
    """Revenue, orders and customers per day, location and category.

    Lines move once, by day, location and category; every fold after that finds its rows together:
    lines to (order, customer), orders counted with the first of their customers, then customers.
    All these folds run in one task, so lines are dealt to ``FINER`` times the usual partitions, which
    are not merged again: a task holds a share of the lines that does not hang on a target size.
    """
    partitions = FINER * int(silver.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = GOLD["sales_trends"][:10]
    together = silver.select(*keys, "order_id", "user_id", "gross_revenue").repartition(
        partitions, "order_date", "restaurant_id", "item_category"
    )
    revenue = F.col("gross_revenue")
    visits = together.groupBy(*keys, "order_id", "user_id").agg(
        F.sum(revenue).alias("_revenue"), F.count(revenue).alias("_lines")
    )
    turn = F.row_number().over(Window.partitionBy(*keys, "order_id").orderBy("user_id"))
    first = F.when(F.col("order_id").isNotNull() & (F.col("_turn") == 1), 1).otherwise(0)
    customers = (
        visits.withColumn("_turn", turn)
        .groupBy(*keys, "user_id")
        .agg(F.sum("_revenue").alias("_revenue"), F.sum("_lines").alias("_lines"), F.sum(first).alias("_orders"))
    )
    return customers.groupBy(*keys).agg(
        money(F.sum("_revenue")).alias("total_revenue"),
        F.sum("_orders").alias("order_count"),
        F.count("user_id").alias("unique_customers"),
        safe_ratio(F.sum("_revenue"), F.sum("_lines")).alias("avg_item_revenue"),
    )


def trend_revenue(silver: DataFrame) -> DataFrame:
    """Days, locations, categories and revenue of :func:`sales_trends`, summed before lines move."""
    keys = GOLD["sales_trends"][:10]
    return silver.groupBy(*keys).agg(money(F.sum("gross_revenue")).alias("total_revenue"))


def location_totals(orders: DataFrame) -> DataFrame:
    """Totals per location, from Silver rows or order facts."""
    revenue = orders.groupBy(F.col("restaurant_id").alias("_location")).agg(
        F.sum("gross_revenue").alias("_revenue")
    )
    seen = distinct_counts(
        orders,
        "restaurant_id",
        {"total_orders": "order_id", "unique_customers": "user_id", "_days": "order_date"},
    )
    return seen.join(revenue, F.col("restaurant_id").eqNullSafe(F.col("_location"))).select(
        "restaurant_id",
        money(F.col("_revenue")).alias("total_revenue"),
        "total_orders",
        "unique_customers",
        safe_ratio(F.col("_revenue"), F.col("_days")).alias("avg_daily_revenue"),
    )


def location_performance(orders: DataFrame, cfg: Config) -> DataFrame:
    """Locations ranked by revenue, with a tier for the best and the last ranks.

    One row per location is few: a plain window ranks them.
    """
    rank, count = F.col("revenue_rank"), F.col("_count")
    ranked = location_totals(orders).withColumns(
        {
            "revenue_rank": F.dense_rank().over(Window.orderBy(F.col("total_revenue").desc_nulls_last())),
            "_count": F.count(F.lit(1)).over(Window.partitionBy()),
        }
    )
    return ranked.withColumns(
        {
            "avg_order_value": safe_ratio(F.col("total_revenue"), F.col("total_orders")),
            "performance_tier": F.when(rank <= cfg.top_locations, "Top Performer")
            .when(rank >= count - (cfg.bottom_locations - 1), "Needs Attention")
            .otherwise("Mid Tier"),
        }
    ).select(*GOLD["location_performance"])
