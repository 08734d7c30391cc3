"""Location performance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.dates import month_start
from orderlens.functions.numbers import mean, money
from orderlens.functions.text import location_label, ranked_location_label
from orderlens.operators.ordering import quantile
from orderlens.operators.tables import top
from orderlens.session import broadcast_if_small, reliable

SORTABLE = ("total_revenue", "avg_order_value", "total_orders", "unique_customers")
DEFAULT_COMPARED = 10


def serve_location_topn(
    locations: DataFrame, metric: str = "total_revenue", n: int = 10, tier: str | None = None
) -> DataFrame:
    if metric not in SORTABLE:
        raise ValueError(f"metric must be one of {SORTABLE}")
    if tier is not None:
        locations = locations.where(F.col("performance_tier") == tier)
    label = location_label(F.col("restaurant_id")).alias("location_label")
    return top(
        locations, metric, "restaurant_id", n, ["restaurant_id", label, *SORTABLE, "performance_tier"]
    )


def serve_location_kpis(locations: DataFrame) -> DataFrame:
    by_rank = F.struct(F.col("revenue_rank"), F.col("restaurant_id"))
    place = F.struct("restaurant_id", "total_revenue")
    return locations.agg(
        F.min_by(place, by_rank).alias("first"),
        # Among equal last ranks the first identifier is shown.
        F.min_by(place, F.struct(-F.col("revenue_rank"), F.col("restaurant_id"))).alias("last"),
        mean("total_revenue").alias("avg_revenue"),
        F.count_if(F.col("performance_tier") == "Top Performer").alias("top_performers"),
    ).select(
        location_label(F.col("first.restaurant_id")).alias("top_location"),
        F.col("first.total_revenue").alias("top_revenue"),
        location_label(F.col("last.restaurant_id")).alias("bottom_location"),
        F.col("last.total_revenue").alias("bottom_revenue"),
        (F.col("first.total_revenue") - F.col("last.total_revenue")).alias("revenue_gap"),
        "avg_revenue",
        "top_performers",
    )


def serve_location_size_capped(locations: DataFrame) -> DataFrame:
    cap = quantile(locations, "total_orders", 95)
    return locations.select(
        "restaurant_id",
        "performance_tier",
        "avg_order_value",
        "total_revenue",
        F.least(F.col("total_orders"), cap).alias("size_capped"),
    )


def serve_location_scorecard(locations: DataFrame) -> DataFrame:
    return locations.select(
        "revenue_rank",
        location_label(F.col("restaurant_id")).alias("location_label"),
        "total_revenue",
        "avg_order_value",
        "total_orders",
        "unique_customers",
        "avg_daily_revenue",
        "performance_tier",
    ).orderBy("revenue_rank", "location_label")


def serve_location_monthly(
    trends: DataFrame,
    locations: DataFrame,
    chosen: Sequence[str] | None = None,
    first: int = DEFAULT_COMPARED,
) -> DataFrame:
    """Monthly revenue of all chosen locations, whatever their rank (default: the ``first`` ones)."""
    ranked = locations.orderBy("revenue_rank", "restaurant_id")
    if chosen is None:
        compared = ranked.limit(first)
    else:
        compared = locations.where(F.col("restaurant_id").isin(list(chosen)))
    label = ranked_location_label(F.col("revenue_rank"), F.col("restaurant_id"))
    labels = broadcast_if_small(
        reliable(compared.select("restaurant_id", label.alias("location_label")))
    )
    monthly = (
        trends.join(labels, "restaurant_id", "left_semi")
        .where(F.col("order_date").isNotNull())
        .groupBy(month_start(F.col("order_date")).alias("month_start"), "restaurant_id")
        .agg(money(F.sum("total_revenue")).alias("total_revenue"))
    )
    return monthly.join(labels, "restaurant_id")


def serve_location_extremes(locations: DataFrame, n: int = 5) -> DataFrame:
    best = locations.orderBy("revenue_rank", "restaurant_id").limit(n)
    worst = locations.orderBy(F.desc("revenue_rank"), "restaurant_id").limit(n)
    return best.withColumn("side", F.lit("top")).unionByName(
        worst.withColumn("side", F.lit("bottom"))
    )
