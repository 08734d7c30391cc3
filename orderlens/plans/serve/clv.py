"""Customer lifetime value."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions.numbers import mean, safe_ratio
from orderlens.functions.text import loyalty_label, mask_id
from orderlens.operators.selection import fold, folded_quantiles
from orderlens.operators.tables import latest_row, top


def latest_snapshots(clv: DataFrame) -> DataFrame:
    """The newest snapshot of every customer."""
    return latest_row(
        clv.where(F.col("user_id").isNotNull()),
        "user_id",
        ["snapshot_date", "is_loyalty"],
        ["snapshot_date", "total_revenue_to_date", "clv_tier", "is_loyalty"],
    )


def filtered_latest(
    clv: DataFrame, tier: str | None = None, loyalty: bool | None = None
) -> DataFrame:
    latest = latest_snapshots(clv)
    if tier is not None:
        latest = latest.where(F.col("clv_tier") == tier)
    if loyalty is not None:
        latest = latest.where(F.col("is_loyalty") == loyalty)
    return latest


def serve_clv_filter(
    clv: DataFrame,
    tier: str | None = None,
    loyalty: bool | None = None,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """All snapshots in the date range of the customers whose newest snapshot passes."""
    snapshots = clv
    if start is not None:
        snapshots = snapshots.where(F.col("snapshot_date") >= F.lit(start))
    if end is not None:
        snapshots = snapshots.where(F.col("snapshot_date") <= F.lit(end))
    if tier is None and loyalty is None:
        return snapshots
    keep = filtered_latest(clv, tier, loyalty).select("user_id")
    return snapshots.join(keep, "user_id", "left_semi")


def serve_clv_kpis(
    clv: DataFrame, tier: str | None = None, loyalty: bool | None = None
) -> DataFrame:
    """All four figures come from one fold of the newest totals, one row per customer before it."""
    values = fold(filtered_latest(clv, tier, loyalty), "total_revenue_to_date", nulls=True)
    known = F.when(F.col("_value").isNotNull(), F.col("_n"))
    # The ten largest values hold the ten best customers; of the last only as many as still count.
    in_front = Window.orderBy(F.desc("_value")).rowsBetween(Window.unboundedPreceding, -1)
    best = (
        values.where(F.col("_value").isNotNull())
        .orderBy(F.desc("_value"))
        .limit(10)
        .withColumn("_left", 10 - F.coalesce(F.sum("_n").over(in_front), F.lit(0)))
        .where("_left > 0")
        .agg(F.sum(F.col("_value") * F.least("_n", "_left")).cast("decimal(30,2)"))
    )
    medians = folded_quantiles(values.where(F.col("_value").isNotNull()), {"q": 50})
    return values.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("customers"),
        safe_ratio(F.sum(F.col("_value") * F.col("_n")), F.sum(known)).alias("avg_clv"),
    ).withColumns(
        {
            "median_clv": medians.agg(F.max("q")).scalar(),
            "top10_revenue": best.scalar(),
        }
    )


def serve_clv_tier_avg(clv: DataFrame) -> DataFrame:
    return (
        latest_snapshots(clv)
        .groupBy("clv_tier")
        .agg(mean("total_revenue_to_date").alias("avg_revenue"))
        .orderBy("avg_revenue")
    )


def serve_clv_growth(snapshots: DataFrame) -> DataFrame:
    """Mean running total per day, over the customers with a snapshot on that day."""
    return (
        snapshots.where(F.col("snapshot_date").isNotNull())
        .groupBy("snapshot_date")
        .agg(mean("total_revenue_to_date").alias("avg_clv"))
    )


def serve_clv_by_loyalty(clv: DataFrame) -> DataFrame:
    return (
        latest_snapshots(clv)
        .where(F.col("is_loyalty").isNotNull())
        .groupBy("is_loyalty")
        .agg(mean("total_revenue_to_date").alias("avg_clv"))
        .select(loyalty_label(F.col("is_loyalty")).alias("group_label"), "is_loyalty", "avg_clv")
    )


def serve_clv_top10(
    clv: DataFrame, tier: str | None = None, loyalty: bool | None = None
) -> DataFrame:
    return top(
        filtered_latest(clv, tier, loyalty),
        "total_revenue_to_date",
        "user_id",
        10,
        [
            mask_id(F.col("user_id")).alias("customer"),
            "total_revenue_to_date",
            "clv_tier",
            "is_loyalty",
        ],
    )
