"""Figures of the overview and the value ranges behind the filter controls."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.dates import month_start
from orderlens.functions.numbers import mean, money, share_of, zero_if_null
from orderlens.plans.serve.clv import latest_snapshots


def _one(df: DataFrame, **figures: Column) -> Column:
    """Several aggregates of one table as one scalar struct: one scan per table."""
    return df.agg(F.struct(*[c.alias(n) for n, c in figures.items()]).alias("figures")).scalar()


def serve_home_kpis(
    clv: DataFrame,
    rfm: DataFrame,
    churn: DataFrame,
    loyalty: DataFrame,
    trends: DataFrame,
    locations: DataFrame,
) -> DataFrame:
    lifetime = (
        clv.where(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.max("total_revenue_to_date").alias("value"))
    )
    customers = _one(
        lifetime, n=F.count(F.lit(1)), total=F.sum("value"), average=mean("value")
    )
    risk = _one(churn, n=F.count_if("churn_risk_flag"), pct=share_of(F.col("churn_risk_flag"), 1))
    vips = _one(rfm, n=F.count_if(F.col("rfm_segment") == "VIP"))
    members = _one(loyalty, value=F.max(F.when(F.col("is_loyalty"), F.col("avg_clv"))))
    places = _one(
        locations,
        n=F.count_distinct("restaurant_id"),
        best=F.max(F.when(F.col("revenue_rank") == 1, F.col("total_revenue"))),
    )
    sales = _one(trends, orders=F.sum("order_count"))
    figures = {
        "customers": customers, "risk": risk, "vips": vips, "members": members,
        "places": places, "sales": sales,
    }
    scalars = [c.alias(n) for n, c in figures.items()]
    return clv.sparkSession.range(1).select(*scalars).select(
        F.col("customers.n").alias("total_customers"),
        F.col("customers.total").alias("total_revenue"),
        F.col("customers.average").alias("avg_clv"),
        F.col("risk.n").alias("at_risk_customers"),
        F.col("risk.pct").alias("at_risk_pct"),
        F.col("vips.n").alias("vip_customers"),
        zero_if_null(F.col("members.value")).alias("loyalty_avg_clv"),
        F.col("places.best").alias("top_location_revenue"),
        zero_if_null(F.col("sales.orders")).alias("total_orders"),
        F.col("places.n").alias("location_count"),
    )


def serve_filter_domains(
    df: DataFrame, ranges: Sequence[str] = (), choices: Sequence[str] = ()
) -> DataFrame:
    """Rows (field, kind, value): ``min`` and ``max`` of each range, each ``value`` of a choice."""
    parts = []
    if ranges:
        ends = [
            F.struct(
                F.lit(c).alias("field"),
                F.lit(kind).alias("kind"),
                pick(c).cast("string").alias("value"),
            )
            for c in ranges
            for kind, pick in (("min", F.min), ("max", F.max))
        ]
        parts.append(df.agg(F.array(*ends).alias("ends")).select(F.inline("ends")))
    if choices:
        values = [
            F.struct(
                F.lit(c).alias("field"),
                F.lit("value").alias("kind"),
                F.col(c).cast("string").alias("value"),
            )
            for c in choices
        ]
        parts.append(
            df.select(F.inline(F.array(*values))).where(F.col("value").isNotNull()).distinct()
        )
    if not parts:
        raise ValueError("name at least one range or choice")
    domains = parts[0]
    for part in parts[1:]:
        domains = domains.unionByName(part)
    return domains.orderBy("field", "kind", "value")


def serve_tier_distribution(clv: DataFrame) -> DataFrame:
    return latest_snapshots(clv).groupBy("clv_tier").agg(F.count(F.lit(1)).alias("customers"))


def serve_segment_distribution(rfm: DataFrame) -> DataFrame:
    return rfm.groupBy("rfm_segment").agg(F.count(F.lit(1)).alias("customers"))


def serve_monthly_revenue(trends: DataFrame) -> DataFrame:
    return (
        trends.where(F.col("order_date").isNotNull())
        .groupBy(month_start(F.col("order_date")).alias("month_start"))
        .agg(money(F.sum("total_revenue")).alias("total_revenue"))
    )
