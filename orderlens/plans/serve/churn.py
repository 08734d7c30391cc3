"""Churn risk."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.numbers import mean, money, share_of
from orderlens.functions.text import mask_id
from orderlens.operators.binning import histogram, labelled_rows, right_closed_bin
from orderlens.operators.ordering import box_stats, median
from orderlens.operators.tables import top

# Bins of the spend change in percent, open on the left.
SPEND_EDGES = [-200, -50, -10, 10, 50, 200]
SPEND_LABELS = ["< -50%", "-50% to -10%", "-10% to +10%", "+10% to +50%", "> +50%"]
OUT_OF_RANGE = "out of range"


def serve_churn_rethreshold(
    churn: DataFrame, days: int = 45, min_orders: int = 1, at_risk_only: bool = False
) -> DataFrame:
    """Recompute the flag for any threshold, then filter."""
    flagged = churn.withColumn(
        "churn_risk_flag", F.coalesce(F.col("days_since_last_order") > days, F.lit(False))
    ).where(F.col("total_orders") >= min_orders)
    return flagged.where("churn_risk_flag") if at_risk_only else flagged


def serve_churn_kpis(churn: DataFrame) -> DataFrame:
    flag = F.col("churn_risk_flag")
    return churn.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(flag).alias("at_risk_customers"),
        share_of(flag, 1).alias("at_risk_pct"),
        F.count_if(~flag).alias("safe_customers"),
        mean(F.when(flag, F.col("days_since_last_order"))).alias("avg_days_inactive_at_risk"),
    ).withColumn("median_order_gap_days", median(churn, "avg_order_gap_days"))


def serve_hist_inactivity(churn: DataFrame, bins: int = 40) -> DataFrame:
    return histogram(churn, "days_since_last_order", "churn_risk_flag", bins)


def serve_hist_gap(churn: DataFrame, bins: int = 40) -> DataFrame:
    """Average order gaps up to their 95th percentile."""
    return histogram(
        churn, "avg_order_gap_days", "churn_risk_flag", bins, Decimal("0.1"), cap_percent=95
    )


def serve_spend_buckets(churn: DataFrame, with_out_of_range: bool = True) -> DataFrame:
    """Customers per bin of spend change, with a row for values beyond the outer edges."""
    labels = SPEND_LABELS + ([OUT_OF_RANGE] if with_out_of_range else [])
    bucket = right_closed_bin(F.col("spend_change_pct"), SPEND_EDGES, SPEND_LABELS)
    counts = (
        churn.where(F.col("spend_change_pct").isNotNull())
        .groupBy(F.coalesce(bucket, F.lit(OUT_OF_RANGE)).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        labelled_rows(churn, "bucket", labels)
        .join(counts, "bucket", "left")
        .select("position", "bucket", F.coalesce("n", F.lit(0)).alias("customers"))
        .orderBy("position")
    )


def serve_revenue_at_stake(churn: DataFrame) -> DataFrame:
    flag = F.col("churn_risk_flag")
    spend_at_risk, spend_safe = [F.when(side, F.col("total_spend")) for side in (flag, ~flag)]
    return churn.agg(
        money(F.sum(spend_at_risk)).alias("at_risk_spend"),
        mean(spend_at_risk).alias("avg_at_risk_spend"),
        mean(spend_safe).alias("avg_safe_spend"),
    ).withColumn("avg_spend_delta", F.col("avg_at_risk_spend") - F.col("avg_safe_spend"))


def serve_churn_spend_box(churn: DataFrame) -> DataFrame:
    return box_stats(churn, "total_spend", ["churn_risk_flag"], cap_percent=95)


def serve_at_risk_top50(churn: DataFrame) -> DataFrame:
    return top(
        churn.where("churn_risk_flag"),
        "total_spend",
        "user_id",
        50,
        [
            mask_id(F.col("user_id")).alias("customer"),
            "days_since_last_order",
            "total_orders",
            "total_spend",
            "avg_order_gap_days",
            "spend_change_pct",
        ],
    )
