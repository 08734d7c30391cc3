"""Recency, frequency and monetary segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.numbers import mean, share_of
from orderlens.operators.ordering import box_stats, quantiles

# The action guide (segment, profile, recommended action, priority).
ACTION_GUIDE = [
    (
        "VIP",
        "Ordered recently, often, and spends a lot",
        "Reward with exclusive offers, early access, loyalty perks",
        "High",
    ),
    (
        "Regular",
        "Active but not top tier across all dimensions",
        "Upsell with bundle deals, encourage loyalty sign-up",
        "Medium",
    ),
    (
        "New Customer",
        "Ordered recently but infrequently",
        "Onboard with welcome series, promote loyalty program",
        "Monitor",
    ),
    (
        "Churn Risk",
        "Hasn't ordered in a while, low frequency",
        "Re-engage with win-back campaign, time-limited discount",
        "High",
    ),
]


def serve_rfm_filter(
    rfm: DataFrame,
    segment: str | None = None,
    min_score: int | None = None,
    max_score: int | None = None,
    max_recency: int | None = None,
) -> DataFrame:
    if segment is not None:
        rfm = rfm.where(F.col("rfm_segment") == segment)
    if min_score is not None:
        rfm = rfm.where(F.col("rfm_score") >= min_score)
    if max_score is not None:
        rfm = rfm.where(F.col("rfm_score") <= max_score)
    if max_recency is not None:
        rfm = rfm.where(F.col("recency_days") <= max_recency)
    return rfm


def serve_rfm_kpis(rfm: DataFrame) -> DataFrame:
    vip, lapsing = F.col("rfm_segment") == "VIP", F.col("rfm_segment") == "Churn Risk"
    return rfm.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(vip).alias("vip_customers"),
        share_of(vip, 1).alias("vip_pct"),
        F.count_if(lapsing).alias("churn_risk_customers"),
        share_of(lapsing, 1).alias("churn_risk_pct"),
        mean("monetary").alias("avg_monetary"),
    )


def serve_rfm_profile(rfm: DataFrame) -> DataFrame:
    return (
        rfm.groupBy("rfm_segment")
        .agg(
            mean("recency_days", 1).alias("avg_recency_days"),
            mean("frequency", 1).alias("avg_frequency"),
            mean("monetary").alias("avg_monetary"),
            F.count("user_id").alias("customers"),
        )
        .orderBy(F.col("avg_monetary").desc())
    )


def serve_rfm_score_box(rfm: DataFrame) -> DataFrame:
    return box_stats(rfm, "rfm_score", ["rfm_segment"])


def _within_p95(rfm: DataFrame) -> DataFrame:
    """Add ``shown``: neither frequency nor spend lies above its own 95th percentile."""
    measures = [
        F.struct(F.lit(c).alias("measure"), F.col(c).cast("decimal(20,4)").alias("value"))
        for c in ("frequency", "monetary")
    ]
    long = rfm.select(F.inline(F.array(*measures)))
    caps = quantiles(long, "value", {"cap": 95}, ["measure"])
    cap = caps.agg(
        F.struct(
            *[
                F.max(F.when(F.col("measure") == c, F.col("cap"))).alias(c)
                for c in ("frequency", "monetary")
            ]
        ).alias("cap")
    ).scalar()
    shown = (F.col("frequency") <= F.col("_cap.frequency")) & (
        F.col("monetary") <= F.col("_cap.monetary")
    )
    return (
        rfm.withColumn("_cap", cap)
        .withColumn("shown", F.coalesce(shown, F.lit(False)))
        .drop("_cap")
    )


def serve_rfm_p95_points(rfm: DataFrame) -> DataFrame:
    return (
        _within_p95(rfm)
        .where("shown")
        .select("user_id", "rfm_segment", "frequency", "monetary", "recency_days", "rfm_score")
    )


def serve_rfm_p95_hidden(rfm: DataFrame) -> DataFrame:
    return _within_p95(rfm).agg(F.count_if(~F.col("shown")).alias("hidden_customers"))


def serve_rfm_scores_long(rfm: DataFrame) -> DataFrame:
    scores = rfm.groupBy("rfm_segment").agg(
        mean("r_score", 4).alias("R"), mean("f_score", 4).alias("F"), mean("m_score", 4).alias("M")
    )
    return scores.unpivot("rfm_segment", ["R", "F", "M"], "dimension", "avg_score")


def serve_rfm_action_guide(rfm: DataFrame) -> DataFrame:
    names = ["rfm_segment", "profile", "recommended_action", "priority"]
    rows = [
        F.struct(F.lit(i).alias("position"), *[F.lit(v).alias(n) for n, v in zip(names, row)])
        for i, row in enumerate(ACTION_GUIDE)
    ]
    guide = rfm.sparkSession.range(1).select(F.inline(F.array(*rows)))
    counts = rfm.groupBy("rfm_segment").agg(F.count(F.lit(1)).alias("n"))
    return (
        guide.join(counts, "rfm_segment", "left")
        .withColumn("customers", F.coalesce("n", F.lit(0)))
        .orderBy("position")
        .select(*names, "customers")
    )
