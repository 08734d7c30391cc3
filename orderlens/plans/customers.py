"""Gold tables about customers.

All builders take Silver rows. They only sum revenue, take maxima and count distinct orders, so they
give the same result on :func:`order_facts`, which is several times shorter: the pipeline stores it by
month and every builder reads the columns and months it needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.config import Config
from orderlens.functions.dates import reference_day, year_and_month
from orderlens.functions.numbers import mean, money, percent, safe_ratio
from orderlens.operators.ordering import ntiles, percent_rank_cuts
from orderlens.schemas import GOLD
from orderlens.session import reliable, scratch_folder
from orderlens.sources.files import store


def order_facts(silver: DataFrame) -> DataFrame:
    """Silver folded to order grain: revenue and bulk flag per order, customer, place and day."""
    facts = silver.groupBy("order_id", "user_id", "restaurant_id", "order_date", "is_loyalty").agg(
        F.sum("gross_revenue").alias("gross_revenue"),
        F.max("is_bulk_order_candidate").alias("is_bulk_order_candidate"),
    )
    return facts.withColumns(year_and_month(F.col("order_date")))


def daily_customers(orders: DataFrame) -> DataFrame:
    """Revenue, orders and bulk orders per customer, day and loyalty flag.

    Folding to one row per order first replaces both distinct counts by plain ones and spreads a
    customer who holds a large part of all rows over the order ids.
    """
    per_order = orders.groupBy("user_id", "order_date", "is_loyalty", "order_id").agg(
        F.sum("gross_revenue").alias("revenue"),
        F.max("is_bulk_order_candidate").alias("is_bulk"),
    )
    return per_order.groupBy("user_id", "order_date", "is_loyalty").agg(
        F.sum("revenue").alias("daily_revenue"),
        F.count("order_id").alias("daily_orders"),
        F.count(F.when(F.col("is_bulk"), F.col("order_id"))).alias("daily_bulk_orders"),
    )


def running_customer_totals(daily: DataFrame) -> DataFrame:
    """Totals up to each day. A customer has at most a few rows per calendar day here."""
    so_far = (
        Window.partitionBy("user_id")
        .orderBy("order_date", "is_loyalty")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return daily.withColumns(
        {
            "total_revenue_to_date": money(F.sum("daily_revenue").over(so_far)),
            "orders_to_date": F.sum("daily_orders").over(so_far).cast("int"),
            "bulk_orders_to_date": F.sum("daily_bulk_orders").over(so_far).cast("int"),
        }
    )


def customer_clv_daily(orders: DataFrame, cfg: Config) -> DataFrame:
    """Lifetime value of every customer as it grows, with a tier from the final value."""
    totals = running_customer_totals(daily_customers(orders))
    whole = Window.partitionBy("user_id")
    # In columns, as the tiers read one of them and a page a few.
    snapshots = store(
        totals.withColumn("final_total", F.max("total_revenue_to_date").over(whole)),
        scratch_folder(orders.sparkSession),
    )
    population = snapshots.select("user_id", "final_total")
    if cfg.clv_population == "customers":
        population = population.distinct()
    cuts = percent_rank_cuts(
        population, "final_total", {"high": cfg.clv_high_share, "medium": cfg.clv_medium_share}
    )
    tier = (
        F.when(F.col("final_total") > F.col("_cuts.high"), "High")
        .when(F.col("final_total") > F.col("_cuts.medium"), "Medium")
        .otherwise("Low")
    )
    return snapshots.withColumn("_cuts", cuts).withColumns(
        {
            "snapshot_date": F.col("order_date"),
            "avg_order_value": safe_ratio(
                F.col("total_revenue_to_date"), F.col("orders_to_date")
            ),
            "has_bulk_order_candidate": F.col("bulk_orders_to_date") > 0,
            "clv_tier": tier,
        }
    ).select(*GOLD["customer_clv_daily"])


def customer_recency(orders: DataFrame, cfg: Config) -> DataFrame:
    """Recency, frequency and spend of the customers active in the look-back window."""
    first_day = F.date_sub(F.col("_today"), cfg.rfm_months * 30)
    # A comparison on the plain column reaches the scan; datediff() on it would not.
    recent = orders.withColumn("_today", reference_day(orders, cfg.reference_day)).where(
        F.col("order_date") >= first_day
    )
    if {"year", "month"} <= set(orders.columns):
        # Silver is laid out by year and month: skip the directories before the window.
        recent = recent.where(F.make_date("year", "month", F.lit(1)) >= F.trunc(first_day, "month"))
    return recent.groupBy("user_id").agg(
        F.date_diff(F.max("_today"), F.max("order_date")).alias("recency_days"),
        F.count_distinct("order_id").alias("frequency"),
        money(F.sum("gross_revenue")).alias("monetary"),
    )


def customer_rfm_segments(orders: DataFrame, cfg: Config) -> DataFrame:
    """Quartile scores per measure and the segment they put a customer in."""
    scored = ntiles(
        reliable(customer_recency(orders, cfg)),
        "user_id",
        ["recency_days", "frequency", "monetary"],
        4,
    ).withColumns(
        {
            "r_score": F.lit(5) - F.col("recency_days_tile"),
            "f_score": F.col("frequency_tile"),
            "m_score": F.col("monetary_tile"),
        }
    )
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return scored.withColumns(
        {
            "rfm_score": r + f + m,
            "rfm_segment": F.when((r >= 3) & (f >= 3) & (m >= 3), "VIP")
            .when((r >= 3) & (f <= 2), "New Customer")
            .when((r <= 2) & (f <= 2), "Churn Risk")
            .otherwise("Regular"),
        }
    ).select(*GOLD["customer_rfm_segments"])


def customer_churn_indicators(orders: DataFrame, cfg: Config) -> DataFrame:
    """Activity profile per customer, all windows in one aggregation."""
    age = F.date_diff(F.col("_today"), F.col("order_date"))
    span = cfg.spend_window_days
    recent = F.when(age.between(0, span), F.col("gross_revenue"))
    before = F.when(age.between(span + 1, 2 * span), F.col("gross_revenue"))
    dated = orders.withColumn("_today", reference_day(orders, cfg.reference_day))
    per_customer = dated.groupBy("user_id").agg(
        F.max("_today").alias("_today"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.count_distinct("order_id").alias("total_orders"),
        money(F.sum("gross_revenue")).alias("total_spend"),
        money(F.sum(recent)).alias("spend_last_90"),
        money(F.sum(before)).alias("spend_prior_90"),
    )
    idle = F.date_diff(F.col("_today"), F.col("last_order_date"))
    active_days = F.date_diff("last_order_date", "first_order_date")
    prior = F.when(F.col("spend_prior_90") > 0, F.col("spend_prior_90"))
    return per_customer.withColumns(
        {
            "days_since_last_order": idle,
            "avg_order_gap_days": F.when(
                F.col("total_orders") > 1,
                safe_ratio(active_days, F.col("total_orders") - 1, places=1),
            ),
            "spend_change_pct": percent(F.col("spend_last_90") - prior, prior),
            "churn_risk_flag": F.coalesce(idle > cfg.churn_days, F.lit(False)),
        }
    ).select(*GOLD["customer_churn_indicators"])


def loyalty_comparison(orders: DataFrame, cfg: Config) -> DataFrame:
    """Members against non-members; whoever was seen as both counts in both groups."""
    per_customer = (
        orders.groupBy("user_id", "is_loyalty")
        .agg(
            money(F.sum("gross_revenue")).alias("spend"),
            F.count_distinct("order_id").alias("orders"),
        )
        .withColumn("order_value", safe_ratio(F.col("spend"), F.col("orders")))
    )
    customers = F.count("user_id")
    return per_customer.groupBy("is_loyalty").agg(
        customers.alias("total_customers"),
        mean("spend").alias("avg_clv"),
        mean("orders").alias("avg_orders_per_customer"),
        mean("order_value").alias("avg_order_value"),
        percent(F.count_if(F.col("orders") > 1), customers).alias("repeat_purchase_rate_pct"),
    )
