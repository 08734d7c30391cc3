"""Loyalty programme impact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.numbers import percent, zero_if_null
from orderlens.operators.ordering import box_stats
from orderlens.plans.serve.clv import latest_snapshots

# Column of the Gold table -> name of the figure.
METRICS = {
    "avg_clv": "Avg CLV",
    "avg_orders_per_customer": "Avg Orders",
    "avg_order_value": "Avg Order Value",
    "repeat_purchase_rate_pct": "Repeat Rate",
}
_ALL = [*METRICS, "total_customers"]


def _side_by_side(loyalty: DataFrame) -> DataFrame:
    """The two rows of the Gold table as one: ``member_*`` and ``other_*``; 0 where absent."""
    flag = F.col("is_loyalty")
    return loyalty.agg(
        *[
            zero_if_null(F.max(F.when(side, F.col(c)))).alias(f"{prefix}_{c}")
            for prefix, side in (("member", flag), ("other", ~flag))
            for c in _ALL
        ]
    )


def _pair(column: str) -> tuple[Column, Column]:
    return F.col(f"member_{column}"), F.col(f"other_{column}")


def _lift() -> Column:
    member, other = _pair("avg_clv")
    return F.when(other > 0, percent(member - other, other, 1)).otherwise(F.lit(0))


def serve_loyalty_overview(loyalty: DataFrame) -> DataFrame:
    members, others = _pair("total_customers")
    share = F.when(members + others > 0, percent(members, members + others, 1))
    deltas = [
        (_pair(c)[0] - _pair(c)[1]).alias(f"{c}_delta") for c in METRICS
    ]
    return _side_by_side(loyalty).select(
        members.alias("loyalty_customers"),
        others.alias("other_customers"),
        share.alias("loyalty_pct"),
        _lift().alias("clv_lift_pct"),
        *deltas,
    )


def serve_loyalty_compare(loyalty: DataFrame) -> DataFrame:
    """One row per figure; the advantage of the lifetime value is a percentage."""
    amount = "decimal(20,2)"
    rows = []
    for position, column in enumerate(_ALL):
        member, other = _pair(column)
        advantage = {"avg_clv": _lift(), "total_customers": F.lit(None)}.get(
            column, member - other
        )
        rows.append(
            F.struct(
                F.lit(position).alias("position"),
                F.lit(column).alias("metric"),
                member.cast(amount).alias("loyalty_members"),
                other.cast(amount).alias("non_members"),
                advantage.cast(amount).alias("advantage"),
            )
        )
    return _side_by_side(loyalty).select(F.inline(F.array(*rows))).orderBy("position")


def serve_loyalty_index(loyalty: DataFrame) -> DataFrame:
    """Each figure with the non-members at 100 (a missing base counts as 1)."""
    rows = []
    for column, name in METRICS.items():
        member, other = _pair(column)
        base = F.when(other > 0, other).otherwise(F.lit(1))
        for group, value in (("Non-Members", F.lit(100)), ("Loyalty Members", None)):
            index = percent(member, base, 1) if value is None else value
            rows.append(
                F.struct(
                    F.lit(name).alias("metric"),
                    F.lit(group).alias("group_label"),
                    index.cast("decimal(20,1)").alias("value"),
                )
            )
    return _side_by_side(loyalty).select(F.inline(F.array(*rows)))


def serve_loyalty_clv_box(clv: DataFrame) -> DataFrame:
    """The cap is taken over all customers, also those without a flag, who have no box."""
    boxes = box_stats(latest_snapshots(clv), "total_revenue_to_date", ["is_loyalty"], cap_percent=95)
    return boxes.where(F.col("is_loyalty").isNotNull())
