"""Column contracts of the source, Silver and Gold tables."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 4)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in columns.items()])


ORDER_ITEMS = _struct(
    app_name=T.StringType(),
    restaurant_id=T.StringType(),
    creation_time_utc=T.StringType(),
    order_id=T.StringType(),
    user_id=T.StringType(),
    printed_card_number=T.StringType(),
    is_loyalty=T.BooleanType(),
    currency=T.StringType(),
    lineitem_id=T.StringType(),
    item_category=T.StringType(),
    item_name=T.StringType(),
    item_price=MONEY,
    item_quantity=T.IntegerType(),
)

ORDER_ITEM_OPTIONS = _struct(
    order_id=T.StringType(),
    lineitem_id=T.StringType(),
    option_group_name=T.StringType(),
    option_name=T.StringType(),
    option_price=MONEY,
    option_quantity=T.IntegerType(),
)

DATE_DIM = _struct(
    date_key=T.StringType(),
    day_of_week=T.StringType(),
    week=T.IntegerType(),
    month=T.StringType(),
    year=T.IntegerType(),
    is_weekend=T.BooleanType(),
    is_holiday=T.BooleanType(),
    holiday_name=T.StringType(),
)

SOURCES = {
    "order_items": ORDER_ITEMS,
    "order_item_options": ORDER_ITEM_OPTIONS,
    "date_dim": DATE_DIM,
}

SILVER = _struct(
    app_name=T.StringType(),
    restaurant_id=T.StringType(),
    creation_time_utc=T.TimestampType(),
    order_id=T.StringType(),
    user_id=T.StringType(),
    is_loyalty=T.BooleanType(),
    currency=T.StringType(),
    lineitem_id=T.StringType(),
    item_category=T.StringType(),
    item_name=T.StringType(),
    item_price=MONEY,
    item_quantity=T.IntegerType(),
    order_date=T.DateType(),
    option_revenue=MONEY,
    option_row_count=T.IntegerType(),
    week=T.IntegerType(),
    day_of_week=T.StringType(),
    is_weekend=T.BooleanType(),
    is_holiday=T.BooleanType(),
    holiday_name=T.StringType(),
    gross_revenue=MONEY,
    is_bulk_order_candidate=T.BooleanType(),
    bulk_flag_reason=T.StringType(),
    year=T.IntegerType(),
    month=T.IntegerType(),
)

# Gold tables and their columns, in order.
GOLD = {
    "customer_clv_daily": [
        "user_id", "snapshot_date", "daily_revenue", "total_revenue_to_date",
        "orders_to_date", "avg_order_value", "clv_tier", "is_loyalty",
        "bulk_orders_to_date", "has_bulk_order_candidate",
    ],
    "customer_rfm_segments": [
        "user_id", "recency_days", "frequency", "monetary", "r_score", "f_score",
        "m_score", "rfm_score", "rfm_segment",
    ],
    "customer_churn_indicators": [
        "user_id", "days_since_last_order", "avg_order_gap_days", "total_orders",
        "total_spend", "spend_last_90", "spend_prior_90", "spend_change_pct",
        "churn_risk_flag", "first_order_date", "last_order_date",
    ],
    "sales_trends": [
        "order_date", "year", "month", "week", "day_of_week", "is_weekend", "is_holiday",
        "holiday_name", "restaurant_id", "item_category", "total_revenue", "order_count",
        "unique_customers", "avg_item_revenue",
    ],
    "loyalty_comparison": [
        "is_loyalty", "total_customers", "avg_clv", "avg_orders_per_customer",
        "avg_order_value", "repeat_purchase_rate_pct",
    ],
    "location_performance": [
        "revenue_rank", "restaurant_id", "total_revenue", "total_orders",
        "unique_customers", "avg_order_value", "avg_daily_revenue", "performance_tier",
    ],
    "discount_effectiveness": [
        "order_id", "user_id", "restaurant_id", "order_date", "year", "month", "is_loyalty",
        "gross_revenue", "total_line_items", "unique_items", "has_free_item",
        "free_item_count", "free_item_revenue_loss", "has_below_avg_item",
        "below_avg_price_item_count", "below_avg_discount_amt", "total_estimated_discount",
        "is_promotional_order", "order_type",
    ],
}
