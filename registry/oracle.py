"""The registered queries as SQL over the given tables, written independently of the Spark code.

``TABLES`` holds the intermediate tables as common table expressions in dependency order;
``ORACLE`` the final SELECT per query. Quotients are rounded half-up by long division in whole numbers.
"""

from __future__ import annotations

import re


def ratio(num: str, den: str, places: int = 2, factor: int = 1) -> str:
    """Long division in HUGEINT: quotient, and one more if twice the remainder reaches the divisor."""
    step = 10**places
    n = f"CAST(CAST({num} AS DECIMAL(28, 4)) * 10000 AS HUGEINT)"
    d = f"nullif(CAST(CAST({den} AS DECIMAL(28, 4)) * 10000 AS HUGEINT), 0)"
    top = f"(abs({n}) * {step * factor})"
    up = f"CASE WHEN 2 * ({top} % abs({d})) >= abs({d}) THEN 1 ELSE 0 END"
    return f"(CAST(sign({n}) * sign({d}) * ({top} // abs({d}) + {up}) AS DOUBLE) / {step}.0)"


def pct(part: str, whole: str, places: int = 2) -> str:
    return ratio(part, whole, places, 100)


def avg(column: str, places: int = 2, where: str | None = None) -> str:
    only = f" FILTER (WHERE {where})" if where else ""
    return ratio(f"sum({column}){only}", f"count({column}){only}", places)


def dbl(expression: str, name: str | None = None) -> str:
    return f"CAST({expression} AS DOUBLE) AS {name or expression}"


def quant(column: str, share: float) -> str:
    return f"round(quantile_cont(CAST({column} AS DOUBLE), {share}), 6)"


def box(column: str) -> str:
    q1, q3 = quant(column, 0.25), quant(column, 0.75)
    return (
        f"count({column}) AS n, CAST(min({column}) AS DOUBLE) AS min, {q1} AS q1,"
        f" {quant(column, 0.5)} AS median, {q3} AS q3, CAST(max({column}) AS DOUBLE) AS max,"
        f" round({q1} - 1.5 * ({q3} - {q1}), 6) AS lower_fence,"
        f" round({q3} + 1.5 * ({q3} - {q1}), 6) AS upper_fence"
    )


LINE_ID = (
    "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INTEGER))"
)
REF = "(SELECT max(order_date) FROM silver)"
BULK_P = "item_price >= 980"
BULK_Q = "item_quantity >= 50"
TIER = """CASE WHEN pr > 0.80 THEN 'High' WHEN pr > 0.20 THEN 'Medium' ELSE 'Low' END"""

TABLES: dict[str, str] = {}

TABLES["items"] = f"""
SELECT CASE WHEN o_orderkey % 100 = 7 THEN 'Store - DEVELOPMENT' ELSE 'Store' END AS app_name,
       'LOC-' || c_nationkey AS restaurant_id,
       CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%gZ')
            ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS creation_time_utc,
       CAST(o_orderkey AS VARCHAR) AS order_id,
       CAST(o_custkey AS VARCHAR) AS user_id,
       CAST(NULL AS VARCHAR) AS printed_card_number,
       (c_mktsegment = 'BUILDING' AND o_orderstatus <> 'P') AS is_loyalty,
       'USD' AS currency,
       {LINE_ID} AS lineitem_id,
       CASE WHEN p_partkey % 10 = 0 THEN p_type || ' https://x.y/1'
            WHEN p_partkey % 10 = 1 THEN p_type || '`1'
            WHEN p_partkey % 10 = 2 THEN ' ' || p_type ELSE p_type END AS item_category,
       p_name AS item_name,
       CAST(CASE WHEN l_returnflag = 'R' AND l_discount = CAST(0.1 AS DOUBLE) THEN 0
            ELSE CAST(p_retailprice AS DECIMAL(12, 2)) * (1 - CAST(l_discount AS DECIMAL(3, 2)))
            END AS DECIMAL(18, 4)) AS item_price,
       CAST(l_quantity AS INTEGER) AS item_quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey"""

TABLES["first_options"] = f"""
SELECT l_orderkey AS k, CAST(l_orderkey AS VARCHAR) AS order_id, {LINE_ID} AS lineitem_id,
       l_returnflag AS option_group_name, l_linestatus AS option_name,
       CAST(CAST(l_tax AS DECIMAL(3, 2)) * 25 AS DECIMAL(18, 4)) AS option_price,
       l_linenumber AS option_quantity
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_tax >= CAST(0.03 AS DOUBLE)
UNION ALL
SELECT l_orderkey, CAST(l_orderkey AS VARCHAR), {LINE_ID}, 'Size', CAST(p_size AS VARCHAR),
       CAST(0.50 AS DECIMAL(18, 4)), 1
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size % 2 = 0"""

TABLES["options"] = """
SELECT * EXCLUDE (k) FROM first_options
UNION ALL SELECT * EXCLUDE (k) FROM first_options WHERE k % 50 = 3
UNION ALL SELECT * EXCLUDE (k) REPLACE (lineitem_id || '-X' AS lineitem_id)
          FROM first_options WHERE k % 500 = 11"""

TABLES["date_dim"] = """
SELECT DISTINCT strftime(d, '%d-%m-%Y') AS date_key, strftime(d, '%A') AS day_of_week,
       CAST(week(d) AS INTEGER) AS week, strftime(d, '%B') AS month,
       CAST(year(d) AS INTEGER) AS year, dayofweek(d) IN (0, 6) AS is_weekend,
       day(d) = 1 AS is_holiday,
       CASE WHEN day(d) = 1 THEN 'Holiday ' || month(d) END AS holiday_name
FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders) WHERE dayofyear(d) % 29 <> 0"""

TABLES["cleaned"] = r"""
SELECT * EXCLUDE (creation_time_utc, item_category),
       TRY_CAST(creation_time_utc AS TIMESTAMP) AS creation_time_utc,
       CAST(TRY_CAST(creation_time_utc AS TIMESTAMP) AS DATE) AS order_date,
       CASE WHEN c = 'Sqalads' THEN 'Salads' ELSE c END AS item_category
FROM (SELECT *, trim(regexp_replace(regexp_replace(item_category, 'https?://\S+', '', 'g'),
                                    '[^a-zA-Z\s&''\-]+$', '', 'g'), ' ') AS c
      FROM items WHERE app_name <> 'Store - DEVELOPMENT')"""

TABLES["option_rows"] = "SELECT DISTINCT * FROM options"

TABLES["rollup"] = """
SELECT order_id, lineitem_id, sum(option_price * option_quantity) AS option_revenue,
       count(*) AS option_row_count FROM option_rows GROUP BY order_id, lineitem_id"""

TABLES["spine"] = """
SELECT d AS date_key, CAST(year(d) AS INTEGER) AS year, strftime(d, '%B') AS month,
       CAST(week(d) AS INTEGER) AS week, strftime(d, '%A') AS day_of_week,
       dayofweek(d) IN (0, 6) AS is_weekend, coalesce(h.is_holiday, false) AS is_holiday,
       h.holiday_name AS holiday_name
FROM (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2000-12-31', INTERVAL 1 DAY))
             AS DATE) AS d)
LEFT JOIN (SELECT CAST(try_strptime(date_key, '%d-%m-%Y') AS DATE) AS hd, is_holiday, holiday_name
           FROM date_dim) h ON h.hd = d"""

TABLES["silver"] = f"""
SELECT *, {BULK_P} OR {BULK_Q} AS is_bulk_order_candidate,
       CASE WHEN {BULK_P} AND {BULK_Q} THEN 'high_item_price_and_quantity'
            WHEN {BULK_P} THEN 'high_item_price' WHEN {BULK_Q} THEN 'high_item_quantity' END
       AS bulk_flag_reason
FROM (SELECT c.app_name, c.restaurant_id, c.creation_time_utc, c.order_id, c.user_id, c.is_loyalty,
             c.currency, c.lineitem_id, c.item_category, c.item_name, c.item_price,
             c.item_quantity, c.order_date,
             CAST(coalesce(r.option_revenue, 0) AS DECIMAL(18, 4)) AS option_revenue,
             CAST(coalesce(r.option_row_count, 0) AS INTEGER) AS option_row_count,
             s.week, s.day_of_week, s.is_weekend, s.is_holiday, s.holiday_name,
             CAST(c.item_price * c.item_quantity + coalesce(r.option_revenue, 0)
                  AS DECIMAL(18, 4)) AS gross_revenue,
             CAST(year(c.order_date) AS INTEGER) AS year,
             CAST(month(c.order_date) AS INTEGER) AS month
      FROM cleaned c
      LEFT JOIN rollup r ON r.order_id = c.order_id AND r.lineitem_id = c.lineitem_id
      LEFT JOIN spine s ON s.date_key = c.order_date)"""

TABLES["daily"] = """
SELECT user_id, order_date, is_loyalty, sum(gross_revenue) AS daily_revenue,
       count(DISTINCT order_id) AS daily_orders,
       count(DISTINCT CASE WHEN is_bulk_order_candidate THEN order_id END) AS daily_bulk_orders
FROM silver GROUP BY user_id, order_date, is_loyalty"""

TABLES["running"] = """
SELECT *, round(sum(daily_revenue) OVER w, 2) AS total_revenue_to_date,
       CAST(sum(daily_orders) OVER w AS INTEGER) AS orders_to_date,
       CAST(sum(daily_bulk_orders) OVER w AS INTEGER) AS bulk_orders_to_date
FROM daily WINDOW w AS (PARTITION BY user_id
     ORDER BY order_date NULLS FIRST, is_loyalty NULLS FIRST
     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

TABLES["finals"] = """
SELECT *, max(total_revenue_to_date) OVER (PARTITION BY user_id) AS final_total FROM running"""

TABLES["clv"] = f"""
SELECT user_id, order_date AS snapshot_date, daily_revenue, total_revenue_to_date, orders_to_date,
       {ratio('total_revenue_to_date', 'orders_to_date')} AS avg_order_value,
       {TIER} AS clv_tier, is_loyalty, bulk_orders_to_date,
       bulk_orders_to_date > 0 AS has_bulk_order_candidate
FROM (SELECT *, percent_rank() OVER (ORDER BY final_total NULLS FIRST) AS pr FROM finals)"""

TABLES["recency"] = f"""
SELECT user_id, CAST({REF} - max(order_date) AS INTEGER) AS recency_days,
       count(DISTINCT order_id) AS frequency, round(sum(gross_revenue), 2) AS monetary
FROM silver WHERE {REF} - order_date <= 180 GROUP BY user_id"""


def _tile(column: str) -> str:
    return f"ntile(4) OVER (ORDER BY {column} NULLS FIRST, user_id NULLS FIRST)"


TABLES["rfm"] = f"""
SELECT *, r_score + f_score + m_score AS rfm_score,
       CASE WHEN r_score >= 3 AND f_score >= 3 AND m_score >= 3 THEN 'VIP'
            WHEN r_score >= 3 AND f_score <= 2 THEN 'New Customer'
            WHEN r_score <= 2 AND f_score <= 2 THEN 'Churn Risk' ELSE 'Regular' END AS rfm_segment
FROM (SELECT *, CAST(5 - {_tile('recency_days')} AS INTEGER) AS r_score,
             CAST({_tile('frequency')} AS INTEGER) AS f_score,
             CAST({_tile('monetary')} AS INTEGER) AS m_score FROM recency)"""

TABLES["churn"] = f"""
SELECT b.user_id, CAST({REF} - last_order_date AS INTEGER) AS days_since_last_order,
       CASE WHEN total_orders > 1 THEN
         {ratio('last_order_date - first_order_date', 'total_orders - 1', 1)} END
         AS avg_order_gap_days,
       total_orders, total_spend, spend_last_90, spend_prior_90,
       CASE WHEN spend_prior_90 > 0 THEN
         {pct('spend_last_90 - spend_prior_90', 'spend_prior_90')} END AS spend_change_pct,
       {REF} - last_order_date > 45 AS churn_risk_flag, first_order_date, last_order_date
FROM (SELECT user_id, min(order_date) AS first_order_date, max(order_date) AS last_order_date,
             count(DISTINCT order_id) AS total_orders, round(sum(gross_revenue), 2) AS total_spend
      FROM silver GROUP BY user_id) b
LEFT JOIN (SELECT user_id, round(sum(gross_revenue), 2) AS spend_last_90 FROM silver
           WHERE {REF} - order_date BETWEEN 0 AND 90 GROUP BY user_id) r USING (user_id)
LEFT JOIN (SELECT user_id, round(sum(gross_revenue), 2) AS spend_prior_90 FROM silver
           WHERE {REF} - order_date BETWEEN 91 AND 180 GROUP BY user_id) p USING (user_id)"""

TABLES["trends"] = f"""
SELECT order_date, year, month, week, day_of_week, is_weekend, is_holiday, holiday_name,
       restaurant_id, item_category, round(sum(gross_revenue), 2) AS total_revenue,
       count(DISTINCT order_id) AS order_count, count(DISTINCT user_id) AS unique_customers,
       {avg('gross_revenue')} AS avg_item_revenue
FROM silver GROUP BY ALL"""

TABLES["per_customer"] = f"""
SELECT *, {ratio('spend', 'orders')} AS order_value
FROM (SELECT user_id, is_loyalty, round(sum(gross_revenue), 2) AS spend,
             count(DISTINCT order_id) AS orders FROM silver GROUP BY user_id, is_loyalty)"""

TABLES["loyalty"] = f"""
SELECT is_loyalty, count(user_id) AS total_customers, {avg('spend')} AS avg_clv,
       {avg('orders')} AS avg_orders_per_customer,
       {avg('CAST(order_value AS DECIMAL(18, 2))')} AS avg_order_value,
       {pct('count(*) FILTER (WHERE orders > 1)', 'count(user_id)')} AS repeat_purchase_rate_pct
FROM per_customer GROUP BY is_loyalty"""

TABLES["location_totals"] = f"""
SELECT restaurant_id, round(sum(gross_revenue), 2) AS total_revenue,
       count(DISTINCT order_id) AS total_orders, count(DISTINCT user_id) AS unique_customers,
       {ratio('sum(gross_revenue)', 'count(DISTINCT order_date)')} AS avg_daily_revenue
FROM silver GROUP BY restaurant_id"""

TABLES["locations"] = f"""
SELECT CAST(rk AS INTEGER) AS revenue_rank, restaurant_id, total_revenue, total_orders,
       unique_customers, {ratio('total_revenue', 'total_orders')} AS avg_order_value,
       avg_daily_revenue,
       CASE WHEN rk <= 5 THEN 'Top Performer'
            WHEN rk >= (SELECT count(*) FROM location_totals) - 2 THEN 'Needs Attention'
            ELSE 'Mid Tier' END AS performance_tier
FROM (SELECT *, dense_rank() OVER (ORDER BY total_revenue DESC NULLS LAST) AS rk
      FROM location_totals)"""

TABLES["price_stats"] = f"""
SELECT item_category, CAST({avg('item_price', 4)} AS DECIMAL(18, 4)) AS category_avg_price,
       CAST(coalesce(round(stddev_samp(CAST(item_price AS DOUBLE)), 4), 0) AS DECIMAL(18, 4))
         AS category_stddev_price,
       count(item_price) AS priced_item_count
FROM silver WHERE item_price > 0 GROUP BY item_category"""

TABLES["signals"] = """
SELECT *, CASE WHEN is_free_item THEN round(a * item_quantity, 2)
               WHEN is_below_avg_price THEN round((a - item_price) * item_quantity, 2)
               ELSE 0 END AS estimated_discount
FROM (SELECT s.*, coalesce(p.category_avg_price, 0) AS a,
             coalesce(p.category_stddev_price, 0) AS sd, item_price = 0 AS is_free_item,
             item_price > 0 AND item_price < coalesce(p.category_avg_price, 0)
               - coalesce(p.category_stddev_price, 0) AS is_below_avg_price
      FROM silver s LEFT JOIN price_stats p ON p.item_category = s.item_category)"""

TABLES["promo_orders"] = """
SELECT order_id, user_id, restaurant_id, order_date, year, month, is_loyalty,
       round(sum(gross_revenue), 2) AS gross_revenue, count(lineitem_id) AS total_line_items,
       count(DISTINCT item_name) AS unique_items,
       CAST(sum(CASE WHEN is_free_item THEN item_quantity ELSE 0 END) AS BIGINT)
         AS free_item_count,
       sum(CASE WHEN is_free_item THEN estimated_discount ELSE 0 END) AS free_item_revenue_loss,
       CAST(sum(CASE WHEN is_below_avg_price THEN item_quantity ELSE 0 END) AS BIGINT)
         AS below_avg_price_item_count,
       sum(CASE WHEN is_below_avg_price THEN estimated_discount ELSE 0 END)
         AS below_avg_discount_amt,
       sum(estimated_discount) AS total_estimated_discount
FROM signals GROUP BY order_id, user_id, restaurant_id, order_date, year, month, is_loyalty"""

TABLES["discounts"] = """
SELECT *, free_item_count > 0 AS has_free_item,
       below_avg_price_item_count > 0 AS has_below_avg_item,
       free_item_count > 0 OR below_avg_price_item_count > 0 AS is_promotional_order,
       CASE WHEN free_item_count > 0 AND below_avg_price_item_count > 0
              THEN 'free_item+below_avg'
            WHEN free_item_count > 0 THEN 'free_item'
            WHEN below_avg_price_item_count > 0 THEN 'below_avg_price'
            ELSE 'full_price' END AS order_type
FROM promo_orders"""

TABLES["latest"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT user_id, snapshot_date, total_revenue_to_date, clv_tier, is_loyalty,
         row_number() OVER (PARTITION BY user_id
           ORDER BY snapshot_date DESC NULLS LAST, is_loyalty DESC NULLS LAST) AS rn
  FROM clv WHERE user_id IS NOT NULL) WHERE rn = 1"""


def query(final: str) -> str:
    """Put the tables that ``final`` needs, directly or not, in front of it."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name, body in TABLES.items():
            if name not in needed and re.search(rf"(?i)\b(?:from|join)\s+{name}\b", text):
                needed.add(name)
                visit(body)

    visit(final)
    parts = [f"{name} AS ({body.strip()})" for name, body in TABLES.items() if name in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + final.strip()


KEY = "order_id, lineitem_id"
MONTH = "CAST(date_trunc('month', order_date) AS DATE)"
LOCATION = "'Loc-' || right(restaurant_id, 6)"
LOCATION_COLUMNS = (
    "revenue_rank, restaurant_id, CAST(total_revenue AS DOUBLE) AS total_revenue, total_orders,"
    " unique_customers, avg_order_value, avg_daily_revenue, performance_tier"
)
DISCOUNT_COLUMNS = (
    "order_id, user_id, restaurant_id, order_date, year, month, is_loyalty,"
    " CAST(gross_revenue AS DOUBLE) AS gross_revenue, total_line_items, unique_items,"
    " has_free_item, free_item_count,"
    " CAST(free_item_revenue_loss AS DOUBLE) AS free_item_revenue_loss, has_below_avg_item,"
    " below_avg_price_item_count,"
    " CAST(below_avg_discount_amt AS DOUBLE) AS below_avg_discount_amt,"
    " CAST(total_estimated_discount AS DOUBLE) AS total_estimated_discount,"
    " is_promotional_order, order_type"
)
CLV_COLUMNS = (
    "user_id, snapshot_date, CAST(daily_revenue AS DOUBLE) AS daily_revenue,"
    " CAST(total_revenue_to_date AS DOUBLE) AS total_revenue_to_date, orders_to_date,"
    " avg_order_value, clv_tier, is_loyalty, bulk_orders_to_date, has_bulk_order_candidate"
)
CHURN_COLUMNS = (
    "user_id, days_since_last_order, avg_order_gap_days, total_orders,"
    " CAST(total_spend AS DOUBLE) AS total_spend, CAST(spend_last_90 AS DOUBLE) AS spend_last_90,"
    " CAST(spend_prior_90 AS DOUBLE) AS spend_prior_90, spend_change_pct, churn_risk_flag,"
    " first_order_date, last_order_date"
)
RFM_COLUMNS = (
    "user_id, recency_days, frequency, CAST(monetary AS DOUBLE) AS monetary, r_score, f_score,"
    " m_score, rfm_score, rfm_segment"
)
TREND_COLUMNS = (
    "order_date, year, month, week, day_of_week, is_weekend, is_holiday, holiday_name,"
    " restaurant_id, item_category, CAST(total_revenue AS DOUBLE) AS total_revenue, order_count,"
    " unique_customers, avg_item_revenue"
)
LOYALTY_LABEL = "CASE WHEN is_loyalty THEN 'Loyalty Members' WHEN NOT is_loyalty THEN 'Non-Members' END"
SUM_REVENUE = "CAST(sum(total_revenue) AS DOUBLE) AS total_revenue"
SUM_ORDERS = "CAST(sum(order_count) AS BIGINT) AS order_count"
PROMO = "count(*) FILTER (WHERE is_promotional_order)"
PROMO_RATE = pct(PROMO, "count(order_id)")
WIDTHS = ", ".join(f"{s}.0 * {10**p}" for p in range(10) for s in (1, 2, 5))


def histogram(source: str, value: str, smallest: str) -> str:
    return f"""
SELECT churn_risk_flag, floor(CAST({value} AS DECIMAL(20, 4)) / w + 1e-9) * w AS bin_start,
       w AS bin_width, count(*) AS customers
FROM {source} CROSS JOIN (
  SELECT min(w) AS w FROM (SELECT unnest([{WIDTHS}]) * {smallest} AS w),
    (SELECT max({value}) - min({value}) AS span FROM {source})
  WHERE w * 40 >= span - 1e-9)
WHERE {value} IS NOT NULL GROUP BY ALL"""


def rounded_histogram(source: str, value: str, smallest: str) -> str:
    inner = histogram(source, value, smallest)
    return (
        "SELECT churn_risk_flag, round(CAST(bin_start AS DOUBLE), 4) AS bin_start,"
        " round(CAST(bin_width AS DOUBLE), 4) AS bin_width, CAST(sum(customers) AS BIGINT)"
        f" AS customers FROM ({inner}) GROUP BY 1, 2, 3"
    )


def period(unit: str) -> str:
    return f"""
SELECT CAST(date_trunc('{unit}', order_date) AS DATE) AS period, {SUM_REVENUE}, {SUM_ORDERS}
FROM trends WHERE order_date IS NOT NULL GROUP BY 1"""


def numeric_summary(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS n, CAST(min({c}) AS DOUBLE) AS min,"
        f" {quant(c, 0.25)} AS q25, {quant(c, 0.5)} AS q50, {quant(c, 0.75)} AS q75,"
        f" CAST(max({c}) AS DOUBLE) AS max, {avg(c, 4)} AS mean,"
        f" round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS std FROM {source}"
        for c in columns
    )


def duplicates(source: str, key: str) -> str:
    return (
        f"SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicates"
        f" FROM (SELECT count(*) AS n FROM {source} GROUP BY {key})"
    )


def null_report(source: str, columns: list[str]) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count,"
        f" count(*) AS n FROM {source}"
        for c in columns
    )
    return (
        f"SELECT column_name, null_count, {pct('null_count', 'n')} AS null_pct"
        f" FROM ({parts}) WHERE null_count > 0"
    )


def top_values(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"(SELECT '{c}' AS column_name, {c} AS value, count(*) AS row_count FROM {source}"
        f" WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY row_count DESC, {c} LIMIT 10)"
        for c in columns
    )


ITEM_TYPES = {
    "app_name": "string", "restaurant_id": "string", "creation_time_utc": "timestamp",
    "order_id": "string", "user_id": "string", "printed_card_number": "string",
    "is_loyalty": "boolean", "currency": "string", "lineitem_id": "string",
    "item_category": "string", "item_name": "string", "item_price": "decimal(18,4)",
    "item_quantity": "int",
}
OPTION_TYPES = {
    "order_id": "string", "lineitem_id": "string", "option_group_name": "string",
    "option_name": "string", "option_price": "decimal(18,4)", "option_quantity": "int",
}
DATE_TYPES = {
    "date_key": "string", "day_of_week": "string", "week": "int", "month": "string", "year": "int",
    "is_weekend": "boolean", "is_holiday": "boolean", "holiday_name": "string",
}
SOURCE_TYPES = {
    "order_items": ("items", ITEM_TYPES),
    "order_item_options": ("options", OPTION_TYPES),
    "date_dim": ("date_dim", DATE_TYPES),
}
CARDINAL = [
    "user_id", "order_id", "restaurant_id", "app_name", "currency", "item_category", "item_name",
    "is_loyalty",
]

GOLD_TABLES = {
    "customer_clv_daily": "clv",
    "customer_rfm_segments": "rfm",
    "customer_churn_indicators": "churn",
    "loyalty_comparison": "loyalty",
    "location_performance": "locations",
    "sales_trends": "trends",
    "discount_effectiveness": "discounts",
}

FINALS: dict[str, str] = {
    # Sources and sinks
    "src_csv": """
SELECT order_id, lineitem_id, option_group_name, option_name,
       CAST(option_price AS VARCHAR) AS option_price,
       CAST(option_quantity AS VARCHAR) AS option_quantity FROM options""",
    "src_csv_typed": "SELECT * REPLACE (CAST(item_price AS DOUBLE) AS item_price) FROM items",
    "src_parquet_latest": """
SELECT * REPLACE (CAST(option_price AS DOUBLE) AS option_price) FROM options""",
    "sink_bronze": """
SELECT DATE '2024-01-09' AS ingestion_date, option_group_name, count(*) AS row_count
FROM options WHERE option_group_name = 'Size' GROUP BY option_group_name
UNION ALL SELECT DATE '2024-01-10', option_group_name, count(*)
FROM options GROUP BY option_group_name""",
    "ingestion_stamp": f"SELECT {KEY}, DATE '2024-01-09' AS ingestion_date FROM items",
    "drop_partition_col": """
SELECT * REPLACE (CAST(option_price AS DOUBLE) AS option_price) FROM options""",
    "src_mode_dispatch": f"""
SELECT {KEY}, user_id, {dbl('item_price')}, item_quantity, is_loyalty FROM items""",
    "src_gold": f"SELECT {RFM_COLUMNS} FROM rfm",
    "sink_silver_incremental": f"""
SELECT {KEY}, year, month, order_date, option_row_count, {dbl('gross_revenue')} FROM silver""",
    "sink_silver": f"""
SELECT {KEY}, year, month, order_date, {dbl('gross_revenue')} FROM silver""",
    "observe_counts": f"""
SELECT count(*) AS rows, {dbl('min(gross_revenue)', 'min_revenue')},
       {dbl('max(gross_revenue)', 'max_revenue')}, {dbl('sum(gross_revenue)', 'total_revenue')},
       count(*) FILTER (WHERE is_bulk_order_candidate) AS bulk_rows,
       count(*) FILTER (WHERE option_row_count = 0) AS rows_without_options FROM silver""",
    "sink_gold": f"SELECT {CHURN_COLUMNS} FROM churn",
    "src_parquet_silver": """
SELECT restaurant_id, CAST(year(order_date) AS INTEGER) AS year, CAST(month(order_date) AS INTEGER) AS month,
       CAST(round(sum(gross_revenue), 2) AS DOUBLE) AS revenue FROM silver GROUP BY ALL""",
    "union_parts": f"SELECT {LOCATION_COLUMNS} FROM locations",
    "readonly_guard": """
SELECT option_group_name, count(*) AS created_rows FROM options GROUP BY option_group_name""",
    "run_pipeline": " UNION ALL ".join(
        f"SELECT '{table}' AS gold_table, count(*) AS row_count FROM {name}"
        for table, name in GOLD_TABLES.items()
    ),
    # Projection, cleaning and scalar functions
    "norm_columns": "SELECT * FROM date_dim",
    "conform_schema": """
SELECT CAST(NULL AS VARCHAR) AS app_name, CAST(NULL AS VARCHAR) AS restaurant_id,
       CAST(NULL AS VARCHAR) AS creation_time_utc, order_id, CAST(NULL AS VARCHAR) AS user_id,
       CAST(NULL AS VARCHAR) AS printed_card_number, is_loyalty, CAST(NULL AS VARCHAR) AS currency,
       lineitem_id, CAST(NULL AS VARCHAR) AS item_category, CAST(NULL AS VARCHAR) AS item_name,
       CAST(item_price AS DOUBLE) AS item_price, item_quantity FROM items""",
    "filter_test_platform": f"SELECT app_name, {KEY} FROM items WHERE app_name <> 'Store - DEVELOPMENT'",
    "parse_iso_ts": f"""
SELECT {KEY}, strftime(TRY_CAST(creation_time_utc AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS created
FROM items""",
    "to_order_date": f"SELECT {KEY}, order_date FROM cleaned",
    "clean_category": r"""
SELECT order_id, lineitem_id, item_category AS raw,
       trim(regexp_replace(regexp_replace(item_category, 'https?://\S+', '', 'g'),
                           '[^a-zA-Z\s&''\-]+$', '', 'g'), ' ') AS category FROM items""",
    "reformat_date_key": """
SELECT date_key, CAST(strptime(date_key, '%d-%m-%Y') AS DATE) AS day FROM date_dim""",
    "calendar_attrs": """
SELECT DISTINCT d AS day, CAST(year(d) AS INTEGER) AS year, strftime(d, '%B') AS month,
       CAST(week(d) AS INTEGER) AS week, strftime(d, '%A') AS day_of_week,
       dayofweek(d) IN (0, 6) AS is_weekend
FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders JOIN lineitem ON l_orderkey = o_orderkey)""",
    "holiday_default": "SELECT date_key, is_holiday, holiday_name FROM spine",
    "gross_revenue": f"""
SELECT {KEY}, {dbl('item_price')}, item_quantity, {dbl('option_revenue')}, {dbl('gross_revenue')}
FROM silver""",
    "bulk_flag": f"SELECT {KEY}, ({BULK_P}) OR ({BULK_Q}) AS flag FROM cleaned",
    "bulk_reason": f"SELECT {KEY}, bulk_flag_reason AS reason FROM silver",
    "year_month_cols": f"SELECT {KEY}, year, month FROM silver",
    "null_to_zero": f"""
SELECT c.order_id, c.lineitem_id, CAST(coalesce(r.option_revenue, 0) AS DOUBLE) AS option_revenue,
       coalesce(r.option_row_count, 0) AS option_row_count
FROM cleaned c LEFT JOIN rollup r ON r.order_id = c.order_id AND r.lineitem_id = c.lineitem_id""",
    "rounding": f"""
SELECT {KEY}, {dbl('round(item_price, 2)', 'price_2')},
       CAST(round(item_price * CAST(1.25 AS DECIMAL(3, 2)), 4) AS DOUBLE) AS price_4,
       CAST(round(item_price, 1) AS DOUBLE) AS price_1 FROM cleaned""",
    "safe_ratio": f"""
SELECT {KEY}, {ratio('item_quantity', 'item_price', 4)} AS ratio,
       {pct('item_price', 'item_quantity')} AS pct FROM cleaned""",
    "label_location": f"""
SELECT restaurant_id, {LOCATION} AS label,
       '#' || lpad(CAST(revenue_rank AS VARCHAR), 2, '0') || ' ' || {LOCATION} AS ranked
FROM locations""",
    "mask_id": "SELECT lineitem_id, left(lineitem_id, 12) || '...' AS masked FROM items",
    "map_bool_label": f"SELECT {KEY}, is_loyalty, {LOYALTY_LABEL} AS group_label FROM items",
    # Joins
    "join_items_options": f"""
SELECT {KEY}, {dbl('item_price')}, {dbl('option_revenue')}, option_row_count FROM silver""",
    "anti_orphan_options": f"""
SELECT * EXCLUDE (option_price), {dbl('option_price')} FROM option_rows o
WHERE NOT EXISTS (SELECT 1 FROM cleaned c
                  WHERE c.order_id = o.order_id AND c.lineitem_id = o.lineitem_id)""",
    "join_calendar": f"""
SELECT {KEY}, order_date, week, day_of_week, is_weekend, is_holiday, holiday_name FROM silver""",
    "join_spine_holidays": "SELECT date_key, holiday_name FROM spine WHERE is_holiday",
    "join_churn_windows": f"""
SELECT user_id, {dbl('total_spend')}, {dbl('spend_last_90')}, {dbl('spend_prior_90')} FROM churn""",
    "join_category_stats": f"""
SELECT {KEY}, s.item_category, CAST(coalesce(category_avg_price, 0) AS DOUBLE)
         AS category_avg_price,
       CAST(coalesce(category_stddev_price, 0) AS DOUBLE) AS category_stddev_price,
       coalesce(priced_item_count, 0) AS priced_item_count
FROM silver s LEFT JOIN price_stats p ON p.item_category = s.item_category""",
    "semi_by_user": """
SELECT user_id, snapshot_date, is_loyalty FROM clv
WHERE user_id IN (SELECT user_id FROM latest WHERE is_loyalty)""",
    "semi_by_restaurant": f"""
SELECT order_date, restaurant_id, item_category, {dbl('total_revenue')} FROM trends
WHERE restaurant_id IN (SELECT restaurant_id FROM locations
                        ORDER BY total_revenue DESC, restaurant_id LIMIT 3)""",
    "setjoin_keys": f"""
SELECT {KEY}, 'matched' AS side
FROM (SELECT {KEY} FROM options INTERSECT SELECT {KEY} FROM items)
UNION ALL
SELECT {KEY}, 'orphan' FROM (SELECT {KEY} FROM options EXCEPT SELECT {KEY} FROM items)""",
    # Aggregations
    "dedup_rows": f"SELECT * REPLACE (CAST(option_price AS DOUBLE) AS option_price) FROM option_rows",
    "distinct_keys": f"SELECT DISTINCT {KEY} FROM cleaned",
    "agg_option_rollup": f"SELECT {KEY}, {dbl('option_revenue')}, option_row_count FROM rollup",
    "agg_category_counts": """
SELECT item_category, count(*) AS row_count FROM cleaned GROUP BY item_category""",
    "agg_global_stats": f"""
SELECT {dbl('min(gross_revenue)', 'min_revenue')}, {dbl('max(gross_revenue)', 'max_revenue')},
       {avg('gross_revenue', 4)} AS avg_revenue, {dbl('sum(gross_revenue)', 'total_revenue')},
       count(*) FILTER (WHERE is_bulk_order_candidate) AS bulk_rows FROM silver""",
    "agg_ref_date": "SELECT max(order_date) AS reference_date FROM silver",
    "agg_daily_customer": f"""
SELECT user_id, order_date, is_loyalty, {dbl('daily_revenue')}, daily_orders, daily_bulk_orders
FROM daily""",
    "agg_rfm": f"SELECT user_id, recency_days, frequency, {dbl('monetary')} FROM recency",
    "agg_churn_base": f"""
SELECT user_id, days_since_last_order, total_orders, {dbl('total_spend')}, first_order_date,
       last_order_date FROM churn""",
    "agg_window_spend": f"""
SELECT user_id, {dbl('spend_last_90')}, {dbl('spend_prior_90')} FROM churn""",
    "agg_sales_trends": """
SELECT order_date, restaurant_id, item_category, order_count, unique_customers FROM trends""",
    "agg_two_level_loyalty": "SELECT * FROM loyalty",
    "agg_location": f"""
SELECT restaurant_id, {dbl('total_revenue')}, total_orders, unique_customers, avg_daily_revenue
FROM location_totals""",
    "agg_category_price_stats": f"""
SELECT item_category, {dbl('category_avg_price')}, {dbl('category_stddev_price')},
       priced_item_count FROM price_stats""",
    "agg_order_promo": f"""
SELECT order_id, {dbl('gross_revenue')}, total_line_items, unique_items, free_item_count,
       {dbl('free_item_revenue_loss')}, below_avg_price_item_count,
       {dbl('below_avg_discount_amt')}, {dbl('total_estimated_discount')} FROM discounts""",
    "agg_order_type_counts": f"""
SELECT count(*) AS total_orders, {PROMO} AS promotional_orders,
       {pct(PROMO, 'count(*)', 1)} AS promo_pct,
       {dbl('sum(total_estimated_discount)', 'total_discount')} FROM discounts""",
    # Window functions
    "win_running_sum": f"""
SELECT user_id, order_date, is_loyalty, {dbl('total_revenue_to_date')}, orders_to_date,
       bulk_orders_to_date FROM running""",
    "win_partition_max": f"SELECT user_id, order_date, is_loyalty, {dbl('final_total')} FROM finals",
    "win_percent_rank": f"""
SELECT DISTINCT {dbl('final_total', 'value')},
       percent_rank() OVER (ORDER BY final_total NULLS FIRST) AS percent_rank FROM finals""",
    "win_ntile": "SELECT user_id, r_score, f_score, m_score FROM rfm",
    "win_dense_rank": """
SELECT item_category, restaurant_id, lines,
       CAST(dense_rank() OVER (ORDER BY lines DESC) AS INTEGER) AS place
FROM (SELECT item_category, restaurant_id, count(*) AS lines FROM silver
      GROUP BY item_category, restaurant_id)""",
    "global_row_number": f"""
SELECT user_id, {dbl('spend')}, row_number() OVER (ORDER BY spend, user_id) AS row_number
FROM (SELECT user_id, round(sum(gross_revenue), 2) AS spend FROM silver GROUP BY user_id)""",
    "win_latest_row": f"""
SELECT user_id, snapshot_date, {dbl('total_revenue_to_date')}, clv_tier, is_loyalty FROM latest""",
    # Sorts, limits and sets
    "sort_desc_log": "SELECT order_type, count(*) AS orders FROM discounts GROUP BY order_type",
    "topk_customers": f"""
SELECT left(user_id, 12) || '...' AS customer, {dbl('total_revenue_to_date')}, clv_tier, is_loyalty
FROM (SELECT * FROM latest ORDER BY total_revenue_to_date DESC NULLS LAST, user_id LIMIT 10)""",
    "topn_value_counts": """
SELECT item_name, count(*) AS row_count FROM items WHERE item_name IS NOT NULL
GROUP BY item_name ORDER BY row_count DESC, item_name LIMIT 10""",
    "top_bottom_5": """
SELECT 'top' AS side, restaurant_id FROM
  (SELECT * FROM locations ORDER BY revenue_rank, restaurant_id LIMIT 5)
UNION ALL SELECT 'bottom', restaurant_id FROM
  (SELECT * FROM locations ORDER BY revenue_rank DESC, restaurant_id LIMIT 5)""",
    "set_intersect": """
SELECT strftime(order_date, '%d-%m-%Y') AS date_key FROM cleaned
INTERSECT SELECT date_key FROM date_dim""",
    "set_except": """
SELECT strftime(order_date, '%d-%m-%Y') AS date_key FROM cleaned
EXCEPT SELECT date_key FROM date_dim""",
    # Silver and Gold
    "date_spine": "SELECT * FROM spine",
    "orders_enriched": """
SELECT * REPLACE (strftime(creation_time_utc, '%Y-%m-%d %H:%M:%S') AS creation_time_utc,
                  CAST(item_price AS DOUBLE) AS item_price,
                  CAST(option_revenue AS DOUBLE) AS option_revenue,
                  CAST(gross_revenue AS DOUBLE) AS gross_revenue) FROM silver""",
    "customer_clv_daily": f"SELECT {CLV_COLUMNS} FROM clv",
    "customer_rfm_segments": f"SELECT {RFM_COLUMNS} FROM rfm",
    "customer_churn_indicators": f"SELECT {CHURN_COLUMNS} FROM churn",
    "sales_trends": f"SELECT {TREND_COLUMNS} FROM trends",
    "loyalty_comparison": "SELECT * FROM loyalty",
    "location_performance": f"SELECT {LOCATION_COLUMNS} FROM locations",
    "promo_item_signals": f"""
SELECT {KEY}, is_free_item, is_below_avg_price, {dbl('estimated_discount')} FROM signals""",
    "discount_effectiveness": f"SELECT {DISCOUNT_COLUMNS} FROM discounts",
    # Overview
    "serve_home_kpis": f"""
SELECT count(*) AS total_customers, {dbl('sum(v)', 'total_revenue')}, {avg('v')} AS avg_clv,
       (SELECT count(*) FROM churn WHERE churn_risk_flag) AS at_risk_customers,
       (SELECT {pct('count(*) FILTER (WHERE churn_risk_flag)', 'count(*)', 1)} FROM churn)
         AS at_risk_pct,
       (SELECT count(*) FROM rfm WHERE rfm_segment = 'VIP') AS vip_customers,
       coalesce((SELECT max(avg_clv) FROM loyalty WHERE is_loyalty), 0) AS loyalty_avg_clv,
       (SELECT CAST(max(total_revenue) AS DOUBLE) FROM locations WHERE revenue_rank = 1)
         AS top_location_revenue,
       (SELECT CAST(sum(order_count) AS BIGINT) FROM trends) AS total_orders,
       (SELECT count(DISTINCT restaurant_id) FROM locations) AS location_count
FROM (SELECT max(total_revenue_to_date) AS v FROM clv WHERE user_id IS NOT NULL
      GROUP BY user_id)""",
    "serve_filter_domains": """
SELECT 'order_date' AS field, 'min' AS kind, CAST(min(order_date) AS VARCHAR) AS value FROM trends
UNION ALL SELECT 'order_date', 'max', CAST(max(order_date) AS VARCHAR) FROM trends
UNION ALL SELECT 'month', 'min', CAST(min(month) AS VARCHAR) FROM trends
UNION ALL SELECT 'month', 'max', CAST(max(month) AS VARCHAR) FROM trends
UNION ALL SELECT DISTINCT 'item_category', 'value', item_category FROM trends
          WHERE item_category IS NOT NULL
UNION ALL SELECT DISTINCT 'restaurant_id', 'value', restaurant_id FROM trends
          WHERE restaurant_id IS NOT NULL""",
    "serve_tier_distribution": """
SELECT clv_tier, count(*) AS customers FROM latest GROUP BY clv_tier""",
    "serve_segment_distribution": """
SELECT rfm_segment, count(*) AS customers FROM rfm GROUP BY rfm_segment""",
    "serve_monthly_revenue": f"""
SELECT {MONTH} AS month_start, {SUM_REVENUE} FROM trends WHERE order_date IS NOT NULL
GROUP BY 1""",
    # Lifetime value
    "serve_clv_filter": f"""
SELECT {CLV_COLUMNS} FROM clv
WHERE user_id IN (SELECT user_id FROM latest WHERE clv_tier = 'High' AND NOT is_loyalty)
  AND snapshot_date BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'""",
    "serve_clv_kpis": f"""
SELECT count(DISTINCT user_id) AS customers, {avg('total_revenue_to_date')} AS avg_clv,
       {quant('total_revenue_to_date', 0.5)} AS median_clv,
       (SELECT CAST(sum(v) AS DOUBLE) FROM (
          SELECT total_revenue_to_date AS v FROM latest WHERE clv_tier = 'Medium'
          ORDER BY v DESC NULLS LAST LIMIT 10)) AS top10_revenue
FROM latest WHERE clv_tier = 'Medium'""",
    "serve_clv_tier_avg": f"""
SELECT clv_tier, {avg('total_revenue_to_date')} AS avg_revenue FROM latest GROUP BY clv_tier""",
    "serve_clv_growth": f"""
SELECT snapshot_date, {avg('total_revenue_to_date')} AS avg_clv FROM clv
WHERE snapshot_date IS NOT NULL GROUP BY snapshot_date""",
    "serve_clv_by_loyalty": f"""
SELECT {LOYALTY_LABEL} AS group_label, is_loyalty, {avg('total_revenue_to_date')} AS avg_clv
FROM latest WHERE is_loyalty IS NOT NULL GROUP BY is_loyalty""",
    "serve_clv_top10": f"""
SELECT left(user_id, 12) || '...' AS customer, {dbl('total_revenue_to_date')}, clv_tier, is_loyalty
FROM (SELECT * FROM latest WHERE is_loyalty
      ORDER BY total_revenue_to_date DESC NULLS LAST, user_id LIMIT 10)""",
    # Segments
    "serve_rfm_filter": f"""
SELECT {RFM_COLUMNS} FROM rfm WHERE rfm_segment = 'Regular' AND rfm_score BETWEEN 5 AND 9
  AND recency_days <= 120""",
    "serve_rfm_kpis": f"""
SELECT count(*) AS customers, count(*) FILTER (WHERE rfm_segment = 'VIP') AS vip_customers,
       {pct("count(*) FILTER (WHERE rfm_segment = 'VIP')", 'count(*)', 1)} AS vip_pct,
       count(*) FILTER (WHERE rfm_segment = 'Churn Risk') AS churn_risk_customers,
       {pct("count(*) FILTER (WHERE rfm_segment = 'Churn Risk')", 'count(*)', 1)}
         AS churn_risk_pct,
       {avg('monetary')} AS avg_monetary FROM rfm""",
    "serve_rfm_profile": f"""
SELECT rfm_segment, {avg('recency_days', 1)} AS avg_recency_days,
       {avg('frequency', 1)} AS avg_frequency, {avg('monetary')} AS avg_monetary,
       count(user_id) AS customers FROM rfm GROUP BY rfm_segment""",
    "serve_rfm_score_box": f"SELECT rfm_segment, {box('rfm_score')} FROM rfm GROUP BY rfm_segment",
    "serve_rfm_p95_points": f"""
SELECT user_id, rfm_segment, frequency, {dbl('monetary')}, recency_days, rfm_score FROM rfm
WHERE frequency <= (SELECT {quant('frequency', 0.95)} FROM rfm)
  AND CAST(monetary AS DOUBLE) <= (SELECT {quant('monetary', 0.95)} FROM rfm)""",
    "serve_rfm_p95_hidden": f"""
SELECT count(*) AS hidden_customers FROM rfm
WHERE NOT (frequency <= (SELECT {quant('frequency', 0.95)} FROM rfm)
           AND CAST(monetary AS DOUBLE) <= (SELECT {quant('monetary', 0.95)} FROM rfm))""",
    "serve_rfm_scores_long": f"""
SELECT rfm_segment, 'R' AS dimension, {avg('r_score', 4)} AS avg_score FROM rfm GROUP BY 1
UNION ALL SELECT rfm_segment, 'F', {avg('f_score', 4)} FROM rfm GROUP BY 1
UNION ALL SELECT rfm_segment, 'M', {avg('m_score', 4)} FROM rfm GROUP BY 1""",
    "serve_rfm_action_guide": """
SELECT g.rfm_segment, profile, recommended_action, priority, coalesce(n, 0) AS customers
FROM (VALUES
  ('VIP', 'Ordered recently, often, and spends a lot',
   'Reward with exclusive offers, early access, loyalty perks', 'High'),
  ('Regular', 'Active but not top tier across all dimensions',
   'Upsell with bundle deals, encourage loyalty sign-up', 'Medium'),
  ('New Customer', 'Ordered recently but infrequently',
   'Onboard with welcome series, promote loyalty program', 'Monitor'),
  ('Churn Risk', 'Hasn''t ordered in a while, low frequency',
   'Re-engage with win-back campaign, time-limited discount', 'High')
) g(rfm_segment, profile, recommended_action, priority)
LEFT JOIN (SELECT rfm_segment, count(*) AS n FROM rfm GROUP BY rfm_segment) c USING (rfm_segment)""",
    # Churn
    "serve_churn_rethreshold": f"""
SELECT {CHURN_COLUMNS} FROM churn WHERE days_since_last_order > 90 AND total_orders >= 3""",
    "serve_churn_kpis": f"""
SELECT count(*) AS customers, count(*) FILTER (WHERE churn_risk_flag) AS at_risk_customers,
       {pct('count(*) FILTER (WHERE churn_risk_flag)', 'count(*)', 1)} AS at_risk_pct,
       count(*) FILTER (WHERE NOT churn_risk_flag) AS safe_customers,
       {avg('days_since_last_order', 2, 'churn_risk_flag')} AS avg_days_inactive_at_risk,
       {quant('avg_order_gap_days', 0.5)} AS median_order_gap_days FROM churn""",
    "serve_churn_kpis_rethreshold": f"""
SELECT count(*) AS customers, count(*) FILTER (WHERE idle) AS at_risk_customers,
       {pct('count(*) FILTER (WHERE idle)', 'count(*)', 1)} AS at_risk_pct,
       count(*) FILTER (WHERE NOT idle) AS safe_customers,
       {avg('days_since_last_order', 2, 'idle')} AS avg_days_inactive_at_risk,
       {quant('avg_order_gap_days', 0.5)} AS median_order_gap_days
FROM (SELECT *, days_since_last_order > 90 AS idle FROM churn WHERE total_orders >= 3)""",
    "serve_hist_inactivity": rounded_histogram("churn", "days_since_last_order", "1"),
    "serve_hist_gap": rounded_histogram(
        "(SELECT * FROM churn WHERE avg_order_gap_days <= "
        f"(SELECT {quant('avg_order_gap_days', 0.95)} FROM churn))",
        "avg_order_gap_days",
        "0.1",
    ),
    "serve_spend_buckets": """
SELECT l.position, l.bucket, coalesce(n, 0) AS customers
FROM (VALUES (0, '< -50%'), (1, '-50% to -10%'), (2, '-10% to +10%'), (3, '+10% to +50%'),
             (4, '> +50%'), (5, 'out of range')) l(position, bucket)
LEFT JOIN (
  SELECT CASE WHEN p > -200 AND p <= -50 THEN 0 WHEN p > -50 AND p <= -10 THEN 1
              WHEN p > -10 AND p <= 10 THEN 2 WHEN p > 10 AND p <= 50 THEN 3
              WHEN p > 50 AND p <= 200 THEN 4 ELSE 5 END AS position, count(*) AS n
  FROM (SELECT spend_change_pct AS p FROM churn WHERE spend_change_pct IS NOT NULL) GROUP BY 1
) c ON c.position = l.position""",
    "serve_revenue_at_stake": f"""
SELECT at_risk_spend, a AS avg_at_risk_spend, s AS avg_safe_spend,
       round(a - s, 2) AS avg_spend_delta
FROM (SELECT CAST(sum(total_spend) FILTER (WHERE churn_risk_flag) AS DOUBLE) AS at_risk_spend,
             {avg('total_spend', 2, 'churn_risk_flag')} AS a,
             {avg('total_spend', 2, 'NOT churn_risk_flag')} AS s FROM churn)""",
    "serve_churn_spend_box": f"""
SELECT churn_risk_flag, {box('total_spend')} FROM churn
WHERE CAST(total_spend AS DOUBLE) <= (SELECT {quant('total_spend', 0.95)} FROM churn)
GROUP BY churn_risk_flag""",
    "serve_at_risk_top50": f"""
SELECT left(user_id, 12) || '...' AS customer, days_since_last_order, total_orders,
       {dbl('total_spend')}, avg_order_gap_days, spend_change_pct
FROM (SELECT * FROM churn WHERE churn_risk_flag
      ORDER BY total_spend DESC NULLS LAST, user_id LIMIT 50)""",
    # Sales
    "serve_sales_filter": f"""
SELECT {TREND_COLUMNS} FROM trends
WHERE order_date BETWEEN DATE '1996-03-01' AND DATE '1999-06-30'
  AND item_category IN ('ECONOMY', 'PROMO') AND restaurant_id IN ('LOC-1', 'LOC-2')""",
    "serve_sales_kpis": f"""
SELECT {SUM_REVENUE}, CAST(sum(order_count) AS BIGINT) AS total_orders,
       count(DISTINCT order_date) AS days,
       coalesce({ratio('sum(total_revenue)', 'count(DISTINCT order_date)')}, 0)
         AS avg_daily_revenue,
       coalesce({pct('sum(total_revenue) FILTER (WHERE is_weekend)', 'sum(total_revenue)', 1)}, 0)
         AS weekend_pct FROM trends""",
    "serve_sales_by_day": period("day"),
    "serve_sales_by_week": period("week"),
    "serve_sales_by_period": period("month"),
    "serve_exact_orders": f"""
SELECT {MONTH} AS period, count(DISTINCT order_id) AS orders FROM silver
WHERE order_date IS NOT NULL GROUP BY 1""",
    "serve_category_share": f"""
SELECT item_category, CAST(r AS DOUBLE) AS total_revenue, {pct('r', 'sum(r) OVER ()', 1)} AS pct
FROM (SELECT item_category, sum(total_revenue) AS r FROM trends
      WHERE item_category IS NOT NULL GROUP BY item_category)""",
    "serve_revenue_by_weekday": f"""
SELECT day_of_week, {SUM_REVENUE}, CAST(min(isodow(order_date)) AS INTEGER) AS weekday_number
FROM trends WHERE day_of_week IS NOT NULL GROUP BY day_of_week""",
    "serve_month_year_matrix": "SELECT CAST(month(order_date) AS INTEGER) AS month_number,"
    " strftime(order_date, '%b') AS month_name, "
    + ", ".join(
        f"CAST(coalesce(sum(total_revenue) FILTER (WHERE year = {y}), 0) AS DOUBLE)"
        f" AS revenue_{y}"
        for y in range(1995, 2002)
    )
    + " FROM trends WHERE order_date IS NOT NULL GROUP BY 1, 2",
    "serve_holiday_impact": f"""
SELECT is_holiday, {SUM_REVENUE}, {avg('total_revenue')} AS avg_row_revenue, {SUM_ORDERS},
       count(DISTINCT order_date) AS days,
       {ratio('sum(total_revenue)', 'count(DISTINCT order_date)')} AS avg_daily_revenue,
       CASE WHEN is_holiday THEN 'Holiday' ELSE 'Regular Day' END AS label
FROM trends WHERE is_holiday IS NOT NULL GROUP BY is_holiday""",
    "serve_named_holidays": f"""
SELECT holiday_name, {SUM_REVENUE}, {SUM_ORDERS} FROM trends
WHERE is_holiday AND holiday_name IS NOT NULL AND holiday_name <> '' GROUP BY holiday_name""",
}
FINALS["win_share_of_total"] = FINALS["serve_category_share"]

_M = {
    "avg_clv": "Avg CLV",
    "avg_orders_per_customer": "Avg Orders",
    "avg_order_value": "Avg Order Value",
    "repeat_purchase_rate_pct": "Repeat Rate",
}
_SIDES = "(SELECT " + ", ".join(
    f"coalesce(max({c}) FILTER (WHERE {flag}is_loyalty), 0) AS {p}_{c}"
    for p, flag in (("m", ""), ("o", "NOT "))
    for c in [*_M, "total_customers"]
) + " FROM loyalty)"
_LIFT = f"CASE WHEN o_avg_clv > 0 THEN {pct('(m_avg_clv - o_avg_clv)', 'o_avg_clv', 1)} ELSE 0 END"

FINALS |= {
    # Loyalty
    "serve_loyalty_overview": f"""
SELECT m_total_customers AS loyalty_customers, o_total_customers AS other_customers,
       {pct('m_total_customers', 'm_total_customers + o_total_customers', 1)} AS loyalty_pct,
       CAST({_LIFT} AS DOUBLE) AS clv_lift_pct, """
    + ", ".join(f"round(m_{c} - o_{c}, 2) AS {c}_delta" for c in _M)
    + f" FROM {_SIDES}",
    "serve_loyalty_compare": " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS metric, CAST(m_{c} AS DOUBLE) AS loyalty_members,"
        f" CAST(o_{c} AS DOUBLE) AS non_members, CAST("
        + (
            _LIFT
            if c == "avg_clv"
            else "NULL" if c == "total_customers" else f"round(m_{c} - o_{c}, 2)"
        )
        + f" AS DOUBLE) AS advantage FROM {_SIDES}"
        for i, c in enumerate([*_M, "total_customers"])
    ),
    "serve_loyalty_index": " UNION ALL ".join(
        f"SELECT '{n}' AS metric, 'Non-Members' AS group_label, CAST(100 AS DOUBLE) AS value"
        f" UNION ALL SELECT '{n}', 'Loyalty Members',"
        f" {pct(f'm_{c}', f'CASE WHEN o_{c} > 0 THEN o_{c} ELSE 1 END', 1)} FROM {_SIDES}"
        for c, n in _M.items()
    ),
    "serve_loyalty_clv_box": f"""
SELECT is_loyalty, {box('total_revenue_to_date')} FROM latest
WHERE is_loyalty IS NOT NULL AND CAST(total_revenue_to_date AS DOUBLE) <=
      (SELECT {quant('total_revenue_to_date', 0.95)} FROM latest)
GROUP BY is_loyalty""",
    # Locations
    "serve_location_topn": f"""
SELECT restaurant_id, {LOCATION} AS location_label, {dbl('total_revenue')}, avg_order_value,
       total_orders, unique_customers, performance_tier
FROM locations WHERE performance_tier = 'Mid Tier'
ORDER BY avg_order_value DESC NULLS LAST, restaurant_id LIMIT 7""",
    "serve_location_kpis": f"""
SELECT 'Loc-' || right(t.restaurant_id, 6) AS top_location,
       CAST(t.total_revenue AS DOUBLE) AS top_revenue,
       'Loc-' || right(b.restaurant_id, 6) AS bottom_location,
       CAST(b.total_revenue AS DOUBLE) AS bottom_revenue,
       CAST(t.total_revenue - b.total_revenue AS DOUBLE) AS revenue_gap, a.avg_revenue,
       a.top_performers
FROM (SELECT * FROM locations ORDER BY revenue_rank, restaurant_id LIMIT 1) t,
     (SELECT * FROM locations ORDER BY revenue_rank DESC, restaurant_id LIMIT 1) b,
     (SELECT {avg('total_revenue')} AS avg_revenue,
             count(*) FILTER (WHERE performance_tier = 'Top Performer') AS top_performers
      FROM locations) a""",
    "serve_location_size_capped": f"""
SELECT restaurant_id, performance_tier, avg_order_value, {dbl('total_revenue')},
       least(CAST(total_orders AS DOUBLE), (SELECT {quant('total_orders', 0.95)} FROM locations))
         AS size_capped FROM locations""",
    "serve_location_scorecard": f"""
SELECT revenue_rank, {LOCATION} AS location_label, {dbl('total_revenue')}, avg_order_value,
       total_orders, unique_customers, avg_daily_revenue, performance_tier FROM locations""",
    "serve_location_monthly": f"""
SELECT {MONTH} AS month_start, t.restaurant_id,
       CAST(sum(t.total_revenue) AS DOUBLE) AS total_revenue,
       '#' || lpad(CAST(any_value(revenue_rank) AS VARCHAR), 2, '0') || ' Loc-'
         || right(t.restaurant_id, 6) AS location_label
FROM trends t JOIN (SELECT restaurant_id, revenue_rank FROM locations
                    ORDER BY revenue_rank, restaurant_id LIMIT 10) l
  ON l.restaurant_id = t.restaurant_id
WHERE order_date IS NOT NULL GROUP BY 1, 2""",
    "serve_location_extremes": f"""
SELECT {LOCATION_COLUMNS}, 'top' AS side FROM
  (SELECT * FROM locations ORDER BY revenue_rank, restaurant_id LIMIT 5)
UNION ALL SELECT {LOCATION_COLUMNS}, 'bottom' FROM
  (SELECT * FROM locations ORDER BY revenue_rank DESC, restaurant_id LIMIT 5)""",
    # Promotions
    "serve_promo_filter": f"""
SELECT {DISCOUNT_COLUMNS} FROM discounts
WHERE order_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31' AND order_type = 'free_item'
  AND NOT is_loyalty""",
    "serve_promo_kpis": f"""
SELECT orders, promo_orders, promo_pct, estimated_value, p AS avg_promo_basket,
       f AS avg_full_basket, CASE WHEN f > 0 THEN {pct('p - f', 'f')} END AS basket_lift_pct
FROM (SELECT count(*) AS orders, {PROMO} AS promo_orders, {pct(PROMO, 'count(*)', 1)} AS promo_pct,
             CAST(sum(total_estimated_discount) AS DOUBLE) AS estimated_value,
             {avg('gross_revenue', 4, 'is_promotional_order')} AS p,
             {avg('gross_revenue', 4, 'NOT is_promotional_order')} AS f FROM discounts)""",
    "serve_order_type_breakdown": """
SELECT order_type, count(*) AS orders FROM discounts GROUP BY order_type""",
    "serve_promo_rate_monthly": f"""
SELECT {MONTH} AS month_start, count(order_id) AS total, {PROMO} AS promo,
       {PROMO_RATE} AS promo_rate FROM discounts WHERE order_date IS NOT NULL GROUP BY 1""",
    "serve_basket_compare": f"""
SELECT CASE WHEN is_promotional_order THEN 'Promotional' ELSE 'Full Price' END AS basket,
       {avg('gross_revenue')} AS avg_basket FROM discounts
WHERE CAST(gross_revenue AS DOUBLE) <= (SELECT {quant('gross_revenue', 0.95)} FROM discounts)
GROUP BY 1""",
    "serve_basket_box": f"""
SELECT CASE WHEN is_promotional_order THEN 'Promotional' ELSE 'Full Price' END AS basket,
       {box('gross_revenue')} FROM discounts
WHERE CAST(gross_revenue AS DOUBLE) <= (SELECT {quant('gross_revenue', 0.95)} FROM discounts)
GROUP BY 1""",
    "serve_promo_by_location": f"""
SELECT restaurant_id, {LOCATION} AS location_label, total, promo, promo_rate
FROM (SELECT restaurant_id, count(order_id) AS total, {PROMO} AS promo, {PROMO_RATE} AS promo_rate
      FROM discounts WHERE restaurant_id IS NOT NULL GROUP BY restaurant_id)
ORDER BY promo_rate DESC NULLS LAST, restaurant_id LIMIT 15""",
    "serve_promo_by_loyalty": f"""
SELECT is_loyalty, count(order_id) AS total, {PROMO} AS promo, {PROMO_RATE} AS promo_rate,
       {avg('total_estimated_discount')} AS avg_discount, {LOYALTY_LABEL} AS group_label
FROM discounts WHERE is_loyalty IS NOT NULL GROUP BY is_loyalty""",
    "serve_promo_top50": f"""
SELECT left(order_id, 12) || '...' AS order, order_date, {LOCATION} AS location_label, is_loyalty,
       {dbl('gross_revenue')}, order_type, free_item_count, below_avg_price_item_count,
       {dbl('total_estimated_discount')}
FROM (SELECT * FROM discounts WHERE is_promotional_order
      ORDER BY total_estimated_discount DESC NULLS LAST, order_id LIMIT 50)""",
    # Quality profile
    "dq_shape_schema": " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS data_type,"
        f" count(*) AS row_count, {len(types)} AS column_count, '{name}' AS table_name FROM {source}"
        for name, (source, types) in SOURCE_TYPES.items()
        for i, (c, t) in enumerate(types.items())
    ),
    "dq_sample": """
SELECT * REPLACE (CAST(option_price AS DOUBLE) AS option_price) FROM options
ORDER BY order_id, lineitem_id, option_group_name, option_name LIMIT 3""",
    "dq_null_report": " UNION ALL ".join(
        f"SELECT *, '{name}' AS table_name FROM ({null_report(source, list(types))})"
        for name, (source, types) in SOURCE_TYPES.items()
    ),
    "dq_null_report_calendar": null_report(
        "date_dim",
        ["date_key", "day_of_week", "week", "month", "year", "is_weekend", "is_holiday",
         "holiday_name"],
    ),
    "dq_row_duplicates": " UNION ALL ".join(
        f"SELECT *, '{name}' AS table_name FROM ({duplicates(source, ', '.join(types))})"
        for name, (source, types) in SOURCE_TYPES.items()
    ),
    "dq_key_duplicates_items": duplicates("items", KEY),
    "dq_key_duplicates": duplicates("options", f"{KEY}, option_name"),
    "dq_key_duplicates_calendar": duplicates("date_dim", "date_key"),
    "dq_cardinality": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values FROM items"
        for c in CARDINAL
    ),
    "dq_numeric_summary": numeric_summary("items", ["item_price", "item_quantity"]),
    "dq_numeric_summary_options": numeric_summary("options", ["option_price", "option_quantity"]),
    "dq_negative_values": """
SELECT 'item_price' AS column_name, count(*) FILTER (WHERE item_price < 0) AS negative_rows
FROM items
UNION ALL SELECT 'option_price', count(*) FILTER (WHERE option_price < 0) FROM options""",
    "dq_date_range": """
SELECT CAST(min(t) AS DATE) AS first_order_day, CAST(max(t) AS DATE) AS last_order_day,
       CAST(floor((epoch(max(t)) - epoch(min(t))) / 86400) AS BIGINT) AS order_span_days,
       (SELECT min(date_key) FROM date_dim) AS calendar_min_key,
       (SELECT max(date_key) FROM date_dim) AS calendar_max_key,
       (SELECT CAST(min(strptime(date_key, '%d-%m-%Y')) AS DATE) FROM date_dim)
         AS calendar_first_day,
       (SELECT CAST(max(strptime(date_key, '%d-%m-%Y')) AS DATE) FROM date_dim)
         AS calendar_last_day
FROM (SELECT CAST(creation_time_utc AS TIMESTAMP) AS t FROM items)""",
    "dq_join_quality_options": f"""
SELECT count(*) AS option_keys, count(*) FILTER (WHERE m) AS matched,
       count(*) FILTER (WHERE NOT m) AS unmatched,
       {pct('count(*) FILTER (WHERE m)', 'count(*)')} AS match_rate_pct
FROM (SELECT EXISTS (SELECT 1 FROM items i WHERE i.order_id = o.order_id
                     AND i.lineitem_id = o.lineitem_id) AS m
      FROM (SELECT DISTINCT {KEY} FROM options) o)""",
    "dq_join_quality_dates": f"""
SELECT count(*) AS order_days, count(*) FILTER (WHERE m) AS matched,
       count(*) FILTER (WHERE NOT m) AS unmatched,
       {pct('count(*) FILTER (WHERE m)', 'count(*)')} AS match_rate_pct,
       array_to_string(list_sort(list(day) FILTER (WHERE NOT m))[1:5], ',') AS sample_unmatched
FROM (SELECT day, EXISTS (SELECT 1 FROM date_dim WHERE date_key = day) AS m
      FROM (SELECT DISTINCT CAST(CAST(CAST(creation_time_utc AS TIMESTAMP) AS DATE) AS VARCHAR)
              AS day FROM items))""",
    "dq_flag_distribution": f"""
SELECT is_loyalty, row_count, {pct('row_count', '(SELECT count(*) FROM items)')} AS pct
FROM (SELECT is_loyalty, count(*) AS row_count FROM items GROUP BY is_loyalty)""",
    "dq_top_values": top_values("items", ["item_category", "app_name", "restaurant_id"]),
    "dq_summary": """
SELECT count(*) AS order_items_rows, count(DISTINCT user_id) AS customers,
       count(DISTINCT order_id) AS orders, count(DISTINCT restaurant_id) AS restaurants,
       count(DISTINCT app_name) AS platforms,
       CAST(min(CAST(creation_time_utc AS TIMESTAMP)) AS DATE) AS first_order_day,
       CAST(max(CAST(creation_time_utc AS TIMESTAMP)) AS DATE) AS last_order_day,
       count(*) FILTER (WHERE is_loyalty) AS loyalty_rows,
       count(*) FILTER (WHERE NOT is_loyalty) AS non_member_rows,
       (SELECT count(*) FROM options) AS option_rows,
       (SELECT count(*) FROM date_dim) AS date_dim_rows,
       (SELECT count(*) FROM options WHERE option_price < 0) AS negative_option_rows
FROM items""",
}

ORACLE: dict[str, str] = {name: query(final) for name, final in FINALS.items()}
