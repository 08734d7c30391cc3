"""Bronze to Silver: one enriched row per order line."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.config import Config
from orderlens.functions.dates import (
    calendar_attributes,
    order_day,
    parse_date_key,
    parse_iso_timestamp,
    year_and_month,
)
from orderlens.functions.text import clean_category
from orderlens.schemas import MONEY, SILVER
from orderlens.session import BROADCAST_ROWS, lying_together
from orderlens.sources.files import store

LINE_KEY = ["order_id", "lineitem_id"]


def drop_test_orders(items: DataFrame, cfg: Config) -> DataFrame:
    """Rows with a null platform name fail the comparison and go as well."""
    return items.where(F.col("app_name") != cfg.test_app_name)


def clean_items(items: DataFrame, cfg: Config) -> DataFrame:
    created = parse_iso_timestamp(F.col("creation_time_utc"))
    return drop_test_orders(items, cfg).withColumns(
        {
            "creation_time_utc": created,
            "order_date": order_day(created),
            "item_category": clean_category(F.col("item_category"), cfg.category_corrections),
        }
    )


def category_counts(cleaned_items: DataFrame) -> DataFrame:
    return cleaned_items.groupBy("item_category").agg(F.count(F.lit(1)).alias("row_count"))


def dedup_rows(options: DataFrame) -> DataFrame:
    """Copies are dropped inside the map tasks first, so a hot group of copies never moves whole."""
    return options.dropDuplicates()


def option_rollup(options: DataFrame) -> DataFrame:
    """Option revenue and option rows per order line."""
    amount = F.col("option_price") * F.col("option_quantity")
    return options.groupBy(*LINE_KEY).agg(
        F.sum(amount).alias("option_revenue"), F.count(F.lit(1)).alias("option_row_count")
    )


def orphan_options(options: DataFrame, cleaned_items: DataFrame) -> DataFrame:
    """Option rows whose order line is not among the cleaned items."""
    return options.join(cleaned_items.select(*LINE_KEY), LINE_KEY, "left_anti")


def join_options(items: DataFrame, rollup: DataFrame) -> DataFrame:
    """Every item exactly once, with its option revenue (0 without options)."""
    return items.join(rollup, LINE_KEY, "left").withColumns(
        {
            "option_revenue": F.coalesce("option_revenue", F.lit(0)).cast(MONEY),
            "option_row_count": F.coalesce("option_row_count", F.lit(0)).cast("int"),
        }
    )


def holidays(date_dim: DataFrame) -> DataFrame:
    """One row per readable source date; where dates repeat, a holiday beats a working day."""
    entry = F.struct(
        F.col("is_holiday").cast("boolean").alias("is_holiday"),
        F.col("holiday_name").cast("string").alias("holiday_name"),
    )
    return (
        date_dim.select(parse_date_key(F.col("date_key")).alias("date_key"), entry.alias("entry"))
        .where(F.col("date_key").isNotNull())
        .groupBy("date_key")
        .agg(F.max("entry").alias("entry"))
        .select("date_key", "entry.*")
    )


def date_spine(date_dim: DataFrame, start: date, end: date) -> DataFrame:
    """Every day from ``start`` to ``end`` with calendar attributes and the source's holidays."""
    first_to_last = F.sequence(F.lit(start), F.lit(end))
    days = date_dim.sparkSession.range(1).select(F.explode(first_to_last).alias("date_key"))
    known = holidays(date_dim).where(F.col("date_key").between(F.lit(start), F.lit(end)))
    return (
        days.join(known, "date_key", "left")
        .withColumns(calendar_attributes(F.col("date_key")))
        .withColumn("is_holiday", F.coalesce("is_holiday", F.lit(False)))
    )


def join_calendar(lines: DataFrame, spine: DataFrame, days: int) -> DataFrame:
    """Calendar attributes by order day; days outside the spine keep nulls."""
    attributes = spine.select(
        "date_key", "week", "day_of_week", "is_weekend", "is_holiday", "holiday_name"
    )
    if days <= BROADCAST_ROWS:
        attributes = F.broadcast(attributes)
    return lines.join(attributes, F.col("order_date") == F.col("date_key"), "left")


def gross_revenue() -> Column:
    amount = F.col("item_price") * F.col("item_quantity") + F.col("option_revenue")
    return amount.cast(MONEY)


def bulk_flags(cfg: Config) -> dict[str, Column]:
    pricey = F.col("item_price") >= F.lit(cfg.bulk_price)
    many = F.col("item_quantity") >= cfg.bulk_quantity
    return {
        "is_bulk_order_candidate": F.coalesce(pricey | many, F.lit(False)),
        "bulk_flag_reason": F.when(pricey & many, "high_item_price_and_quantity")
        .when(pricey, "high_item_price")
        .when(many, "high_item_quantity"),
    }


def orders_enriched(
    items: DataFrame,
    options: DataFrame,
    date_dim: DataFrame,
    cfg: Config,
    by_month: bool = False,
    by_order: bool = False,
    kept_in: str | None = None,
) -> DataFrame:
    """The Silver table; with ``by_month`` rebalanced by year and month, to be written.

    Options move once: copies, sums and the join all find them by order line. With ``by_order`` items and
    options lie by order instead, so that a fold of Silver by order moves nothing; run it ``lying_together``.
    With ``kept_in`` they also meet by order, and the joined lines are stored in that folder at once. If they
    move on by month, what the join moved is then off the disks, and the lines of an order, which follow each
    other, move in fewer bytes. The rebalance comes before the columns that follow from others, so that these
    never move.
    """
    cleaned = clean_items(items, cfg)
    if by_order or kept_in:
        # What lies so already does not move.
        cleaned, options = cleaned.repartition("order_id"), options.repartition("order_id")
    else:
        options = options.repartition(*LINE_KEY)
    lines = join_options(cleaned, option_rollup(dedup_rows(options)))
    if kept_in:
        with lying_together(items.sparkSession):
            lines = store(lines.drop("printed_card_number"), kept_in)
    if by_month:
        months = year_and_month(F.col("order_date"))
        lines = lines.withColumns(months).hint("rebalance", "year", "month")
    spine = date_spine(date_dim, cfg.calendar_start, cfg.calendar_end)
    days = (cfg.calendar_end - cfg.calendar_start).days + 1
    enriched = join_calendar(lines, spine, days).withColumns(
        {
            "gross_revenue": gross_revenue(),
            **bulk_flags(cfg),
            **year_and_month(F.col("order_date")),
        }
    )
    return enriched.select(*SILVER.fieldNames())


def revenue_stats(silver: DataFrame) -> DataFrame:
    """Revenue figures and bulk rows, in one pass."""
    revenue = F.col("gross_revenue")
    return silver.agg(
        F.min(revenue).alias("min_revenue"),
        F.max(revenue).alias("max_revenue"),
        F.avg(revenue).alias("avg_revenue"),
        F.sum(revenue).alias("total_revenue"),
        F.count_if(F.col("is_bulk_order_candidate")).alias("bulk_rows"),
    )
