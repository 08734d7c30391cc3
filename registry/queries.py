"""One Spark query per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from decimal import Decimal
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens import retail
from orderlens.functions import dates, numbers, text
from orderlens.operators import ordering, tables
from orderlens.plans import customers, pipeline, promotions, quality, sales
from orderlens.plans import silver as silver_plan
from orderlens.plans.serve import churn as churn_page
from orderlens.plans.serve import clv as clv_page
from orderlens.plans.serve import locations as location_page
from orderlens.plans.serve import loyalty as loyalty_page
from orderlens.plans.serve import overview
from orderlens.plans.serve import promo as promo_page
from orderlens.plans.serve import rfm as rfm_page
from orderlens.plans.serve import sales as sales_page
from orderlens.schemas import GOLD, ORDER_ITEMS
from orderlens.session import leaving_no_shuffle_files, lying_together, reliable, scratch_folder
from orderlens.sources import files, jdbc

CFG = retail.CONFIG
_OF_ORDERS = [
    "order_id", "user_id", "restaurant_id", "order_date", "is_loyalty", "gross_revenue",
    "is_bulk_order_candidate",
]

_OF_PROMOTIONS = [
    "order_id", "order_date", "restaurant_id", "is_loyalty", "gross_revenue", "order_type", "free_item_count",
    "below_avg_price_item_count", "total_estimated_discount", "is_promotional_order",
]

Query = Callable[[SparkSession, str], DataFrame]


class Frames:
    """The source, Silver and Gold frames of one data directory, as lazy plans.

    Pages read a Gold table several times; in production it is a written table, here it is
    checkpointed for them (``*_table``).
    """

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark = spark
        self.tables = retail.Tables(spark, base)

    @cached_property
    def items(self) -> DataFrame:
        return retail.order_items(self.tables)

    @cached_property
    def options(self) -> DataFrame:
        return retail.order_item_options(self.tables)

    @cached_property
    def date_dim(self) -> DataFrame:
        return retail.date_dim(self.tables)

    @cached_property
    def sources(self) -> dict[str, DataFrame]:
        return {
            "order_items": self.items,
            "order_item_options": self.options,
            "date_dim": self.date_dim,
        }

    @cached_property
    def cleaned(self) -> DataFrame:
        return silver_plan.clean_items(self.items, CFG)

    @cached_property
    def option_rows(self) -> DataFrame:
        return silver_plan.dedup_rows(self.options)

    @cached_property
    def spine(self) -> DataFrame:
        return silver_plan.date_spine(self.date_dim, CFG.calendar_start, CFG.calendar_end)

    @cached_property
    def silver(self) -> DataFrame:
        return silver_plan.orders_enriched(self.items, self.options, self.date_dim, CFG)

    @cached_property
    def silver_by_month(self) -> DataFrame:
        """Silver as it is written."""
        sources, kept = (self.items, self.options, self.date_dim), scratch_folder(self.spark)
        return silver_plan.orders_enriched(*sources, CFG, by_month=True, kept_in=kept)

    @cached_property
    def silver_by_order(self) -> DataFrame:
        """Silver with the lines of an order together, to be folded by order."""
        return silver_plan.orders_enriched(self.items, self.options, self.date_dim, CFG, by_order=True)

    @cached_property
    def orders(self) -> DataFrame:
        """Order facts, stored once for all tables that only need order grain.

        They are written where they are made: a single query would not win back what a move by month costs.
        """
        with lying_together(self.spark):
            return files.store(customers.order_facts(self.silver_by_order), scratch_folder(self.spark))

    @cached_property
    def clv(self) -> DataFrame:
        return customers.customer_clv_daily(self.orders, CFG)

    @cached_property
    def rfm(self) -> DataFrame:
        return customers.customer_rfm_segments(self.orders, CFG)

    @cached_property
    def churn(self) -> DataFrame:
        return customers.customer_churn_indicators(self.orders, CFG)

    @cached_property
    def trends(self) -> DataFrame:
        return sales.sales_trends(self.silver, CFG)

    @cached_property
    def loyalty(self) -> DataFrame:
        return customers.loyalty_comparison(self.orders, CFG)

    @cached_property
    def locations(self) -> DataFrame:
        return sales.location_performance(self.orders, CFG)

    @cached_property
    def discounts(self) -> DataFrame:
        return promotions.discount_effectiveness(self.silver, CFG, self.cleaned)

    @cached_property
    def promotional_orders(self) -> DataFrame:
        """The discounts of promotional orders, stored, as the lines of an order lie together to be written."""
        with lying_together(self.spark):
            discounts = promotions.discount_effectiveness(self.silver_by_order, CFG, self.cleaned)
            found = discounts.where("is_promotional_order").select(*_OF_PROMOTIONS)
            return files.store(found, scratch_folder(self.spark))

    @cached_property
    def stored(self) -> Frames:
        """The same frames over Silver stored once, for pages that read order facts and trends."""
        kept = Frames(self.spark, self.tables.base)
        columns = dict.fromkeys([*GOLD["sales_trends"][:10], *_OF_ORDERS])
        kept.silver = files.store(self.silver.select(*columns), scratch_folder(self.spark))
        kept.silver_by_order = kept.silver
        return kept

    @cached_property
    def revenue(self) -> DataFrame:
        """The part of the trends that pages on revenue read."""
        return sales.trend_revenue(self.silver)

    @cached_property
    def locations_table(self) -> DataFrame:
        return reliable(self.locations)

    @cached_property
    def baskets_table(self) -> DataFrame:
        """The part of the discounts that pages on baskets read, stored, as the lines of an order lie together."""
        with lying_together(self.spark):
            discounts = promotions.discount_effectiveness(self.silver_by_order, CFG, self.cleaned)
            baskets = discounts.select("is_promotional_order", "gross_revenue")
            return files.store(baskets, scratch_folder(self.spark))

    @cached_property
    def churn_table(self) -> DataFrame:
        return reliable(self.churn)

    @cached_property
    def trends_table(self) -> DataFrame:
        return reliable(self.trends)


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the number type both engines print alike."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _query(build: Callable[[Frames], DataFrame]) -> Query:
    return lambda spark, base: _plain(build(Frames(spark, base)))


_KEY = ["order_id", "lineitem_id"]
_SNAPSHOT = ["user_id", "order_date", "is_loyalty"]

_BUILDERS: dict[str, Callable[[Frames], DataFrame]] = {}


def _register(name: str):
    def add(build: Callable[[Frames], DataFrame]):
        _BUILDERS[name] = build
        return build

    return add


# Sources and sinks: written to and read back from a new folder


def _csv_folder(f: Frames) -> str:
    folder = scratch_folder(f.spark)
    sources = {
        "order_items": retail.with_iso_text(f.items),
        "order_item_options": f.options,
        "date_dim": f.date_dim,
    }
    for name, df in sources.items():
        writer = df.write.option("header", True).option("ignoreLeadingWhiteSpace", False)
        with leaving_no_shuffle_files(f.spark):
            writer.csv(f"{folder}/{name}.csv", compression="gzip")
    return folder


@_register("src_csv")
def _(f):
    return files.read_csv(f.spark, _csv_folder(f), "order_item_options")


@_register("src_csv_typed")
def _(f):
    return files.read_typed_csv(f.spark, _csv_folder(f), "order_items")


@_register("src_parquet_latest")
def _(f):
    """Two Bronze days with different columns; only the newer one is read."""
    folder = scratch_folder(f.spark)
    files.write_bronze(f.options.drop("option_quantity"), folder, "options", date(2024, 1, 9))
    files.write_bronze(f.options, folder, "options", date(2024, 1, 10))
    return files.read_latest_bronze(f.spark, folder, "options")


def _two_days(f: Frames) -> str:
    """Options of two days, the second of them replaced: first without sizes, then whole."""
    folder = scratch_folder(f.spark)
    sizes = F.col("option_group_name") == "Size"
    files.write_bronze(f.options.where(sizes), folder, "options", date(2024, 1, 9))
    files.write_bronze(f.options.where(~sizes), folder, "options", date(2024, 1, 10))
    files.write_bronze(f.options, folder, "options", date(2024, 1, 10))
    return folder


@_register("sink_bronze")
def _(f):
    """Rows of both days by group, after the second was replaced."""
    folder = _two_days(f)
    days = [files.read_bronze_day(f.spark, folder, "options", date(2024, 1, d)) for d in (9, 10)]
    both = days[0].unionByName(days[1])
    return both.groupBy("ingestion_date", "option_group_name").agg(F.count(F.lit(1)).alias("row_count"))


@_register("ingestion_stamp")
def _(f):
    folder = scratch_folder(f.spark)
    files.write_bronze(f.items, folder, "items", date(2024, 1, 9))
    day = files.latest_partition(f.spark, f"{folder}/items")
    return files.read_bronze_day(f.spark, folder, "items", day).select(*_KEY, "ingestion_date")


@_register("drop_partition_col")
def _(f):
    return files.drop_partition_column(
        files.read_bronze_day(f.spark, _two_days(f), "options", date(2024, 1, 10))
    )


@_register("src_mode_dispatch")
def _(f):
    """The items, read through the switch between kinds of sources."""
    return pipeline.read_source(f.spark, "csv", "order_items", csv_base=_csv_folder(f)).select(
        *_KEY, "user_id", "item_price", "item_quantity", "is_loyalty"
    )


@_register("src_gold")
def _(f):
    """A Gold table written twice, read with an absent one beside it, which reads as empty."""
    folder = scratch_folder(f.spark)
    files.write_gold(f.rfm.where("r_score = 1"), folder, "customer_rfm_segments")
    files.write_gold(f.rfm, folder, "customer_rfm_segments")
    there = files.read_gold(f.spark, folder, "customer_rfm_segments")
    return there.unionByName(files.read_gold(f.spark, folder, "absent", there.schema))


@_register("sink_silver_incremental")
def _(f):
    """Two Bronze days: of February 1998 the first lacks the orders, of the others some options."""
    folder = scratch_folder(f.spark)
    items = retail.with_iso_text(f.items)
    late = (F.col("option_group_name") == "Size") & (F.col("order_id").cast("bigint") % 97 == 5)
    first = {
        "order_items": items.where(~F.col("creation_time_utc").startswith("1998-02")),
        "order_item_options": f.options.where(~late),
        "date_dim": f.date_dim,
    }
    second = {"order_items": items, "order_item_options": f.options, "date_dim": f.date_dim}
    for day, sources in ((date(2024, 1, 9), first), (date(2024, 1, 10), second)):
        for table, df in sources.items():
            files.write_bronze(df, f"{folder}/bronze", table, day)
        pipeline.build_silver(f.spark, f"{folder}/bronze", f"{folder}/silver", CFG, incremental=True)
    stored = files.read_silver(f.spark, f"{folder}/silver")
    return stored.select(*_KEY, "year", "month", "order_date", "option_row_count", "gross_revenue")


@_register("sink_silver")
def _(f):
    folder = scratch_folder(f.spark)
    files.write_silver(f.silver_by_month, folder, balanced=True)
    stored = files.read_silver(f.spark, folder)
    return stored.select(*_KEY, "year", "month", "order_date", "gross_revenue")


@_register("observe_counts")
def _(f):
    seen = files.write_silver(f.silver_by_month, scratch_folder(f.spark), balanced=True)
    names = ["rows", "min_revenue", "max_revenue", "total_revenue", "bulk_rows", "rows_without_options"]
    return f.spark.createDataFrame([tuple(seen[n] for n in names)], names)


@_register("sink_gold")
def _(f):
    folder = scratch_folder(f.spark)
    files.write_gold(f.churn, folder, "customer_churn_indicators")
    return files.read_gold(f.spark, folder, "customer_churn_indicators")


@_register("src_parquet_silver")
def _(f):
    """The stored Silver table, all of it."""
    folder = scratch_folder(f.spark)
    files.write_silver(f.silver_by_month, folder, balanced=True)
    return (
        files.read_silver(f.spark, folder)
        .groupBy("restaurant_id", "year", "month")
        .agg(numbers.money(F.sum("gross_revenue")).alias("revenue"))
    )


@_register("union_parts")
def _(f):
    """A Gold table in many part files reads as one."""
    folder = scratch_folder(f.spark)
    files.write_gold(f.loyalty.repartition(4), folder, "loyalty_comparison")
    files.write_gold(f.locations.repartition(7), folder, "location_performance")
    return files.read_gold(f.spark, folder, "location_performance")


@_register("readonly_guard")
def _(f):
    """A guarded SELECT over the options, as the query utility runs it."""
    f.options.createOrReplaceTempView("order_item_options")
    return jdbc.run_select(
        f.spark,
        "SELECT option_group_name, count(*) AS created_rows FROM order_item_options"
        " GROUP BY option_group_name",
    )


@_register("run_pipeline")
def _(f):
    """CSV to Bronze to Silver to Gold; the rows written to each Gold table."""
    folder = scratch_folder(f.spark)
    done = pipeline.run(
        f.spark,
        f"{folder}/bronze",
        f"{folder}/silver",
        f"{folder}/gold",
        CFG,
        "csv",
        csv_base=_csv_folder(f),
    )
    return f.spark.createDataFrame(list(done["gold"].items()), ["gold_table", "row_count"])


# Projection, cleaning and scalar functions


@_register("norm_columns")
def _(f):
    loud = f.date_dim.toDF(*[c.upper() for c in f.date_dim.columns])
    return tables.lower_columns(loud)


@_register("conform_schema")
def _(f):
    raw = f.items.select(
        *_KEY,
        F.col("item_price").cast("string"),
        F.concat(F.col("item_quantity"), F.lit(".0")).alias("item_quantity"),
        F.col("is_loyalty").cast("string"),
    )
    return tables.conform(raw, ORDER_ITEMS)


@_register("filter_test_platform")
def _(f):
    return silver_plan.drop_test_orders(f.items, CFG).select("app_name", *_KEY)


@_register("parse_iso_ts")
def _(f):
    created = dates.parse_iso_timestamp(F.col("creation_time_utc"))
    items = retail.with_iso_text(f.items)
    return items.select(*_KEY, F.date_format(created, "yyyy-MM-dd HH:mm:ss").alias("created"))


@_register("to_order_date")
def _(f):
    return f.cleaned.select(*_KEY, "order_date")


@_register("clean_category")
def _(f):
    cleaned = text.clean_category(F.col("item_category"), CFG.category_corrections)
    return f.items.select(*_KEY, F.col("item_category").alias("raw"), cleaned.alias("category"))


@_register("reformat_date_key")
def _(f):
    return f.date_dim.select("date_key", dates.parse_date_key(F.col("date_key")).alias("day"))


@_register("calendar_attrs")
def _(f):
    day = F.to_date(F.col("creation_time_utc").try_cast("timestamp"))
    days = f.items.select(day.alias("day")).distinct()
    return days.withColumns(dates.calendar_attributes(F.col("day")))


@_register("holiday_default")
def _(f):
    return f.spine.select("date_key", "is_holiday", "holiday_name")


@_register("gross_revenue")
def _(f):
    return f.silver.select(*_KEY, "item_price", "item_quantity", "option_revenue", "gross_revenue")


@_register("bulk_flag")
def _(f):
    return f.cleaned.select(*_KEY, silver_plan.bulk_flags(CFG)["is_bulk_order_candidate"].alias("flag"))


@_register("bulk_reason")
def _(f):
    return f.cleaned.select(*_KEY, silver_plan.bulk_flags(CFG)["bulk_flag_reason"].alias("reason"))


@_register("year_month_cols")
def _(f):
    return f.cleaned.select(
        *_KEY, *[c.alias(n) for n, c in dates.year_and_month(F.col("order_date")).items()]
    )


@_register("null_to_zero")
def _(f):
    joined = f.cleaned.join(silver_plan.option_rollup(f.option_rows), _KEY, "left")
    return joined.select(
        *_KEY,
        numbers.zero_if_null(F.col("option_revenue")).alias("option_revenue"),
        numbers.zero_if_null(F.col("option_row_count")).alias("option_row_count"),
    )


@_register("rounding")
def _(f):
    price = F.col("item_price")
    return f.cleaned.select(
        *_KEY,
        numbers.money(price).alias("price_2"),
        numbers.money(price * F.lit(Decimal("1.25")), 4).alias("price_4"),
        numbers.money(price, 1).alias("price_1"),
    )


@_register("safe_ratio")
def _(f):
    return f.cleaned.select(
        *_KEY,
        numbers.safe_ratio(F.col("item_quantity"), F.col("item_price"), 4).alias("ratio"),
        numbers.percent(F.col("item_price"), F.col("item_quantity")).alias("pct"),
    )


@_register("label_location")
def _(f):
    return f.locations.select(
        "restaurant_id",
        text.location_label(F.col("restaurant_id")).alias("label"),
        text.ranked_location_label(F.col("revenue_rank"), F.col("restaurant_id")).alias("ranked"),
    )


@_register("mask_id")
def _(f):
    return f.items.select("lineitem_id", text.mask_id(F.col("lineitem_id")).alias("masked"))


@_register("map_bool_label")
def _(f):
    return f.items.select(
        *_KEY, "is_loyalty", text.loyalty_label(F.col("is_loyalty")).alias("group_label")
    )


# Joins


@_register("join_items_options")
def _(f):
    joined = silver_plan.join_options(f.cleaned, silver_plan.option_rollup(f.option_rows))
    return joined.select(*_KEY, "item_price", "option_revenue", "option_row_count")


@_register("anti_orphan_options")
def _(f):
    return silver_plan.orphan_options(f.option_rows, f.cleaned)


@_register("join_calendar")
def _(f):
    days = (CFG.calendar_end - CFG.calendar_start).days + 1
    joined = silver_plan.join_calendar(f.cleaned, f.spine, days)
    return joined.select(
        *_KEY, "order_date", "week", "day_of_week", "is_weekend", "is_holiday", "holiday_name"
    )


@_register("join_spine_holidays")
def _(f):
    return f.spine.where("is_holiday").select("date_key", "holiday_name")


@_register("join_churn_windows")
def _(f):
    return f.churn.select("user_id", "total_spend", "spend_last_90", "spend_prior_90")


@_register("join_category_stats")
def _(f):
    return promotions.promo_item_signals(f.silver, CFG, f.cleaned).select(
        *_KEY, "item_category", "category_avg_price", "category_stddev_price", "priced_item_count"
    )


@_register("semi_by_user")
def _(f):
    return clv_page.serve_clv_filter(f.clv, loyalty=True).select(
        "user_id", "snapshot_date", "is_loyalty"
    )


@_register("semi_by_restaurant")
def _(f):
    f = f.stored
    best = location_page.serve_location_topn(f.locations, n=3).select("restaurant_id")
    return f.revenue.join(F.broadcast(best), "restaurant_id", "left_semi").select(
        "order_date", "restaurant_id", "item_category", "total_revenue"
    )


@_register("setjoin_keys")
def _(f):
    matched = tables.keys_in_both(f.option_rows, f.items, _KEY)
    orphans = tables.keys_only_left(f.option_rows, f.items, _KEY)
    return matched.withColumn("side", F.lit("matched")).unionByName(
        orphans.withColumn("side", F.lit("orphan"))
    )


# Aggregations


@_register("dedup_rows")
def _(f):
    return f.option_rows


@_register("distinct_keys")
def _(f):
    return tables.distinct_keys(f.cleaned, _KEY)


@_register("agg_option_rollup")
def _(f):
    return silver_plan.option_rollup(f.option_rows)


@_register("agg_category_counts")
def _(f):
    return silver_plan.category_counts(f.cleaned).orderBy(F.desc("row_count"), "item_category")


@_register("agg_global_stats")
def _(f):
    stats = silver_plan.revenue_stats(f.silver)
    return stats.withColumn("avg_revenue", F.round("avg_revenue", 4))


@_register("agg_ref_date")
def _(f):
    return f.silver.agg(F.max("order_date").alias("reference_date"))


@_register("agg_daily_customer")
def _(f):
    return customers.daily_customers(f.silver)


@_register("agg_rfm")
def _(f):
    return customers.customer_recency(f.silver, CFG)


@_register("agg_churn_base")
def _(f):
    return f.churn.select(
        "user_id", "days_since_last_order", "total_orders", "total_spend", "first_order_date",
        "last_order_date",
    )


@_register("agg_window_spend")
def _(f):
    return f.churn.select("user_id", "spend_last_90", "spend_prior_90")


@_register("agg_sales_trends")
def _(f):
    return f.trends.select(
        "order_date", "restaurant_id", "item_category", "order_count", "unique_customers"
    )


@_register("agg_two_level_loyalty")
def _(f):
    return f.loyalty


@_register("agg_location")
def _(f):
    return sales.location_totals(customers.order_facts(f.silver))


@_register("agg_category_price_stats")
def _(f):
    return promotions.category_price_stats(f.silver)


@_register("agg_order_promo")
def _(f):
    return f.discounts.select(
        "order_id", "gross_revenue", "total_line_items", "unique_items", "free_item_count",
        "free_item_revenue_loss", "below_avg_price_item_count", "below_avg_discount_amt",
        "total_estimated_discount",
    )


@_register("agg_order_type_counts")
def _(f):
    return promotions.promo_totals(f.discounts)


# Window functions


@_register("win_running_sum")
def _(f):
    return customers.running_customer_totals(customers.daily_customers(f.silver)).select(
        *_SNAPSHOT, "total_revenue_to_date", "orders_to_date", "bulk_orders_to_date"
    )


@_register("win_partition_max")
def _(f):
    totals = customers.running_customer_totals(customers.daily_customers(f.silver))
    return totals.select(
        *_SNAPSHOT,
        F.max("total_revenue_to_date").over(Window.partitionBy("user_id")).alias("final_total"),
    )


@_register("win_percent_rank")
def _(f):
    """Final totals of all snapshots, with the percent rank that decides their tier."""
    totals = customers.running_customer_totals(customers.daily_customers(f.silver))
    final = F.max("total_revenue_to_date").over(Window.partitionBy("user_id"))
    return ordering.percent_ranks(totals.select(final.alias("value")), "value")


@_register("win_ntile")
def _(f):
    return f.rfm.select("user_id", "r_score", "f_score", "m_score")


@_register("win_dense_rank")
def _(f):
    totals = reliable(
        f.silver.groupBy("item_category", "restaurant_id").agg(
            F.count(F.lit(1)).alias("lines")
        )
    )
    return ordering.dense_ranks(totals, "lines", name="place")


@_register("global_row_number")
def _(f):
    customers_seen = f.silver.groupBy("user_id").agg(
        numbers.money(F.sum("gross_revenue")).alias("spend")
    )
    return ordering.row_numbers(customers_seen, ["spend", "user_id"])


@_register("win_latest_row")
def _(f):
    return clv_page.latest_snapshots(f.clv)


@_register("win_share_of_total")
def _(f):
    return sales_page.serve_category_share(reliable(f.revenue))


# Sorts, limits and sets


@_register("sort_desc_log")
def _(f):
    return promotions.order_type_counts(f.discounts).orderBy(F.desc("orders"), "order_type")


@_register("topk_customers")
def _(f):
    return clv_page.serve_clv_top10(f.clv)


@_register("topn_value_counts")
def _(f):
    return tables.value_counts(f.items, "item_name", 10)


@_register("top_bottom_5")
def _(f):
    return location_page.serve_location_extremes(f.locations).select("side", "restaurant_id")


@_register("set_intersect")
def _(f):
    ordered = f.cleaned.select(F.date_format("order_date", "dd-MM-yyyy").alias("date_key"))
    return tables.keys_in_both(ordered, f.date_dim, ["date_key"])


@_register("set_except")
def _(f):
    ordered = f.cleaned.select(F.date_format("order_date", "dd-MM-yyyy").alias("date_key"))
    return tables.keys_only_left(ordered, f.date_dim, ["date_key"])


# Silver and Gold

_BUILDERS |= {
    "date_spine": lambda f: f.spine,
    "orders_enriched": lambda f: f.silver.withColumn(
        "creation_time_utc", F.date_format("creation_time_utc", "yyyy-MM-dd HH:mm:ss")
    ),
    "customer_clv_daily": lambda f: f.clv,
    "customer_rfm_segments": lambda f: f.rfm,
    "customer_churn_indicators": lambda f: f.churn,
    "sales_trends": lambda f: f.trends,
    "loyalty_comparison": lambda f: f.loyalty,
    "location_performance": lambda f: f.locations,
    "promo_item_signals": lambda f: promotions.promo_item_signals(f.silver, CFG, f.cleaned).select(
        *_KEY, "is_free_item", "is_below_avg_price", "estimated_discount"
    ),
    "discount_effectiveness": lambda f: f.discounts,
}

# Pages

_BUILDERS |= {
    "serve_home_kpis": lambda f: overview.serve_home_kpis(
        f.stored.clv, f.stored.rfm, f.stored.churn, f.stored.loyalty, f.stored.trends,
        f.stored.locations,
    ),
    "serve_filter_domains": lambda f: overview.serve_filter_domains(
        f.trends_table, ["order_date", "month"], ["item_category", "restaurant_id"]
    ),
    "serve_tier_distribution": lambda f: overview.serve_tier_distribution(f.clv),
    "serve_segment_distribution": lambda f: overview.serve_segment_distribution(f.rfm),
    "serve_monthly_revenue": lambda f: overview.serve_monthly_revenue(f.trends),
    "serve_clv_filter": lambda f: clv_page.serve_clv_filter(
        f.clv, "High", False, date(1997, 1, 1), date(1999, 12, 31)
    ),
    "serve_clv_kpis": lambda f: clv_page.serve_clv_kpis(f.clv, "Medium"),
    "serve_clv_tier_avg": lambda f: clv_page.serve_clv_tier_avg(f.clv),
    "serve_clv_growth": lambda f: clv_page.serve_clv_growth(f.clv),
    "serve_clv_by_loyalty": lambda f: clv_page.serve_clv_by_loyalty(f.clv),
    "serve_clv_top10": lambda f: clv_page.serve_clv_top10(f.clv, loyalty=True),
    "serve_rfm_filter": lambda f: rfm_page.serve_rfm_filter(f.rfm, "Regular", 5, 9, 120),
    "serve_rfm_kpis": lambda f: rfm_page.serve_rfm_kpis(f.rfm),
    "serve_rfm_profile": lambda f: rfm_page.serve_rfm_profile(f.rfm),
    "serve_rfm_score_box": lambda f: rfm_page.serve_rfm_score_box(f.rfm),
    "serve_rfm_p95_points": lambda f: rfm_page.serve_rfm_p95_points(f.rfm),
    "serve_rfm_p95_hidden": lambda f: rfm_page.serve_rfm_p95_hidden(f.rfm),
    "serve_rfm_scores_long": lambda f: rfm_page.serve_rfm_scores_long(f.rfm),
    "serve_rfm_action_guide": lambda f: rfm_page.serve_rfm_action_guide(f.rfm),
    "serve_churn_rethreshold": lambda f: churn_page.serve_churn_rethreshold(f.churn, 90, 3, True),
    "serve_churn_kpis": lambda f: churn_page.serve_churn_kpis(f.churn_table),
    "serve_churn_kpis_rethreshold": lambda f: churn_page.serve_churn_kpis(
        churn_page.serve_churn_rethreshold(f.churn_table, 90, 3)
    ),
    "serve_hist_inactivity": lambda f: churn_page.serve_hist_inactivity(f.churn),
    "serve_hist_gap": lambda f: churn_page.serve_hist_gap(f.churn_table),
    "serve_spend_buckets": lambda f: churn_page.serve_spend_buckets(f.churn),
    "serve_revenue_at_stake": lambda f: churn_page.serve_revenue_at_stake(f.churn),
    "serve_churn_spend_box": lambda f: churn_page.serve_churn_spend_box(f.churn_table),
    "serve_at_risk_top50": lambda f: churn_page.serve_at_risk_top50(f.churn),
    "serve_sales_filter": lambda f: sales_page.serve_sales_filter(
        f.trends, date(1996, 3, 1), date(1999, 6, 30), ["ECONOMY", "PROMO"], ["LOC-1", "LOC-2"]
    ),
    "serve_sales_kpis": lambda f: sales_page.serve_sales_kpis(f.trends),
    "serve_sales_by_day": lambda f: sales_page.serve_sales_by_period(f.trends, "daily"),
    "serve_sales_by_week": lambda f: sales_page.serve_sales_by_period(f.trends, "weekly"),
    "serve_sales_by_period": lambda f: sales_page.serve_sales_by_period(f.trends, "monthly"),
    "serve_exact_orders": lambda f: sales_page.serve_exact_orders(f.silver, "monthly"),
    "serve_category_share": lambda f: sales_page.serve_category_share(reliable(f.revenue)),
    "serve_revenue_by_weekday": lambda f: sales_page.serve_revenue_by_weekday(f.trends),
    "serve_month_year_matrix": lambda f: sales_page.serve_month_year_matrix(f.trends),
    "serve_holiday_impact": lambda f: sales_page.serve_holiday_impact(f.trends),
    "serve_named_holidays": lambda f: sales_page.serve_named_holidays(f.trends),
    "serve_loyalty_overview": lambda f: loyalty_page.serve_loyalty_overview(f.loyalty),
    "serve_loyalty_compare": lambda f: loyalty_page.serve_loyalty_compare(f.loyalty),
    "serve_loyalty_index": lambda f: loyalty_page.serve_loyalty_index(f.loyalty),
    "serve_loyalty_clv_box": lambda f: loyalty_page.serve_loyalty_clv_box(f.clv),
    "serve_location_topn": lambda f: location_page.serve_location_topn(
        f.locations, "avg_order_value", 7, "Mid Tier"
    ),
    "serve_location_kpis": lambda f: location_page.serve_location_kpis(f.locations),
    "serve_location_size_capped": lambda f: location_page.serve_location_size_capped(f.locations),
    "serve_location_scorecard": lambda f: location_page.serve_location_scorecard(f.locations),
    "serve_location_monthly": lambda f: location_page.serve_location_monthly(
        f.stored.revenue, f.stored.locations
    ),
    "serve_location_extremes": lambda f: location_page.serve_location_extremes(f.locations_table),
    "serve_promo_filter": lambda f: promo_page.serve_promo_filter(
        f.discounts, date(1996, 1, 1), date(1998, 12, 31), "free_item", False
    ),
    "serve_promo_kpis": lambda f: promo_page.serve_promo_kpis(f.discounts),
    "serve_order_type_breakdown": lambda f: promo_page.serve_order_type_breakdown(f.discounts),
    "serve_promo_rate_monthly": lambda f: promo_page.serve_promo_rate_monthly(f.discounts),
    "serve_basket_compare": lambda f: promo_page.serve_basket_compare(f.baskets_table),
    "serve_basket_box": lambda f: promo_page.serve_basket_box(f.baskets_table),
    "serve_promo_by_location": lambda f: promo_page.serve_promo_by_location(f.discounts),
    "serve_promo_by_loyalty": lambda f: promo_page.serve_promo_by_loyalty(f.discounts),
    "serve_promo_top50": lambda f: promo_page.serve_promo_top50(f.promotional_orders),
}

# Quality profile

_BUILDERS |= {
    "dq_shape_schema": lambda f: quality.per_table(f.sources, quality.dq_shape_schema),
    "dq_sample": lambda f: quality.dq_sample(
        f.options, _KEY + ["option_group_name", "option_name"]
    ),
    "dq_null_report": lambda f: quality.per_table(f.sources, quality.dq_null_report),
    "dq_null_report_calendar": lambda f: quality.dq_null_report(f.date_dim),
    "dq_row_duplicates": lambda f: quality.per_table(f.sources, quality.dq_row_duplicates),
    "dq_key_duplicates_items": lambda f: quality.dq_key_duplicates(f.items, _KEY),
    "dq_key_duplicates": lambda f: quality.dq_key_duplicates(f.options, [*_KEY, "option_name"]),
    "dq_key_duplicates_calendar": lambda f: quality.dq_key_duplicates(f.date_dim, ["date_key"]),
    "dq_cardinality": lambda f: quality.dq_cardinality(f.items),
    "dq_numeric_summary": lambda f: quality.dq_numeric_summary(
        f.items, ["item_price", "item_quantity"]
    ),
    "dq_numeric_summary_options": lambda f: quality.dq_numeric_summary(
        f.options, ["option_price", "option_quantity"]
    ),
    "dq_negative_values": lambda f: quality.dq_negative_values(f.items, f.options),
    "dq_date_range": lambda f: quality.dq_date_range(f.items, f.date_dim),
    "dq_join_quality_options": lambda f: quality.dq_join_quality_options(f.items, f.options),
    "dq_join_quality_dates": lambda f: quality.dq_join_quality_dates(f.items, f.date_dim),
    "dq_flag_distribution": lambda f: quality.dq_flag_distribution(f.items),
    "dq_top_values": lambda f: quality.dq_top_values(f.items),
    "dq_summary": lambda f: quality.dq_summary(f.items, f.options, f.date_dim),
}

QUERIES: dict[str, Query] = {name: _query(build) for name, build in _BUILDERS.items()}
assert set(GOLD) <= set(QUERIES)
