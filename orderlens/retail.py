"""Adapter from a star-schema retail data set to the three source tables.

Orders, order lines, parts and customers become order items with options and a holiday calendar,
with the flaws the cleaning rules are about: dirty categories, test orders, free items, exact copies
and orphans among the options.
"""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.config import Config
from orderlens.plans.silver import orders_enriched
from orderlens.schemas import MONEY

CONFIG = Config(
    test_app_name="Store - DEVELOPMENT",
    calendar_start=date(1995, 1, 1),
    calendar_end=date(2000, 12, 31),
    bulk_price=Decimal("980"),
    bulk_quantity=50,
)


class Tables:
    """The Parquet tables under one folder, each opened once."""

    def __init__(self, spark: SparkSession, base: str) -> None:
        self._spark, self.base = spark, base
        self._open: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = self._spark.read.parquet(f"{self.base}/{name}.parquet")
        return self._open[name]


def _line_id(order: Column, quantity: Column) -> Column:
    return F.concat_ws("-", order, "l_linenumber", "l_partkey", "l_suppkey", quantity)


def order_items(tables: Tables) -> DataFrame:
    """One item per line.

    Customers meet orders and parts meet lines first. Lines meet their orders last and by the text of the
    order's key, so that the items lie by ``order_id`` and need not move again for it. Rows carry keys,
    days and flags through the joins; other text is made of them only in the final columns.
    """
    customers = tables["customer"].select(
        "c_custkey", "c_nationkey", (F.col("c_mktsegment") == "BUILDING").alias("builder")
    )
    orders = (
        tables["orders"]
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").cast("string").alias("order_id"),
            (F.col("o_orderkey") % 100 == 7).alias("test"),
            "o_custkey",
            "c_nationkey",
            F.col("o_orderdate").cast("timestamp").alias("creation_time_utc"),
            (F.col("builder") & (F.col("o_orderstatus") != "P")).alias("is_loyalty"),
        )
    )
    parts = tables["part"].select(
        "p_partkey",
        "p_type",
        F.col("p_name").alias("item_name"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("price"),
    )
    lines = tables["lineitem"].select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("l_quantity").cast("int").alias("item_quantity"),
        F.col("l_discount").cast("decimal(3,2)").alias("discount"),
        ((F.col("l_returnflag") == "R") & (F.col("l_discount") == 0.1)).alias("free"),
    )
    discounted = F.col("price") * (1 - F.col("discount"))
    rows = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "item_quantity",
        "p_type",
        "item_name",
        F.when(F.col("free"), F.lit(0)).otherwise(discounted).cast(MONEY).alias("item_price"),
    )
    # A partition's orders are hashed, so that its lines, several times as many and wider, need no sort.
    rows = rows.join(orders.hint("shuffle_hash"), "order_id")
    part = F.col("l_partkey") % 10
    return rows.select(
        F.when(F.col("test"), F.lit(CONFIG.test_app_name)).otherwise(F.lit("Store")).alias("app_name"),
        F.concat(F.lit("LOC-"), "c_nationkey").alias("restaurant_id"),
        "creation_time_utc",
        "order_id",
        F.col("o_custkey").cast("string").alias("user_id"),
        F.lit(None).cast("string").alias("printed_card_number"),
        "is_loyalty",
        F.lit("USD").alias("currency"),
        _line_id(F.col("order_id"), F.col("item_quantity")).alias("lineitem_id"),
        F.when(part == 0, F.concat("p_type", F.lit(" https://x.y/1")))
        .when(part == 1, F.concat("p_type", F.lit("`1")))
        .when(part == 2, F.concat(F.lit(" "), F.col("p_type")))
        .otherwise(F.col("p_type"))
        .alias("item_category"),
        "item_name",
        "item_price",
        "item_quantity",
    )


def order_item_options(tables: Tables) -> DataFrame:
    """Two possible options per line, as one pass: an array of rows is built and unfolded."""
    lines, parts = tables["lineitem"], tables["part"]
    rows = lines.join(parts, lines["l_partkey"] == parts["p_partkey"])

    def option(line: Column, group: Column, name: Column, price: Column, quantity: Column) -> Column:
        return F.struct(
            F.col("l_orderkey").cast("string").alias("order_id"),
            line.alias("lineitem_id"),
            group.alias("option_group_name"),
            name.alias("option_name"),
            price.cast(MONEY).alias("option_price"),
            quantity.cast("int").alias("option_quantity"),
        )

    order = F.col("l_orderkey")
    line = _line_id(order, F.col("l_quantity").cast("int"))
    orphan = F.concat(line, F.lit("-X"))
    by_tax = F.col("l_tax") >= 0.03
    by_size = F.col("p_size") % 2 == 0
    copied, lost = order % 50 == 3, order % 500 == 11
    tax_price = F.col("l_tax").cast("decimal(3,2)") * 25

    def tax_option(line_id: Column) -> Column:
        return option(
            line_id, F.col("l_returnflag"), F.col("l_linestatus"), tax_price, F.col("l_linenumber")
        )

    def size_option(line_id: Column) -> Column:
        return option(
            line_id,
            F.lit("Size"),
            F.col("p_size").cast("string"),
            F.lit(Decimal("0.50")),
            F.lit(1),
        )

    candidates = [
        F.when(wanted & extra, make(line_id))
        for wanted, make in ((by_tax, tax_option), (by_size, size_option))
        for extra, line_id in ((F.lit(True), line), (copied, line), (lost, orphan))
    ]
    # An option that does not apply is a null entry and unfolds to a row of nulls.
    return rows.select(F.inline(F.array(*candidates))).where(F.col("order_id").isNotNull())


def date_dim(tables: Tables) -> DataFrame:
    day = F.col("day")
    days = (
        tables["orders"]
        .select(F.to_date("o_orderdate").alias("day"))
        # The source lacks every 29th day of a year.
        .where(F.dayofyear(day) % 29 != 0)
        .distinct()
    )
    first = F.dayofmonth(day) == 1
    return days.select(
        F.date_format(day, "dd-MM-yyyy").alias("date_key"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.weekofyear(day).alias("week"),
        F.date_format(day, "MMMM").alias("month"),
        F.year(day).alias("year"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        first.alias("is_holiday"),
        F.when(first, F.concat(F.lit("Holiday "), F.month(day).cast("string"))).alias(
            "holiday_name"
        ),
    )


def with_iso_text(items: DataFrame) -> DataFrame:
    """Creation times as ISO-8601 text, as a CSV source has them; half of them with milliseconds."""
    created = F.col("creation_time_utc")
    return items.withColumn(
        "creation_time_utc",
        F.when(
            F.col("order_id").cast("bigint") % 2 == 0,
            F.date_format(created, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"),
        ).otherwise(F.date_format(created, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
    )


def silver(spark: SparkSession, base: str, cfg: Config = CONFIG) -> DataFrame:
    tables = Tables(spark, base)
    return orders_enriched(
        order_items(tables), order_item_options(tables), date_dim(tables), cfg
    )
