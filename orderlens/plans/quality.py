"""Data-quality profile of the source tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions.dates import parse_date_key, parse_iso_timestamp
from orderlens.functions.numbers import mean, percent
from orderlens.operators.ordering import quantiles
from orderlens.session import reliable

KEY_COLUMNS = [
    "user_id", "order_id", "restaurant_id", "app_name", "currency", "item_category",
    "item_name", "is_loyalty",
]


def per_table(tables: dict[str, DataFrame], report: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The same report of several tables, with a column that names the table; one scan of each."""
    parts = [report(df).withColumn("table_name", F.lit(name)) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def value_fold(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_name``, ``value`` (as text) and ``row_count`` of every value of each column.

    One scan of those columns; the map tasks fold before anything is shuffled.
    """
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns
    ]
    return (
        df.select(F.inline(F.array(*pairs)))
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def dq_shape_schema(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, and the size of the table."""
    columns = [
        F.struct(
            F.lit(i).alias("position"), F.lit(n).alias("column_name"), F.lit(t).alias("data_type")
        )
        for i, (n, t) in enumerate(df.dtypes)
    ]
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.inline(F.array(*columns)), "row_count", F.lit(len(columns)).alias("column_count")
    )


def dq_sample(df: DataFrame, order: Sequence[str], n: int = 3) -> DataFrame:
    return df.orderBy(*order).limit(n)


def dq_null_report(df: DataFrame) -> DataFrame:
    """Null count and share of every column that has nulls."""
    per_column = [
        F.struct(F.lit(c).alias("column_name"), F.count_if(F.col(c).isNull()).alias("null_count"))
        for c in df.columns
    ]
    return (
        df.agg(F.array(*per_column).alias("columns"), F.count(F.lit(1)).alias("n"))
        .select(F.inline("columns"), "n")
        .where(F.col("null_count") > 0)
        .select("column_name", "null_count", percent(F.col("null_count"), F.col("n")).alias("null_pct"))
        .orderBy(F.desc("null_pct"), "column_name")
    )


def _beyond_first(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    copies = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def dq_row_duplicates(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each set of identical rows."""
    return _beyond_first(df, df.columns)


def dq_key_duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return _beyond_first(df, key)


def dq_cardinality(df: DataFrame, columns: Sequence[str] = KEY_COLUMNS) -> DataFrame:
    """Distinct non-null values per column."""
    values = value_fold(df, [c for c in columns if c in df.columns])
    return values.groupBy("column_name").agg(F.count("value").alias("distinct_values"))


def dq_numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles per column."""
    moments = [
        F.struct(
            F.lit(c).alias("column_name"),
            mean(c, 4).alias("mean"),
            F.round(F.stddev_samp(F.col(c).cast("double")), 4).alias("std"),
        )
        for c in columns
    ]
    measures = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("decimal(20,4)").alias("value"))
        for c in columns
    ]
    spread = quantiles(
        df.select(F.inline(F.array(*measures))),
        "value",
        {"q25": 25, "q50": 50, "q75": 75},
        ["column_name"],
        extremes=True,
    )
    return spread.join(df.agg(F.array(*moments).alias("m")).select(F.inline("m")), "column_name")


def dq_negative_values(items: DataFrame, options: DataFrame) -> DataFrame:
    def negatives(df: DataFrame, column: str) -> DataFrame:
        count = F.count_if(F.col(column) < 0).alias("negative_rows")
        return df.agg(count).select(F.lit(column).alias("column_name"), "negative_rows")

    return negatives(items, "item_price").unionByName(negatives(options, "option_price"))


def _order_days(items: DataFrame) -> Column:
    return F.to_date(parse_iso_timestamp(F.col("creation_time_utc")))


def dq_date_range(items: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Span of the orders and of the calendar (its raw keys compared as text, and as days)."""
    created = parse_iso_timestamp(F.col("creation_time_utc"))
    day = parse_date_key(F.col("date_key"))
    calendar = date_dim.agg(
        F.struct(
            F.min("date_key").alias("min_key"),
            F.max("date_key").alias("max_key"),
            F.min(day).alias("first_day"),
            F.max(day).alias("last_day"),
        ).alias("calendar")
    ).scalar()
    seconds = F.unix_timestamp(F.max(created)) - F.unix_timestamp(F.min(created))
    return items.agg(
        F.to_date(F.min(created)).alias("first_order_day"),
        F.to_date(F.max(created)).alias("last_order_day"),
        F.floor(seconds / 86_400).cast("bigint").alias("order_span_days"),
    ).withColumn("calendar", calendar).select(
        "first_order_day",
        "last_order_day",
        "order_span_days",
        F.col("calendar.min_key").alias("calendar_min_key"),
        F.col("calendar.max_key").alias("calendar_max_key"),
        F.col("calendar.first_day").alias("calendar_first_day"),
        F.col("calendar.last_day").alias("calendar_last_day"),
    )


def _key_coverage(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct keys of ``left``, with ``matched``: does ``right`` have the key (null equals null)?

    Both sides are folded in the map tasks and meet in one shuffle; no join, so no hot key.
    """
    sides = left.select(*columns, F.lit(True).alias("in_left"), F.lit(False).alias("in_right"))
    sides = sides.unionByName(
        right.select(*columns, F.lit(False).alias("in_left"), F.lit(True).alias("in_right"))
    )
    return (
        sides.groupBy(*columns)
        .agg(F.max("in_left").alias("in_left"), F.max("in_right").alias("matched"))
        .where("in_left")
        .drop("in_left")
    )


def _coverage_figures(total: str) -> list[Column]:
    matched = F.count_if("matched")
    return [
        F.count(F.lit(1)).alias(total),
        matched.alias("matched"),
        F.count_if(~F.col("matched")).alias("unmatched"),
        percent(matched, F.count(F.lit(1))).alias("match_rate_pct"),
    ]


def dq_join_quality_options(items: DataFrame, options: DataFrame) -> DataFrame:
    keys = _key_coverage(options, items, ["order_id", "lineitem_id"])
    return keys.agg(*_coverage_figures("option_keys"))


def dq_join_quality_dates(items: DataFrame, date_dim: DataFrame, samples: int = 5) -> DataFrame:
    """Order days found among the calendar keys, compared as raw text.

    A calendar in another date format therefore shows up as absent.
    """
    days = items.select(_order_days(items).cast("string").alias("day"))
    keys = date_dim.select(F.col("date_key").cast("string").alias("day"))
    coverage = reliable(_key_coverage(days, keys, ["day"]))
    missing = coverage.where(~F.col("matched")).orderBy("day").limit(samples)
    listed = missing.agg(F.array_join(F.array_sort(F.collect_list("day")), ",")).scalar()
    return coverage.agg(*_coverage_figures("order_days")).withColumn("sample_unmatched", listed)


def dq_flag_distribution(df: DataFrame, column: str = "is_loyalty") -> DataFrame:
    """Rows and share per value, nulls included."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("pct", percent(F.col("row_count"), total))


def dq_top_values(
    df: DataFrame, columns: Sequence[str] = ("item_category", "app_name", "restaurant_id"), n: int = 10
) -> DataFrame:
    """The most frequent values of each column, from one scan; equal counts in order of the text.

    Each task passes on only its own first ``n`` of a column, so columns of many values do no harm.
    """
    place = F.row_number().over(
        Window.partitionBy("column_name").orderBy(F.desc("row_count"), F.col("value"))
    )
    return (
        value_fold(df, columns)
        .where(F.col("value").isNotNull())
        .withColumn("_place", place)
        .where(F.col("_place") <= n)
        .drop("_place")
    )


def dq_summary(items: DataFrame, options: DataFrame, date_dim: DataFrame) -> DataFrame:
    """The headline figures of the profile in one row."""
    created = _order_days(items)
    option_figures = options.agg(
        F.struct(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("option_price") < 0).alias("negative")
        ).alias("figures")
    ).scalar()
    calendar_rows = date_dim.agg(F.count(F.lit(1))).scalar()
    return items.agg(
        F.count(F.lit(1)).alias("order_items_rows"),
        F.count_distinct("user_id").alias("customers"),
        F.count_distinct("order_id").alias("orders"),
        F.count_distinct("restaurant_id").alias("restaurants"),
        F.count_distinct("app_name").alias("platforms"),
        F.min(created).alias("first_order_day"),
        F.max(created).alias("last_order_day"),
        F.count_if("is_loyalty").alias("loyalty_rows"),
        F.count_if(~F.col("is_loyalty")).alias("non_member_rows"),
    ).withColumn("option_figures", option_figures).withColumns(
        {
            "option_rows": F.col("option_figures.n"),
            "date_dim_rows": calendar_rows,
            "negative_option_rows": F.col("option_figures.negative"),
        }
    ).drop("option_figures")
