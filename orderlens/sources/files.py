"""CSV and Parquet sources, and the Bronze, Silver and Gold sinks."""

from __future__ import annotations

import re
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.operators.tables import conform, lower_columns
from orderlens.schemas import SOURCES
from orderlens.session import leaving_no_shuffle_files
from orderlens.sources import versions
from orderlens.sources.versions import COMPRESSION

DAY_COLUMN = "ingestion_date"


def read_csv(spark: SparkSession, base: str, table: str) -> DataFrame:
    """``<base>/<table>.csv`` by header, all columns text, names in lower case.

    Only the header is read ahead. Types come from :func:`read_typed_csv`, not from a scan that
    guesses them.
    """
    return lower_columns(spark.read.option("header", True).csv(f"{base}/{table}.csv"))


def read_typed_csv(
    spark: SparkSession, base: str, table: str, schema: T.StructType | None = None
) -> DataFrame:
    return conform(read_csv(spark, base, table), schema or SOURCES[table])


def latest_partition(spark: SparkSession, root: str) -> str:
    """The newest complete ``ingestion_date=`` day under ``root``; no data is read.

    Only ISO dates count, and only days of which a write has ended well.
    """
    days = [
        n.split("=", 1)[1]
        for n in versions.names_in(spark, root)
        if re.fullmatch(rf"{DAY_COLUMN}=\d{{4}}-\d{{2}}-\d{{2}}", n)
    ]
    for day in sorted(days, reverse=True):
        if versions.current(spark, f"{root}/{DAY_COLUMN}={day}") is not None:
            return day
    raise ValueError(f"no complete {DAY_COLUMN} partition under {root}")


def latest_bronze_folder(spark: SparkSession, base: str, table: str) -> str:
    """Where the content of the newest day lies; a later write does not change what is in there."""
    root = f"{base}/{table}"
    return versions.current(spark, f"{root}/{DAY_COLUMN}={latest_partition(spark, root)}")


def read_bronze_day(spark: SparkSession, base: str, table: str, day: date | str) -> DataFrame:
    """One day of a Bronze table, with its day as a column."""
    folder = versions.current(spark, f"{base}/{table}/{DAY_COLUMN}={day}")
    if folder is None:
        raise ValueError(f"{table} has no complete day {day}")
    return spark.read.parquet(folder).withColumn(DAY_COLUMN, F.lit(str(day)).cast("date"))


def drop_partition_column(df: DataFrame) -> DataFrame:
    return df.drop(DAY_COLUMN)


def read_latest_bronze(spark: SparkSession, base: str, table: str) -> DataFrame:
    """The newest day of a Bronze table; older days may have other schemas and are not opened."""
    day = latest_partition(spark, f"{base}/{table}")
    return drop_partition_column(read_bronze_day(spark, base, table, day))


def read_silver(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.parquet(f"{base}/orders_enriched")


def read_gold(
    spark: SparkSession, base: str, table: str, schema: T.StructType | None = None
) -> DataFrame:
    """A Gold table; with a schema, an absent table reads as an empty one."""
    folder = versions.current(spark, f"{base}/{table}")
    if folder is None:
        if schema is None:
            raise ValueError(f"no Gold table {table} under {base}")
        return spark.createDataFrame([], schema)
    df = spark.read.parquet(folder)
    days = ("snapshot_date", "order_date", "first_order_date", "last_order_date")
    return df.withColumns({c: F.to_date(c) for c in days if c in df.columns})


def ingestion_day(day: date | None = None) -> str:
    return (day or datetime.now(UTC).date()).isoformat()


def count_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while ``df`` is written, instead of running it twice."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_bronze(df: DataFrame, base: str, table: str, day: date | None = None) -> int:
    """Replace one ingestion day and leave the others; an empty table replaces its day as well.

    Readers see the day's former content until the write has ended.
    """
    counted, seen = count_rows(df, table)
    versions.replace(counted, f"{base}/{table}/{DAY_COLUMN}={ingestion_day(day)}")
    return seen.get["rows"]


def write_silver(
    silver: DataFrame, base: str, incremental: bool = False, balanced: bool = False
) -> dict:
    """Write by year and month; returns row count, revenue figures and months seen on the way.

    A full rebuild also removes months that no longer exist; ``incremental`` keeps them. The
    rebalance step splits a month that holds much of the data into several files; ``balanced`` rows
    (``orders_enriched`` with ``by_month``) have gone through it.
    """
    rows = silver if balanced else silver.hint("rebalance", "year", "month")
    seen = Observation("orders_enriched")
    revenue = F.col("gross_revenue")
    # Observed after the shuffle: a map stage that runs again would count twice.
    observed = rows.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.min(revenue).alias("min_revenue"),
        F.max(revenue).alias("max_revenue"),
        F.avg(revenue).alias("avg_revenue"),
        F.sum(revenue).alias("total_revenue"),
        F.count_if(F.col("is_bulk_order_candidate")).alias("bulk_rows"),
        F.count_if(F.col("option_row_count") == 0).alias("rows_without_options"),
        F.collect_set(F.struct("year", "month")).alias("filled"),
    )
    with leaving_no_shuffle_files(silver.sparkSession):
        (
            observed.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic" if incremental else "static")
            .partitionBy("year", "month")
            .parquet(f"{base}/orders_enriched", compression=COMPRESSION)
        )
    return seen.get


def store_by_month(df: DataFrame, folder: str) -> DataFrame:
    """Write ``df``, which has ``year`` and ``month``, in folders by month and read it back.

    Later readers open only the columns and months they need, also where the first month wanted is
    known no sooner than at run time.
    """
    balanced = df.hint("rebalance", "year", "month")
    with leaving_no_shuffle_files(df.sparkSession):
        balanced.write.mode("overwrite").partitionBy("year", "month").parquet(
            folder, compression=COMPRESSION
        )
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def store(df: DataFrame, folder: str) -> DataFrame:
    """Write ``df`` as its tasks make it, without moving rows, and read it back."""
    with leaving_no_shuffle_files(df.sparkSession):
        df.write.mode("overwrite").parquet(folder, compression=COMPRESSION)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def write_gold(df: DataFrame, base: str, table: str) -> int:
    """Replace a Gold table; readers see its former content until the write has ended."""
    counted, seen = count_rows(df, table)
    versions.replace(counted, f"{base}/{table}")
    return seen.get["rows"]


def remove_silver_month(spark: SparkSession, base: str, year: int | None, month: int | None) -> None:
    names = ["__HIVE_DEFAULT_PARTITION__" if x is None else str(x) for x in (year, month)]
    versions.remove(spark, f"{base}/orders_enriched/year={names[0]}/month={names[1]}")
