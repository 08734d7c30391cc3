"""Small relational building blocks: shape, keys, sets, top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def _as_type(df: DataFrame, name: str, target: T.DataType) -> Column:
    c = F.col(name)
    is_text = isinstance(df.schema[name].dataType, T.StringType)
    if is_text and isinstance(target, (T.IntegerType, T.LongType)):
        c = c.try_cast("double")  # "2.0" is a whole number too
    return c.try_cast(target).alias(name)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``: cast where present, typed null where missing."""
    present = set(df.columns)
    return df.select(
        *[
            _as_type(df, f.name, f.dataType)
            if f.name in present
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def latest_row(
    df: DataFrame, key: str, order: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """The row of each ``key`` that comes last by ``order`` (nulls first)."""
    newest = F.max_by(F.struct(*columns), F.struct(*order)).alias("row")
    return df.groupBy(key).agg(newest).select(key, "row.*")


def top(df: DataFrame, value: str, tie: str, n: int, columns: Sequence[str | Column]) -> DataFrame:
    """The ``n`` rows with the highest ``value``; equal ones by ``tie``."""
    return df.orderBy(F.col(value).desc_nulls_last(), F.col(tie)).limit(n).select(*columns)


def value_counts(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    return counts if n is None else top(counts, "row_count", column, n, [column, "row_count"])


def distinct_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def keys_in_both(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    return left.select(*columns).intersect(right.select(*columns))


def keys_only_left(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    return left.select(*columns).subtract(right.select(*columns))


def distinct_counts(df: DataFrame, by: str, columns: dict[str, str]) -> DataFrame:
    """Per value of ``by``: how many different non-null values each column has.

    ``columns`` maps results to columns. Every column is folded on its own, to (key, value) in the map
    tasks and then to a count, so that rows are not multiplied, a scan reads two columns, and a key that
    holds much of the data is spread over its values. What is joined is one row per key.
    """
    counts = df.select(by).distinct()
    for name, column in columns.items():
        mine = (
            df.where(F.col(column).isNotNull())
            .select(F.col(by).alias("_key"), column)
            .distinct()
            .groupBy("_key")
            .agg(F.count(F.lit(1)).alias(name))
        )
        counts = counts.join(mine, F.col(by).eqNullSafe(F.col("_key")), "left").drop("_key")
    return counts.withColumns({name: F.coalesce(name, F.lit(0)) for name in columns})


def with_share(df: DataFrame, value: str, name: str, share: Column) -> DataFrame:
    """Add ``share`` to a small aggregate; it may use the column ``grand_total`` of ``value``."""
    total = df.agg(F.sum(value)).scalar()
    return df.withColumn("grand_total", total).withColumn(name, share).drop("grand_total")
