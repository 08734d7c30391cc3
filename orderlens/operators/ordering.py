"""Exact global ranks and quantiles without a single-task window.

Quantiles and percent-rank cuts are order statistics and come from ``selection``. Ranks of rows rest on
another idea. A globally sorted frame is a list of slices (its range
partitions) that are sorted among each other. Once the sorted frame is checkpointed the slices are
fixed, so the number of rows in front of a row is the size of the earlier slices - one number per
slice, a frame as long as the partition count - plus its position inside its own slice.

Rows with the same value are folded into one weighted row before the sort, hence a value shared by
a third of all rows is one row, and orders that must separate ties append a unique column.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.operators.selection import (
    Place,
    fold,
    folded_quantiles,
    order_statistics,
)
from orderlens.session import reliable

# monotonically_increasing_id() keeps the position inside the partition in its lower 33 bits.
_POSITION_BITS = (1 << 33) - 1


def rows_before(
    df: DataFrame,
    order: Sequence[str | Column],
    weight: str | None = None,
    name: str = "rows_before",
) -> DataFrame:
    """Add the number (or total ``weight``) of rows that sort in front of each row.

    ``order`` should be unique; rows that tie come in any order.
    """
    slices = (
        reliable(df.orderBy(*order))
        .withColumn("_slice", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS)))
    )
    size = F.count(F.lit(1)) if weight is None else F.sum(weight)
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        slices.groupBy("_slice")
        .agg(size.alias("_size"))
        .select("_slice", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    )
    if weight is None:
        inside = F.col("_at")
    else:
        in_front = (
            Window.partitionBy("_slice")
            .orderBy("_at")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        inside = F.coalesce(F.sum(weight).over(in_front), F.lit(0))
    # `starts` has one row per partition of `slices`.
    return slices.join(F.broadcast(starts), "_slice").select(
        *df.columns, (F.col("_start") + inside).cast("bigint").alias(name)
    )


def row_numbers(df: DataFrame, order: Sequence[str | Column], name: str = "row_number") -> DataFrame:
    """Global ``row_number()`` over a unique order."""
    return rows_before(df, order, name=name).withColumn(name, F.col(name) + 1)


def dense_ranks(df: DataFrame, value: str, descending: bool = True, name: str = "rank") -> DataFrame:
    """Global ``dense_rank()`` by one column, nulls last.

    Rows are sorted by the value and a hash of the whole row, which spreads a value that many rows
    share over several slices. A slice carries on from the number of different values before it, one
    less where it begins with the value that the slice before it ended with.
    """
    key = F.col(value)
    order = key.desc_nulls_last() if descending else key.asc_nulls_last()
    inside = F.dense_rank().over(Window.partitionBy("_slice").orderBy(order))
    slices = (
        reliable(df.orderBy(order, F.xxhash64(*df.columns)))
        .withColumn("_slice", F.spark_partition_id())
        .withColumn("_inside", inside)
    )
    ends = slices.groupBy("_slice").agg(
        F.max("_inside").alias("_different"),
        F.min(F.struct("_inside", value)).getField(value).alias("_first"),
        F.max(F.struct("_inside", value)).getField(value).alias("_last"),
    )
    in_turn = Window.orderBy("_slice")
    goes_on = F.col("_first").eqNullSafe(F.lag("_last").over(in_turn)) & (F.row_number().over(in_turn) > 1)
    earlier = F.sum("_different").over(in_turn) - F.col("_different")
    starts = ends.withColumn("_goes_on", goes_on).select(
        "_slice", (earlier - F.sum(F.col("_goes_on").cast("int")).over(in_turn)).alias("_start")
    )
    # `starts` has one row per partition of `slices`.
    return slices.join(F.broadcast(starts), "_slice").select(
        *df.columns, (F.col("_start") + F.col("_inside")).cast("int").alias(name)
    )


def percent_ranks(df: DataFrame, value: str, name: str = "percent_rank") -> DataFrame:
    """Each different value with the global ``percent_rank()`` of its rows, nulls first.

    That is the number of rows before it over all other rows; 0 if there is only one row. Rows are
    folded to (value, count) before anything is sorted, so a common value is one row.
    """
    folded = df.groupBy(value).agg(F.count(F.lit(1)).alias("_weight"))
    ranked = rows_before(folded, [F.col(value).asc_nulls_first()], "_weight")
    others = ranked.agg(F.sum("_weight") - 1).scalar()
    return ranked.withColumn("_others", others).select(
        value,
        F.when(F.col("_others") > 0, F.col("rows_before") / F.col("_others")).otherwise(F.lit(0.0)).alias(name),
    )


def percent_rank_cuts(df: DataFrame, value: str, shares: dict[str, float]) -> Column:
    """Cut values by percent rank, as one scalar struct with a field per entry of ``shares``.

    ``percent_rank() > share`` over all rows of ``df`` holds exactly where ``value > cut``, so the
    rows themselves need no rank and no sort. A percent rank is the number of smaller values over
    n - 1, so the cut is the value at place ``floor(share * (n - 1))``; nulls come first.
    """

    def place_of(share: float) -> Place:
        exact = F.lit(Decimal(str(share)))
        return lambda n: F.floor(F.greatest(n - 1, F.lit(0)) * exact)

    found = order_statistics(fold(df, value, nulls=True), {name: place_of(share) for name, share in shares.items()})
    return found.agg(F.max(F.struct(*shares)).alias("cuts")).scalar()


def ntiles(df: DataFrame, key: str, columns: Sequence[str], tiles: int) -> DataFrame:
    """Add ``ntile(tiles)`` of each column over the whole frame, as ``<column>_tile``.

    Rows are ordered by (column, ``key``), nulls first, and ``key`` must be unique. Only the first
    row of each tile is looked up in the sorted order; all rows are then placed by comparison with
    those few rows, without being moved. ``df`` should be checkpointed: it is read twice.
    """
    measures = [
        F.struct(F.lit(c).alias("measure"), F.col(c).cast("decimal(28,4)").alias("value"))
        for c in columns
    ]
    long = df.select(F.explode(F.array(*measures)).alias("m"), key).select("m.*", key)
    # Measures follow each other in the sort, every one with as many rows as `df`. A scalar
    # subquery is added as a column once; naming it in every expression would plan it each time.
    total = F.col("_total")
    ordered = (
        rows_before(long, ["measure", "value", key])
        .withColumn("_total", df.agg(F.count(F.lit(1))).scalar())
        .withColumn("_at", F.col("rows_before") % total)
    )
    firsts = []
    for column in columns:
        for tile in range(1, tiles):
            # The first `total % tiles` tiles hold one row more than the others.
            start = _div(total, tiles) * tile + F.least(F.lit(tile), total % tiles)
            here = (F.col("measure") == column) & (F.col("_at") == start)
            firsts.append(
                F.max(F.when(here, F.struct("value", key))).alias(f"{column}_{tile}")
            )
    found = ordered.agg(F.struct(*firsts).alias("firsts")).scalar()
    placed = {}
    for column in columns:
        mine = F.struct(F.col(column).cast("decimal(28,4)").alias("value"), F.col(key))
        reached = [
            F.coalesce((mine >= F.col(f"_firsts.{column}_{tile}")).cast("int"), F.lit(0))
            for tile in range(1, tiles)
        ]
        placed[f"{column}_tile"] = reduce(lambda a, b: a + b, reached, F.lit(1))
    return df.withColumn("_firsts", found).withColumns(placed).drop("_firsts")


def _div(whole: Column, by: int) -> Column:
    return ((whole - whole % by) / by).cast("bigint")


def quantiles(
    df: DataFrame,
    value: str,
    percents: dict[str, int],
    by: Sequence[str] = (),
    extremes: bool = False,
) -> DataFrame:
    """Exact interpolated percentiles of ``value``, per group of ``by``.

    ``percents`` maps output columns to whole percentages. ``extremes`` adds ``n``, ``min`` and
    ``max``. Null values are left out. The groups themselves should be few: they are flags or
    segments; a group may hold any number of rows.
    """
    return folded_quantiles(fold(df, value, by), percents, by, extremes)


def quantile(df: DataFrame, value: str, percent: int) -> Column:
    """One exact percentile of the whole frame, as a scalar subquery (null if there is no value)."""
    return quantiles(df, value, {"q": percent}).agg(F.max("q")).scalar()


def median(df: DataFrame, value: str) -> Column:
    return quantile(df, value, 50)


def box_stats(df: DataFrame, value: str, by: Sequence[str], cap_percent: int | None = None) -> DataFrame:
    """Five-number summary per group with fences at 1.5 interquartile ranges.

    With ``cap_percent`` only values up to that percentile over all groups count. Cap and quartiles
    are read from the same counts.
    """
    percents = {"q1": 25, "median": 50, "q3": 75}
    box = folded_quantiles(fold(df, value, by), percents, by, True, cap_percent)
    reach = (F.col("q3") - F.col("q1")) * F.lit(Decimal("1.5"))
    return box.withColumns(
        {
            "lower_fence": (F.col("q1") - reach).cast("decimal(24,6)"),
            "upper_fence": (F.col("q3") + reach).cast("decimal(24,6)"),
        }
    )
