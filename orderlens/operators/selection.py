"""Exact order statistics by radix selection: no sort of the rows, no checkpoint, one lazy plan.

The rows are folded to (group, value, count) once; everything after that reads this fold, whose
shuffle Spark runs once and reuses. A value's decimal digits are its radix: the key of a bucket is the
sign, the number of digits and the leading ``LEADING`` ones, so that keys sort like values and a group
has at most some hundred thousand of them, however long the table. A running count over the histogram
by group and key tells which buckets hold the wanted ranks, for all groups and ranks at once; only the
values of those buckets are then counted one by one.

If only values up to a percentile over all groups count (a cap), the ranks depend on how many of a
group's values lie below it. The histogram bounds that number from both sides, by the bucket of the
cap, so the buckets of all ranks in between are taken; the exact counts then give the cap, the number,
and the ranks. So cap and quartiles come from the same two passes over the fold.

What is joined back is a few rows per group, so it is broadcast; more than ``MOST_BUCKETS`` such rows
(groups are flags, segments or column names) are refused by an error, never cut.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from orderlens.session import BROADCAST_ROWS

LEADING = 5
MOST_BUCKETS = BROADCAST_ROWS
_VALUE = "decimal(20,4)"
_UNITS = 10_000

# From the number of values of a group to the place wanted, counted from 0.
Place = Callable[[Column], Column]


def _key(value: Column) -> Column:
    """The bucket of a value; buckets sort like their values."""
    digits = F.abs(value * _UNITS).cast("decimal(24,0)").cast("string")
    bucket = F.length(digits) * 10**LEADING + F.substring(digits, 1, LEADING).cast("int")
    return F.when(value < 0, -bucket).otherwise(bucket)


def _refuse_many(buckets: DataFrame) -> DataFrame:
    """The same few rows; an error if they are too many to be broadcast."""
    rows = F.collect_list(F.struct(*buckets.columns))
    checked = F.when(F.size("rows") <= MOST_BUCKETS, F.col("rows")).otherwise(
        F.raise_error(F.lit("too many groups for order statistics; aggregate by fewer"))
    )
    return buckets.agg(rows.alias("rows")).select(F.inline(checked))


def fold(
    df: DataFrame, value: str, by: Sequence[str] = (), weight: str | None = None, nulls: bool = False
) -> DataFrame:
    """Columns ``by``, ``_value`` and ``_n``: how often (or with what weight) each value occurs.

    Nulls are left out, or with ``nulls`` come before all values.
    """
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    rows = df if nulls else df.where(F.col(value).isNotNull())
    return (
        rows.select(*by, F.col(value).cast(_VALUE).alias("_value"), *([weight] if weight else []))
        .groupBy(*by, "_value")
        .agg(n.cast("bigint").alias("_n"))
    )


def order_statistics(
    folded: DataFrame,
    places: Mapping[str, Place],
    by: Sequence[str] = (),
    cap_percent: int | None = None,
) -> DataFrame:
    """Columns ``by``, ``_n`` and, for each entry of ``places``, the value at that place of its group.

    ``folded`` comes from :func:`fold`, by the same columns or more. Places must not fall as the number
    of values rises; one outside its group is null. With ``cap_percent`` only values up to that
    percentile over all groups count, and groups without one are left out.
    """
    groups = list(by) or ["_all"]
    frame = folded.withColumn("_key", _key(F.col("_value")))
    if not by:
        frame = frame.withColumn("_all", F.lit(1))
    own, every = Window.partitionBy(*groups), Window.partitionBy()
    n = F.col("_n")

    def so_far(window: WindowSpec) -> Column:
        return F.coalesce(F.sum(n).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    # The histogram, with the least and the largest number of values that may count. What is taken over
    # all groups comes first: after it the rows, at most one per bucket, stay where they are.
    placed = frame.groupBy(*groups, "_key").agg(F.sum(n).alias("_n"))
    carried, wanted = ["_low"], F.lit(False)
    low = high = n
    if cap_percent is not None:
        through, at = F.col("_through"), F.col("_cap_at")
        placed = placed.withColumns(
            {
                "_through": F.sum(n).over(Window.orderBy("_key")),
                "_cap_at": _floor_percent(F.sum(n).over(every) - 1, cap_percent),
            }
        ).withColumns(
            {
                "_cap_key": F.min(F.when(through > at, F.col("_key"))).over(every),
                "_cap_at": at - F.coalesce(F.max(F.when(through <= at, through)).over(every), F.lit(0)),
            }
        )
        low = F.when(F.col("_key") < F.col("_cap_key"), n)
        high = F.when(F.col("_key") <= F.col("_cap_key"), n)
        placed = placed.withColumn("_holds_cap", F.col("_key") == F.col("_cap_key"))
        carried += ["_holds_cap", "_cap_at"]
        wanted = F.col("_holds_cap")
    placed = placed.withColumns(
        {
            "_before": so_far(own.orderBy("_key")),
            "_low": F.coalesce(F.sum(low).over(own), F.lit(0)),
            "_high": F.coalesce(F.sum(high).over(own), F.lit(0)),
        }
    )
    for place in places.values():
        first, last = place(F.col("_low")), place(F.col("_high"))
        wanted = wanted | ((F.col("_before") + n > first) & (F.col("_before") <= last))
    buckets = placed.where(wanted).select(
        *[F.col(c).alias(f"_of{c}") for c in (*groups, "_key")], F.col("_before").alias("_base"), *carried
    )

    # The values of those buckets.
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of{c}")) for c in (*groups, "_key")])
    exact = (
        frame.join(F.broadcast(_refuse_many(buckets) if by else buckets), same)
        .groupBy(*groups, "_key", "_base", *carried, "_value")
        .agg(F.sum(n).alias("_n"))
    )
    count = F.col("_low")
    if cap_percent is not None:
        in_cap = F.when(F.col("_holds_cap"), n)
        exact = exact.withColumn("_through", F.sum(in_cap).over(Window.orderBy("_value")))
        # The first value with which the place of the cap is reached.
        reached = F.when(F.col("_holds_cap") & (F.col("_through") > F.col("_cap_at")), F.col("_value"))
        exact = exact.withColumn("_cap", F.min(reached).over(every))
        below = F.when(F.col("_holds_cap") & (F.col("_value") <= F.col("_cap")), n)
        count = F.col("_low") + F.coalesce(F.sum(below).over(own), F.lit(0))
    in_bucket = Window.partitionBy(*groups, "_key").orderBy("_value")
    exact = exact.withColumns({"_before": F.col("_base") + so_far(in_bucket), "_count": count})
    here = {
        name: (place(F.col("_count")) >= F.col("_before")) & (place(F.col("_count")) < F.col("_before") + n)
        for name, place in places.items()
    }
    found = exact.groupBy(*groups).agg(
        F.max("_count").alias("_n"), *[F.max(F.when(hit, F.col("_value"))).alias(x) for x, hit in here.items()]
    )
    return found.where("_n > 0").select(*by, "_n", *places)


def _floor_percent(n: Column, percent: int) -> Column:
    whole = n * percent
    return ((whole - F.pmod(whole, F.lit(100))) / 100).cast("bigint")


def percentile_places(percents: Mapping[str, int]) -> dict[str, Place]:
    """The two places each percentile lies between, as ``_low_<name>`` and ``_high_<name>``."""
    places: dict[str, Place] = {}
    for name, percent in percents.items():
        def low(n: Column, percent: int = percent) -> Column:
            return _floor_percent(n - 1, percent)

        def high(n: Column, percent: int = percent) -> Column:
            return -_floor_percent(1 - n, percent)

        places |= {f"_low_{name}": low, f"_high_{name}": high}
    return places


def interpolated(name: str, percent: int) -> Column:
    low, high = F.col(f"_low_{name}"), F.col(f"_high_{name}")
    part = (((F.col("_n") - 1) * percent) % 100).cast("decimal(3,0)")
    return (low + (high - low) * part * F.lit(Decimal("0.01"))).cast("decimal(24,6)")


def folded_quantiles(
    folded: DataFrame,
    percents: Mapping[str, int],
    by: Sequence[str] = (),
    extremes: bool = False,
    cap_percent: int | None = None,
) -> DataFrame:
    """Interpolated percentiles of a fold, per group of ``by``; ``extremes`` adds ``n``, ``min``, ``max``."""
    places = percentile_places(percents)
    if extremes:
        places |= {"_min": lambda n: F.lit(0), "_max": lambda n: n - 1}
    found = order_statistics(folded, places, by, cap_percent)
    ends = [F.col("_n").alias("n"), F.col("_min").alias("min")] if extremes else []
    last = [F.col("_max").alias("max")] if extremes else []
    return found.select(*by, *ends, *[interpolated(n, p).alias(n) for n, p in percents.items()], *last)


def up_to_percentile(folded: DataFrame, percent: int) -> DataFrame:
    """The part of a fold that does not exceed its percentile over all groups.

    A percentile lies between two neighbouring values and short of the upper one (unless they are
    equal), so what does not exceed it is what does not exceed the lower one.
    """
    low = percentile_places({"cap": percent})["_low_cap"]
    cap = order_statistics(folded, {"cap": low}).agg(F.max("cap")).scalar()
    return folded.withColumn("_cap", cap).where(F.col("_value") <= F.col("_cap")).drop("_cap")
