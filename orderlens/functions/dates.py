"""Parsing and calendar attributes."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_iso_timestamp(raw: Column) -> Column:
    """ISO-8601 text, with or without fraction and zone; unreadable text becomes null.

    The cast alone would read a lone time as today and a long number as a year.
    """
    return F.when(raw.rlike(r"^\s*\d{4}-\d{2}-\d{2}(?!\d)"), raw.try_cast("timestamp"))


def order_day(timestamp: Column) -> Column:
    return F.to_date(timestamp)


def parse_date_key(raw: Column) -> Column:
    return F.try_to_date(raw, "dd-MM-yyyy")


def calendar_attributes(day: Column) -> dict[str, Column]:
    return {
        "year": F.year(day),
        "month": F.date_format(day, "MMMM"),
        "week": F.weekofyear(day),
        "day_of_week": F.date_format(day, "EEEE"),
        "is_weekend": F.dayofweek(day).isin(1, 7),
    }


def year_and_month(day: Column) -> dict[str, Column]:
    return {"year": F.year(day), "month": F.month(day)}


def period_start(day: Column, granularity: str) -> Column:
    """First day of the day, week (from Monday) or month that ``day`` lies in."""
    units = {"daily": "day", "weekly": "week", "monthly": "month"}
    if granularity not in units:
        raise ValueError(f"granularity must be one of {sorted(units)}")
    return F.date_trunc(units[granularity], day).cast("date")


def month_start(day: Column) -> Column:
    return period_start(day, "monthly")


def reference_day(orders: DataFrame, fixed: date | None) -> Column:
    """The day look-backs count from: a given one, or the newest order day as scalar subquery."""
    if fixed is not None:
        return F.lit(fixed)
    return orders.agg(F.max("order_date")).scalar()
