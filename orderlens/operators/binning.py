"""Histograms and labelled bins."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.operators.selection import fold, up_to_percentile


def _width(span: Column, max_bins: int, smallest: Decimal) -> Column:
    """The smallest of 1, 2, 5, 10, 20, 50 ... times ``smallest`` that spans ``span`` in ``max_bins``."""
    steps = span.cast("double") / float(max_bins * smallest)
    # One power of ten too low at most, as logarithms are rounded; the next two are tried as well.
    power = F.greatest(F.floor(F.log10(F.greatest(steps, F.lit(1.0)))) - 1, F.lit(0))
    candidates = F.transform(
        F.sequence(F.lit(0), F.lit(8)),
        lambda i: (
            F.pow(F.lit(10.0), power + F.floor(i / 3)).cast("decimal(24,0)")
            * F.element_at(F.array(*[F.lit(smallest * k) for k in (1, 2, 5)]), (i % 3 + 1).cast("int"))
        ).cast("decimal(28,4)"),
    )
    return F.filter(candidates, lambda width: width * max_bins >= span).getItem(0)


def histogram(
    df: DataFrame,
    value: str,
    by: str,
    max_bins: int = 40,
    smallest: Decimal = Decimal(1),
    cap_percent: int | None = None,
) -> DataFrame:
    """Row counts in at most about ``max_bins`` round bins ``[bin_start, bin_start + bin_width)``.

    The width is the smallest 1-2-5 step that spans the values in ``max_bins`` steps. With
    ``cap_percent`` only values up to that percentile over all groups count.
    """
    # Cap, span and counts all come from one fold to distinct values, whose shuffle is reused.
    folded = fold(df, value, [by])
    if cap_percent is not None:
        folded = up_to_percentile(folded, cap_percent)
    span = F.max("_value") - F.min("_value")
    widest = folded.agg(_width(span, max_bins, smallest).cast("decimal(20,4)").alias("width")).scalar()
    start = F.floor(F.col("_value") / F.col("bin_width")) * F.col("bin_width")
    return (
        folded.withColumn("bin_width", widest)
        .groupBy(by, start.cast("decimal(20,4)").alias("bin_start"), "bin_width")
        .agg(F.sum("_n").alias("customers"))
    )


def right_closed_bin(value: Column, edges: list[int], labels: list[str]) -> Column:
    """Label of the bin ``(edge, next edge]`` that ``value`` lies in; null outside all bins."""
    if len(edges) != len(labels) + 1:
        raise ValueError("there must be one edge more than labels")
    label = F.lit(None).cast("string")
    for low, high, name in zip(reversed(edges[:-1]), reversed(edges[1:]), reversed(labels)):
        label = F.when((value > low) & (value <= high), name).otherwise(label)
    return label


def labelled_rows(df: DataFrame, column: str, labels: list[str]) -> DataFrame:
    """A frame with one row per label and its position, for bins that must show up when empty."""
    rows = F.posexplode(F.array(*[F.lit(label) for label in labels])).alias("position", column)
    return df.sparkSession.range(1).select(rows)
