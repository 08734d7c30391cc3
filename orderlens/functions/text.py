"""Cleaning and labelling of text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What is cut from a raw category, in this order.
URL_TOKEN = r"https?://\S+"
TRAILING_NOISE = r"[^a-zA-Z\s&'\-]+$"


def clean_category(raw: Column, corrections: dict[str, str]) -> Column:
    """Drop URLs, then trailing characters no category name ends in, trim, correct spelling."""
    # A plain substring test spares nearly every row the search for a URL.
    without_url = F.when(raw.contains("://"), F.regexp_replace(raw, URL_TOKEN, "")).otherwise(raw)
    # The pattern is tried at every character; a name that ends in a letter or blank cannot match it.
    last = F.right(without_url, F.lit(1))
    clean = last.between("a", "z") | last.between("A", "Z") | (last == " ")
    name = F.trim(F.when(clean, without_url).otherwise(F.regexp_replace(without_url, TRAILING_NOISE, "")))
    changes = {wrong: right for wrong, right in corrections.items() if wrong != right}
    if not changes:
        return name
    pairs = [F.lit(text) for pair in changes.items() for text in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), name), name)


def location_label(restaurant_id: Column) -> Column:
    return F.concat(F.lit("Loc-"), F.right(restaurant_id, F.lit(6)))


def ranked_location_label(rank: Column, restaurant_id: Column) -> Column:
    number = rank.cast("string")
    padded = F.when(F.length(number) < 2, F.lpad(number, 2, "0")).otherwise(number)
    return F.concat(F.lit("#"), padded, F.lit(" "), location_label(restaurant_id))


def mask_id(identifier: Column) -> Column:
    return F.concat(F.left(identifier, F.lit(12)), F.lit("..."))


def bool_label(flag: Column, if_true: str, if_false: str) -> Column:
    return F.when(flag, if_true).when(~flag, if_false)


def loyalty_label(flag: Column) -> Column:
    return bool_label(flag, "Loyalty Members", "Non-Members")
