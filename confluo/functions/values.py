"""Column functions for dates, nested arrays and maps of raw records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date spellings seen in store pages, most specific first. Callers may pass their own.
DATE_FORMATS = ("d MMM, yyyy", "MMM d, yyyy", "d MMMM, yyyy", "MMMM d, yyyy", "yyyy-MM-dd", "MMM yyyy", "MMMM yyyy", "yyyy")


def no_strings() -> Column:
    return F.array().cast("array<string>")


def earliest_date(dates: Column) -> Column:
    """Smallest epoch of an array of ``{date}`` structs, nulls skipped; null when there is none."""
    return F.array_min(F.transform(dates, lambda d: d["date"]))


def nested_names(items: Column, field: str = "name") -> Column:
    return F.coalesce(F.transform(items, lambda i: i[field]), no_strings())


def developer_names(companies: Column) -> Column:
    developers = F.filter(companies, lambda c: F.coalesce(c["developer"], F.lit(False)))
    return F.coalesce(F.transform(developers, lambda c: c["company"]["name"]), no_strings())


def number_or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0)).cast("int")


def map_key_list(flags: Column, only_true: bool = False) -> Column:
    """Keys of a name -> flag map. The flags are ignored unless ``only_true``."""
    kept = F.map_filter(flags, lambda _, on: F.coalesce(on, F.lit(False))) if only_true else flags
    return F.coalesce(F.map_keys(kept), no_strings())


def join_list(items: Column) -> Column:
    return F.array_join(items, ",")


def epoch_to_timestamp(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def parse_date(text: Column, coming_soon: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First format that reads the whole text; null if unreleased, empty or unreadable."""
    attempts = [F.try_to_timestamp(text, F.lit(fmt)) for fmt in formats]
    known = ~F.coalesce(coming_soon, F.lit(False)) & (text != "")
    return F.when(known, F.coalesce(*attempts))


def unreadable_date(text: Column, coming_soon: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """True where a date was given but no format fits; summed up, it is the report of lost dates."""
    given = ~F.coalesce(coming_soon, F.lit(False)) & (F.coalesce(text, F.lit("")) != "")
    return given & parse_date(text, coming_soon, formats).isNull()
