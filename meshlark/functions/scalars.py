"""Small column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def or_else(value: Column, *fallbacks) -> Column:
    """First value that is not NULL."""
    return F.coalesce(value, *[f if isinstance(f, Column) else F.lit(f) for f in fallbacks])


def utc_micros(moment: Column) -> Column:
    """Epoch microseconds of a time without zone (read as UTC), whatever the session time zone is."""
    since = (moment.cast("timestamp_ntz") - F.lit("1970-01-01").cast("timestamp_ntz")).cast("interval second")
    return (since.cast("decimal(20,6)") * 1_000_000).cast("long")


def utc_millis(moment: Column) -> Column:
    """Epoch milliseconds (floored) of a time without zone, read as UTC."""
    return F.floor(utc_micros(moment) / 1000).cast("long")


def epoch_ms(text: Column) -> Column:
    """Date or timestamp text, read as UTC, to epoch milliseconds; NULL for text that is no date."""
    return utc_millis(text.try_cast("timestamp_ntz"))


def first_value(cell: Column) -> Column:
    """First element of a list cell; NULL for an empty or missing list."""
    return F.try_element_at(cell, F.lit(1))


def joined_labels(labels: Column) -> Column:
    """Labels as one comma-separated text."""
    return F.concat_ws(",", labels)


def coerced(df, types: dict[str, str]):
    """Cast result columns to declared types; text that does not parse becomes NULL."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in types.items()})


def half_even(value: Column, digits: int = 0) -> Column:
    """Round half to even. Scaling first keeps true ties exact for ratios of whole numbers."""
    scale = 10 ** digits
    return F.bround(value * F.lit(float(scale)), 0) / F.lit(float(scale)) if digits else F.bround(value, 0)
