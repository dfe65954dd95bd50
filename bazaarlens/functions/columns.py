"""Arithmetic that keeps money exact and follows the warehouse's NULL rules under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(38,6)"
PART = "decimal(26,6)"  # a part of this type over EXACT gives a quotient of 12 places
QUOTIENT = "decimal(38,12)"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def row_count() -> Column:
    """Aggregate: all rows."""
    return F.count(F.lit(1))


def rounded(value: Column, places: int) -> Column:
    """Round half up on a decimal, so that a binary fraction never decides the last digit."""
    return F.round(value.cast(QUOTIENT), places)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole to 12 places, so that it is rounded once, where it is shown; NULL when the whole is zero."""
    return (part.cast(PART) / F.nullif(whole.cast(EXACT), F.lit(0).cast(EXACT))).cast(QUOTIENT)


def percent(part: Column, whole: Column) -> Column:
    return ratio(part.cast(EXACT) * 100, whole)


def indicator(flag: Column) -> Column:
    """1 for TRUE, 0 for FALSE and for NULL."""
    return F.when(flag, 1).otherwise(0)


def share_true(flag: Column) -> Column:
    """Aggregate: percentage of all rows with the flag TRUE; a NULL flag counts as not true."""
    return percent(F.sum(indicator(flag)), row_count())


def share_true_known(flag: Column) -> Column:
    """Aggregate: percentage of TRUE among the rows whose flag is known."""
    return percent(F.sum(indicator(flag)), F.count(flag))


def clip(value: Column, low=None, high=None) -> Column:
    """Clamp to [low, high]; NULL stays NULL (greatest and least alone would skip it)."""
    bounded = value
    if high is not None:
        bounded = F.least(bounded, F.lit(high))
    if low is not None:
        bounded = F.greatest(bounded, F.lit(low))
    return F.when(value.isNotNull(), bounded)


def days_between(start: Column, end: Column) -> Column:
    """Midnights crossed from start to end (two-argument datediff; the unit form counts 24-hour spans)."""
    return F.datediff(end, start)


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation over the rows where both sides are known; NULL when a side is constant."""
    both = x.isNotNull() & y.isNotNull()
    px, py = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    return F.try_divide(F.covar_pop(px, py), F.stddev_pop(px) * F.stddev_pop(py))


def text_label(flag: Column, yes: str, no: str) -> Column:
    return F.when(flag, yes).otherwise(no)


def padded_zip(zip_code: Column) -> Column:
    """Five-character zip prefix; a numeric load loses leading zeros."""
    text = zip_code.cast("string")
    return F.when(F.length(text) < 5, F.lpad(text, 5, "0")).otherwise(text)


def safe_timestamp(text: Column) -> Column:
    return text.try_cast("timestamp_ntz")


def safe_date(text: Column) -> Column:
    return text.try_cast("date")


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance on a sphere of radius 6371 km."""
    half_dlat = F.radians(lat1 - lat2) / 2
    half_dlng = F.radians(lng1 - lng2) / 2
    chord = F.pow(F.sin(half_dlat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_dlng), 2)
    # rounding can lift antipodal points just above 1, where asin is undefined
    return 2 * 6371 * F.asin(F.sqrt(clip(chord, high=1.0)))


def cut(value: Column, edges: list, labels: list[str], right: bool = True) -> Column:
    """Band label: (a, b] bins by default, [a, b) with ``right=False``; None as an outer edge means open.

    Values outside every bin get NULL, in particular the lowest edge itself when bins are right-closed.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per bin is needed")
    ladder = None
    for low, high, label in zip(edges[:-1], edges[1:], labels):
        inside = value.isNotNull()
        if low is not None:
            inside = inside & ((value > low) if right else (value >= low))
        if high is not None:
            inside = inside & ((value <= high) if right else (value < high))
        ladder = F.when(inside, label) if ladder is None else ladder.when(inside, label)
    return ladder
