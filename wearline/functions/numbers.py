"""Null-safe numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_number(raw: Column) -> Column:
    """Text to double; anything unreadable, and NaN, is null.

    Words are told apart by their first character: parsing one costs an exception per row, and a
    rating column is full of the letter that marks an absent component.
    """
    text = F.trim(raw.cast("string"))
    return F.when(F.left(text, F.lit(1)).isin(*"0123456789.+-"), F.nanvl(
        text.try_cast("double"), F.lit(None).cast("double")))


def clip(value: Column, low: float, high: float) -> Column:
    """Bound a value; ``greatest``/``least`` alone would turn null into a bound."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def lesser(a: Column, b: Column) -> Column:
    return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b))


def half_even(value: Column, places: int = 0) -> Column:
    return F.bround(value, places)


def ratio(top: Column, bottom: Column) -> Column:
    """Division in which a zero denominator gives null."""
    return top / F.nullif(bottom, F.lit(0.0))


def within(value: Column, low: float, high: float) -> Column:
    """The value if it lies in [low, high], else null."""
    return F.when(value.between(low, high), value)


def decode_degrees(packed: Column, west: bool = False) -> Column:
    """Packed sexagesimal numbers to decimal degrees, told apart by their magnitude.

    (0, 200] is already decimal, [1e4, 1e6) is DDMMSS, [1e6, 1e9) is DDMMSSss; the rest,
    zero included, carries no position. ``west`` makes the result negative.
    """
    size = F.abs(packed)

    def sexagesimal(unit: float) -> Column:
        degrees = F.floor(size / (unit * 10_000))
        minutes = F.floor((size % (unit * 10_000)) / (unit * 100))
        seconds = (size % (unit * 100)) / unit
        return degrees + minutes / F.lit(60.0) + seconds / F.lit(3600.0)

    degrees = (
        F.when((size > 0) & (size <= 200), size)
        .when((size >= 10_000) & (size < 1_000_000), sexagesimal(1.0))
        .when((size >= 1_000_000) & (size < 1_000_000_000), sexagesimal(100.0))
    )
    if west:
        return -degrees
    return F.when(packed < 0, -degrees).otherwise(degrees)


def decode_hundredths(value: Column) -> Column:
    """Factors above 10 in magnitude are stored times one hundred."""
    return F.when(F.abs(value) <= 10, value).otherwise(value / F.lit(100.0))
