"""Output projections: how results leave the library (strings for dates, rounded doubles)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import OUTPUT_DIGITS


def day_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def timestamp_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")


def money_out(c: Column) -> Column:
    """Decimal money leaves as a double rounded to its 4 stored places."""
    return F.round(c.cast("double"), 4)


def dbl(c: Column, digits: int = OUTPUT_DIGITS) -> Column:
    return F.round(c.cast("double"), digits)


def quantile_out(c: Column) -> Column:
    """Interpolated quantiles of values with at most 4 decimals have at most 7: rounding at 8
    places removes engine noise without creating ties."""
    return F.round(c.cast("double"), 8)


def decimal_round(c: Column, digits: int) -> Column:
    """Round a value with at most 10 decimals as a decimal (half away from zero), then to double."""
    return F.round(c.cast("decimal(38,10)"), digits).cast("double")
