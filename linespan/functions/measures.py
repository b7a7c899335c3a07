"""Exact two-decimal measures, boundary-counting time differences, geodesy."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from linespan.functions.columns import as_column

# WGS84 ellipsoid.
EQUATORIAL_RADIUS_M = 6378137.0
FLATTENING = 1 / 298.257223563


def whole_division(numerator: Column, denominator: Column) -> Column:
    """Quotient of two whole columns without its fraction."""
    return F.call_function("div", numerator, denominator)


def ratio_2dp(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as DECIMAL(12,2), halves away from zero.

    Both are whole and the denominator is positive. Whole-number arithmetic
    keeps the result exact and away from wide decimals.
    """
    top = F.abs(numerator).cast("bigint") * 200 + denominator.cast("bigint")
    hundredths = whole_division(top, denominator.cast("bigint") * 2)
    # Not by signum, which is a double: its cast to a decimal goes through text.
    signed = F.when(numerator < 0, -hundredths).otherwise(hundredths)
    return (signed.cast("decimal(12,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(12,2)")


def average_2dp(value: Column | str) -> Column:
    """Average of non-NULL values as DECIMAL(18,2), exact before rounding.

    Hundredths are summed as whole numbers; a sum of decimals this wide is kept in big numbers.
    """
    column = as_column(value)
    hundredths = (column.cast("decimal(12,2)") * F.lit(100)).cast("bigint")
    total = (F.sum(hundredths).cast("decimal(19,0)") * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(20,2)")
    count = F.count(column).cast("decimal(14,0)")
    return F.round(F.try_divide(total, count), 2).cast("decimal(18,2)")


def average_6dp(value: Column | str) -> Column:
    """Average of coordinates as DECIMAL(9,6), exact before rounding."""
    column = as_column(value)
    total = F.sum(column.cast("decimal(9,6)")).cast("decimal(20,6)")
    count = F.count(column).cast("decimal(12,0)")
    return F.round(F.try_divide(total, count), 6).cast("decimal(9,6)")


def score_1dp(value: Column) -> Column:
    """Non-negative score rounded to one decimal place."""
    return F.floor(value * 10 + 0.5) / 10


def hours_crossed(start: Column, end: Column) -> Column:
    """Number of hour marks between two zone-less timestamps."""
    return F.datediff(F.to_date(end), F.to_date(start)) * 24 + F.hour(end) - F.hour(start)


def minutes_crossed(start: Column, end: Column) -> Column:
    """Number of minute marks between two zone-less timestamps."""
    return hours_crossed(start, end) * 60 + F.minute(end) - F.minute(start)


def milliseconds_crossed(start: Column, end: Column) -> Column:
    """Number of millisecond marks between two zone-less timestamps."""

    def within_minute(moment: Column) -> Column:
        return F.floor(F.extract(F.lit("SECOND"), moment) * 1000).cast("bigint")

    return (
        minutes_crossed(start, end).cast("bigint") * 60000
        + within_minute(end)
        - within_minute(start)
    )


def geodesic_metres(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance on the WGS84 ellipsoid by Lambert's formula for long lines."""
    phi1, phi2 = F.radians(lat1.cast("double")), F.radians(lat2.cast("double"))
    beta1 = F.atan(F.tan(phi1) * (1 - FLATTENING))
    beta2 = F.atan(F.tan(phi2) * (1 - FLATTENING))
    half_lat = F.sin((beta2 - beta1) / 2)
    half_lon = F.sin(F.radians(lon2.cast("double") - lon1.cast("double")) / 2)
    haversine = F.least(
        half_lat * half_lat + F.cos(beta1) * F.cos(beta2) * half_lon * half_lon, F.lit(1.0)
    )
    sigma = F.asin(F.sqrt(haversine)) * 2
    p, q = (beta1 + beta2) / 2, (beta2 - beta1) / 2
    x = (sigma - F.sin(sigma)) * F.pow(F.sin(p) * F.cos(q) / F.cos(sigma / 2), 2)
    y = (sigma + F.sin(sigma)) * F.pow(F.cos(p) * F.sin(q) / F.sin(sigma / 2), 2)
    metres = (sigma - (x + y) * (FLATTENING / 2)) * EQUATORIAL_RADIUS_M
    return F.when(sigma == 0, F.lit(0.0)).otherwise(metres)
