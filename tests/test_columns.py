from __future__ import annotations

import datetime as dt
import hashlib
import math
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from linespan.functions import columns, measures
from linespan.sources.landing import utc_moment


def values(spark, expression, rows, schema="v string"):
    frame = spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], schema)
    return [r[0] for r in frame.coalesce(1).select(expression).collect()]


def test_call_seconds(spark):
    texts = ["27:15:00", " 05:06:07 ", "0:00:59", "7:60:00", "7:00:60", "7:00", "7:00:00:00",
             "", None, "aa:00:00", "-1:00:00", "596522:00:00", "596523:00:00", "7::00"]
    want = [98100, 18367, 59, None, None, None, None, None, None, None, None,
            596522 * 3600, None, None]
    assert values(spark, columns.call_seconds("v"), texts) == want


def test_row_hash_uses_raw_text_and_separator(spark):
    frame = spark.createDataFrame([("route-1", "Example", None)], "a string, b string, c string")
    got = frame.select(columns.row_hash(["a", "b", "c"])).first()[0]
    assert got == hashlib.sha256(b"route-1\x1fExample\x1f").hexdigest()
    assert got == "8dd5ae87ea040901745d7d0755dea857830cc8878a18cf452081f99499b05483"
    spaced = spark.createDataFrame([("route-1 ", "Example", "")], "a string, b string, c string")
    assert spaced.select(columns.row_hash(["a", "b", "c"])).first()[0] != got


def test_cleaning_and_typed_text(spark):
    assert values(spark, columns.cleaned("v"), ["  a b ", "   ", "", None]) == ["a b", None, None, None]
    assert values(spark, columns.small_number("v"), ["3", " 4 ", "x", "", "40000", "1.5"]) == [
        3, 4, None, None, None, None,
    ]
    got = values(spark, columns.coordinate("v"), ["53.4808", "5e1", "-2.2426001", "1000", "north"])
    assert got == [Decimal("53.480800"), None, Decimal("-2.242600"), None, None]


def test_feed_date(spark):
    got = values(spark, columns.feed_date("v"), ["20260817", " 20260817 ", "2026-08-17",
                                                 "20260230", "", None, "202608171"])
    day = dt.date(2026, 8, 17)
    assert got == [day, day, None, None, None, None, None]


def test_utc_moment(spark):
    got = values(
        spark, utc_moment(F.col("v")),
        ["2026-08-17T10:00:00+01:00", "2026-08-17T10:00:00Z", "2026-08-17 10:00:00",
         "Mon, 17 Aug 2026 10:00:00 GMT", "", None],
    )
    assert got == [
        dt.datetime(2026, 8, 17, 9), dt.datetime(2026, 8, 17, 10), dt.datetime(2026, 8, 17, 10),
        dt.datetime(2026, 8, 17, 10), None, None,
    ]


@pytest.mark.parametrize("numerator", [0, 1, 30, 59, 12345, 98765, -30, -45])
def test_ratio_rounds_halves_away_from_zero(spark, numerator):
    for denominator in (1, 3, 7, 60, 60 * 17, 200, 400):
        frame = spark.range(1).select(
            measures.ratio_2dp(F.lit(numerator), F.lit(denominator)).alias("r")
        )
        exact = Decimal(numerator) / Decimal(denominator)
        want = exact.copy_abs().quantize(Decimal("0.01"), ROUND_HALF_UP) * (-1 if exact < 0 else 1)
        assert frame.first().r == want, (numerator, denominator)


def test_average_is_exact_before_rounding(spark):
    frame = spark.createDataFrame([(1,), (2,), (2,), (None,)], "v int")
    got = frame.agg(measures.average_2dp("v").alias("a")).first().a
    assert got == Decimal("1.67")
    empty = frame.where("v > 9").agg(measures.average_2dp("v").alias("a")).first().a
    assert empty is None


def test_time_differences_count_boundaries(spark):
    frame = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 0, 59, 59, 999600), dt.datetime(2024, 1, 1, 1, 1, 0, 0))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    row = frame.select(
        measures.hours_crossed(F.col("a"), F.col("b")),
        measures.minutes_crossed(F.col("a"), F.col("b")),
        measures.milliseconds_crossed(F.col("a"), F.col("b")),
    ).first()
    assert list(row) == [1, 2, 60001]


def vincenty(lat1, lon1, lat2, lon2):
    a, f = 6378137.0, 1 / 298.257223563
    b = a * (1 - f)
    u1, u2 = (math.atan((1 - f) * math.tan(math.radians(x))) for x in (lat1, lat2))
    span = lam = math.radians(lon2 - lon1)
    for _ in range(200):
        sin_s = math.hypot(
            math.cos(u2) * math.sin(lam),
            math.cos(u1) * math.sin(u2) - math.sin(u1) * math.cos(u2) * math.cos(lam),
        )
        if sin_s == 0:
            return 0.0
        cos_s = math.sin(u1) * math.sin(u2) + math.cos(u1) * math.cos(u2) * math.cos(lam)
        sigma = math.atan2(sin_s, cos_s)
        sin_a = math.cos(u1) * math.cos(u2) * math.sin(lam) / sin_s
        cos2 = 1 - sin_a**2
        mid = cos_s - 2 * math.sin(u1) * math.sin(u2) / cos2 if cos2 else 0
        c = f / 16 * cos2 * (4 + f * (4 - 3 * cos2))
        last, lam = lam, span + (1 - c) * f * sin_a * (
            sigma + c * sin_s * (mid + c * cos_s * (-1 + 2 * mid**2))
        )
        if abs(lam - last) < 1e-13:
            break
    u = cos2 * (a * a - b * b) / (b * b)
    big_a = 1 + u / 16384 * (4096 + u * (-768 + u * (320 - 175 * u)))
    big_b = u / 1024 * (256 + u * (-128 + u * (74 - 47 * u)))
    delta = big_b * sin_s * (
        mid + big_b / 4 * (cos_s * (2 * mid**2 - 1)
                           - big_b / 6 * mid * (4 * sin_s**2 - 3) * (4 * mid**2 - 3))
    )
    return b * big_a * (sigma - delta)


def test_geodesic_distance_agrees_with_vincenty(spark):
    pairs = [(53.5, -2.2, 53.5005, -2.2), (53.5, -2.2, 53.5, -2.199), (53.4, -2.3, 53.49, -2.1),
             (53.5, -2.2, 53.5, -2.2)]
    frame = spark.createDataFrame(pairs, "a double, b double, c double, d double").coalesce(1)
    got = frame.select(measures.geodesic_metres(*[F.col(x) for x in "abcd"])).collect()
    for pair, row in zip(pairs, got, strict=True):
        assert row[0] == pytest.approx(vincenty(*pair), abs=0.02)
