from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from farelane.functions.clock import parse_request_timestamp, parse_timestamp
from farelane.functions.features import FEATURES, add_features, matching_cols, model_input
from farelane.functions.geo import haversine_km

NAN = float("nan")


def _distances(spark, points):
    df = spark.createDataFrame(points, "lon1 double, lat1 double, lon2 double, lat2 double")
    km = haversine_km(*[F.col(c) for c in df.columns])
    return [r[0] for r in df.select(km).collect()]


def _haversine(lon1, lat1, lon2, lat2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin((p2 - p1) / 2) ** 2
    a += math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 6367 * 2 * math.asin(min(1.0, math.sqrt(a)))


def test_haversine_values(spark):
    points = [(-73.98, 40.75, -73.95, 40.78), (0.0, 0.0, 90.0, 0.0), (10.0, 20.0, -170.0, 60.0)]
    back = [(c, d, a, b) for a, b, c, d in points]
    got, reverse = _distances(spark, points), _distances(spark, back)
    assert got == pytest.approx([_haversine(*p) for p in points], abs=1e-6)
    assert got == pytest.approx(reverse, abs=1e-9)


def test_haversine_identity_and_antipodes(spark):
    points = [(12.5, -33.0, 12.5, -33.0), (0.0, 90.0, 0.0, -90.0)]
    points += [(x / 7, x / 11, x / 7 - 180, -x / 11) for x in range(1, 60)]
    got = _distances(spark, points)
    assert got[0] == 0.0
    assert got[1:] == pytest.approx([math.pi * 6367] * (len(points) - 1), abs=1e-3)
    assert max(got) <= math.pi * 6367


def test_haversine_missing(spark):
    bad = [(None, 1.0, 1.0, 1.0), (1.0, NAN, 1.0, 1.0), (1.0, 1.0, float("inf"), 1.0)]
    assert _distances(spark, bad) == [None, None, None]


TIMES = [
    ("2009-06-15 17:26:21 UTC", "2009-06-15 17:26:21", None),
    ("2009-06-15 17:26:21+00:00", "2009-06-15 17:26:21", "2009-06-15 17:26:21"),
    ("2009-06-15T17:26:21Z", "2009-06-15 17:26:21", "2009-06-15 17:26:21"),
    ("2009-06-15 17:26:21+0530", "2009-06-15 11:56:21", "2009-06-15 11:56:21"),
    ("2009-06-15 17:26:21.25-05:00", "2009-06-15 22:26:21.25", "2009-06-15 22:26:21.25"),
    ("2009-06-15 17:26", "2009-06-15 17:26:00", "2009-06-15 17:26:00"),
    ("2009-06-15T17:26Z", "2009-06-15 17:26:00", "2009-06-15 17:26:00"),
    ("2009-01-01 05:00:46+05:00", "2009-01-01 00:00:46", "2009-01-01 00:00:46"),
    ("2009-06-15", "2009-06-15 00:00:00", None),
    ("2009", None, None),
    ("12:00", None, None),
    ("garbage", None, None),
    ("2009-02-30 10:00:00", None, None),
    (None, None, None),
]


def test_parse_timestamp(spark):
    df = spark.createDataFrame([(t,) for t, _, _ in TIMES], "t string")
    parsed = [parse_timestamp(F.col("t")), parse_request_timestamp(F.col("t"))]
    got = df.select("t", *[c.cast("string") for c in parsed]).collect()
    assert [tuple(r) for r in got] == TIMES


def test_weekday_and_hour(spark):
    rows = [("2024-01-07 23:59:59",), ("2024-01-08 00:00:00",), (None,)]
    df = spark.createDataFrame(rows, "t string").select(
        F.to_timestamp("t").alias("pickup_datetime"),
        *[F.lit(1.0).alias(f"{p}_{c}") for p in ("pickup", "dropoff") for c in ("longitude", "latitude")],
    )
    got = [tuple(r) for r in add_features(df).select("day_of_week", "hour").collect()]
    assert got == [(6, 23), (0, 0), (None, None)]


def test_hour_is_utc_whatever_the_session(spark):
    rows = spark.sql("SELECT timestamp_micros(1704585600000000) AS pickup_datetime, 1D AS pickup_longitude, "
                     "1D AS pickup_latitude, 1D AS dropoff_longitude, 1D AS dropoff_latitude")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert add_features(rows).first()["hour"] == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_matching_cols(spark):
    df = spark.createDataFrame([], "pickup_longitude double, pickup_latitude double, flat_fee int")
    assert matching_cols(df, "lon") == ["pickup_longitude"]
    assert matching_cols(df, "lat") == ["pickup_latitude", "flat_fee"]


def test_matching_cols_refuses_text(spark):
    df = spark.createDataFrame([], "pickup_latitude double, plate string")
    with pytest.raises(TypeError, match="plate"):
        matching_cols(df, "lat")


def test_model_input_order_and_missing(spark):
    df = spark.createDataFrame([(1.5, 2, 3), (None, None, 4), (NAN, 0, None)], "hav_distance_km double, day_of_week int, hour int")
    assert FEATURES == ["hav_distance_km", "day_of_week", "hour"]
    got = [list(r.features.toArray()) for r in model_input().transform(df).collect()]
    assert got == [[1.5, 2.0, 3.0], [-1.0, -1.0, 4.0], [-1.0, 0.0, -1.0]]
