from __future__ import annotations

import datetime as dt

import pytest

from farelane.functions.features import add_features
from farelane.operators import quality
from farelane.schema import TRIPS, nan_to_null
from farelane.sources.derived import trips

NAN = float("nan")
GOOD = {
    "fare_amount": 10.0,
    "pickup_datetime": dt.datetime(2024, 1, 1, 12),
    "pickup_longitude": -73.9,
    "pickup_latitude": 40.7,
    "dropoff_longitude": -73.8,
    "dropoff_latitude": 40.8,
    "passenger_count": 2,
}
EDGES = [
    ({}, True),
    ({"fare_amount": 2.5}, False),
    ({"fare_amount": 2.51}, True),
    ({"fare_amount": None}, True),
    ({"fare_amount": NAN}, True),
    ({"fare_amount": -1.0}, False),
    ({"pickup_longitude": 0.0}, False),
    ({"pickup_latitude": 0.0}, False),
    ({"dropoff_longitude": -0.0}, False),
    ({"dropoff_latitude": None}, False),
    ({"pickup_longitude": NAN}, False),
    ({"dropoff_latitude": NAN}, False),
    ({"pickup_longitude": 180.0}, True),
    ({"dropoff_longitude": -180.0}, True),
    ({"pickup_longitude": 180.0001}, False),
    ({"pickup_latitude": 90.0}, True),
    ({"dropoff_latitude": -90.0}, True),
    ({"dropoff_latitude": -90.0001}, False),
    ({"passenger_count": 6}, True),
    ({"passenger_count": 7}, False),
    ({"passenger_count": None}, True),
    ({"pickup_datetime": None}, True),
]


def edge_trips(spark, edges=EDGES):
    rows = [{"key": i, **GOOD, **change} for i, (change, _) in enumerate(edges)]
    return spark.createDataFrame([tuple(r[n] for n in TRIPS.fieldNames()) for r in rows], TRIPS)


@pytest.mark.parametrize("normalised", [False, True])
def test_clean_edges(spark, normalised):
    df = edge_trips(spark)
    df = nan_to_null(df) if normalised else df
    kept = {r.key for r in quality.clean(df).collect()}
    assert kept == {i for i, (_, valid) in enumerate(EDGES) if valid}


def test_clean_is_idempotent(spark, sf_dir):
    once = quality.clean(trips(spark, sf_dir))
    assert once.exceptAll(quality.clean(once)).isEmpty()


def test_known_counts(spark):
    df = trips(spark, "/root/testdata/sf0.01")
    cleaned = quality.clean(df)
    assert (df.count(), cleaned.count()) == (10000, 8332)
    assert cleaned.filter("fare_amount IS NULL").count() == 101
    assert cleaned.filter("passenger_count IS NULL").count() == 135


def test_rate_counts_null_as_valid(spark):
    df = edge_trips(spark, [({"fare_amount": f}, None) for f in (1.0, 2.5, None, 9.0)])
    rate = quality.invalid_rate(df, quality.valid_fare()).first()[0]
    assert rate == 0.5


def test_weekdays_keep_missing(spark):
    days = [dt.datetime(2024, 1, d) for d in range(1, 8)] + [None]
    df = add_features(edge_trips(spark, [({"pickup_datetime": d}, None) for d in days]))
    kept = sorted(r.key for r in quality.weekdays(df).collect())
    assert kept == [0, 1, 2, 3, 4, 7]


def test_trim_keeps_null_and_the_limit(spark):
    df = edge_trips(spark, [({"passenger_count": p}, None) for p in (1, 4, 5, None)])
    kept = {r.key for r in quality.trim_above(df, "passenger_count", 4.0).collect()}
    assert kept == {0, 1, 3}


def test_text_column_named_like_a_coordinate(spark):
    df = edge_trips(spark).selectExpr("*", "'AB-1' AS plate")
    with pytest.raises(TypeError):
        quality.clean(df)
