"""Shapes in which the registered queries return trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.schema import COORDINATES


def _trip_values() -> list[Column]:
    # Instants leave as microseconds, which no reader's time zone can shift.
    return [
        F.col("key"),
        F.col("fare_amount"),
        F.unix_micros("pickup_datetime").alias("pickup_us"),
        *[F.col(c) for c in COORDINATES],
        F.col("passenger_count"),
    ]


def trip_rows(df: DataFrame) -> DataFrame:
    return df.select(*_trip_values())


def featured_rows(df: DataFrame) -> DataFrame:
    return df.select(
        *_trip_values(),
        F.round("hav_distance_km", 6).alias("hav_distance_km"),
        "day_of_week",
        "hour",
    )
