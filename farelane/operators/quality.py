"""Validity rules and the cleaning built on them.

Each rule is stated in its positive form: what a valid row looks like. A null fare or
passenger count passes, a null coordinate does not, and the comparisons reach the scan as
pushed filters, which a negated ``coalesce`` would not.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.functions.features import matching_cols

# The initial charge, the seats of a cab, and the degrees of a globe.
MIN_FARE = 2.5
MAX_PASSENGERS = 6
MAX_LONGITUDE = 180
MAX_LATITUDE = 90
WEEKEND = (5, 6)


def _all(rules: list[Column]) -> Column:
    return reduce(and_, rules) if rules else F.lit(True)


def valid_fare() -> Column:
    fare = F.col("fare_amount")
    return fare.isNull() | (fare > MIN_FARE)


def nonzero_coords(df: DataFrame) -> Column:
    return _all([F.col(c) != 0 for c in matching_cols(df, "lon|lat")])


def present_coords(df: DataFrame) -> Column:
    return _all([F.col(c).isNotNull() for c in matching_cols(df, "lon|lat")])


def longitudes_in_range(df: DataFrame) -> Column:
    names = matching_cols(df, "lon")
    return _all([F.col(c).between(-MAX_LONGITUDE, MAX_LONGITUDE) for c in names])


def latitudes_in_range(df: DataFrame) -> Column:
    names = matching_cols(df, "lat")
    return _all([F.col(c).between(-MAX_LATITUDE, MAX_LATITUDE) for c in names])


def valid_coords(df: DataFrame) -> Column:
    """All coordinate columns present, not zero and on the globe. NaN, which Spark orders
    above every number, fails the ranges."""
    return (
        present_coords(df) & nonzero_coords(df) & longitudes_in_range(df) & latitudes_in_range(df)
    )


def valid_passengers(limit: int = MAX_PASSENGERS) -> Column:
    passengers = F.col("passenger_count")
    return passengers.isNull() | (passengers <= limit)


def is_valid_trip(df: DataFrame) -> Column:
    return valid_coords(df) & valid_fare() & valid_passengers()


def clean(df: DataFrame) -> DataFrame:
    """The trips that pass every rule."""
    return df.filter(is_valid_trip(df))


def weekdays(df: DataFrame) -> DataFrame:
    """Monday to Friday; a trip without a weekday stays."""
    day = F.col("day_of_week")
    return df.filter(day.isNull() | ~day.isin(*WEEKEND))


def invalid_rate(df: DataFrame, valid: Column, name: str = "invalid_rate") -> DataFrame:
    """One row: the share of rows that are not ``valid``, to 3 decimals."""
    invalid = F.when(valid, 0.0).otherwise(1.0)
    return df.agg(F.round(F.avg(invalid), 3).alias(name))


def trim_above(df: DataFrame, column: str, limit: float | None) -> DataFrame:
    """Rows whose ``column`` does not exceed ``limit``; a null stays."""
    if limit is None:
        return df
    col = F.col(column)
    return df.filter(col.isNull() | (col <= limit))
