"""The trip table: columns, types, and the casts that bring any input to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.functions.clock import parse_timestamp

COORDINATES = ["pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude"]
FEATURES = ["hav_distance_km", "day_of_week", "hour"]
LABEL = "fare_amount"

TRIPS = T.StructType(
    [
        T.StructField("key", T.LongType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("pickup_datetime", T.TimestampType()),
        *[T.StructField(c, T.DoubleType()) for c in COORDINATES],
        T.StructField("passenger_count", T.IntegerType()),
    ]
)

TRIP_REQUEST = T.StructType([TRIPS["pickup_datetime"], *[TRIPS[c] for c in COORDINATES]])


def typed_column(name: str, source: T.DataType) -> Column:
    """Column ``name`` of an input, cast to its trip type; null where the text does not parse."""
    col, target = F.col(name), TRIPS[name].dataType
    if source == target:
        return col
    if isinstance(target, T.TimestampType):
        return parse_timestamp(col) if isinstance(source, T.StringType) else col.cast(target)
    if name == "key":
        # A key that is not an integer still has to identify and order its row; a text counts as
        # an integer only in its usual form, so that different texts stay different.
        number = col.try_cast(target)
        same = number.cast("string") == col.cast("string")
        return F.when(col.isNotNull(), F.when(same, number).otherwise(F.xxhash64(col)))
    if isinstance(target, T.IntegerType):
        # Rounded up and held within range: a count is above a limit if and only if it was before.
        number = F.nanvl(col.try_cast("double"), F.lit(None).cast("double"))
        held = F.when(number.isNotNull(), F.least(F.greatest(F.ceil(F.least(F.greatest(number, F.lit(-1e15)), F.lit(1e15))), F.lit(-(1 << 31))), F.lit((1 << 31) - 1)))
        return held.cast(target)
    return col.try_cast(target)


def null_safe_hash(columns: list[str]) -> Column:
    """A hash of a row in which null differs from every value and has a place."""
    return F.xxhash64(*[x for c in columns for x in (F.col(c).isNull(), F.col(c))])


def cast_trips(df: DataFrame) -> DataFrame:
    """Cast the known columns by name and keep every other column as it is."""
    known = {f.name: f.dataType for f in df.schema if f.name in TRIPS.fieldNames()}
    return df.withColumns({name: typed_column(name, source) for name, source in known.items()})


def nan_to_null(df: DataFrame) -> DataFrame:
    """Make NaN and null the same thing in the floating-point columns."""
    null = F.lit(None).cast("double")
    floating = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.nanvl(F.col(c), null) for c in floating}) if floating else df
