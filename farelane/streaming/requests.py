"""Validation of JSON scoring requests. All of it are column expressions, for batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.functions.clock import parse_request_timestamp
from farelane.operators.quality import MAX_LATITUDE, MAX_LONGITUDE
from farelane.schema import TRIP_REQUEST

# The coordinate fields of a request with their bounds, and the text of a number.
BOUNDS = {
    "pickup_latitude": MAX_LATITUDE,
    "pickup_longitude": MAX_LONGITUDE,
    "dropoff_latitude": MAX_LATITUDE,
    "dropoff_longitude": MAX_LONGITUDE,
}
NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"

def _given(name: str) -> Column:
    return F.array_position("names_", name)


def _text(name: str) -> Column:
    return F.get("texts_", (_given(name) - 1).cast("int"))


def _number(name: str) -> Column:
    return F.when(_text(name).rlike(NUMBER), _text(name).try_cast("double"))


def _error(name: str, valid: Column, in_range: Column) -> Column:
    return (
        F.when(_given(name) == 0, f"{name}:required")
        .when(_text(name).isNull(), f"{name}:null")
        .when(~valid, f"{name}:invalid")
        .when(~in_range, f"{name}:range")
    )


def _with_settled(df: DataFrame, name: str, column: Column) -> DataFrame:
    """Add a column by generating it, one row for one, instead of projecting it. Later filters
    then look at its values; through a projection they would repeat the work behind it."""
    return df.select("*", F.explode(F.array(column)).alias(name))


def _read_json(df: DataFrame) -> DataFrame:
    """Add the field names and texts of the JSON object in ``value``, null if it is none. The
    last of equally named fields comes first and so is the one that counts."""
    # Read as the only element of an array, since the parser ignores text after a whole value.
    alone = F.from_json(
        F.concat(F.lit("["), "value", F.lit("]")),
        "array<map<string,string>>",
        {"allowSingleQuotes": "false"},
    )
    fields = F.when(F.size("read_") == 1, F.get("read_", F.lit(0)))
    read = _with_settled(df, "read_", alone).withColumn("fields_", fields)
    return read.withColumns(
        {
            "names_": F.reverse(F.map_keys("fields_")),
            "texts_": F.reverse(F.map_values("fields_")),
        }
    ).drop("read_", "fields_")


def validate(df: DataFrame) -> DataFrame:
    """Parse the JSON in ``value`` and add the typed request columns and ``errors``.

    The codes are ``field:required|null|invalid|range|unknown``, all of a request's together,
    and ``request:invalid`` where the text is no JSON object.
    """
    typed = {name: _number(name) for name in BOUNDS}
    typed["pickup_datetime"] = parse_request_timestamp(_text("pickup_datetime"))
    parsed = _read_json(df).withColumns(typed)

    checks = [
        _error(name, F.col(name).isNotNull(), F.col(name).between(-bound, bound))
        for name, bound in BOUNDS.items()
    ]
    checks.append(_error("pickup_datetime", F.col("pickup_datetime").isNotNull(), F.lit(True)))
    known = F.array(*[F.lit(name) for name in TRIP_REQUEST.fieldNames()])
    extra = F.array_sort(F.array_except("names_", known))
    unknown = F.transform(extra, lambda name: F.concat(name, F.lit(":unknown")))
    found = F.array_except(F.array(*checks), F.array(F.lit(None)))
    errors = F.when(F.isnull("names_"), F.array(F.lit("request:invalid"))).otherwise(
        F.concat(found, unknown)
    )
    return _with_settled(parsed, "errors", errors).drop("names_", "texts_")


def load_valid(validated: DataFrame) -> DataFrame:
    """The requests without errors, as typed records."""
    return validated.filter(F.size("errors") == 0).drop("errors", "value")


def rejects(validated: DataFrame) -> DataFrame:
    """The requests with errors: their text and all their codes."""
    return validated.filter(F.size("errors") > 0).drop(*TRIP_REQUEST.fieldNames())
