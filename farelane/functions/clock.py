"""Time expressions. The session time zone is UTC (see ``session.prepare``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text forms a pickup time may take.
_DATE = r"\d{4}-\d{1,2}-\d{1,2}"
_CLOCK = r"\d{1,2}:\d{1,2}"
_SECONDS = r":\d{1,2}(\.\d{1,12})?"
_OFFSET = r"Z|[+-]\d{2}(:?\d{2})?"
TRIP_TIME = rf"^\s*{_DATE}([T ]{_CLOCK}({_SECONDS})?( ?({_OFFSET}|UTC|GMT))?)?\s*$"
REQUEST_TIME = rf"^{_DATE}[T ]{_CLOCK}({_SECONDS})?({_OFFSET})?$"


def _parse(text: Column) -> Column:
    # Spark's parser wants seconds and a colon inside the offset; supply both where they lack.
    full = F.regexp_replace(text, rf"([T ]{_CLOCK})(?=$| ?[Z+\-UG])", "$1:00")
    full = F.regexp_replace(full, r"(:[\d.]+ ?[+-]\d{2})(\d{2})$", "$1:$2")
    # Without an offset the text is UTC, whatever the session's zone.
    zoned = F.when(~full.rlike(rf"[T ]{_CLOCK}"), F.concat(full, F.lit(" 00:00:00+00:00")))
    zoned = zoned.when(full.rlike(rf":[\d.]+ ?({_OFFSET}|UTC|GMT)$"), full)
    return F.try_to_timestamp(zoned.otherwise(F.concat(full, F.lit("+00:00"))))


def parse_timestamp(text: Column) -> Column:
    """Text to an instant; a missing offset means UTC; null where it is not a date or date-time."""
    return F.when(text.rlike(TRIP_TIME), _parse(F.trim(text)))


def parse_request_timestamp(text: Column) -> Column:
    """As ``parse_timestamp``, for requests: a full ISO date-time is required."""
    return F.when(text.rlike(REQUEST_TIME), _parse(text))


def day_of_week(ts: Column) -> Column:
    """0 = Monday ... 6 = Sunday."""
    return F.weekday(ts)


def hour_of_day(ts: Column) -> Column:
    """0 ... 23."""
    return F.hour(ts)
