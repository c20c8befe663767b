"""Trips and requests derived from the ``events`` test table.

The expressions are plain SQL that every engine computes alike: integers, text, and one
correctly rounded division where a column is fractional.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.schema import cast_trips
from farelane.session import prepare

_DETOUR = """(ABS((event_id*7919)%1000 - (event_id*6101)%1000)
              + ABS((event_id*5381)%1000 - (event_id*4877)%1000))"""

TRIP_COLUMNS = {
    "key": "event_id",
    "fare_amount": f"""CASE WHEN event_id % 89 = 0 THEN NULL
        WHEN event_id % 83 = 0 THEN CAST(2.5 AS DOUBLE)
        ELSE CAST(2500 + 15*{_DETOUR} + 10*(user_id % 100) AS DOUBLE) / 1000 END""",
    "pickup_datetime": "ts",
    "pickup_longitude": """CASE WHEN event_id % 97 = 0 THEN CAST(0 AS DOUBLE)
        WHEN event_id % 103 = 0 THEN CAST(190 AS DOUBLE)
        ELSE CAST(-740200 + (event_id*7919)%1000 AS DOUBLE) / 10000 END""",
    "pickup_latitude": """CASE WHEN event_id % 107 = 0 THEN CAST(-95 AS DOUBLE)
        ELSE CAST(407000 + (event_id*5381)%1000 AS DOUBLE) / 10000 END""",
    "dropoff_longitude": """CASE WHEN event_id % 101 = 0 THEN NULL
        ELSE CAST(-740200 + (event_id*6101)%1000 AS DOUBLE) / 10000 END""",
    "dropoff_latitude": "CAST(407000 + (event_id*4877)%1000 AS DOUBLE) / 10000",
    "passenger_count": """CAST(CASE WHEN event_id % 71 = 0 THEN NULL
        ELSE user_id % 8 END AS INT)""",
}

_TIME_TEXT = "replace(substr(CAST(ts AS STRING), 1, 19), ' ', 'T')"

# One request per event. Of every 77, eleven are special: ten with a defect of their own
# kind and one (35) with a number given as text, which is fine.
REQUEST_COLUMNS = {
    "key": "event_id",
    "value": f"""CASE WHEN event_id % 77 = 0 THEN 'not json' ELSE concat(
        CASE WHEN event_id % 77 = 7 THEN '{{'
             WHEN event_id % 77 = 14 THEN '{{"pickup_latitude": null, '
             WHEN event_id % 77 = 21 THEN '{{"pickup_latitude": true, '
             WHEN event_id % 77 = 28 THEN '{{"pickup_latitude": 90.5, '
             WHEN event_id % 77 = 35 THEN '{{"pickup_latitude": "40.75", '
             WHEN event_id % 77 = 42 THEN '{{"pickup_latitude": "5f", '
             WHEN event_id % 77 = 49 THEN '{{"pickup_latitude": "NaN", '
             ELSE concat('{{"pickup_latitude": 40.7', CAST(event_id % 10 AS STRING), ', ') END,
        CASE WHEN event_id % 77 = 56 THEN '"tip": 1, ' ELSE '' END,
        '"pickup_longitude": -73.9', CAST(event_id % 7 AS STRING),
        ', "dropoff_latitude": 40.6', CAST(event_id % 8 AS STRING),
        ', "dropoff_longitude": ',
        CASE WHEN event_id % 77 = 28 THEN '-180.5'
             ELSE concat('-73.8', CAST(event_id % 9 AS STRING)) END,
        ', "pickup_datetime": "',
        CASE WHEN event_id % 77 = 63 THEN substr({_TIME_TEXT}, 1, 10)
             WHEN event_id % 77 = 70 THEN '12:00'
             WHEN event_id % 3 = 0 THEN concat({_TIME_TEXT}, '+00:00')
             WHEN event_id % 3 = 1 THEN concat(substr({_TIME_TEXT}, 1, 16), 'Z')
             ELSE {_TIME_TEXT} END,
        '"}}') END""",
}


def select_sql(columns: dict[str, str]) -> str:
    """The expressions as one SELECT over ``events``."""
    return "SELECT " + ", ".join(f"{sql} AS {name}" for name, sql in columns.items()) + " FROM events"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/events.parquet")


def _derive(spark: SparkSession, sf_dir: str, columns: dict[str, str]) -> DataFrame:
    return events(spark, sf_dir).select(*[F.expr(sql).alias(n) for n, sql in columns.items()])


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled trips, one per event."""
    return cast_trips(_derive(spark, sf_dir, TRIP_COLUMNS))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring requests as JSON text in ``value``, one per event."""
    return _derive(spark, sf_dir, REQUEST_COLUMNS)
