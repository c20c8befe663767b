"""Fragments of the plain SQL equivalents. They restate the rules, not the Spark code."""

from __future__ import annotations

from farelane.sources.derived import REQUEST_COLUMNS, TRIP_COLUMNS, select_sql

_LON = ["pickup_longitude", "dropoff_longitude"]
_LAT = ["pickup_latitude", "dropoff_latitude"]


def _every(rule: str, names: list[str]) -> str:
    return " AND ".join(rule.format(c=name) for name in names)


FARE = "(fare_amount IS NULL OR fare_amount > 2.5)"
NONZERO = _every("{c} <> 0", _LON + _LAT)
PRESENT = _every("{c} IS NOT NULL", _LON + _LAT)
LON_RANGE = _every("{c} BETWEEN -180 AND 180", _LON)
LAT_RANGE = _every("{c} BETWEEN -90 AND 90", _LAT)
COORDS = f"{PRESENT} AND {NONZERO} AND {LON_RANGE} AND {LAT_RANGE}"
PASSENGERS = "(passenger_count IS NULL OR passenger_count <= 6)"
CLEAN = f"{FARE} AND {COORDS} AND {PASSENGERS}"

DISTANCE = f"""CASE WHEN {PRESENT} THEN 6367 * 2 * asin(sqrt(least(1.0,
    pow(sin((radians(dropoff_latitude) - radians(pickup_latitude)) / 2), 2)
    + cos(radians(pickup_latitude)) * cos(radians(dropoff_latitude))
    * pow(sin((radians(dropoff_longitude) - radians(pickup_longitude)) / 2), 2)))) END"""
DAY = "CAST(isodow(pickup_datetime) - 1 AS INT)"
HOUR = "CAST(hour(pickup_datetime) AS INT)"
FEATURED = f"*, {DISTANCE} AS hav_distance_km, {DAY} AS day_of_week, {HOUR} AS hour"

_TRIP_VALUES = """key, fare_amount, epoch_us(pickup_datetime) AS pickup_us, pickup_longitude,
    pickup_latitude, dropoff_longitude, dropoff_latitude, passenger_count"""


def with_trips(body: str, *ctes: str) -> str:
    """``body`` over ``trips`` and further common table expressions."""
    return "WITH " + ", ".join([f"trips AS ({select_sql(TRIP_COLUMNS)})", *ctes]) + " " + body


def trip_rows(where: str = "TRUE") -> str:
    return with_trips(f"SELECT {_TRIP_VALUES} FROM trips WHERE {where}")


CLEANED = f"cleaned AS (SELECT {FEATURED} FROM trips WHERE {CLEAN})"

# The exploratory stages; each quantile is taken over the stage before it.
STAGES = (
    f"after_fare AS (SELECT * FROM trips WHERE {FARE})",
    f"after_coords AS (SELECT * FROM after_fare WHERE {COORDS})",
    f"""after_passengers AS (SELECT {FEATURED} FROM after_coords WHERE passenger_count IS NULL
        OR passenger_count <= (SELECT quantile_cont(passenger_count, 0.98) FROM after_coords))""",
    """after_distance AS (SELECT * FROM after_passengers WHERE hav_distance_km IS NULL
        OR hav_distance_km <= (SELECT quantile_cont(hav_distance_km, 0.99) FROM after_passengers))""",
)


def explored(body: str, *ctes: str) -> str:
    """``body`` over the exploratory stages."""
    return with_trips(body, *STAGES, *ctes)


def featured_rows(table: str) -> str:
    return f"""SELECT {_TRIP_VALUES}, round(hav_distance_km, 6) AS hav_distance_km,
        day_of_week, hour FROM {table}"""


def rolling(width_us: int, table: str) -> str:
    """Rows of ``table`` with ``n``, the fares in the time before, ties in key order."""
    return f"""SELECT *,
        count(fare_amount) OVER (ORDER BY epoch_us(pickup_datetime)
            RANGE BETWEEN {width_us - 1} PRECEDING AND 1 PRECEDING)
        + count(fare_amount) OVER (PARTITION BY pickup_datetime ORDER BY key
            ROWS UNBOUNDED PRECEDING) AS n FROM {table}"""


SPLITS = """hashed AS (SELECT *, CAST(concat('0x', substr(md5(concat('1234:', key)), 1, 15)) AS BIGINT)
        AS shuffled FROM trips),
    ranked AS (SELECT *, row_number() OVER (ORDER BY shuffled, key) AS place FROM hashed),
    sized AS (SELECT count(*) AS n, CAST(ceil(count(*) * 0.25) AS BIGINT) AS n_test FROM trips),
    splits AS (SELECT ranked.*, CASE WHEN place <= n_test THEN 'test'
        WHEN place <= n_test + CAST(ceil((n - n_test) * 0.25) AS BIGINT) THEN 'validation'
        ELSE 'training' END AS split_name FROM ranked, sized)"""

HELD = f"held AS (SELECT {FEATURED} FROM splits WHERE {CLEAN})"


def best_cut(table: str) -> tuple[str, ...]:
    """``best``: of the cuts between the weekdays and between the hours of ``table`` the one that
    leaves the least squared error, and the mean fares below and above it."""
    points = " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, {c} AS v, count(*) AS n, sum(fare_amount) AS s
            FROM {table} WHERE fare_amount IS NOT NULL GROUP BY {c}"""
        for c in ("day_of_week", "hour")
    )
    return (
        f"points AS ({points})",
        """sums AS (SELECT feature, v, sum(n) OVER up AS n, sum(s) OVER up AS s, lead(v) OVER (PARTITION BY feature ORDER BY v) AS next,
            sum(n) OVER (PARTITION BY feature) AS all_n, sum(s) OVER (PARTITION BY feature) AS all_s
            FROM points WINDOW up AS (PARTITION BY feature ORDER BY v))""",
        """best AS (SELECT feature, (v + next) / 2.0 AS cut, s / n AS below, (all_s - s) / (all_n - n) AS above FROM sums
            WHERE next IS NOT NULL ORDER BY s * s / n + (all_s - s) * (all_s - s) / (all_n - n) DESC LIMIT 1)""",
    )


STUMP_ERROR = """(fare_amount - CASE WHEN (CASE feature WHEN 'hour' THEN hour ELSE day_of_week END) < cut
    THEN below ELSE above END)"""

_NUMBER = r"\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*"
_TIME = (
    r"\d{4}-\d{1,2}-\d{1,2}[T ]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d{1,12})?)?(Z|[+-]\d{2}(:?\d{2})?)?"
)


def _number_error(name: str, bound: int) -> str:
    given, text = f"json_type(doc, '$.{name}')", f"json_extract_string(doc, '$.{name}')"
    return f"""CASE WHEN {given} IS NULL THEN '{name}:required'
        WHEN {given} = 'NULL' THEN '{name}:null'
        WHEN {given} NOT IN ('DOUBLE', 'BIGINT', 'UBIGINT', 'VARCHAR')
          OR NOT regexp_full_match({text}, '{_NUMBER}') THEN '{name}:invalid'
        WHEN NOT TRY_CAST({text} AS DOUBLE) BETWEEN -{bound} AND {bound} THEN '{name}:range' END"""


_TIME_GIVEN = "json_type(doc, '$.pickup_datetime')"
_TIME_STRING = "json_extract_string(doc, '$.pickup_datetime')"
_ERRORS = f"""CASE WHEN doc IS NULL THEN ['request:invalid'] ELSE list_concat(
    list_filter([{_number_error('pickup_latitude', 90)}, {_number_error('pickup_longitude', 180)},
      {_number_error('dropoff_latitude', 90)}, {_number_error('dropoff_longitude', 180)},
      CASE WHEN {_TIME_GIVEN} IS NULL THEN 'pickup_datetime:required'
        WHEN {_TIME_GIVEN} = 'NULL' THEN 'pickup_datetime:null'
        WHEN {_TIME_GIVEN} <> 'VARCHAR' OR NOT regexp_full_match({_TIME_STRING}, '{_TIME}')
          THEN 'pickup_datetime:invalid' END], lambda e: e IS NOT NULL),
    list_transform(list_filter(json_keys(doc), lambda k: k NOT IN ('pickup_latitude',
      'pickup_longitude', 'dropoff_latitude', 'dropoff_longitude', 'pickup_datetime')),
      lambda k: k || ':unknown')) END"""

REQUESTS = f"""requests AS ({select_sql(REQUEST_COLUMNS)}),
    docs AS (SELECT key, value, CASE WHEN json_valid(value) THEN value END AS doc FROM requests),
    checked AS (SELECT key, value, doc, {_ERRORS} AS errors FROM docs)"""

# The valid requests with their features.
SCORED_REQUESTS = f"""{REQUESTS},
    valid AS (SELECT CAST(json_extract_string(doc, '$.pickup_latitude') AS DOUBLE) AS pickup_latitude,
        CAST(json_extract_string(doc, '$.pickup_longitude') AS DOUBLE) AS pickup_longitude,
        CAST(json_extract_string(doc, '$.dropoff_latitude') AS DOUBLE) AS dropoff_latitude,
        CAST(json_extract_string(doc, '$.dropoff_longitude') AS DOUBLE) AS dropoff_longitude,
        date_trunc(CASE WHEN key % 3 = 1 THEN 'minute' ELSE 'second' END, ts) AS pickup_datetime
        FROM checked JOIN events ON key = event_id WHERE len(errors) = 0)"""
