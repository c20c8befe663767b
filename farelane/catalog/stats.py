"""Profiling and grouped statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.catalog import query, sql
from farelane.functions.features import add_features, with_distance
from farelane.operators import quality, stats
from farelane.operators.quantiles import exact_quantile
from farelane.plans.explore import explore_clean, fare_stage, passengers_stage
from farelane.schema import LABEL
from farelane.sources.derived import trips

_RATE = "round(avg(CASE WHEN {valid} THEN 0.0 ELSE 1.0 END), 3)"


@query("SELECT count(*) AS row_count FROM events")
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.count_rows(trips(spark, sf_dir))


@query(
    sql.with_trips(f"SELECT {_RATE.format(valid=sql.FARE)} AS invalid_fare_rate FROM trips")
)
def invalid_fare_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.invalid_rate(trips(spark, sf_dir), quality.valid_fare(), "invalid_fare_rate")


@query(
    sql.explored(f"SELECT {_RATE.format(valid=sql.COORDS)} AS invalid_coord_rate FROM after_fare")
)
def invalid_coord_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fare_stage(trips(spark, sf_dir))
    return quality.invalid_rate(df, quality.valid_coords(df), "invalid_coord_rate")


@query(
    sql.with_trips(
        """SELECT name, CAST(q AS DOUBLE) AS q, quantile FROM (
          SELECT 'fare_amount' AS name, 0.5 AS q, round(quantile_cont(fare_amount, 0.5), 6) AS quantile FROM trips
          UNION ALL SELECT 'fare_amount', 0.98, round(quantile_cont(fare_amount, 0.98), 6) FROM trips
          UNION ALL SELECT 'passenger_count', 0.98, round(quantile_cont(passenger_count, 0.98), 6) FROM trips
          UNION ALL SELECT 'hav_distance_km', 0.99, round(quantile_cont(hav_distance_km, 0.99), 6) FROM cleaned)""",
        sql.CLEANED,
    )
)
def quantile_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = trips(spark, sf_dir)
    cleaned = with_distance(quality.clean(df))
    wanted = [
        (df, "fare_amount", 0.5),
        (df, "fare_amount", 0.98),
        (df, "passenger_count", 0.98),
        (cleaned, "hav_distance_km", 0.99),
    ]
    found = [(name, q, exact_quantile(table, name, q)) for table, name, q in wanted]
    rows = spark.createDataFrame(found, "name string, q double, quantile double")
    return rows.withColumn("quantile", F.round("quantile", 6))


def _median_sql(key: str, where: str) -> str:
    return sql.explored(
        f"""SELECT {key}, round(median(fare_amount), 6) AS median_fare_amount
            FROM after_distance WHERE {where} GROUP BY {key} ORDER BY {key}"""
    )


def _rounded(medians: DataFrame) -> DataFrame:
    name = f"median_{LABEL}"
    return medians.withColumn(name, F.round(name, 6))


@query(_median_sql("hour", "day_of_week NOT IN (5, 6)"))
def median_fare_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(stats.median_by(quality.weekdays(explore_clean(trips(spark, sf_dir))), "hour"))


@query(_median_sql("day_of_week", "day_of_week IS NOT NULL"))
def median_fare_by_dow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(stats.median_by(explore_clean(trips(spark, sf_dir)), "day_of_week"))


@query(_median_sql("passenger_count", "passenger_count IS NOT NULL"))
def median_fare_by_passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(stats.median_by(explore_clean(trips(spark, sf_dir)), "passenger_count"))


@query(
    sql.explored(
        """SELECT passenger_count, count(*) AS n_trips FROM after_distance
           WHERE passenger_count IS NOT NULL GROUP BY passenger_count ORDER BY passenger_count"""
    )
)
def trips_by_passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.size_by(explore_clean(trips(spark, sf_dir)), "passenger_count")


def _histogram_sql(table: str) -> str:
    return sql.explored(
        """SELECT bin, round(lo + bin * width, 6) AS bin_start, round(lo + (bin + 1) * width, 6) AS bin_end,
             coalesce(n, 0) AS n_trips
           FROM (SELECT CAST(range AS INT) AS bin FROM range(10)) CROSS JOIN bounds LEFT JOIN binned USING (bin)""",
        f"""bounds AS (SELECT min(hav_distance_km) AS lo,
              (max(hav_distance_km) - min(hav_distance_km)) / 10 AS width FROM {table})""",
        f"""binned AS (SELECT bin, count(*) AS n FROM {table}, bounds,
              (SELECT CAST(range AS INT) AS bin FROM range(10)) WHERE hav_distance_km >= lo + bin * width
              AND (bin = 9 OR hav_distance_km < lo + (bin + 1) * width) GROUP BY 1)""",
    )


def _rounded_bins(bins: DataFrame) -> DataFrame:
    return bins.withColumns({c: F.round(c, 6) for c in ("bin_start", "bin_end")})


@query(_histogram_sql("after_passengers"))
def distance_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = passengers_stage(trips(spark, sf_dir))
    return _rounded_bins(stats.histogram(df, "hav_distance_km"))


@query(_histogram_sql("after_distance"))
def distance_histogram_trimmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = explore_clean(trips(spark, sf_dir))
    return _rounded_bins(stats.histogram(df, "hav_distance_km"))


# The metrics are taken on a fixed linear fare, so that SQL can compute the same.
_LINEAR_SQL = "2.5 + 1.5 * hav_distance_km"


def _linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = add_features(quality.clean(trips(spark, sf_dir)))
    return cleaned.withColumn("predictions", 2.5 + 1.5 * F.col("hav_distance_km"))


@query(
    sql.with_trips(
        f"SELECT round(sqrt(avg(pow(fare_amount - ({_LINEAR_SQL}), 2))), 6) AS rmse FROM cleaned",
        sql.CLEANED,
    )
)
def rmse_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.rmse(_linear(spark, sf_dir), LABEL, "predictions").select(
        F.round("rmse", 6).alias("rmse")
    )


@query(
    sql.with_trips(
        f"""SELECT round(1 - sum(pow(fare_amount - ({_LINEAR_SQL}), 2))
              / sum(pow(fare_amount - mean, 2)), 6) AS r2
            FROM cleaned, (SELECT avg(fare_amount) AS mean FROM cleaned)""",
        sql.CLEANED,
    )
)
def r2_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.r2(_linear(spark, sf_dir), LABEL, "predictions").select(F.round("r2", 6).alias("r2"))
