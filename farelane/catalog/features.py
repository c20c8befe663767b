"""Scalar functions and features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.catalog import query, sql
from farelane.catalog.rows import featured_rows
from farelane.functions import clock
from farelane.functions.features import add_features as featured
from farelane.functions.features import with_distance
from farelane.sources.derived import events, trips



@query(
    """SELECT event_id AS key, epoch_us(CASE event_id % 5
         WHEN 2 THEN date_trunc('minute', ts) WHEN 3 THEN date_trunc('day', ts)
         WHEN 4 THEN date_trunc('second', ts) - INTERVAL 5 HOUR
         ELSE date_trunc('second', ts) END) AS pickup_us FROM events"""
)
def parse_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    form = F.col("event_id") % 5
    text = (
        F.when(form == 0, F.concat(seconds, F.lit(" UTC")))
        .when(form == 1, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
        .when(form == 2, F.date_format("ts", "yyyy-MM-dd HH:mm"))
        .when(form == 3, F.date_format("ts", "yyyy-MM-dd"))
        .otherwise(F.concat(seconds, F.lit("+05:00")))
    )
    parsed = F.unix_micros(clock.parse_timestamp(text))
    return events(spark, sf_dir).select(F.col("event_id").alias("key"), parsed.alias("pickup_us"))


@query(sql.with_trips(f"SELECT key, round({sql.DISTANCE}, 6) AS hav_distance_km FROM trips"))
def haversine(spark: SparkSession, sf_dir: str) -> DataFrame:
    distance = F.round("hav_distance_km", 6).alias("hav_distance_km")
    return with_distance(trips(spark, sf_dir)).select("key", distance)


@query(sql.with_trips(f"SELECT key, {sql.DAY} AS day_of_week FROM trips"))
def day_of_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = clock.day_of_week(F.col("pickup_datetime"))
    return trips(spark, sf_dir).select("key", day.alias("day_of_week"))


@query(sql.with_trips(f"SELECT key, {sql.HOUR} AS hour FROM trips"))
def hour_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = clock.hour_of_day(F.col("pickup_datetime"))
    return trips(spark, sf_dir).select("key", hour.alias("hour"))


@query(
    sql.with_trips(
        sql.featured_rows("featured"), f"featured AS (SELECT {sql.FEATURED} FROM trips)"
    )
)
def add_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return featured_rows(featured(trips(spark, sf_dir)))
