"""Validity rules and cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from farelane.catalog import query, sql
from farelane.catalog.rows import featured_rows, trip_rows
from farelane.functions.features import add_features
from farelane.operators import quality
from farelane.plans import explore
from farelane.sources.derived import trips


@query(sql.trip_rows(sql.FARE))
def filter_fare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trip_rows(trips(spark, sf_dir).filter(quality.valid_fare()))


@query(sql.trip_rows(sql.NONZERO))
def filter_coord_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = trips(spark, sf_dir)
    return trip_rows(df.filter(quality.nonzero_coords(df)))


@query(sql.trip_rows(sql.PRESENT))
def filter_coord_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = trips(spark, sf_dir)
    return trip_rows(df.filter(quality.present_coords(df)))


@query(sql.trip_rows(sql.LON_RANGE))
def filter_lon_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = trips(spark, sf_dir)
    return trip_rows(df.filter(quality.longitudes_in_range(df)))


@query(sql.trip_rows(sql.LAT_RANGE))
def filter_lat_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = trips(spark, sf_dir)
    return trip_rows(df.filter(quality.latitudes_in_range(df)))


@query(sql.trip_rows(sql.PASSENGERS))
def filter_passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trip_rows(trips(spark, sf_dir).filter(quality.valid_passengers()))


@query(sql.trip_rows(sql.CLEAN))
def clean_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trip_rows(quality.clean(trips(spark, sf_dir)))


@query(sql.explored(sql.featured_rows("after_passengers")))
def trim_passengers_q98(spark: SparkSession, sf_dir: str) -> DataFrame:
    return featured_rows(explore.passengers_stage(trips(spark, sf_dir)))


@query(
    sql.with_trips(
        sql.featured_rows(
            "cleaned WHERE hav_distance_km <= (SELECT quantile_cont(hav_distance_km, 0.99) FROM cleaned)"
        ),
        sql.CLEANED,
    )
)
def trim_distance_q99(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = add_features(quality.clean(trips(spark, sf_dir)))
    return featured_rows(explore.trim_quantile(cleaned, "hav_distance_km", 0.99))


@query(sql.trip_rows(f"pickup_datetime IS NULL OR {sql.DAY} NOT IN (5, 6)"))
def filter_weekdays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trip_rows(quality.weekdays(add_features(trips(spark, sf_dir))))


@query(sql.explored(sql.featured_rows("after_distance")))
def explore_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return featured_rows(explore.explore_clean(trips(spark, sf_dir)))
