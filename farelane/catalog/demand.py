"""Rolling demand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.catalog import query, sql
from farelane.operators import demand
from farelane.plans.explore import DEMAND_WIDTHS, explore_clean
from farelane.sources.derived import trips

HALF_HOUR_NAME, HOUR_NAME = DEMAND_WIDTHS


def _counted(spark: SparkSession, sf_dir: str, width_us: int, name: str) -> DataFrame:
    explored = explore_clean(trips(spark, sf_dir)).select("key", "pickup_datetime", "fare_amount")
    return demand.rolling_count(explored, width_us, name)


def _rows_sql(width_us: int, name: str) -> str:
    return sql.explored(
        f"SELECT key, epoch_us(pickup_datetime) AS pickup_us, fare_amount, n AS {name} FROM rolled",
        f"rolled AS ({sql.rolling(width_us, 'after_distance')})",
    )


def _rows(spark: SparkSession, sf_dir: str, width_us: int, name: str) -> DataFrame:
    counted = _counted(spark, sf_dir, width_us, name)
    pickup = F.unix_micros("pickup_datetime").alias("pickup_us")
    return counted.select("key", pickup, "fare_amount", name)


def _corr_sql(width_us: int) -> str:
    return sql.explored(
        "SELECT round(corr(n, fare_amount), 6) AS corr FROM rolled",
        f"rolled AS ({sql.rolling(width_us, 'after_distance')})",
    )


def _corr(spark: SparkSession, sf_dir: str, width_us: int, name: str) -> DataFrame:
    corr = demand.demand_fare_corr(_counted(spark, sf_dir, width_us, name), name)
    return corr.select(F.round("corr", 6).alias("corr"))


def _table_sql(width_us: int, name: str) -> str:
    return sql.explored(
        f"""SELECT n AS {name}, count(fare_amount) AS n, round(avg(fare_amount), 9) AS mean_fare,
              round(median(fare_amount), 6) AS median_fare FROM rolled GROUP BY rolled.n""",
        f"rolled AS ({sql.rolling(width_us, 'after_distance')})",
    )


def _table(spark: SparkSession, sf_dir: str, width_us: int, name: str) -> DataFrame:
    table = demand.demand_fare_table(_counted(spark, sf_dir, width_us, name), name)
    return table.withColumns(
        {"mean_fare": F.round("mean_fare", 9), "median_fare": F.round("median_fare", 6)}
    )


@query(_rows_sql(demand.HALF_HOUR, HALF_HOUR_NAME))
def rolling_trips_30m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, sf_dir, demand.HALF_HOUR, HALF_HOUR_NAME)


@query(_rows_sql(demand.HOUR, HOUR_NAME))
def rolling_trips_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, sf_dir, demand.HOUR, HOUR_NAME)


@query(_corr_sql(demand.HALF_HOUR))
def demand_fare_corr_30m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _corr(spark, sf_dir, demand.HALF_HOUR, HALF_HOUR_NAME)


@query(_corr_sql(demand.HOUR))
def demand_fare_corr_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _corr(spark, sf_dir, demand.HOUR, HOUR_NAME)


@query(_table_sql(demand.HALF_HOUR, HALF_HOUR_NAME))
def demand_fare_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, demand.HALF_HOUR, HALF_HOUR_NAME)


@query(_table_sql(demand.HOUR, HOUR_NAME))
def demand_fare_table_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, demand.HOUR, HOUR_NAME)
