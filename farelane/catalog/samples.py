"""Order, head samples, splits and folds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.catalog import query, sql
from farelane.catalog.rows import trip_rows
from farelane.operators import sampling, split
from farelane.plans.explore import explore_clean
from farelane.sources.derived import trips

HEAD_ROWS = 777


@query(
    sql.explored(
        """SELECT key, epoch_us(pickup_datetime) AS pickup_us, fare_amount FROM after_distance
           ORDER BY pickup_datetime NULLS LAST, key"""
    )
)
def sort_by_pickup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = sampling.sort_trips(explore_clean(trips(spark, sf_dir)))
    return ordered.select("key", F.unix_micros("pickup_datetime").alias("pickup_us"), "fare_amount")


@query(f"SELECT * FROM ({sql.trip_rows()}) ORDER BY key LIMIT {HEAD_ROWS}")
def head_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trip_rows(sampling.head_sample(trips(spark, sf_dir), HEAD_ROWS))


@query(
    f"""SELECT * FROM ({sql.trip_rows()}) ORDER BY key
        LIMIT (SELECT CAST(floor(count(*) * 0.1) AS BIGINT) FROM events)"""
)
def head_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trip_rows(sampling.head_fraction(trips(spark, sf_dir), 0.1))


@query(sql.with_trips("SELECT key, split_name FROM splits", sql.SPLITS))
def split_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split_trips(trips(spark, sf_dir)).select("key", "split_name")


def _training_and_validation(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    labelled = split.split_trips(trips(spark, sf_dir))
    return [
        labelled.filter(F.col("split_name") == name).drop("split_name")
        for name in ("training", "validation")
    ]


@query(
    sql.with_trips(
        "SELECT key, fare_amount, passenger_count FROM splits WHERE split_name <> 'test'", sql.SPLITS
    )
)
def union_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = split.union_splits(*_training_and_validation(spark, sf_dir))
    return both.select("key", "fare_amount", "passenger_count")


@query(
    sql.with_trips(
        """SELECT key, CAST(CASE split_name WHEN 'training' THEN -1 ELSE 0 END AS INT) AS split
           FROM splits WHERE split_name <> 'test'""",
        sql.SPLITS,
    )
)
def predefined_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.with_fold(*_training_and_validation(spark, sf_dir)).select("key", "split")
