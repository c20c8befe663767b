"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.catalog import query, sql
from farelane.catalog.rows import trip_rows
from farelane.functions.features import add_features
from farelane.operators.model import fit_gbt
from farelane.operators.quality import clean
from farelane.operators.split import split_trips
from farelane.plans.jobs import run_inference
from farelane.session import fresh_path
from farelane.sources.derived import events, trips
from farelane.sources.readers import dataset_profile as profile
from farelane.sources.readers import land, read_trips
from farelane.sources.sinks import load_or_split, read_split, save_model
from farelane.sources.sinks import write_splits as write


@query(sql.trip_rows())
def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "trips") + ".csv"
    text = F.date_format("pickup_datetime", "yyyy-MM-dd HH:mm:ss.SSSSSS 'UTC'")
    trips(spark, sf_dir).withColumn("pickup_datetime", text).write.option("header", True).csv(path)
    return trip_rows(read_trips(spark, path))


@query(sql.trip_rows())
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "trips") + ".parquet"
    trips(spark, sf_dir).write.parquet(path)
    return trip_rows(read_trips(spark, path))


@query(sql.trip_rows(sql.CLEAN))
def scan_parquet_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "trips") + ".parquet"
    trips(spark, sf_dir).write.parquet(path)
    return trip_rows(read_trips(spark, path, only_valid=True))


@query(
    sql.with_trips("SELECT split_name, count(*) AS n_trips FROM splits GROUP BY split_name", sql.SPLITS)
)
def write_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_path(spark, "splits")
    write(split_trips(trips(spark, sf_dir)), root)
    return spark.read.parquet(root).groupBy("split_name").agg(F.count(F.lit(1)).alias("n_trips"))


@query(sql.with_trips("SELECT key, split_name FROM splits WHERE split_name <> 'test'", sql.SPLITS))
def reuse_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, root = fresh_path(spark, "trips") + ".parquet", fresh_path(spark, "splits")
    trips(spark, sf_dir).write.parquet(path)
    load_or_split(spark, path, root)
    training, validation = load_or_split(spark, path, root)
    return training.select("key", F.lit("training").alias("split_name")).union(
        validation.select("key", F.lit("validation"))
    )


@query(sql.with_trips("SELECT key, fare_amount FROM splits WHERE split_name = 'test'", sql.SPLITS))
def read_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_path(spark, "splits")
    write(split_trips(trips(spark, sf_dir)), root)
    return read_split(spark, root, "test").select("key", "fare_amount")


@query("SELECT count(*) AS total_rows, CAST(floor(count(*) * 0.1) AS BIGINT) AS head_rows FROM events")
def dataset_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(spark, f"{sf_dir}/events.parquet").select("total_rows", "head_rows")


# Trips as CSV fields. Of every 50, five do not parse: a fare, a time, a coordinate and two of these.
_BAD = {
    "fare_amount": "CASE WHEN event_id % 50 IN (7, 31) THEN 'free' ELSE CAST(event_id % 40 + 3 AS STRING) END",
    "pickup_datetime": """CASE WHEN event_id % 50 IN (13, 31) THEN 'yesterday'
        ELSE concat(substr(CAST(ts AS STRING), 1, 19), ' UTC') END""",
    "pickup_longitude": """CASE WHEN event_id % 50 IN (19, 43) THEN '73W' ELSE '-73.9' END""",
    "pickup_latitude": "CASE WHEN event_id % 50 = 43 THEN '40N' ELSE '40.7' END",
    "dropoff_longitude": "'-73.8'",
    "dropoff_latitude": "'40.8'",
    "passenger_count": "CAST(event_id % 5 + 1 AS STRING)",
}
_FIELDS = {"key": "CAST(event_id AS STRING)"} | _BAD
_CSV_FILES = 4
_ERRORS_SQL = """CASE event_id % 50 WHEN 7 THEN 'fare_amount' WHEN 13 THEN 'pickup_datetime' WHEN 19 THEN 'pickup_longitude'
    WHEN 31 THEN 'fare_amount,pickup_datetime' WHEN 43 THEN 'pickup_longitude,pickup_latitude' END"""


def _csv_with_bad_lines(spark: SparkSession, sf_dir: str) -> str:
    """A CSV of a file for each remainder of the id."""
    path = fresh_path(spark, "trips") + ".csv"
    fields = events(spark, sf_dir).select(
        *[F.expr(e).alias(n) for n, e in _FIELDS.items()], (F.col("event_id") % _CSV_FILES).alias("part")
    )
    fields.repartition(_CSV_FILES, "part").write.option("header", True).partitionBy("part").csv(path)
    return path


@query(
    f"""SELECT key, errors FROM (SELECT {_FIELDS['key']} AS key, {_ERRORS_SQL} AS errors FROM events)
        WHERE errors IS NOT NULL"""
)
def scan_csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that a job wrote as rejects."""
    rejects = fresh_path(spark, "rejects")
    land(spark, _csv_with_bad_lines(spark, sf_dir), rejects=rejects)
    return spark.read.parquet(rejects).select("key", F.array_join("errors", ",").alias("errors"))


@query(f"SELECT event_id AS key, CAST(event_id % 40 + 3 AS DOUBLE) AS fare_amount FROM events WHERE {_ERRORS_SQL} IS NULL")
def scan_csv_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the same input that are trips."""
    return land(spark, _csv_with_bad_lines(spark, sf_dir)).trips().select("key", "fare_amount")


_LINE_BYTES = " + ".join(f"length({e}) + 1" for e in _FIELDS.values())
_HEADER_BYTES = sum(len(n) + 1 for n in _FIELDS)


@query(
    f"""SELECT CAST(sum({_LINE_BYTES}) + count(DISTINCT event_id % {_CSV_FILES}) * {_HEADER_BYTES} AS BIGINT) AS bytes,
          count(*) AS total_rows, CAST(floor(count(*) * 0.1) AS BIGINT) AS head_rows,
          count({_ERRORS_SQL}) AS rejected_rows FROM events"""
)
def csv_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The footprint of a CSV with everything in it: its bytes, all of its lines, and the bad ones."""
    return profile(spark, _csv_with_bad_lines(spark, sf_dir), rejects=fresh_path(spark, "rejects"))


@query(
    f"""SELECT count(*) AS n_scored, count({_ERRORS_SQL}) AS n_rejected, count({_ERRORS_SQL}) AS n_written FROM events"""
)
def inference_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch inference over that CSV: every line is scored, and the bad ones are counted and kept."""
    rejects, path, artifact = (fresh_path(spark, n) for n in ("rejects", "predictions", "model"))
    save_model(fit_gbt(add_features(clean(trips(spark, sf_dir))), 2, 2), artifact)
    found = run_inference(spark, _csv_with_bad_lines(spark, sf_dir), path, artifact, rejects=rejects)
    written = spark.read.parquet(rejects).agg(F.count(F.lit(1))).scalar()
    scored = spark.read.parquet(path).agg(F.count("predictions").alias("n_scored"))
    return scored.select("n_scored", F.lit(found.rejected).cast("long").alias("n_rejected"), written.alias("n_written"))
