"""Request validation and streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.catalog import query, sql
from farelane.catalog.models import fitted
from farelane.session import fresh_path
from farelane.sources.derived import requests
from farelane.sources.readers import read_requests
from farelane.streaming import requests as r
from farelane.streaming.scoring import read_commits, read_rejects, read_scored, score_stream

def _error_text() -> Column:
    return F.array_join("errors", ",").alias("errors")


@query(f"WITH {sql.REQUESTS} SELECT key, array_to_string(errors, ',') AS errors FROM checked")
def validate_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.validate(requests(spark, sf_dir)).select("key", _error_text())


@query(
    f"""WITH {sql.REQUESTS} SELECT key, value, array_to_string(errors, ',') AS errors FROM checked
        WHERE len(errors) > 0"""
)
def reject_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.rejects(r.validate(requests(spark, sf_dir))).select("key", "value", _error_text())


@query(
    f"""WITH {sql.REQUESTS} SELECT key,
          CAST(json_extract_string(doc, '$.pickup_latitude') AS DOUBLE) AS pickup_latitude,
          CAST(json_extract_string(doc, '$.pickup_longitude') AS DOUBLE) AS pickup_longitude,
          CAST(json_extract_string(doc, '$.dropoff_latitude') AS DOUBLE) AS dropoff_latitude,
          CAST(json_extract_string(doc, '$.dropoff_longitude') AS DOUBLE) AS dropoff_longitude,
          epoch_us(date_trunc(CASE WHEN key % 3 = 1 THEN 'minute' ELSE 'second' END, ts)) AS pickup_us
        FROM checked JOIN events ON key = event_id WHERE len(errors) = 0"""
)
def load_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = r.load_valid(r.validate(requests(spark, sf_dir)))
    return valid.select("key", *r.BOUNDS, F.unix_micros("pickup_datetime").alias("pickup_us"))


def _request_files(spark: SparkSession, sf_dir: str) -> str:
    path = fresh_path(spark, "requests")
    requests(spark, sf_dir).select("value").write.text(path)
    return path


@query(f"WITH {sql.REQUESTS} SELECT value, array_to_string(errors, ',') AS errors FROM checked")
def stream_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fresh_path(spark, "validated")
    validated = r.validate(read_requests(spark, _request_files(spark, sf_dir)))
    stream = validated.select("value", "errors").writeStream.format("parquet")
    stream = stream.option("checkpointLocation", fresh_path(spark, "progress"))
    stream.trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.parquet(out).select("value", _error_text())


@query(
    f"""WITH {sql.SCORED_REQUESTS} SELECT pickup_latitude, pickup_longitude, dropoff_latitude, dropoff_longitude,
          epoch_us(pickup_datetime) AS pickup_us, round({sql.DISTANCE}, 6) AS hav_distance_km,
          {sql.DAY} AS day_of_week, {sql.HOUR} AS hour, TRUE AS has_fare FROM valid"""
)
def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, progress = fresh_path(spark, "stream"), fresh_path(spark, "progress")
    arriving = read_requests(spark, _request_files(spark, sf_dir))
    stream = score_stream(fitted(spark, sf_dir), arriving, root, progress, availableNow=True)
    stream.awaitTermination()
    scored = read_scored(spark, root)
    pickup = F.unix_micros("pickup_datetime").alias("pickup_us")
    distance, has_fare = F.round("hav_distance_km", 6).alias("hav_distance_km"), F.col("fare_amount").isNotNull()
    return scored.select(*r.BOUNDS, pickup, distance, "day_of_week", "hour", has_fare.alias("has_fare"))


@query(
    f"""WITH {sql.REQUESTS} SELECT count_if(len(errors) = 0) AS n_scored, count_if(len(errors) > 0) AS n_rejects,
          count_if(len(errors) = 0) AS rows_scored, count_if(len(errors) > 0) AS rows_rejects FROM checked"""
)
def stream_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the commits of all batches say, beside what their folders hold."""
    root, progress = fresh_path(spark, "stream"), fresh_path(spark, "progress")
    arriving = read_requests(spark, _request_files(spark, sf_dir), max_files=1)
    score_stream(fitted(spark, sf_dir), arriving, root, progress, availableNow=True).awaitTermination()
    held = [table(spark, root).agg(F.count(F.lit(1))).scalar().alias(f"rows_{name}") for name, table in (("scored", read_scored), ("rejects", read_rejects))]
    return read_commits(spark, root).agg(*[F.sum(c).alias(c) for c in ("n_scored", "n_rejects")]).select("*", *held)
