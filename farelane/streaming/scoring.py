"""Scoring a stream of requests.

Each micro-batch writes its tables to folders of its own and then a commit, a small file that names
them. Readers take the folders that commits name, so a batch is seen whole or not at all.
"""

from __future__ import annotations

import json
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from farelane.functions.features import add_features
from farelane.operators.model import score
from farelane.schema import LABEL, TRIP_REQUEST
from farelane.session import hadoop_path, read_file, write_file
from farelane.streaming.requests import BOUNDS, load_valid, rejects, validate


def score_requests(model: PipelineModel, validated: DataFrame) -> DataFrame:
    """The valid requests with their predicted ``fare_amount``."""
    scored = score(model, add_features(load_valid(validated)))
    return scored.withColumnRenamed("predictions", LABEL)


TABLES = ("scored", "rejects")

#: The columns of the tables while there is no commit.
NO_ROWS = {
    "scored": T.StructType(
        [
            *[TRIP_REQUEST[name] for name in (*BOUNDS, "pickup_datetime")],
            T.StructField("hav_distance_km", T.DoubleType()),
            T.StructField("day_of_week", T.IntegerType()),
            T.StructField("hour", T.IntegerType()),
            T.StructField(LABEL, T.DoubleType()),
        ]
    ),
    "rejects": T.StructType(
        [T.StructField("value", T.StringType()), T.StructField("errors", T.ArrayType(T.StringType()))]
    ),
}


def _commit_path(root: str, batch_id: int) -> str:
    return f"{root}/commits/{batch_id}.json"


def write_batch(model: PipelineModel, batch: DataFrame, batch_id: int, root: str) -> None:
    """Write the scored requests and the rejects of a validated micro-batch, then commit it.

    A batch that has its commit is left as it is: a batch that is played again has the same rows. One
    that ended before its commit left folders that nothing names, and is written anew.
    """
    spark = batch.sparkSession
    if read_file(spark, _commit_path(root, batch_id)) is not None:
        return
    commit: dict[str, object] = {"batch_id": batch_id}
    attempt = uuid.uuid4().hex
    batch.persist()
    try:
        for name, rows in zip(TABLES, (score_requests(model, batch), rejects(batch))):
            seen = Observation()
            folder = f"{name}/batch_id={batch_id}/attempt={attempt}"
            rows.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{root}/{folder}")
            commit |= {name: folder, f"n_{name}": seen.get["n"]}
    finally:
        batch.unpersist()
    write_file(spark, _commit_path(root, batch_id), json.dumps(commit))


def score_stream(
    model: PipelineModel, requests: DataFrame, root: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Start a query that writes each micro-batch's scored requests and rejects under ``root`` and
    commits them together. A replayed batch appears once, an unfinished one not at all.

    ``trigger`` is passed to ``DataStreamWriter.trigger``, for example ``availableNow=True``.
    """
    writer = validate(requests).writeStream.foreachBatch(
        lambda batch, batch_id: write_batch(model, batch, batch_id, root)
    )
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def read_commits(spark: SparkSession, root: str) -> DataFrame:
    """A row for each finished batch: its number, its folders and how many rows they have."""
    schema = "batch_id long, scored string, n_scored long, rejects string, n_rejects long"
    fs, folder = hadoop_path(spark, f"{root}/commits")
    if not fs.exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("pathGlobFilter", "*.json").json(f"{root}/commits")


def _read(spark: SparkSession, root: str, name: str) -> DataFrame:
    # A path for each finished batch; a stream's file sink keeps a list of the same length.
    folders = [f"{root}/{r[0]}" for r in read_commits(spark, root).select(name).collect()]
    if not folders:
        return spark.createDataFrame([], T.StructType([*NO_ROWS[name].fields, T.StructField("batch_id", T.IntegerType())]))
    return spark.read.option("basePath", f"{root}/{name}").parquet(*folders).drop("attempt")


def read_scored(spark: SparkSession, root: str) -> DataFrame:
    """The scored requests of all finished batches."""
    return _read(spark, root, "scored")


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """The refused requests of all finished batches."""
    return _read(spark, root, "rejects").select("value", "errors", F.col("batch_id"))
