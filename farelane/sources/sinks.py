"""Writing splits, predictions and models."""

from __future__ import annotations

import json
import math

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.operators.sampling import head_sample
from farelane.operators.split import SEED, split_trips
from farelane.session import fresh_path, hadoop_path, read_file, write_file
from farelane.sources.readers import file_sizes, land


def write_splits(df: DataFrame, root: str, mode: str = "errorifexists") -> None:
    """Raw, uncleaned trips with their ``split_name``, one Parquet folder per split."""
    df.write.mode(mode).partitionBy("split_name").parquet(root)


def read_split(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One split; the others' folders are not listed into the scan."""
    return spark.read.parquet(root).filter(F.col("split_name") == name).drop("split_name")


def has_splits(spark: SparkSession, root: str) -> bool:
    """Whether a finished write stands under ``root``; a split without rows has no folder."""
    fs, marker = hadoop_path(spark, f"{root}/_SUCCESS")
    return fs.exists(marker)


def fingerprint(spark: SparkSession, path: str, seed: int, sample_rows: int | None) -> dict | None:
    """What splits are made of: number, bytes and a hash of the names and lengths of the input's
    files, the seed and the sample; None if the input is gone. Only the sums come to the driver."""
    fs, root = hadoop_path(spark, path)
    if not fs.exists(root):
        return None
    base = fs.getFileStatus(root).getPath().toUri().getPath().rstrip("/")
    # Names below the input, so that a moved input is still the same.
    name = F.element_at(F.split("path", base, 2), -1)
    one = F.xxhash64(name, "length").cast("decimal(38,0)")
    files = file_sizes(spark, path).agg(F.count("path").alias("n"), F.sum("length").alias("bytes"), F.sum(one).alias("names"))
    n, size, names = files.first()
    return {"files": n, "bytes": int(size or 0), "names": str(names), "seed": seed, "sample_rows": sample_rows}


def split_manifest(spark: SparkSession, root: str) -> dict:
    """What was written beside the splits: the input's fingerprint, ``rows`` and ``rejected``; empty
    for splits without one."""
    text = read_file(spark, f"{root}/_manifest.json")
    return json.loads(text) if text else {}


def load_or_split(
    spark: SparkSession, path: str, root: str, sample_rows: int | None = None, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Training and validation trips: reused from ``root`` when there, else split and written.

    A new split reads the input once (``land``); CSV lines that do not parse are written to
    ``<root>-rejects`` and counted in the manifest beside the splits. Splits are reused only for what
    they were made of: another input, seed or sample under the same root is refused. Where the input
    is gone the splits stand for it. What an unfinished write left under ``root`` is overwritten.
    ``sample_rows`` limits a new split to the first rows by key; by default all are used.
    """
    now = fingerprint(spark, path, seed, sample_rows)
    if not has_splits(spark, root):
        found = land(spark, path, rejects=f"{root}-rejects")
        trips = found.trips()
        if sample_rows is not None:
            trips = head_sample(trips, sample_rows)
        write_splits(split_trips(trips, seed), root, "overwrite")
        made = {"input": now, "rows": found.rows, "rejected": found.rejected}
        write_file(spark, f"{root}/_manifest.json", json.dumps(made))
    elif now is not None:
        made = split_manifest(spark, root).get("input")
        other = [k for k in now if made is not None and made.get(k) != now[k]]
        if other:
            raise ValueError(f"the splits under {root} were made of something else: {', '.join(other)} differ")
    return read_split(spark, root, "training"), read_split(spark, root, "validation")


#: Bytes of a file of predictions, and of its rows before they are encoded and compressed: the task that
#: writes a file reads its rows from a shuffle, where equal values don't shrink as they do in Parquet.
FILE_BYTES, TASK_BYTES = 128 << 20, 128 << 20
#: Rows whose bytes in a file are measured to tell how many rows a file holds.
TRIAL_ROWS = 10_000


def write_balanced(
    df: DataFrame, path: str, file_bytes: int = FILE_BYTES, rows: int | None = None, task_bytes: int = TASK_BYTES
) -> int:
    """Parquet at a new path, in files of about ``file_bytes`` however many tasks compute ``df``, or
    smaller ones of about ``task_bytes`` before encoding and compression; returns their number.

    The first rows are written to the shared folder, as files hold them and plain, to learn the bytes
    of a row; with the number of rows (``rows``, else counted, which reads no column that the count
    doesn't need) that gives the number of files, and a shuffle deals the rows out evenly to them.
    """
    spark = df.sparkSession
    first = df.take(TRIAL_ROWS)
    total = len(first) if len(first) < TRIAL_ROWS else rows if rows is not None else df.count()
    files = 1
    if first:
        trial = spark.createDataFrame(first, df.schema).coalesce(1)

        def bytes_of_all(**options: str) -> float:
            at = fresh_path(spark, "trial")
            trial.write.options(**options).parquet(at)
            return total * file_sizes(spark, at).agg(F.sum("length")).first()[0] / len(first)

        plain = bytes_of_all(**{"compression": "none", "parquet.enable.dictionary": "false"})
        files = max(1, round(bytes_of_all() / file_bytes), math.ceil(plain / task_bytes))
    df.repartition(files).write.mode("errorifexists").parquet(path)
    return files


def write_predictions(
    df: DataFrame,
    path: str,
    files: int | None = None,
    file_bytes: int = FILE_BYTES,
    rows: int | None = None,
) -> None:
    """Parquet at a new path, in files as ``write_balanced`` has them. ``files`` sets their number instead.
    Either is a shuffle after scoring, so scoring itself stays as wide as the scan."""
    if files is None:
        write_balanced(df, path, file_bytes, rows)
    else:
        df.repartition(files).write.mode("errorifexists").parquet(path)


def save_model(model: PipelineModel, path: str, grid: DataFrame | None = None) -> None:
    """The fitted pipeline under ``path``, with the tuning results beside it if given."""
    model.write().overwrite().save(f"{path}/model")
    if grid is not None:
        grid.write.mode("overwrite").json(f"{path}/grid")


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/model")
