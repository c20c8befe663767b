"""The jobs a user runs: train, evaluate, score a file."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.functions.features import add_features
from farelane.operators.model import MAX_DEPTHS, N_TREES, Tuned, evaluate, score, tune
from farelane.operators.quality import clean
from farelane.operators.split import with_fold
from farelane.schema import FEATURES, cast_trips, nan_to_null
from farelane.sources.readers import Landed, file_format, land
from farelane.sources.sinks import load_model, load_or_split, save_model, split_manifest, write_predictions


def train(
    spark: SparkSession,
    path: str,
    split_root: str,
    artifact: str,
    sample_rows: int | None = None,
    max_depths: tuple[int, ...] = MAX_DEPTHS,
    n_trees: tuple[int, ...] = N_TREES,
    features: tuple[str, ...] = tuple(FEATURES),
) -> Tuned:
    """Split (or reuse the splits), clean, add features, tune, save. The test split is written
    raw and never read here. CSV lines that do not parse are written to ``<split_root>-rejects``;
    ``rejected`` of the result says how many the splits were made without."""
    training, validation = load_or_split(spark, path, split_root, sample_rows)
    folded = clean(with_fold(training, validation))
    tuned = tune(add_features(folded), max_depths, n_trees, features)
    save_model(tuned.model, artifact, tuned.grid_frame(spark))
    return replace(tuned, rejected=split_manifest(spark, split_root).get("rejected", 0))


def _format(path: str) -> str:
    """That of the suffix; a path without one, such as the folder of a split, is Parquet."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return file_format(path) if "." in name else "parquet"


def evaluate_file(spark: SparkSession, artifact: str, path: str, rejects: str | None = None) -> DataFrame:
    """One row: the RMSE of a saved model on the valid trips of a file, and ``n_rejected``, how many
    CSV lines do not parse; those are written to ``rejects`` if given."""
    found = land(spark, path, _format(path), rejects)
    error = evaluate(load_model(artifact), add_features(found.trips(only_valid=True)))
    return error.withColumn("n_rejected", F.lit(found.rejected).cast("long"))


def run_inference(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    artifact: str,
    files: int | None = None,
    rejects: str | None = None,
) -> Landed:
    """Score every row of a file, valid or not, and write the predictions. CSV lines that do not parse
    are scored by what does, counted, and also written as text to ``rejects`` if given."""
    found = land(spark, input_path, rejects=rejects)
    rows = nan_to_null(cast_trips(found.all_rows()))
    write_predictions(score(load_model(artifact), add_features(rows)), output_path, files, rows=found.rows)
    return found
