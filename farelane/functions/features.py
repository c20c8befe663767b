"""Feature columns derived from a trip."""

from __future__ import annotations

import re

from pyspark.ml import PipelineModel
from pyspark.ml.feature import Bucketizer, SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.functions.clock import day_of_week, hour_of_day
from farelane.functions.geo import haversine_km
from farelane.schema import FEATURES, typed_column
from farelane.session import prepare


def with_pickup_ts(df: DataFrame) -> DataFrame:
    """``pickup_datetime`` as a timestamp, whatever form it came in."""
    pickup = typed_column("pickup_datetime", df.schema["pickup_datetime"].dataType)
    return df.withColumn("pickup_datetime", pickup)


def with_distance(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "hav_distance_km",
        haversine_km(
            F.col("pickup_longitude"),
            F.col("pickup_latitude"),
            F.col("dropoff_longitude"),
            F.col("dropoff_latitude"),
        ),
    )


def with_time_features(df: DataFrame) -> DataFrame:
    prepare(df.sparkSession)
    pickup = F.col("pickup_datetime")
    return with_pickup_ts(df).withColumns(
        {"day_of_week": day_of_week(pickup), "hour": hour_of_day(pickup)}
    )


def add_features(df: DataFrame) -> DataFrame:
    """Distance, weekday and hour beside all input columns; every row stays."""
    return with_time_features(with_distance(df))


# Below every real value of the features, so a tree can part missing values from the rest.
MISSING = -1.0
FILLED = [f"{name}_filled" for name in FEATURES]
BINNED = [f"{name}_{kind}" for name in FEATURES for kind in ("at", "bin")]


def filled_features(features: tuple[str, ...] = tuple(FEATURES)) -> SQLTransformer:
    """Adds ``<name>_filled`` for each feature: a missing one is a value of its own."""
    filled = ", ".join(
        f"coalesce(nanvl(CAST({name} AS DOUBLE), NULL), {MISSING}D) AS {name}_filled" for name in features
    )
    return SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__")


def model_input() -> PipelineModel:
    """The feature vector in the model's column order, as stages that save with the model. A
    missing feature is a value of its own; no row is dropped or refused."""
    assembled = VectorAssembler(inputCols=FILLED, outputCol="features", handleInvalid="keep")
    return PipelineModel([filled_features(), assembled])


def binned_input(cuts: dict[str, list[float]]) -> PipelineModel:
    """As ``model_input``, with the number of the bin that each feature of ``cuts`` falls in, how many
    of its cuts are not above it, in the feature's place."""
    names = list(cuts)
    bins = Bucketizer(
        splitsArray=[[float("-inf"), *cuts[name], float("inf")] for name in names],
        inputCols=[f"{name}_filled" for name in names],
        outputCols=[f"{name}_at" for name in names],
        handleInvalid="keep",
    )
    # A number like any other: bins are marked as unordered kinds, which they are not.
    plain = ", ".join(f"{name}_at + 0.0D AS {name}_bin" for name in names)
    ordered = SQLTransformer(statement=f"SELECT *, {plain} FROM __THIS__")
    assembled = VectorAssembler(inputCols=[f"{name}_bin" for name in names], outputCol="features", handleInvalid="keep")
    return PipelineModel([filled_features(tuple(names)), bins, ordered, assembled])


def matching_cols(df: DataFrame, pattern: str) -> list[str]:
    """Numeric columns whose name contains ``pattern``; a match of another type is an error."""
    matched = [f for f in df.schema if re.search(pattern, f.name)]
    wrong = [f.name for f in matched if not isinstance(f.dataType, T.NumericType)]
    if wrong:
        raise TypeError(f"columns matching {pattern!r} must be numeric: {', '.join(wrong)}")
    return [f.name for f in matched]
