"""Reproducible splits and folds."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.operators.quantiles import rank_cuts

SEED = 1234
HELD_OUT = 0.25
HASH_DIGITS = 15
SPLIT_NAMES = ("training", "validation", "test")
TRAIN_FOLD, VALIDATION_FOLD = -1, 0


def shuffle_rank(seed: int) -> Column:
    """A row's place in the shuffled order: the leading bits of the hash of seed and key."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")))
    return F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("long")


def split_sizes(count: int) -> tuple[int, int]:
    """Rows of the test split, and of the validation split taken from the rest."""
    test = math.ceil(count * HELD_OUT)
    return test, math.ceil((count - test) * HELD_OUT)


def split_trips(df: DataFrame, seed: int = SEED) -> DataFrame:
    """Add ``split_name``: test, validation and training by hash of the key, in exact sizes.

    The two cuts in the hash order are found by counting, so labelling is a projection. A
    row's split depends on the set of keys and the seed, not on files or partitions. Copies
    of one key share a split, so that none leaks across.
    """
    rank = shuffle_rank(seed)

    def ends(count: int) -> list[int]:
        test, validation = split_sizes(count)
        return [test, test + validation]

    whole = (0, 16**HASH_DIGITS - 1)
    _, [test, validation] = rank_cuts(df, [rank, F.col("key")], ends, whole)
    name = (
        F.when(test.inside | test.tied, "test")
        .when(validation.inside | validation.tied, "validation")
        .otherwise("training")
    )
    return df.withColumn("split_name", name)


def union_splits(first: DataFrame, second: DataFrame) -> DataFrame:
    """All rows of both, by column name."""
    return first.unionByName(second, allowMissingColumns=True)


def with_fold(training: DataFrame, validation: DataFrame) -> DataFrame:
    """Both splits with ``split``: -1 is only trained on, 0 is the fold that scores."""
    return union_splits(
        training.withColumn("split", F.lit(TRAIN_FOLD)),
        validation.withColumn("split", F.lit(VALIDATION_FOLD)),
    )
