from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from farelane.operators.sampling import head_fraction, head_sample, sort_trips
from farelane.operators.split import split_sizes, split_trips, union_splits, with_fold
from farelane.sources.derived import trips


@pytest.mark.parametrize("n", [0, 1, 137, 999, 1000, 5000])
def test_head_sample(spark, sf_dir, n):
    got = sorted(r.key for r in head_sample(trips(spark, sf_dir), n).select("key").collect())
    assert got == list(range(min(n, 1000)))


def test_head_fraction(spark, sf_dir):
    assert head_fraction(trips(spark, sf_dir), 0.1234).count() == 123


def test_head_with_copies(spark):
    """Rows level in the key at the cut, some of them whole copies of each other."""
    rows = [(1, "a"), (2, "b")] + [(5, "x")] * 40 + [(5, "y")] * 40 + [(9, "z")] * 3
    df = spark.createDataFrame(rows, "key long, tag string").repartition(4)
    for n in (2, 3, 30, 42, 60, 82, 84):
        got = head_sample(df, n)
        assert got.count() == n
        assert got.filter("key < 5").count() == 2
        assert got.exceptAll(df).isEmpty()


def test_sort(spark, sf_dir):
    df = trips(spark, sf_dir).withColumn(
        "pickup_datetime", F.when(F.col("key") % 10 != 0, F.date_trunc("hour", "pickup_datetime"))
    )
    got = [(r.pickup_datetime is None, r.pickup_datetime, r.key) for r in sort_trips(df).collect()]
    assert [g[0] for g in got] == sorted(g[0] for g in got)
    timed = [g[1:] for g in got if not g[0]]
    assert timed == sorted(timed)


def test_split_sizes(spark):
    counts = split_trips(trips(spark, "/root/testdata/sf0.01")).groupBy("split_name").count()
    assert {r[0]: r[1] for r in counts.collect()} == {"test": 2500, "validation": 1875, "training": 5625}


@pytest.mark.parametrize("n", [1, 2, 3, 7, 10])
def test_small_splits(spark, n):
    labels = [r.split_name for r in split_trips(spark.range(n).withColumnRenamed("id", "key")).collect()]
    test, validation = split_sizes(n)
    assert test == math.ceil(n / 4)
    assert (labels.count("test"), labels.count("validation")) == (test, validation)


def test_split_is_stable(spark, sf_dir):
    df = trips(spark, sf_dir).select("key")
    one = {tuple(r) for r in split_trips(df).collect()}
    other = {tuple(r) for r in split_trips(df.repartition(7).orderBy(F.rand(3))).collect()}
    assert one == other
    assert one != {tuple(r) for r in split_trips(df, seed=99).collect()}


def test_copies_share_a_split(spark):
    df = spark.range(100).select((F.col("id") % 5).alias("key"))
    assert split_trips(df).distinct().count() == 5


def test_union_and_folds(spark):
    a = spark.createDataFrame([(1, 2.0), (1, 2.0)], "key long, fare_amount double")
    b = spark.createDataFrame([(3.0, 4, "x")], "fare_amount double, key long, note string")
    both = union_splits(a, b)
    assert both.count() == 3 and both.columns == ["key", "fare_amount", "note"]
    folds = with_fold(a, b).select("key", "split").collect()
    assert sorted(map(tuple, folds)) == [(1, -1), (1, -1), (4, 0)]
