from __future__ import annotations

import numpy as np
import pytest

from farelane.functions.features import add_features
from farelane.operators import stats
from farelane.operators.quality import clean
from farelane.sources.derived import trips


def test_median_equals_pandas(spark):
    df = clean(trips(spark, "/root/testdata/sf0.01"))
    got = {r[0]: r[1] for r in stats.median_by(df, "passenger_count").collect()}
    frame = df.select("passenger_count", "fare_amount").toPandas()
    expected = frame.groupby("passenger_count").fare_amount.median().to_dict()
    assert got == pytest.approx(expected)


def test_median_of_missing_values(spark):
    rows = [(1, None), (1, None), (2, 5.0), (2, None), (None, 7.0), (3, 1.0), (3, 2.0)]
    df = spark.createDataFrame(rows, "k int, fare_amount double")
    got = [tuple(r) for r in stats.median_by(df, "k").collect()]
    assert got == [(1, None), (2, 5.0), (3, 1.5)]


def test_median_with_a_hot_key(spark, monkeypatch):
    """Every group counts as hot, so the medians come from range slices."""
    from farelane.operators import running

    df = clean(trips(spark, "/root/testdata/sf0.01"))
    expected = stats.median_by(df, "passenger_count").collect()
    monkeypatch.setattr(running.running_total, "__defaults__", (20,))
    assert stats.median_by(df, "passenger_count").collect() == expected


def test_size_counts_missing_fares(spark):
    rows = [(1, None), (1, 2.0), (None, 7.0), (0, None)]
    df = spark.createDataFrame(rows, "k int, fare_amount double")
    assert [tuple(r) for r in stats.size_by(df, "k").collect()] == [(0, 1), (1, 2)]


@pytest.mark.parametrize(
    "values", [[1.0, 2.0, 2.5, 9.0, 10.0, None], [4.0, 4.0], [0.0, 100.0], [3.0]]
)
def test_histogram_equals_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = stats.histogram(df, "x").orderBy("bin").collect()
    counts, edges = np.histogram([v for v in values if v is not None], bins=10)
    assert [r.n_trips for r in got] == counts.tolist()
    assert [r.bin_start for r in got] == pytest.approx(edges[:-1])
    assert [r.bin_end for r in got] == pytest.approx(edges[1:])


def test_histogram_of_nothing(spark):
    df = spark.createDataFrame([], "x double")
    assert [r.n_trips for r in stats.histogram(df, "x").collect()] == [0] * 10


def test_known_histogram(spark):
    df = add_features(clean(trips(spark, "/root/testdata/sf0.01")))
    got = [r.n_trips for r in stats.histogram(df, "hav_distance_km").orderBy("bin").collect()]
    assert got == [397, 990, 1175, 1395, 1475, 1132, 934, 461, 308, 65]


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (8.0, 6.0), (None, 1.0)], "y double, p double")
    assert stats.rmse(df, "y", "p").first()[0] == pytest.approx((5 / 3) ** 0.5)
    assert stats.r2(df, "y", "p").first()[0] == pytest.approx(1 - 5 / 26)
