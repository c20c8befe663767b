from __future__ import annotations

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from farelane.operators.demand import HALF_HOUR, HOUR, demand_fare_corr, demand_fare_table, rolling_count, rolling_counts
from farelane.operators.quality import clean
from farelane.sources.derived import trips

START = dt.datetime(2024, 1, 1)


def _trips(spark, rows):
    """Rows of (minute or None, fare); the key is the position."""
    data = [
        (i, None if m is None else START + dt.timedelta(minutes=m), f) for i, (m, f) in enumerate(rows)
    ]
    return spark.createDataFrame(data, "key long, pickup_datetime timestamp, fare_amount double")


def _counts(df, width=HALF_HOUR, **options):
    return {r.key: r.n for r in rolling_count(df, width, "n", **options).collect()}


def _brute_force(rows, minutes):
    expected = {}
    for key, (at, _) in enumerate(rows):
        if at is not None:
            expected[key] = sum(
                fare is not None and t is not None and (at - minutes < t < at or (t == at and k <= key))
                for k, (t, fare) in enumerate(rows)
            )
    return expected


def test_ties(spark):
    rows = [(0, 1.0), (0, 2.0), (10, None), (30, 4.0), (30, 5.0), (40, 6.0)]
    assert list(_counts(_trips(spark, rows)).values()) and _counts(_trips(spark, rows)) == dict(
        enumerate([1, 2, 2, 1, 2, 3])
    )


def test_before_the_epoch_and_without_time(spark):
    rows = [(-40_000_000, 1.0), (-39_999_990, 2.0), (None, 3.0)]
    assert _counts(_trips(spark, rows)) == {0: 1, 1: 2}


@pytest.mark.parametrize("slice_rows", [10_000_000, 40, 5])
def test_crowded_instant_and_bucket(spark, slice_rows):
    """A third of the trips at one instant, a third in one half hour, the rest spread; whether
    or not their buckets count as hot."""
    rng = random.Random(3)
    rows = [(95, rng.choice([None, 1.0]))] * 60
    rows += [(rng.uniform(120, 150), 1.0) for _ in range(60)]
    rows += [(rng.uniform(0, 600), rng.choice([None, 2.0, 3.0])) for _ in range(60)]
    rows = [(None if m is None else round(m, 3), f) for m, f in rows]
    rng.shuffle(rows)
    df = _trips(spark, rows).repartition(5)
    assert _counts(df, slice_rows=slice_rows) == _brute_force(rows, 30)
    assert _counts(df, HOUR, slice_rows=slice_rows) == _brute_force(rows, 60)


@pytest.mark.parametrize("slice_rows", [10_000_000, 7])
def test_several_widths_at_once(spark, slice_rows):
    """Also widths of which one is not a part of the other, equal ones, and trips on bucket edges."""
    rng = random.Random(8)
    rows = [(rng.choice([0, 30, 60, 90, rng.uniform(-100, 200)]), rng.choice([None, 1.0, 2.0])) for _ in range(150)]
    rows = [(round(m, 3), f) for m, f in rows]
    widths = {"a": HALF_HOUR, "b": HOUR, "c": 25 * 60_000_000, "d": HOUR, "e": 1}
    got = rolling_counts(_trips(spark, rows).repartition(3), widths, slice_rows=slice_rows).collect()
    for name, us in widths.items():
        assert {r.key: r[name] for r in got} == _brute_force(rows, us / 60_000_000)


def test_equals_pandas_rolling(spark, sf_dir):
    df = clean(trips(spark, sf_dir))
    got = _counts(df)
    frame = df.select("key", "pickup_datetime", "fare_amount").toPandas()
    frame = frame.sort_values(["pickup_datetime", "key"]).set_index("pickup_datetime")
    expected = frame.rolling("30min").fare_amount.count().astype(int)
    assert got == dict(zip(frame.key, expected))


def test_all_columns_and_rows_stay(spark, sf_dir):
    df = trips(spark, sf_dir)
    counted = rolling_count(df, HALF_HOUR, "n", slice_rows=10)
    assert counted.columns == [*df.columns, "n"]
    assert df.exceptAll(counted.drop("n")).isEmpty()


def test_demand_fare(spark):
    df = spark.createDataFrame(
        [(1, 2.0), (1, 4.0), (2, 9.0), (2, None), (3, None)], "n_before long, fare_amount double"
    )
    table = {r.n_before: (r.n, r.mean_fare, r.median_fare) for r in demand_fare_table(df, "n_before").collect()}
    assert table == {1: (2, 3.0, 3.0), 2: (1, 9.0, 9.0), 3: (0, None, None)}
    expected = pd.Series([1.0, 1.0, 2.0]).corr(pd.Series([2.0, 4.0, 9.0]))
    assert demand_fare_corr(df, "n_before").first()[0] == pytest.approx(expected)


def test_running_total_of_hot_groups(spark):
    from farelane.operators.running import running_total

    df = spark.range(1000).select(
        F.when(F.col("id") < 600, 0).otherwise(F.col("id") % 7).alias("g"), "id", (F.col("id") % 5).alias("x")
    )
    results = [
        {tuple(r) for r in running_total(df, ["g"], ["id"], F.col("x"), F.col("x"), hot).collect()}
        for hot in (10_000, 100, 3)
    ]
    assert results[0] == results[1] == results[2]
    assert len(results[0]) == 1000
