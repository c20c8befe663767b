"""The physical plans the operators are meant to get."""

from __future__ import annotations

import pytest

from farelane.functions.features import add_features
from farelane.operators import model as m
from farelane.operators.demand import HALF_HOUR, rolling_count
from farelane.operators.quality import clean
from farelane.operators.sampling import head_sample
from farelane.operators.split import split_trips
from farelane.plans.explore import trim_quantile
from farelane.sources.derived import trips
from farelane.sources.readers import read_trips
from farelane.sources.sinks import read_split, write_splits


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "t.parquet")
    trips(spark, "/root/testdata/sf0.001").write.parquet(path)
    return path


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_cleaning_reaches_the_scan(spark, stored):
    text = read_trips(spark, stored, only_valid=True)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    pushed = text[text.index("PushedFilters") :]
    for name in ("pickup_longitude", "dropoff_longitude"):
        assert f"GreaterThanOrEqual({name},-180.0)" in pushed
        assert f"LessThanOrEqual({name},180.0)" in pushed
    assert "GreaterThan(fare_amount,2.5)" in pushed
    assert "LessThanOrEqual(passenger_count,6)" in pushed


def test_only_needed_columns_are_read(spark, stored):
    text = plan(read_trips(spark, stored).select("fare_amount"))
    assert "ReadSchema: struct<fare_amount:double>" in text


def test_features_and_scores_stay_in_the_jvm(spark, stored):
    featured = add_features(read_trips(spark, stored))
    assert "Exchange" not in plan(featured)
    assert "Python" not in plan(featured)
    scored = m.score(m.fit_gbt(featured, 3, 2), featured)
    assert "Python" not in plan(scored) and "Exchange" not in plan(scored)


def test_rolling_count_is_sliced_and_has_no_single_task(spark, stored):
    text = plan(rolling_count(read_trips(spark, stored), HALF_HOUR, "n"))
    assert "SinglePartition" not in text and "slice_" in text
    # Only the saved slices are read again, not the source.
    assert stored not in text


def test_labels_cuts_and_trims_do_not_shuffle(spark, stored):
    df = read_trips(spark, stored)
    for result in (clean(df), split_trips(df), head_sample(df, 100), trim_quantile(df, "fare_amount", 0.9)):
        assert "Exchange" not in plan(result)
    assert "LessThan(key," in plan(head_sample(df, 100))
    assert "LessThanOrEqual(passenger_count," in plan(trim_quantile(df, "passenger_count", 0.98))


def test_a_split_reads_its_own_folder(spark, stored, tmp_path):
    write_splits(split_trips(read_trips(spark, stored)), str(tmp_path / "s"))
    text = plan(read_split(spark, str(tmp_path / "s"), "training"))
    assert "PartitionFilters: [isnotnull(split_name" in text
