from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelane.operators import quantiles
from farelane.operators.quantiles import exact_quantile, order_stats

RNG = random.Random(7)
TABLES = {
    "uniform": [RNG.uniform(-5, 5) for _ in range(3000)],
    "hot_value": [3.25] * 1500 + [RNG.uniform(0, 10) for _ in range(1500)],
    "outliers": [RNG.expovariate(1) for _ in range(2000)] + [1e300, -1e300, 1e12],
    "infinite": [1.0, 2.0, 3.0, 4.0, float("inf"), float("-inf"), 1.7e308, -1.7e308],
    "tiny": [5e-324, 1e-323, 0.0, 1.5e-323],
    "close": [1.0 + i * 2**-52 for i in range(1000)],
    "one": [42.0],
    "with_missing": [None, 1.0, float("nan"), 2.0, 4.0],
}


@pytest.mark.parametrize("name", TABLES)
def test_equals_numpy(spark, name):
    values = TABLES[name]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    present = [v for v in values if v is not None and not math.isnan(v)]
    for q in (0.0, 0.5, 0.98, 1.0):
        if name == "infinite":
            # No interpolation next to an infinity, where numpy gives NaN.
            expected = {0.0: min(present), 0.5: 2.5}.get(q, max(present))
        else:
            expected = float(np.quantile(present, q))
        got = exact_quantile(df, "x", q)
        assert got == pytest.approx(expected, rel=1e-12, abs=1e-15) or got == expected


def test_empty_and_all_null(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert exact_quantile(df, "x", 0.5) is None
    assert exact_quantile(df.limit(0), "x", 0.5) is None


def test_integers_beyond_double_precision(spark):
    base = 2**60
    values = [base + i for i in range(500)] + [-base, 2**63 - 1, -(2**63)]
    df = spark.createDataFrame([(v,) for v in values], "x long").repartition(3)
    count, stats = order_stats(df, "x", range)
    assert count == len(values)
    assert [stats[r].lo for r in range(count)] == sorted(values)


@pytest.mark.parametrize("values", [[3, 1, 2, 2, 2, None], [-(2**31), 5, 6, 2**31 - 1], [None], []])
def test_small_integers(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x int").repartition(2)
    count, cells = order_stats(df, "x", range)
    ordered = sorted(v for v in values if v is not None)
    assert count == len(ordered)
    assert [cells[r].lo for r in range(count)] == ordered
    expected = float(np.quantile(ordered, 0.9)) if ordered else None
    assert exact_quantile(df, "x", 0.9) == pytest.approx(expected)


@pytest.mark.parametrize("few", [0, 50])
def test_many_passes(spark, monkeypatch, few):
    """Few cells and a coarse sketch only mean more passes, not other results."""
    monkeypatch.setattr(quantiles, "FEW", few)
    monkeypatch.setattr(quantiles, "CELLS", 4)
    monkeypatch.setattr(quantiles, "SKETCH_ACCURACY", 2)
    values = TABLES["hot_value"]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    ordered = sorted(values)
    _, stats = order_stats(df, "x", lambda n: [0, 10, n // 2, n - 1])
    assert {r: s.value_at(r) for r, s in stats.items()} == {r: ordered[r] for r in stats}
    for cell in stats.values():
        assert cell.lo == cell.hi
        assert cell.below == sum(v < cell.lo for v in values)
        assert cell.n == values.count(cell.lo)
    for q in (0.1, 0.5, 0.999):
        assert exact_quantile(df, "x", q) == pytest.approx(float(np.quantile(values, q)), rel=1e-12)


@pytest.mark.parametrize("few", [4, 10_000])
def test_a_wrong_sketch_only_costs_passes(spark, monkeypatch, few):
    """Brackets far from the ranks, with and without the table of the bracket."""
    monkeypatch.setattr(quantiles, "FEW", few)
    values = sorted(TABLES["uniform"])
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    wrong = quantiles.Sketch(len(values), [values[1000 + i] for i in range(quantiles.GRID + 1)])
    for q in (0.0, 0.3, 0.5, 0.9, 1.0):
        assert exact_quantile(df, "x", q, wrong) == pytest.approx(float(np.quantile(values, q)), rel=1e-12)


@pytest.mark.parametrize("spread", [8, 5000, 10**12])
def test_chained_quantiles(spark, spread):
    """Whole numbers beyond the ones that are counted singly take the longer way."""
    rng = random.Random(spread)
    rows = [(rng.choice([None, rng.randint(-spread // 4, spread)]), rng.choice([None, rng.expovariate(1)])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "k long, x double").repartition(5)
    first, second = quantiles.chained_quantiles(df, "k", 0.98, F.col("x"), 0.99)
    cut = np.quantile([k for k, _ in rows if k is not None], 0.98)
    left = [x for k, x in rows if x is not None and (k is None or k <= cut)]
    assert first == pytest.approx(cut) and second == pytest.approx(np.quantile(left, 0.99), rel=1e-12)


def test_chained_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None, 1.0), (None, None)], "k int, x double")
    assert quantiles.chained_quantiles(df, "k", 0.5, F.col("x"), 0.5) == (None, 1.0)
    assert quantiles.chained_quantiles(df.limit(0), "k", 0.5, F.col("x"), 0.5) == (None, None)


def test_equals_percentile(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    got = exact_quantile(df, F.col("l_extendedprice").cast("double"), 0.37)
    expected = df.select(F.percentile(F.col("l_extendedprice").cast("double"), 0.37)).first()[0]
    assert got == pytest.approx(expected, rel=1e-12)
