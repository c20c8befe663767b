from __future__ import annotations

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from farelane.functions.features import add_features
from farelane.operators import model as m
from farelane.operators.quality import clean
from farelane.operators.split import split_trips, with_fold
from farelane.operators.stats import r2, rmse
from farelane.plans.jobs import evaluate_file, run_inference, train
from farelane.schema import LABEL, TRIP_REQUEST
from farelane.sources.derived import trips
from farelane.sources.sinks import load_model, read_split, save_model

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def folded(spark):
    labelled = split_trips(trips(spark, SF))
    training = labelled.filter("split_name = 'training'")
    validation = labelled.filter("split_name = 'validation'")
    return add_features(clean(with_fold(training, validation))).persist()


@pytest.fixture(scope="module")
def tuned(folded):
    return m.tune(folded, (3, 4), (2, 5))


def test_grid(tuned, spark):
    assert [(p.max_depth, p.n_trees) for p in tuned.grid] == [(3, 2), (3, 5), (4, 2), (4, 5)]
    assert tuned.best.r2 == max(p.r2 for p in tuned.grid) > 0.85
    rows = tuned.grid_frame(spark).collect()
    assert [r.is_best for r in rows].count(True) == 1


def test_grid_scores_equal_separate_fits(tuned, folded):
    """The first trees of a longer fit are the shorter fit."""
    validation = m.with_label(folded.filter("split = 0"))
    for point in tuned.grid[:3]:
        model = m.fit_gbt(folded.filter("split = -1"), point.max_depth, point.n_trees)
        scored = m.score(model, validation)
        assert r2(scored, LABEL, "predictions").first()[0] == pytest.approx(point.r2, abs=1e-12)


def test_metrics_equal_the_evaluator(tuned, folded):
    scored = m.with_label(m.score(tuned.model, folded))
    for name, ours in (("rmse", rmse), ("r2", r2)):
        evaluator = RegressionEvaluator(labelCol=LABEL, predictionCol="predictions", metricName=name)
        expected = evaluator.evaluate(scored)
        assert ours(scored, LABEL, "predictions").first()[0] == pytest.approx(expected)


def test_first_of_equal_points_wins():
    point = m.GridPoint
    grid = [point(3, 50, 0.5), point(3, 100, 0.7), point(4, 50, 0.7)]
    assert max(grid, key=lambda p: p.r2) == grid[1]


def test_round_trip(spark, tuned, folded, tmp_path):
    path = str(tmp_path / "artifact")
    save_model(tuned.model, path, tuned.grid_frame(spark))
    save_model(tuned.model, path, tuned.grid_frame(spark))
    before = m.score(tuned.model, folded).select("key", "predictions")
    after = m.score(load_model(path), folded).select("key", "predictions")
    assert before.exceptAll(after).isEmpty()
    assert spark.read.json(f"{path}/grid").count() == 4


def test_scoring_keeps_rows_and_columns(spark, tuned):
    df = add_features(trips(spark, SF)).withColumn("extra", F.lit("x"))
    scored = m.score(tuned.model, df)
    assert scored.columns == [*df.columns, "predictions"]
    assert scored.count() == scored.filter("predictions IS NOT NULL").count() == 10000


def test_missing_features_can_be_learned_from(folded):
    holes = folded.withColumns(
        {
            "hour": F.when(F.col("key") % 5 != 0, F.col("hour")),
            "hav_distance_km": F.when(F.col("key") % 7 != 0, F.col("hav_distance_km")),
        }
    )
    scored = m.score(m.fit_gbt(holes, 3, 3), holes)
    assert scored.filter("predictions IS NULL OR isnan(predictions)").isEmpty()


def test_cells_give_the_trees_that_rows_give(folded):
    """A fit on weighted cells and one on every binned row for itself make the same cuts."""
    rows = m.with_label(folded).drop("split")
    cuts = m.feature_cuts(rows)
    matrix = m.feature_matrix(rows, cuts)
    n = rows.count()
    assert matrix.cells.agg(F.sum("rows")).first()[0] == n > matrix.cells.count()
    whole = matrix.inputs.transform(rows).withColumn("rows", F.lit(1.0))
    bins = max(len(c) for c in cuts.values()) + 1
    a, b = (m._fit_trees(x, 3, 4, bins) for x in (matrix.cells, whole))
    vectors = matrix.inputs.transform(rows)
    both = b.setPredictionCol("other").transform(a.transform(vectors))
    assert both.agg(F.max(F.abs(F.col("prediction") - F.col("other")))).first()[0] < 1e-9


def test_cuts(spark):
    rows = [(None, 3, 1.0), (0.5, 3, 2.0), (1.5, None, 3.0), (2.5, 5, 4.0)] + [(i / 10, 3, 1.0) for i in range(100, 300)]
    df = spark.createDataFrame(rows, "hav_distance_km double, day_of_week int, fare_amount double")
    cuts = m.feature_cuts(df, ("hav_distance_km", "day_of_week"), bins=8)
    assert cuts["day_of_week"] == [1.0, 4.0]
    assert cuts["hav_distance_km"][0] == -0.5 and len(cuts["hav_distance_km"]) == 8
    assert cuts["hav_distance_km"] == sorted(set(cuts["hav_distance_km"]))
    one = m.feature_cuts(df.limit(1).select("day_of_week", "fare_amount"), ("day_of_week",))
    assert one == {"day_of_week": [0.0]}


def test_a_fit_is_made_anew_for_other_rows(spark, tmp_path):
    """The same folder with another table in it gives another model."""
    from farelane.catalog.models import fitted

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.write.parquet(str(tmp_path / "events.parquet"))
    first = fitted(spark, str(tmp_path)).stages[-1].toDebugString
    events.withColumn("user_id", F.lit(0)).withColumn("event_id", F.col("event_id") * 3).write.mode("overwrite").parquet(str(tmp_path / "events.parquet"))
    spark.catalog.refreshByPath(str(tmp_path / "events.parquet"))
    assert fitted(spark, str(tmp_path)).stages[-1].toDebugString != first


def test_jobs_report_bad_lines(spark, tmp_path):
    path, root, artifact = (str(tmp_path / n) for n in ("t.csv", "splits", "artifact"))
    text = F.date_format("pickup_datetime", "yyyy-MM-dd HH:mm:ss 'UTC'")
    broken = trips(spark, "/root/testdata/sf0.001").withColumn("pickup_datetime", text)
    broken = broken.withColumn("fare_amount", F.when(F.col("key") % 100 == 0, "x").otherwise(F.col("fare_amount").cast("string")))
    broken.write.option("header", True).csv(path)
    tuned = train(spark, path, root, artifact, max_depths=(2,), n_trees=(2,))
    assert tuned.rejected == 10 and spark.read.parquet(f"{root}-rejects").count() == 10
    again = train(spark, path, root, artifact, max_depths=(2,), n_trees=(2,))
    assert again.rejected == 10
    row = evaluate_file(spark, artifact, path, rejects=str(tmp_path / "bad")).first()
    assert row.n_rejected == 10 and row.rmse > 0
    found = run_inference(spark, path, str(tmp_path / "out"), artifact, rejects=str(tmp_path / "bad"))
    assert (found.rows, found.rejected) == (1000, 10)
    assert spark.read.parquet(str(tmp_path / "out")).filter("predictions IS NOT NULL").count() == 1000
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 10
    with pytest.raises(ValueError, match="json"):
        evaluate_file(spark, artifact, "x.json")


def test_jobs(spark, tmp_path):
    path, root, artifact = (str(tmp_path / n) for n in ("t.parquet", "splits", "artifact"))
    trips(spark, SF).write.parquet(path)
    tuned = train(spark, path, root, artifact, max_depths=(3,), n_trees=(5,))
    assert tuned.best.r2 > 0.85
    error = evaluate_file(spark, artifact, f"{root}/split_name=test").first()["rmse"]
    test = add_features(clean(read_split(spark, root, "test")))
    assert error == pytest.approx(m.evaluate(tuned.model, test).first()[0])
    assert 0 < error < 2

    requests, out = str(tmp_path / "requests.csv"), str(tmp_path / "out")
    trips(spark, SF).select(*TRIP_REQUEST.fieldNames()).write.option("header", True).csv(requests)
    run_inference(spark, requests, out, artifact, files=4)
    assert spark.read.parquet(out).filter("predictions IS NOT NULL").count() == 10000
