"""Training, tuning, scoring and evaluation over the whole grid; scoring uses one of its points."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farelane.catalog import query, sql
from farelane.functions.features import add_features
from farelane.operators import model as m
from farelane.operators.quality import clean
from farelane.operators.split import split_trips, with_fold
from farelane.operators.stats import r2
from farelane.plans.jobs import evaluate_file, run_inference, train
from farelane.schema import LABEL
from farelane.session import fresh_path
from farelane.sources.derived import trips
from farelane.sources.sinks import load_model, save_model
from farelane.sources.sinks import write_predictions as write

# The grid point whose model is scored.
DEPTH, TREES = m.MAX_DEPTHS[0], m.N_TREES[0]

# Calendar features alone have few values, so that SQL can find the best cut of a tree of depth 1.
CALENDAR = ("day_of_week", "hour")


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_features(clean(trips(spark, sf_dir)))


def fitted(spark: SparkSession, sf_dir: str) -> PipelineModel:
    """The model of that point, fitted anew by each query."""
    return m.fit_gbt(_cleaned(spark, sf_dir), DEPTH, TREES)


def _scored_rows(scored: DataFrame) -> DataFrame:
    return scored.select(
        "key",
        F.round("hav_distance_km", 6).alias("hav_distance_km"),
        "day_of_week",
        "hour",
        F.col("predictions").isNotNull().alias("has_prediction"),
    )


_SCORED_SQL = sql.with_trips(
    f"""SELECT key, round({sql.DISTANCE}, 6) AS hav_distance_km, {sql.DAY} AS day_of_week,
        {sql.HOUR} AS hour, TRUE AS has_prediction FROM trips"""
)


# Least share of the fares' variance that a fitted model explains.
_GOOD = 0.85
_GRID_SQL = """SELECT d.max_depth, t.n_trees, TRUE AS good FROM (VALUES (3), (4)) d(max_depth)
    CROSS JOIN (VALUES (50), (100)) t(n_trees)"""


def _good_points(grid: DataFrame) -> DataFrame:
    """Each point with whether it explains enough; the best of them has to be marked, once."""
    marked = F.sum(F.col("is_best").cast("int")).over(Window.partitionBy())
    most = F.max("r2").over(Window.partitionBy())
    best = (marked == 1) & (~F.col("is_best") | (F.col("r2") == most))
    return grid.withColumn("good", best & (F.col("r2") > _GOOD)).select("max_depth", "n_trees", "good")


@query(
    sql.with_trips(
        f"SELECT 3 AS max_depth, 50 AS n_trees, count(fare_amount) AS n_scored, TRUE AS good FROM trips WHERE {sql.CLEAN}"
    )
)
def train_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = m.score(fitted(spark, sf_dir), _cleaned(spark, sf_dir)).filter(F.col(LABEL).isNotNull())
    count = scored.agg(F.count("predictions").alias("n_scored"))
    return r2(scored, LABEL, "predictions").withColumn("n_scored", count.scalar()).select(
        F.lit(DEPTH).alias("max_depth"), F.lit(TREES).alias("n_trees"), "n_scored", (F.col("r2") > _GOOD).alias("good")
    )


@query(_GRID_SQL)
def grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = split_trips(trips(spark, sf_dir))
    training, validation = (
        labelled.filter(F.col("split_name") == name) for name in ("training", "validation")
    )
    folded = add_features(clean(with_fold(training, validation)))
    return _good_points(m.tune(folded).grid_frame(spark))


def _trained_files(spark: SparkSession, sf_dir: str) -> tuple[str, str, m.Tuned]:
    path, root = fresh_path(spark, "trips") + ".parquet", fresh_path(spark, "splits")
    artifact = fresh_path(spark, "model")
    trips(spark, sf_dir).write.parquet(path)
    return root, artifact, train(spark, path, root, artifact)


@query(_GRID_SQL)
def train_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, artifact, _ = _trained_files(spark, sf_dir)
    grid = spark.read.schema("max_depth int, n_trees int, r2 double, is_best boolean")
    return _good_points(grid.json(f"{artifact}/grid"))


@query(
    sql.with_trips(
        f"""SELECT feature, cut, round(below, 6) AS mean_below, round(above, 6) AS mean_above,
              round(sqrt(avg(pow({sql.STUMP_ERROR}, 2))), 6) AS rmse
            FROM cleaned, best WHERE fare_amount IS NOT NULL GROUP BY feature, cut, below, above""",
        sql.CLEANED,
        *sql.best_cut("cleaned"),
    )
)
def boosting_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tree of depth 1: its cut, its leaves and its error."""
    cleaned = _cleaned(spark, sf_dir)
    model = m.fit_gbt(cleaned, 1, 1, CALENDAR)
    rows = [m.first_cut(model)]
    cut = spark.createDataFrame(rows, "feature string, cut double, mean_below double, mean_above double")
    error = m.evaluate(model, cleaned).scalar()
    return cut.select("feature", "cut", *[F.round(c, 6).alias(c) for c in ("mean_below", "mean_above")], F.round(error, 6).alias("rmse"))


@query(
    sql.with_trips(
        f"""SELECT round(sqrt(avg(pow({sql.STUMP_ERROR}, 2))), 6) AS rmse, CAST(0 AS BIGINT) AS n_rejected
            FROM held, best WHERE split_name = 'test' AND fare_amount IS NOT NULL""",
        sql.SPLITS,
        sql.HELD,
        "learnt AS (SELECT * FROM held WHERE split_name <> 'test')",
        *sql.best_cut("learnt"),
    )
)
def evaluate_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The error on the test split of a model that the train job made, a tree of depth 1."""
    path, root = fresh_path(spark, "trips") + ".parquet", fresh_path(spark, "splits")
    artifact = fresh_path(spark, "model")
    trips(spark, sf_dir).write.parquet(path)
    train(spark, path, root, artifact, max_depths=(1,), n_trees=(1,), features=CALENDAR)
    error = evaluate_file(spark, artifact, f"{root}/split_name=test")
    return error.select(F.round("rmse", 6).alias("rmse"), "n_rejected")


@query(
    sql.with_trips(
        f"""SELECT 1 AS max_depth, 1 AS n_trees,
              round(1 - sum(pow({sql.STUMP_ERROR}, 2)) / sum(pow(fare_amount - mean, 2)), 6) AS r2
            FROM held, best, (SELECT avg(fare_amount) AS mean FROM held WHERE split_name = 'validation')
            WHERE split_name = 'validation' AND fare_amount IS NOT NULL""",
        sql.SPLITS,
        sql.HELD,
        "learnt AS (SELECT * FROM held WHERE split_name = 'training')",
        *sql.best_cut("learnt"),
    )
)
def grid_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R² on the validation fold of a grid of one point, a tree of depth 1."""
    labelled = split_trips(trips(spark, sf_dir))
    training, validation = (labelled.filter(F.col("split_name") == name) for name in ("training", "validation"))
    tuned = m.tune(add_features(clean(with_fold(training, validation))), (1,), (1,), CALENDAR)
    return tuned.grid_frame(spark).select("max_depth", "n_trees", F.round("r2", 6).alias("r2"))


@query(sql.with_trips(f"SELECT count(*) AS n_rows, count(*) AS n_equal FROM trips WHERE {sql.CLEAN}"))
def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, artifact = fitted(spark, sf_dir), fresh_path(spark, "model")
    save_model(model, artifact)
    before = m.score(model, _cleaned(spark, sf_dir)).withColumnRenamed("predictions", "before")
    after = m.score(load_model(artifact), before)
    equal = F.count_if(F.col("before") == F.col("predictions"))
    return after.agg(F.count(F.lit(1)).alias("n_rows"), equal.alias("n_equal"))


@query(_SCORED_SQL)
def batch_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = m.score(fitted(spark, sf_dir), add_features(trips(spark, sf_dir)))
    return _scored_rows(scored)


@query(_SCORED_SQL)
def write_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "predictions")
    write(m.score(fitted(spark, sf_dir), add_features(trips(spark, sf_dir))), path)
    return _scored_rows(spark.read.parquet(path))


@query(_SCORED_SQL)
def batch_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, path = fresh_path(spark, "trips") + ".parquet", fresh_path(spark, "predictions")
    artifact = fresh_path(spark, "model")
    trips(spark, sf_dir).write.parquet(source)
    save_model(fitted(spark, sf_dir), artifact)
    run_inference(spark, source, path, artifact)
    return _scored_rows(spark.read.parquet(path))
