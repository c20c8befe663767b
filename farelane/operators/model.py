"""Fitting, tuning, scoring and evaluating the fare regressor."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.functions.features import BINNED, FILLED, MISSING, binned_input, filled_features
from farelane.operators.split import SEED, TRAIN_FOLD, VALIDATION_FOLD
from farelane.operators.stats import rmse
from farelane.schema import FEATURES, LABEL
from farelane.session import ensure_checkpoint_dir, save_table

# The tuning grid and the learning rate.
MAX_DEPTHS = (3, 4)
N_TREES = (50, 100)
LEARNING_RATE = 0.3


@dataclass(frozen=True)
class GridPoint:
    max_depth: int
    n_trees: int
    r2: float


@dataclass(frozen=True)
class Tuned:
    """The grid in order, its best point (the first among equals), the model refit on training
    and validation rows together, and how many lines of the input did not parse."""

    grid: list[GridPoint]
    best: GridPoint
    model: PipelineModel
    rejected: int = 0

    def grid_frame(self, spark) -> DataFrame:
        rows = [(p.max_depth, p.n_trees, p.r2, p == self.best) for p in self.grid]
        return spark.createDataFrame(rows, "max_depth int, n_trees int, r2 double, is_best boolean")


def with_label(df: DataFrame) -> DataFrame:
    """Rows a regressor can learn from. Cleaning keeps null labels; fitting cannot."""
    return df.filter(F.col(LABEL).isNotNull())


#: Bins of a feature with many values, the sketch that finds their cuts, and the cells of a partition.
BINS, SKETCH_ACCURACY, PARTITION_CELLS = 32, 10_000, 50_000


@dataclass(frozen=True)
class Matrix:
    """Labelled rows cut into bins once, for any number of fits.

    Trees ask only on which side of a cut a feature is, so rows that agree in all bins are one cell,
    with their number (``rows``), mean label and the spread of their labels (``within``, a sum of
    squares) beside the fold. For a squared loss the cells, weighted, give the trees that the rows
    give. There are as many cells as combinations of bins at most, whatever the number of rows.
    """

    inputs: PipelineModel
    cells: DataFrame
    cuts: dict[str, list[float]]

    def fold(self, split: int) -> DataFrame:
        return self.cells.filter(F.col("split") == split)


def feature_cuts(df: DataFrame, features: tuple[str, ...] = tuple(FEATURES), bins: int = BINS) -> dict[str, list[float]]:
    """The cuts between the bins of each feature: midpoints of its values where they are few, else
    quantiles; what is missing has a bin of its own. Two passes at most, one row each."""
    filled = filled_features(features).transform(df)
    ranks = [i / bins for i in range(1, bins)]
    asked = []
    for name in features:
        value = F.col(f"{name}_filled")
        real = F.when(value != MISSING, value)
        asked += [
            F.percentile_approx(real, ranks, SKETCH_ACCURACY).alias(f"{name}_ranks"),
            F.approx_count_distinct(value).alias(f"{name}_values"),
            F.min(value).alias(f"{name}_least"),
        ]
    found = filled.agg(*asked).first()
    # A set of values is asked for only where a sketch says that it is small.
    few = [name for name in features if found[f"{name}_values"] <= 2 * bins]
    sets = filled.agg(*[F.collect_set(f"{n}_filled").alias(n) for n in few]).first() if few else {}
    cuts = {}
    for name in features:
        values = sorted(sets[name]) if name in few else []
        if name in few and len(values) <= bins:
            own = [(a + b) / 2 for a, b in zip(values, values[1:])]
        else:
            own = sorted(set(found[f"{name}_ranks"] or []))
            if found[f"{name}_least"] == MISSING:
                own = [MISSING / 2, *[c for c in own if c > MISSING / 2]]
        cuts[name] = own or [0.0]
    return cuts


def feature_matrix(df: DataFrame, cuts: dict[str, list[float]]) -> Matrix:
    """The labelled rows of ``df`` in cells, per ``split`` if it has one; combined on the map side and
    written, so that no fit reads the rows again."""
    inputs = binned_input(cuts)
    *to_bins, assemble = inputs.stages
    binned = PipelineModel(to_bins).transform(with_label(df))
    fold = F.col("split") if "split" in df.columns else F.lit(TRAIN_FOLD)
    keys = [f"{name}_bin" for name in cuts]
    cells = binned.groupBy(*keys, fold.alias("split")).agg(
        F.count(F.lit(1)).cast("double").alias("rows"),
        F.avg(LABEL).alias(LABEL),
        (F.var_pop(LABEL) * F.count(F.lit(1))).alias("within"),
    )
    saved = save_table(cells, "cells")
    parts = -(-saved.count() // PARTITION_CELLS)
    return Matrix(inputs, assemble.transform(saved.repartition(max(parts, 1), *keys)).drop(*keys), cuts)


def _fit_trees(cells: DataFrame, max_depth: int, n_trees: int, bins: int) -> GBTRegressionModel:
    ensure_checkpoint_dir(cells.sparkSession)
    booster = GBTRegressor(
        labelCol=LABEL,
        weightCol="rows",
        maxDepth=max_depth,
        maxIter=n_trees,
        maxBins=max(bins, 2),
        stepSize=LEARNING_RATE,
        seed=SEED,
    )
    return booster.fit(cells)


def _most_bins(cuts: dict[str, list[float]]) -> int:
    return max(len(c) for c in cuts.values()) + 1


def fit_gbt(df: DataFrame, max_depth: int, n_trees: int, features: tuple[str, ...] = tuple(FEATURES)) -> PipelineModel:
    """Gradient-boosted trees for the fare over ``features`` of ``df``."""
    matrix = feature_matrix(df.drop("split"), feature_cuts(with_label(df), features))
    trees = _fit_trees(matrix.cells, max_depth, n_trees, _most_bins(matrix.cuts))
    return PipelineModel([*matrix.inputs.stages, trees])


def first_cut(model: PipelineModel) -> tuple[str, float, float, float] | None:
    """The first cut of a model's first tree: the feature, the cut, and the values below and from it
    on, if these are leaves; None if the tree is a single leaf."""
    _, bins, _, assemble, trees = model.stages
    root = trees.trees[0]._java_obj.rootNode()
    if root.subtreeDepth() == 0:
        return None
    split = root.split()
    at = split.featureIndex()
    cut = bins.getSplitsArray()[at][int(split.threshold()) + 1]
    name = assemble.getInputCols()[at].removesuffix("_bin")
    return name, cut, root.leftChild().prediction(), root.rightChild().prediction()


def explained(error: float, variance: float) -> float:
    """R² from the mean squared error; of equal labels 1 if they are met and else 0."""
    if variance == 0:
        return float(error == 0)
    return 1 - error / variance


def tune(
    df: DataFrame,
    max_depths: tuple[int, ...] = MAX_DEPTHS,
    n_trees: tuple[int, ...] = N_TREES,
    features: tuple[str, ...] = tuple(FEATURES),
) -> Tuned:
    """Grid search on the one predefined fold: fit on ``split`` -1, rank by R² on ``split`` 0.

    The features are cut into bins once, by the rows that are trained on, and all fits share the
    cells. Boosting adds its trees one by one, so the first 50 of 100 trees are the 50-tree model:
    one fit per depth, with the most trees, scores every tree count of the grid, and one pass over
    the validation cells gives the error after each tree.
    """
    data = df.select(*features, LABEL, "split")
    cuts = feature_cuts(with_label(data).filter(F.col("split") == TRAIN_FOLD), features)
    matrix = feature_matrix(data, cuts)
    cells = matrix.cells.persist(StorageLevel.MEMORY_AND_DISK)
    fit = partial(_fit_trees, bins=_most_bins(cuts))
    try:
        training, validation = matrix.fold(TRAIN_FOLD), matrix.fold(VALIDATION_FOLD)
        mean = F.sum(F.col(LABEL) * F.col("rows")) / F.sum("rows")
        held = validation.agg(F.sum("rows").alias("n"), F.sum("within").alias("within"), mean.alias("mean")).first()
        if held.n is None:
            raise ValueError("the validation fold has no labelled rows")
        between = validation.agg(F.sum(F.col("rows") * F.pow(F.col(LABEL) - held.mean, 2))).first()[0]
        # What no model over these bins explains, and what there is to explain.
        within, variance = held.within / held.n, (held.within + between) / held.n

        @inheritable_thread_target(df.sparkSession)
        def scores(max_depth: int) -> list[GridPoint]:
            model = fit(training, max_depth, max(n_trees))
            mse = model.evaluateEachIteration(validation, "squared")
            return [GridPoint(max_depth, n, explained(mse[n - 1] + within, variance)) for n in n_trees]

        with ThreadPool(len(max_depths)) as pool:
            grid = [point for points in pool.map(scores, max_depths) for point in points]
        best = max(grid, key=lambda point: point.r2)
        refit = fit(cells, best.max_depth, best.n_trees)
    finally:
        cells.unpersist()
    return Tuned(grid, best, PipelineModel([*matrix.inputs.stages, refit]))


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``predictions``; every row and column of ``df`` stays, as does its order."""
    scored = model.transform(df).drop("features", *FILLED, *BINNED)
    return scored.withColumnRenamed("prediction", "predictions")


def evaluate(model: PipelineModel, df: DataFrame) -> DataFrame:
    """One row: the RMSE of the model on rows that carry features and label."""
    return rmse(score(model, df), LABEL, "predictions")
