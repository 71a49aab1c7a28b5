"""Random forest: fit, search, predict."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, replace
from itertools import product
from math import ceil
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import PredictionModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabstride.constants import FOLDS, FOREST_GRID, SEED
from tabstride.operators.running import running_totals
from tabstride.operators.splits import kfold
from tabstride.session import scratch_path

SEARCHED = list(FOREST_GRID)
# Rows of a part of a fit, and parts at least.  Bagging works part by part, so the number of
# parts belongs to the model like a seed; it follows from the number of rows alone.
PART_ROWS = 250_000
LEAST_PARTS = 8


def fixed_layout(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Rows placed and ordered by key, so that a seeded fit does not depend on the input files.

    Without ``partitions`` there are as many as the rows need.
    """
    partitions = partitions or max(LEAST_PARTS, ceil(df.count() / PART_ROWS))
    return df.repartition(partitions, key).sortWithinPartitions(key)


def _forest(seed: int, params: Mapping | None = None) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol="label", featuresCol="features", seed=seed, **dict(params or {})
    )


def rf_fit(
    df: DataFrame,
    params: Mapping | None = None,
    seed: int = SEED,
    key: str = "id",
    partitions: int | None = None,
) -> RandomForestClassificationModel:
    """Fit a forest on ``features, label`` in a layout fixed by ``key``."""
    # Several passes read the rows: metadata, split candidates, then the trees.
    placed = fixed_layout(df.select(key, "features", "label"), key, partitions).persist()
    try:
        return _forest(seed, params).fit(placed)
    finally:
        placed.unpersist()


def param_grid(
    forest: RandomForestClassifier, grid: Mapping[str, Sequence] = FOREST_GRID
) -> list[dict]:
    """All combinations of the searched values: 36 by default."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(forest.getParam(name), list(values))
    return builder.build()


@dataclass(frozen=True)
class NodeTable:
    """The nodes of a forest's trees, tree after tree; a leaf is its own child."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray
    depth: int

    def cut(self, depth: int) -> NodeTable:
        """The trees down to ``depth``; leaves of one parent and one class become their parent.

        That is how a forest of this depth is grown: splits do not look below themselves, and
        Spark prunes in this way.
        """
        here = np.arange(len(self.left))
        left, right = self.left.copy(), self.right.copy()
        levels = [self.roots]
        for _ in range(depth):
            inner = levels[-1][left[levels[-1]] != levels[-1]]
            levels.append(np.concatenate([left[inner], right[inner]]))
        left[levels[-1]] = right[levels[-1]] = levels[-1]
        active = self.share > 0.5
        for level in reversed(levels[:-1]):
            a, b = left[level], right[level]
            same = (left[a] == a) & (left[b] == b) & (active[a] == active[b])
            left[level[same]] = right[level[same]] = here[level[same]]
        return replace(self, left=left, right=right, depth=min(depth, self.depth))

    def votes(self, rows: np.ndarray, trees: Sequence[int]) -> np.ndarray:
        """Probability of class 1 by the first so many trees, a column for each number."""
        every, number = np.arange(len(rows)), 0
        total, out = np.zeros(len(rows)), np.empty((len(rows), len(trees)))
        for i in np.argsort(trees, kind="stable").tolist():
            while number < min(trees[i], len(self.roots)):
                at = np.full(len(rows), self.roots[number])
                for _ in range(self.depth):
                    lower = rows[every, self.feature[at]] <= self.threshold[at]
                    at = np.where(lower, self.left[at], self.right[at])
                total += self.share[at]
                number += 1
            out[:, i] = total / number
        return out


def node_table(model: RandomForestClassificationModel) -> NodeTable:
    """Read a forest of two classes over continuous features from its saved form.

    At most ``numTrees * 2 ** (maxDepth + 1)`` nodes reach the driver.
    """
    spark = SparkSession.active()
    path = scratch_path(spark, "forest")
    model.save(path)
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), "nodeData.id", F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"), "nodeData.split.featureIndex",
        F.try_element_at("nodeData.split.leftCategoriesOrThreshold", F.lit(1)).alias("threshold"),
        "nodeData.split.numCategories", "nodeData.impurityStats",
    ).toPandas().sort_values(["tree", "id"], ignore_index=True)
    leaf = nodes["left"].to_numpy() < 0
    if (nodes["numCategories"].to_numpy()[~leaf] >= 0).any():
        raise ValueError("The forest splits on categories")
    stats = np.stack(nodes["impurityStats"].to_numpy())
    if stats.shape[1] != 2:
        raise ValueError("The forest must have two classes")
    tree = nodes["tree"].to_numpy()
    first = np.searchsorted(tree, tree)  # place of the node's root; ids count from 0 in a tree
    here = np.arange(len(nodes))
    # Narrow numbers: a worker that scores a search holds the trees of all its fits.
    left, right = (np.where(leaf, here, first + nodes[c].to_numpy()).astype(np.int32)
                   for c in ("left", "right"))
    return NodeTable(
        np.unique(first), np.where(leaf, 0, nodes["featureIndex"]).astype(np.int32),
        np.where(leaf, 0.0, nodes["threshold"]).astype(float), left, right,
        stats[:, 1] / stats.sum(axis=1), model.getMaxDepth(),
    )


def fold_areas(scored: DataFrame) -> DataFrame:
    """Exact ROC area per ``fold`` and ``setting`` of rows with ``label, prob``.

    Null where a fold has rows of one class only.
    """
    keys = ["fold", "setting"]
    counts = scored.groupBy(*keys, "prob").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )
    ranked = running_totals(counts, [F.col("prob")], ["neg"], keys)
    wins = F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") / 2))
    pairs = F.sum("pos") * F.sum("neg")
    return ranked.groupBy(*keys).agg(F.when(pairs > 0, wins / pairs).alias("area"))


def rf_cross_validate(
    df: DataFrame,
    grid: Mapping[str, Sequence] = FOREST_GRID,
    folds: int = FOLDS,
    seed: int = SEED,
    key: str = "id",
    partitions: int | None = None,
    parallelism: int = 4,
) -> CrossValidatorModel:
    """Search the grid by mean ROC area over hash folds; the best setting is refitted.

    Per fold and combination of the other values one forest is fitted, of the most trees and
    the greatest depth asked for.  Smaller forests are prefixes of it: its first trees, which
    are drawn alike, cut at their depth.  All settings of all folds are scored in one pass over
    the rows, by votes summed tree by tree, and all areas are exact.  A fold without both
    classes has no area and no part in the mean.  At most ``parallelism`` forests are fitted at
    a time, fewer of a table of many parts.
    """
    forest = _forest(seed)
    settings = param_grid(forest, grid)
    values = [{p.name: v for p, v in s.items()} for s in settings]
    sizes = sorted(set(grid.get("numTrees", [forest.getNumTrees()])))
    depths = sorted(set(grid.get("maxDepth", [forest.getMaxDepth()])))
    others = [n for n in grid if n not in ("numTrees", "maxDepth")]
    fits = [dict(zip(others, v, strict=True)) for v in product(*[grid[n] for n in others])]
    shapes = list(product(fits, depths, sizes))
    largest = {"numTrees": sizes[-1], "maxDepth": depths[-1]}

    folded = kfold(df.select(key, "features", "label"), key, folds, seed)
    placed = fixed_layout(folded, key, partitions).persist()

    def fitted(task: tuple[int, dict]) -> list[NodeTable]:
        fold, params = task
        table = node_table(_forest(seed, params | largest).fit(placed.filter(F.col("fold") != fold)))
        return [table.cut(depth) for depth in depths]

    try:
        placed.count()
        # A fit holds a number per row and tree; a table of many parts keeps the cores busy alone.
        at_once = max(1, parallelism * LEAST_PARTS // max(LEAST_PARTS, placed.rdd.getNumPartitions()))
        tasks = [(fold, params) for fold in range(folds) for params in fits]
        with ThreadPool(at_once) as pool:
            tables = pool.map(inheritable_thread_target(df.sparkSession)(fitted), tasks, chunksize=1)
        shared = df.sparkSession.sparkContext.broadcast(
            [sum(tables[i * len(fits) : (i + 1) * len(fits)], []) for i in range(folds)]
        )

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                fold = batch.column("fold").to_numpy()
                for f in np.unique(fold).tolist():
                    rows = np.flatnonzero(fold == f)
                    lists = batch.column("x").take(pa.array(rows))
                    x = lists.flatten().to_numpy().reshape(len(rows), -1)
                    label = batch.column("label").take(pa.array(rows))
                    for i, table in enumerate(shared.value[f]):
                        for j, prob in enumerate(table.votes(x, sizes).T):
                            setting = np.full(len(rows), i * len(sizes) + j, np.int32)
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(fold[rows]), pa.array(setting), label, pa.array(prob)],
                                ["fold", "setting", "label", "prob"],
                            )

        inputs = placed.select("fold", F.col("label").cast("int").alias("label"),
                               vector_to_array("features").alias("x"))
        scored = inputs.mapInArrow(score, "fold int, setting int, label int, prob double")
        measured: dict[int, list[float]] = {}
        for row in fold_areas(scored).collect():  # one row per setting and fold
            if row["area"] is not None:
                measured.setdefault(row["setting"], []).append(row["area"])
        if not measured:
            raise ValueError("No fold has rows of both classes")
        areas = [
            measured[shapes.index((
                {n: v[n] for n in others}, v.get("maxDepth", depths[-1]), v.get("numTrees", sizes[-1])
            ))]
            for v in values
        ]
        means = [float(np.mean(a)) for a in areas]
        best = _forest(seed, values[int(np.argmax(means))]).fit(placed)
    finally:
        placed.unpersist()
    search = CrossValidator(
        estimator=forest, estimatorParamMaps=settings, numFolds=folds, parallelism=parallelism,
        evaluator=BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0), foldCol="fold",
    )
    return search._copyValues(
        CrossValidatorModel(best, means, stdMetrics=[float(np.std(a)) for a in areas])
    )


def best_params(model: CrossValidatorModel) -> dict[str, float]:
    """The searched values of the best forest."""
    best = model.bestModel
    return {name: best.getOrDefault(name) for name in SEARCHED}


def predict_forest(
    model: PredictionModel | CrossValidatorModel, df: DataFrame
) -> DataFrame:
    """Add raw prediction, probability vector and class."""
    return model.transform(df)
