"""Boosted regression trees for any loss: MLlib trees on pseudo-residuals, leaf values from grouped aggregates.

A round fits one least-squares tree to the loss's pseudo-residuals, asks it for the leaf of every row, and estimates
the leaf values anew for the loss by one aggregate over the leaves: a Newton step for counts (log link), a median with
clipped deviations for the robust loss, the mean for squared errors. Rows only carry features, label and score; the
score is cached from round to round and its lineage is cut by a checkpoint every few rounds.

The fitted model is a list of small arrays. It scores Arrow batches in one pass for all trees, and it can be stored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyridge.session import checkpoint_dir

ROWS_PER_PARTITION = 50_000
CUT_EVERY = 10
LOCAL_CHECKPOINTS = "/tmp/tallyridge-checkpoints"
SCORE_LIMIT = 30.0  # of the log link: counts up to e^30 and down to e^-30


def _param(name: str, doc: str, kind) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=kind)


class Squared:
    """Mean start, residuals, mean per leaf."""

    def start(self, y: Column) -> Column:
        return F.avg(y)

    def prepare(self, rows: DataFrame) -> None:
        """Nothing depends on the current residuals."""

    def residual(self, y: Column, score: Column) -> Column:
        return y - score

    def leaf_values(self, leaves: DataFrame) -> dict[int, float]:
        return _by_leaf(leaves, F.avg(F.col("y") - F.col("score")))

    def output(self, score: np.ndarray) -> np.ndarray:
        return score


class Poisson(Squared):
    """Counts with a log link: start at the log of the mean, one Newton step per leaf."""

    def start(self, y: Column) -> Column:
        return F.ln(F.greatest(F.avg(y), F.lit(1e-9)))

    def residual(self, y: Column, score: Column) -> Column:
        return y - F.exp(score)

    def leaf_values(self, leaves: DataFrame) -> dict[int, float]:
        mean = F.exp("score")
        return _by_leaf(leaves, F.sum(F.col("y") - mean) / F.greatest(F.sum(mean), F.lit(1e-9)))

    def output(self, score: np.ndarray) -> np.ndarray:
        return np.exp(np.clip(score, -SCORE_LIMIT, SCORE_LIMIT))


class Huber(Squared):
    """Median start; residuals are clipped at their ``share`` quantile; a leaf's value is its median residual plus the
    mean of the clipped deviations from it. Quantiles are nearest-rank and come from mergeable sketches."""

    accuracy = 10_000

    def __init__(self, share: float = 0.9):
        self.share, self.limit = share, 0.0

    def quantile(self, value: Column, share: float) -> Column:
        return F.percentile_approx(value, share, self.accuracy)

    def start(self, y: Column) -> Column:
        return self.quantile(y, 0.5)

    def prepare(self, rows: DataFrame) -> None:
        self.limit = rows.agg(self.quantile(F.abs(F.col("y") - F.col("score")), self.share).alias("q")).first()["q"] or 0.0

    def residual(self, y: Column, score: Column) -> Column:
        return F.greatest(F.least(y - score, F.lit(self.limit)), F.lit(-self.limit))

    def leaf_values(self, leaves: DataFrame) -> dict[int, float]:
        gap = F.col("y") - F.col("score")
        medians = _by_leaf(leaves, self.quantile(gap, 0.5))
        rest = gap - _looked_up(medians)
        clipped = F.greatest(F.least(rest, F.lit(self.limit)), F.lit(-self.limit))
        return {k: medians[k] + v for k, v in _by_leaf(leaves, F.avg(clipped)).items()}


LOSSES = {"squared": Squared, "poisson": Poisson, "huber": Huber}


def _by_leaf(leaves: DataFrame, value: Column) -> dict[int, float]:
    """One number per leaf: at most 2^depth rows reach the driver."""
    return {r["leaf"]: float(r["value"]) for r in leaves.groupBy("leaf").agg(value.alias("value")).collect()}


def _looked_up(values: dict[int, float]) -> Column:
    """The value of column ``leaf`` from a small array; leaves without rows get 0."""
    flat = [values.get(k, 0.0) for k in range(max(values, default=0) + 1)]
    return F.element_at(F.array(*map(F.lit, flat)), F.col("leaf") + 1)


def tree_arrays(description: str) -> dict[str, list]:
    """Nodes of a fitted tree from its printed form: feature (-1: leaf), threshold, left, right and leaf number."""
    nodes: list[list] = []
    leaves = 0
    parent_of_depth: dict[int, int] = {}
    for line in description.splitlines()[1:]:
        depth, text = (len(line) - len(line.lstrip())), line.strip()
        if split := re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", text):
            at = _attach(nodes, parent_of_depth, depth)
            nodes.append([int(split[1]), float(split[2]), -1, -1, -1])
            parent_of_depth[depth] = at
        elif text.startswith("Predict:"):
            _attach(nodes, parent_of_depth, depth)
            nodes.append([-1, 0.0, -1, -1, leaves])
            leaves += 1
        elif not text.startswith("Else"):
            raise ValueError(f"unknown line in a tree: {text}")
    return dict(zip(("feature", "threshold", "left", "right", "leaf"), map(list, zip(*nodes))))


def _attach(nodes: list[list], parent_of_depth: dict[int, int], depth: int) -> int:
    """Hang the next node below the open split one level up: left first, then right."""
    at = len(nodes)
    if depth - 1 in parent_of_depth:
        parent = nodes[parent_of_depth[depth - 1]]
        parent[2 if parent[2] < 0 else 3] = at
    return at


def tree_scores(trees: list[dict], x: np.ndarray) -> np.ndarray:
    """Sum of the trees' values for each row; all rows go down a tree level by level."""
    total = np.zeros(len(x))
    row = np.arange(len(x))
    for t in trees:
        feature, threshold, left, right = (np.array(t[k]) for k in ("feature", "threshold", "left", "right"))
        at = np.zeros(len(x), np.int64)
        while (feature[at] >= 0).any():
            inner = feature[at] >= 0
            goes_left = x[row, np.maximum(feature[at], 0)] <= threshold[at]
            at = np.where(inner, np.where(goes_left, left[at], right[at]), at)
        total += np.array(t["value"])[at]
    return total


class BoostedTrees(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """``rounds`` trees of ``depth`` levels with at least ``leaf`` rows per leaf, each added with weight ``step``."""

    loss = _param("loss", "squared, poisson or huber", TypeConverters.toString)
    rounds = _param("rounds", "number of trees", TypeConverters.toInt)
    depth = _param("depth", "levels of splits", TypeConverters.toInt)
    step = _param("step", "weight of a tree", TypeConverters.toFloat)
    leaf = _param("leaf", "least rows of a leaf", TypeConverters.toInt)
    bins = _param("bins", "candidate thresholds per feature", TypeConverters.toInt)
    label = _param("label", "column to learn", TypeConverters.toString)

    def __init__(self, loss: str = "squared", rounds: int = 250, depth: int = 5, step: float = 0.05, leaf: int = 40, bins: int = 64, label: str = "rides"):
        super().__init__()
        self._set(loss=loss, rounds=rounds, depth=depth, step=step, leaf=leaf, bins=bins, label=label)

    def _fit(self, dataset: DataFrame) -> "BoostedTreesModel":
        """Rows with a null label are not learned from; a table without rows is an error."""
        name, step = self.getOrDefault(self.loss), self.getOrDefault(self.step)
        loss = LOSSES[name]()
        spark = dataset.sparkSession
        checkpoint_dir(spark, LOCAL_CHECKPOINTS if spark.sparkContext.master.startswith("local[") else None)
        rows = dataset.select("features", F.col(self.getOrDefault(self.label)).cast("double").alias("y")).where(F.col("y").isNotNull())
        facts = rows.agg(F.count(F.lit(1)).alias("n"), loss.start(F.col("y")).alias("start")).first()
        if not facts["n"]:
            raise ValueError("boosting needs rows with a label")
        if name == "poisson" and rows.where("y < 0").limit(1).count():
            raise ValueError("counts cannot be negative")
        start = float(facts["start"])
        parts = max(1, -(-facts["n"] // ROWS_PER_PARTITION))
        rows = rows.repartition(parts).withColumn("score", F.lit(start)).checkpoint()  # the plan that made the features ends here
        held = rows.persist(StorageLevel.MEMORY_AND_DISK)
        tree = DecisionTreeRegressor(labelCol="residual", maxDepth=self.getOrDefault(self.depth), minInstancesPerNode=self.getOrDefault(self.leaf),
                                     maxBins=self.getOrDefault(self.bins), leafCol="leaf", seed=42)
        trees = []
        for k in range(self.getOrDefault(self.rounds)):
            loss.prepare(rows)
            fitted = tree.fit(rows.withColumn("residual", loss.residual(F.col("y"), F.col("score"))))
            leaves = fitted.transform(rows).select("features", "y", "score", F.col("leaf").cast("int").alias("leaf"))
            values = {leaf: step * value for leaf, value in loss.leaf_values(leaves).items()}
            nodes = tree_arrays(fitted.toDebugString)
            trees.append({**nodes, "value": [values.get(leaf, 0.0) if leaf >= 0 else 0.0 for leaf in nodes.pop("leaf")]})
            after = leaves.select("features", "y", (F.col("score") + _looked_up(values)).alias("score"))
            if (k + 1) % CUT_EVERY == 0:
                after = after.checkpoint()
            rows = after.persist(StorageLevel.MEMORY_AND_DISK)
            rows.count()  # filled before its predecessor goes
            held.unpersist()
            held = rows
        held.unpersist()
        return BoostedTreesModel(json.dumps({"loss": name, "start": start, "trees": trees}))


class BoostedTreesModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``prediction`` from column ``features``."""

    content = _param("content", "loss, start and trees as JSON", TypeConverters.toString)

    def __init__(self, content: str = "{}"):
        super().__init__()
        self._set(content=content)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        held = json.loads(self.getOrDefault(self.content))
        trees, start, output = held["trees"], held["start"], LOSSES[held["loss"]]().output

        @F.pandas_udf("double")
        def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                x = np.stack(batch.to_numpy()) if len(batch) else np.empty((0, 1))
                yield pd.Series(output(start + tree_scores(trees, x)))

        return dataset.withColumn("prediction", predicted(vector_to_array("features")))
