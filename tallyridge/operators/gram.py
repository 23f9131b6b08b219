"""Ridge searches from additive Gram matrices: one pass over the rows for all folds, windows, subsets and penalties.

The products of all pairs of features (with 1 and the label) are summed per day. These sums are additive, so a prefix
sum over the days gives the matrix of any training window, and each fit is one small eigenvalue problem that serves
every penalty. A second pass scores the validation days of all fits together, with the operational rules.

What reaches the driver is one matrix per calendar day, whatever the number of rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyridge.operators.scoring import operational

PENALTIES = tuple(float(10 ** (-2 + 7 * k / 19)) for k in range(20))  # from 0.01 to 100,000


@dataclass(frozen=True)
class Grams:
    """Sums of products before each day: ``prefix[k]`` covers ``days[:k]``. Features and label are shifted by ``shift``."""

    columns: list[str]
    days: list[datetime]
    prefix: np.ndarray
    shift: np.ndarray

    def between(self, start: datetime, end: datetime) -> np.ndarray:
        at = [int(np.searchsorted(np.array(self.days, "datetime64[us]"), np.datetime64(x, "us"))) for x in (start, end)]
        return self.prefix[at[1]] - self.prefix[at[0]]

    def ridge(self, gram: np.ndarray, subset: list[str], penalties) -> list[tuple[float, list[float]]]:
        """(intercept, weight of every column) per penalty. Features are scaled by their sample deviation, the intercept
        is free of penalty, and constant features get no weight."""
        use = [1 + self.columns.index(c) for c in subset]
        n, last = gram[0, 0], gram.shape[0] - 1
        if n < 2:
            raise ValueError("a training window needs at least two rows")
        mean = gram[0] / n
        centred = gram - n * np.outer(mean, mean)
        spread = np.sqrt(np.maximum(np.diag(centred)[use], 0.0) / (n - 1))
        moves = spread > 1e-9 * (1 + np.abs(mean[use] + self.shift[[u - 1 for u in use]]))
        scale = np.where(moves, 1 / np.where(moves, spread, 1.0), 0.0)
        values, vectors = np.linalg.eigh(centred[np.ix_(use, use)] * np.outer(scale, scale))
        target = vectors.T @ (centred[use, last] * scale)
        out = []
        for penalty in penalties:
            weights = np.zeros(len(self.columns))
            weights[[u - 1 for u in use]] = vectors @ (target / np.maximum(values + penalty, 1e-12)) * scale
            intercept = mean[last] + self.shift[-1] - weights @ (mean[1:last] + self.shift[:-1])
            out.append((float(intercept), weights.tolist()))
        return out


def day_grams(frame: DataFrame, columns: list[str], label: str = "rides", day: str = "day") -> Grams:
    """Rows with a null feature or label are left out. The means of all rows are the shift, which keeps sums small."""
    names = [*columns, label]
    rows = frame.select(F.col(day).cast("timestamp_ntz").alias("__day"), *[F.col(c).cast("double").alias(c) for c in names]).dropna()
    means = rows.agg(*[F.avg(c).alias(c) for c in names]).first()
    if means is None or means[0] is None:
        raise ValueError("a search needs rows with features and a label")
    shift = np.array([means[c] for c in names])
    z = [F.lit(1.0), *[F.col(c) - F.lit(float(s)) for c, s in zip(names, shift)]]
    pairs = [(i, j) for i in range(len(z)) for j in range(i, len(z))]
    sums = rows.groupBy("__day").agg(*[F.sum(z[i] * z[j]).alias(f"p{i}_{j}") for i, j in pairs]).orderBy("__day").collect()  # a row per day
    grams = np.zeros((len(sums) + 1, len(z), len(z)))
    for k, r in enumerate(sums):
        for (i, j), value in zip(pairs, r[1:]):
            grams[k + 1, i, j] = grams[k + 1, j, i] = value
    return Grams(list(columns), [r[0] for r in sums], grams.cumsum(axis=0), shift)


def search(frame: DataFrame, plans: dict[str, DataFrame], columns: list[str], subsets: dict[str, list[str]], penalties=PENALTIES,
           label: str = "rides", day: str = "day", clock: str = "clock_hours") -> DataFrame:
    """(plan, fold, subset, penalty, rows, rmse): every fit scored on its validation window.

    ``plans`` maps names to fold tables as ``chronological_folds`` makes them. Predictions are operational: not below
    zero, and zero in the clock gap.
    """
    grams = day_grams(frame, columns, label, day)
    fits = []
    for plan, folds in plans.items():
        for b in folds.orderBy("fold").collect():  # a few folds
            gram = grams.between(b["train_start"], b["train_end"])
            models = [(subset, float(p), *fit) for subset, own in subsets.items() for p, fit in zip(penalties, grams.ridge(gram, own, penalties))]
            fits.append((plan, b["fold"], b["valid_start"], b["valid_end"], models))
    spark = frame.sparkSession
    kind = "plan string, fold int, a timestamp_ntz, z timestamp_ntz, models array<struct<subset: string, penalty: double, intercept: double, weights: array<double>>>"
    step = F.make_dt_interval(F.lit(1))
    days = spark.createDataFrame(fits, kind).select("plan", "fold", "models", F.explode(F.sequence("a", F.col("z") - step, step)).alias("__day"))
    rows = frame.select(F.col(day).cast("timestamp_ntz").alias("__day"), F.col(clock), F.col(label).cast("double").alias("__y"),
                        F.array(*[F.col(c).cast("double") for c in columns]).alias("__x")).where(F.col("__y").isNotNull() & ~F.exists("__x", lambda x: x.isNull()))
    each = rows.join(days, "__day").select("*", F.explode("models").alias("m"))
    raw = F.aggregate(F.zip_with("__x", "m.weights", lambda x, w: x * w), F.col("m.intercept"), lambda total, v: total + v)
    miss = F.col("__y") - operational(raw, F.col(clock))
    return each.groupBy("plan", "fold", "m.subset", "m.penalty").agg(F.count(F.lit(1)).alias("rows"), F.sqrt(F.avg(miss * miss)).alias("rmse"))


def mean_scores(scores: DataFrame) -> DataFrame:
    """(plan, subset, penalty, folds, cv_rmse, selected): mean over folds; the lowest is selected, ties to the smaller penalty."""
    means = scores.groupBy("plan", "subset", "penalty").agg(F.count(F.lit(1)).alias("folds"), F.avg("rmse").alias("cv_rmse"))
    best = means.agg(F.min(F.struct("cv_rmse", "penalty", "plan", "subset")).alias("b")).select("b.*")
    same = reduce(lambda a, b: a & b, [means[c] == best[c] for c in ("plan", "subset", "penalty")])
    return means.join(F.broadcast(best), same, "left").select(means["plan"], means["subset"], means["penalty"], "folds", means["cv_rmse"], best["plan"].isNotNull().alias("selected"))  # one row


def naive_rmse(frame: DataFrame, folds: DataFrame, predicted: Column, label: str = "rides", day: str = "day") -> DataFrame:
    """(fold, validation_rows, naive_rmse) of a column of predictions over the validation windows."""
    step = F.make_dt_interval(F.lit(1))
    days = folds.select("fold", F.explode(F.sequence("valid_start", F.col("valid_end") - step, step)).alias("__day"))
    miss = F.col(label) - predicted
    rows = frame.withColumn("__day", F.col(day).cast("timestamp_ntz")).join(days, "__day")
    return rows.groupBy("fold").agg(F.count(F.lit(1)).alias("validation_rows"), F.sqrt(F.avg(miss * miss)).alias("naive_rmse"))
