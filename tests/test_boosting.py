import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler

from tallyridge.operators.boosting import BoostedTrees, tree_arrays


def sample(n=200, seed=5):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 9, n), rng.integers(0, 7, n)], axis=1).astype(float)
    y = rng.poisson(np.exp(0.3 * x[:, 0] + 0.2 * (x[:, 1] > 3))).astype(float)
    y[::50] += 60
    return x, y


def grow(x, target, depth, leaf):
    """Plain least-squares tree: (feature, threshold, left, right), or the rows of a leaf."""
    def split(rows, level):
        best = None
        if level < depth:
            whole = ((target[rows] - target[rows].mean()) ** 2).sum()
            for f in range(x.shape[1]):
                levels = np.unique(x[:, f])
                for cut in (levels[1:] + levels[:-1]) / 2:
                    left, right = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                    if min(len(left), len(right)) >= leaf:
                        gain = whole - sum(((target[r] - target[r].mean()) ** 2).sum() for r in (left, right))
                        if gain > 1e-9 and (best is None or gain > best[0] * (1 + 1e-12)):
                            best = (gain, left, right)
        return [rows] if best is None else split(best[1], level + 1) + split(best[2], level + 1)

    return split(np.arange(len(x)), 0)


def nearest_rank(v, q):
    return np.sort(v)[max(0, int(np.ceil(q * len(v))) - 1)]


def plain(x, y, loss, rounds, depth, step, leaf):
    start = {"squared": y.mean(), "poisson": np.log(y.mean()), "huber": nearest_rank(y, 0.5)}[loss]
    score = np.full(len(y), start)
    for _ in range(rounds):
        gap = y - (np.exp(score) if loss == "poisson" else score)
        limit = nearest_rank(abs(gap), 0.9) if loss == "huber" else np.inf
        for rows in grow(x, np.clip(gap, -limit, limit), depth, leaf):
            if loss == "poisson":
                value = gap[rows].sum() / np.exp(score[rows]).sum()
            elif loss == "huber":
                middle = nearest_rank(gap[rows], 0.5)
                value = middle + np.clip(gap[rows] - middle, -limit, limit).mean()
            else:
                value = gap[rows].mean()
            score[rows] += step * value
    return np.exp(score) if loss == "poisson" else score


@pytest.mark.parametrize("loss", ["squared", "poisson", "huber"])
def test_equals_plain_boosting(spark, tmp_path, loss):
    x, y = sample()
    df = spark.createDataFrame([(float(a), float(b), float(t), i) for i, ((a, b), t) in enumerate(zip(x, y))], "a double, b double, rides double, i int")
    both = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"), BoostedTrees(loss, rounds=12, depth=2, step=0.3, leaf=8)]).fit(df)
    got = [r.prediction for r in both.transform(df).orderBy("i").collect()]
    assert got == pytest.approx(plain(x, y, loss, 12, 2, 0.3, 8), rel=1e-6)
    both.write().overwrite().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model")).transform(df).orderBy("i").collect()
    assert [r.prediction for r in again] == got


def test_one_leaf_nulls_negative_counts_and_no_rows(spark):
    rows = [(1.0, 2.0), (1.0, 4.0), (1.0, None)]
    df = VectorAssembler(inputCols=["a"], outputCol="features").transform(spark.createDataFrame(rows, "a double, rides double"))
    for loss in ("squared", "poisson"):
        assert [r.prediction for r in BoostedTrees(loss, rounds=3, leaf=1).fit(df).transform(df).collect()] == pytest.approx([3.0] * 3)
    with pytest.raises(ValueError, match="rows with a label"):
        BoostedTrees(rounds=1).fit(df.where("rides > 9"))
    with pytest.raises(ValueError, match="negative"):
        BoostedTrees("poisson", rounds=1).fit(df.withColumn("rides", -df.rides))


def test_printed_trees_become_arrays():
    text = "model (depth=2)\n  If (feature 1 <= 0.5)\n   Predict: 1.0\n  Else (feature 1 > 0.5)\n   If (feature 0 <= -1.0E-4)\n    Predict: 2.0\n   Else (feature 0 > -1.0E-4)\n    Predict: 3.0\n"
    assert tree_arrays(text) == {"feature": [1, -1, 0, -1, -1], "threshold": [0.5, 0.0, -1e-4, 0.0, 0.0], "left": [1, -1, 3, -1, -1], "right": [2, -1, 4, -1, -1], "leaf": [-1, 0, -1, 1, 2]}
