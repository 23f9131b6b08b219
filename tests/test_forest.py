import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.linalg import DenseVector, SparseVector
from pyspark.sql import functions as F

from tallyridge.operators import forest as T
from tallyridge.operators import models as L


def rows(spark, n=700, classes=2):
    """Values below, at and above zero, a constant feature, dense and sparse vectors, weights of each class."""
    rng = np.random.default_rng(8)
    x = np.stack([rng.integers(0, 2, n), rng.integers(-6, 7, n) / 2, rng.integers(1, 9, n), np.zeros(n), rng.integers(-9, 1, n), rng.integers(0, 30, n) == 0], 1).astype(float)
    y = ((x[:, 1] > 0.4) ^ (x[:, 2] > 4) ^ (rng.random(n) < 0.2)) + (rng.random(n) < 0.1) * (classes - 2)
    vector = lambda v: SparseVector(6, {int(i): float(v[i]) for i in np.flatnonzero(v)})
    return spark.createDataFrame([(i, vector(v) if i % 3 else DenseVector(v), int(c), 0.7 if c == 1 else 1.3) for i, (v, c) in enumerate(zip(x, y))],
                                 ["id", "features", "y", "weight"])


def scored(model, df):
    return {r["id"]: r["probability"].toArray() for r in model.transform(df).select("id", "probability").collect()}


@pytest.mark.parametrize("classes, weighted, leaf", [(2, True, 1), (2, False, 4), (3, True, 5), (2, True, 7)])
def test_one_whole_tree_equals_that_of_the_library(spark, classes, weighted, leaf):
    df = rows(spark, classes=classes).repartition(3).cache()
    one = RandomForestClassifier(labelCol="y", numTrees=1, maxDepth=7, featureSubsetStrategy="all", bootstrap=False, seed=1, minInstancesPerNode=leaf,
                                 **({"weightCol": "weight"} if weighted else {}))
    ours, theirs = T.fitted(one, df), one.fit(df)
    assert ours.totalNumNodes == theirs.totalNumNodes > 20 and ours.numFeatures == 6 and ours.numClasses == classes
    a, b = scored(ours, df), scored(theirs, df)
    assert max(np.abs(a[i] - b[i]).max() for i in a) < 1e-9


def test_forests_repeat_and_large_levels_are_split_in_batches(spark, monkeypatch):
    df = rows(spark).cache()
    forest = RandomForestClassifier(labelCol="y", weightCol="weight", numTrees=9, maxDepth=8, featureSubsetStrategy="all", seed=3)
    a, b = (scored(T.fitted(forest, df), df) for _ in range(2))
    assert all((a[i] == b[i]).all() for i in a)
    bins, n = T.bins_of(T._unwrapped(df, "features", "y", "weight"), 32)
    packed = [r for x in T._unwrapped(df, "features", "y", "weight").mapInArrow(T._packed(bins), "key string, cells binary, y binary, w binary").collect() for r in [x]]
    table = np.concatenate([np.frombuffer(r["cells"], np.uint16).reshape(bins.width, -1) for r in packed], 1)
    y, w = (np.concatenate([np.frombuffer(r[c], t) for r in packed]) for c, t in (("y", np.uint16), ("w", float)))
    assert n == len(y) == 700
    grow = lambda: T.grown_tree(bins, table, y.astype(int), w, np.arange(n) % 3, 8, 2, 6, np.random.default_rng(0))
    whole = grow()
    monkeypatch.setattr(T, "HISTOGRAM", 1)
    small = grow()
    assert all(np.allclose(whole[k], small[k]) for k in whole) and len(whole["left"]) > 20


def test_bins_hold_rare_values_and_even_ranks(spark):
    assert T._thresholds(np.array([0.0, 1.0]), np.array([10**9, 1]), 32).tolist() == [0.5]
    many = T._thresholds(np.arange(1000.0), np.ones(1000, int), 4)
    assert many == pytest.approx([249.5, 499.5, 749.5], abs=1)
    assert T._thresholds(np.array([3.0]), np.array([5]), 32).size == 0
    v, n = T._thinned(np.arange(5000.0), np.full(5000, 2), 100)
    assert len(v) == 100 and n.sum() == 10_000


def test_classifier_grows_whole_trees_and_leaves_larger_tables_to_the_library(spark, monkeypatch):
    df = rows(spark).cache()
    calls, by_levels = [], L.ForestClassifier._by_levels
    monkeypatch.setattr(L.ForestClassifier, "_by_levels", lambda *a: calls.append(1) or by_levels(*a))
    for most, times in ((T.CELLS_IN_TASK, 0), (100, 1)):
        monkeypatch.setattr(T, "CELLS_IN_TASK", most)
        model = L.ForestClassifier(12, 6).fit(df)
        assert len(calls) == times and [p.getNumTrees for p in model.stages[:-1]] == [10, 2]
        assert L.MacroF1().evaluate(model.transform(df).withColumn("prediction", F.col("prediction").cast("int"))) > 0.7


def test_nulls_are_refused(spark):
    df = rows(spark, 20).withColumn("y", F.when(F.col("id") > 3, F.col("y")))
    with pytest.raises(Exception, match="without nulls"):
        T.fitted(RandomForestClassifier(labelCol="y", numTrees=2), df)


def test_forest_queries_grow_whole_trees_and_score_on_all_cores(spark, monkeypatch):
    """A table of one partition: the forest comes from the packed rows, and what is scored is dealt out."""
    from datetime import datetime, timedelta
    from types import SimpleNamespace

    from tallyridge.plans import catalog

    hours = [(datetime(2024, 1, 1) + timedelta(hours=i), float(50 + i % 24), "NYC") for i in range(31 * 24)]
    text = lambda n, c: F.when(F.col("row_id") % 7 > 0, (F.col("row_id") % n).cast("string")).alias(c)
    items = spark.range(900, numPartitions=1).select(F.col("id").alias("row_id")).select(
        "row_id", *[(F.col("row_id") * k % 19).cast("double").alias(c) for k, c in ((3, "cap_diameter"), (5, "stem_height"), (7, "stem_width"))],
        *[text(n, c) for n, c in ((5, "brand"), (3, "kind"), (4, "color"), (2, "has_ring"), (6, "ring_type"))],
        F.when(F.col("row_id") * 3 % 19 < 9, "p").otherwise("e").alias("label"))
    v = SimpleNamespace(spark=spark, items=items, hourly=spark.createDataFrame(hours, "timestamp timestamp_ntz, rides double, area string"))
    monkeypatch.setitem(L.CLASSIFIERS, "random_forest", lambda **k: L.ForestClassifier(**{**k, "numTrees": 5, "maxDepth": 6}))
    regressor, dealt, grown = L.forest_regressor, L.dealt_out, T.fitted
    monkeypatch.setattr(L, "forest_regressor", lambda c: regressor(c, 2, 3))
    seen = []
    monkeypatch.setattr(L, "dealt_out", lambda df: seen.append("dealt") or dealt(df))
    monkeypatch.setattr(T, "fitted", lambda *a: seen.append("grown") or grown(*a))
    facts = catalog._PLANS["model_random_forest_cls"](v).first()
    assert facts.rows == facts.probabilities == facts.decided > 100 and facts.beats_majority
    scored = catalog._PLANS["score_batch_classify"](v)
    assert scored.where("scored AND ranks_well").count() == facts.rows
    assert seen == ["dealt", "grown", "dealt"] * 2
    seen.clear()
    parity = {r.model: (r.rows, r.max_difference, r.unmatched) for r in catalog._PLANS["score_parity"](v).collect()}
    assert parity["items"] == (900, 0.0, 0) and parity["demand"][1:] == (0.0, 0) and seen == ["dealt"] * 3 + ["grown", "dealt"]
