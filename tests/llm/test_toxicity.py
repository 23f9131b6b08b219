import random

import numpy as np

from tallyridge.llm import toxicity as X

BAD = ["vile", "scum", "idiotic"]


def corpus(seed, n):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefg") for _ in range(4)) for _ in range(200)]
    rows = []
    for i in range(n):
        w = [rng.choice(words) for _ in range(rng.randrange(5, 120))]
        toxic = int(rng.random() < 0.3)
        for _ in range(2 * toxic):
            w.insert(rng.randrange(len(w) + 1), rng.choice(BAD) + rng.choice(["", ",", "!"]))
        rows.append((i, " ".join(w), toxic))
    return rows


def frames(spark, rows):
    docs = spark.createDataFrame([(i, t, "s", 0.5) for i, t, _ in rows], "doc_id long, text string, source string, score double")
    return docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")


def test_held_out_accuracy_and_sparsity(spark):
    docs, labels = frames(spark, corpus(1, 900))
    model = X.fit(docs, labels.where(~X.held_out()))
    assert 0 < len(model.indexes) < 300
    got = X.score(docs, model).join(labels, "doc_id").where(X.held_out()).toPandas()
    assert list(X.score(docs, model).columns) == ["doc_id", "text", "source", "score", "predicted"]
    bad, good = got[got.toxic == 1], got[got.toxic == 0]
    assert (bad.predicted == 1).mean() > 0.9 and (good.predicted == 0).all()
    again = X.fit(docs, labels.where(~X.held_out()))
    assert np.array_equal(model.indexes, again.indexes) and np.array_equal(model.weights, again.weights)


def test_odd_rows(spark):
    rows = corpus(2, 60) + [(100, None, 1), (101, "", 0), (102, "vile " * 20000, 1), (102, "vile " * 20000, 1)]
    docs, labels = frames(spark, rows)
    labels = labels.unionByName(spark.createDataFrame([(5, None), (None, 1), (900, 1)], "doc_id long, toxic int"))
    got = X.score(docs.unionByName(spark.createDataFrame([(None, "vile", None, None)], docs.schema)), X.fit(docs, labels)).collect()
    assert len(got) == len(rows) + 1 and all(0 <= r.score <= 1 for r in got)
    score = {r.doc_id: r.score for r in got}
    assert score[100] == score[101]
    assert X.score(docs.limit(0), X.fit(docs, labels)).count() == 0


def test_without_labels(spark):
    docs, labels = frames(spark, corpus(3, 20))
    assert {r.score for r in X.score(docs, X.fit(docs, labels.limit(0))).collect()} == {0.5}
    assert {r.score for r in X.score(docs, X.fit(docs.limit(0), labels)).collect()} == {0.5}


def test_features_count_neighbours_within_a_row_only():
    rows, at = X.features(["a b c", None, "", "A b"], X.WordHashes(), 18)
    assert np.bincount(rows, minlength=4).tolist() == [3 + 2 + 1, 0, 0, 2 + 1]
    assert set(at[rows == 3]) < set(at[rows == 0])
