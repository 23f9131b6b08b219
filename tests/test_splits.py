import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyridge.operators import splits as P


def plain_folds(rows, k, seed):
    """Every group on its own, in order, to the fold that keeps the class shares most even."""
    classes = sorted({y for _, _, y in rows}, key=lambda y: (y is not None, y))
    counts = defaultdict(lambda: [0] * len(classes))
    for _, g, y in rows:
        counts[g][classes.index(y)] += 1
    totals = [sum(c[i] for c in counts.values()) for i in range(len(classes))]

    def key(g):
        c = counts[g]
        return (-(len(c) * sum(n * n for n in c) - sum(c) ** 2), c, hashlib.md5(f"{'' if g is None else g}|{seed}".encode()).hexdigest(), g)

    held, fold = np.zeros((k, len(classes)), np.int64), {}
    for g in sorted(counts, key=key):
        scores = []
        for f in range(k):
            after = held.copy()
            after[f] += counts[g]
            uneven = sum(math.sqrt(k * int((after[:, c] ** 2).sum()) - int(after[:, c].sum()) ** 2) / (k * totals[c]) for c in range(len(classes)))
            scores.append((uneven, int(held[f].sum()), f))
        fold[g] = min(scores)[2] + 1
        held[min(scores)[2]] += counts[g]
    return fold, held, totals


def table(kind):
    rng = np.random.default_rng(8)
    if kind == "random":
        return [(i, int(rng.integers(0, 60)), "pe"[int(rng.random() < 0.3)]) for i in range(1500)]
    if kind == "equal":  # thousands of groups of the same make, after one large group
        return [(i, -1, "p") for i in range(400)] + [(1000 + i, i // 2, "pe"[i % 2]) for i in range(3000)] + [(9000 + i, 5000 + i, "e") for i in range(777)]
    if kind == "pure":  # groups of one class each, and rows without a group
        return [(i, None if i % 50 == 0 else i // 20, "abc"[i // 20 % 3]) for i in range(1200)]
    return [(1, 1, "p"), (2, 1, None), (3, 2, None)]


@pytest.mark.parametrize("kind", ["random", "equal", "pure", "few"])
def test_group_folds_equal_plain_dealing(spark, kind):
    rows = table(kind)
    got = P.group_folds(spark.createDataFrame(rows, "row_id long, g long, label string"), "g", "label", 5, 42).collect()
    fold, held, totals = plain_folds(rows, 5, 42)
    assert Counter((r.row_id, r.g, r.fold) for r in got) == Counter((i, g, fold[g]) for i, g, _ in rows)
    if kind == "random":
        assert (abs(held / totals - 0.2) < 0.03).all()


def test_group_folds_of_no_rows(spark):
    empty = spark.createDataFrame([], "row_id long, g long, label string")
    assert P.group_folds(empty, "g", "label", 5, 42).count() == 0


def test_groups_stay_whole_and_classes_even(spark):
    df = spark.range(4000).select(F.col("id").alias("row_id"), F.floor(F.col("id") / 37).alias("g"), F.when(F.col("id") % 11 < 3, "p").otherwise("e").alias("label"))
    out = P.group_folds(df, "g", "label", 5, 1)
    assert out.groupBy("g").agg(F.count_distinct("fold").alias("n")).where("n > 1").count() == 0
    shares = [r.s for r in out.groupBy("fold").agg(F.avg((F.col("label") == "p").cast("int")).alias("s")).collect()]
    assert len(shares) == 5 and max(shares) - min(shares) < 0.01
