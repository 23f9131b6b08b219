import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyridge.llm import negatives as N

SCHEMA = "vec_id long, embedding array<double>, label int, row string, score int, width int"


def brute(rows, divisor, settings=N.Settings()):
    def vector(v):
        return None if not v or any(x is None or not np.isfinite(x) for x in v) else tuple(int(np.floor(256 * float(x))) for x in v)

    kept = {(i, label, vector(v)) for i, v, label in rows if i is not None and label is not None and vector(v)}
    out = []
    for i, label, v in [r for r in kept if r[0] % divisor == 0]:
        scores = [(-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in kept if j != i and len(w) == len(v)]
        for p, j, _ in sorted(s for s in scores if s[2] == label)[:settings.positives]:
            inside = sorted(s for s in scores if s[2] != label and settings.low * -p <= 100 * -s[0] <= settings.high * -p)
            out += [(i, j, n + 1, m, -p, -s) for n, (s, m, _) in enumerate(inside[:settings.negatives])]
    return sorted(out)


def table(seed, n=260, width=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, width))
    rows = [(i, (centres[i % 5] + rng.normal(size=width) * 0.5).tolist(), int(rng.integers(0, 4))) for i in range(n)]
    rows += [(1000 + i, rows[0][1], 0) for i in range(30)] + [(2000 + i, [0.0] * width, 1) for i in range(8)] + [rows[7]] * 6 + [rows[10]] * 3
    return rows + [(3000, None, 1), (3010, [1.0, None], 1), (3020, [float("nan")] * width, 1), (3030, [float("-inf")] * width, 2), (3040, [1.0, 2.0], 2),
                   (3041, [1.0, 1.5], 2), (3042, [0.5, 0.75], 1), (3050, [], 0), (3060, rows[1][1], None), (None, rows[1][1], 1)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1, 2) for i, v, label in rows], SCHEMA)


@pytest.mark.parametrize("settings", [N.Settings(), N.Settings(3, 2, 30, 90, 3, 17, 2), N.Settings(40, 2, 0, 100, 1000, 1, 1)])
def test_equals_brute_force(spark, settings):
    rows = table(settings.positives, 260 if settings.row_block > 1 else 40)
    got = N.mine(frame(spark, rows), F.col("vec_id") % 10 == 0, settings)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute(rows, 10, settings)
    assert want and sorted(map(tuple, got.collect())) == want


def test_empty_and_without_partners(spark):
    df = frame(spark, [(0, [1.0, 2.0], 1), (3, [1.0, 2.0], 2)])
    assert N.mine(df, F.col("vec_id") % 10 == 0).count() == 0
    assert N.mine(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert N.mine(df, F.lit(None).cast("boolean")).count() == 0


def test_huge_components_stay_exact(spark):
    rows = [(k, [3.0 ** k * 2 ** 12, 5.0 + k, 2.0 ** 18 + k], k % 2) for k in range(14)]
    assert sorted(map(tuple, N.mine(frame(spark, rows), F.col("vec_id") % 2 == 0).collect())) == brute(rows, 2)


def test_bounds_hold_and_skip_most_candidates_of_close_anchors():
    rng = np.random.default_rng(3)
    centre = rng.normal(size=32) * 100
    anchors = np.floor(centre + rng.normal(size=(40, 32)) * 2)
    rows = np.floor(np.concatenate([rng.normal(size=(2000, 32)) * 60, centre + rng.normal(size=(60, 32)) * 20]))
    tree = N.Tree(anchors)
    assert sum(map(len, tree.children)) == 39
    scores, opened = anchors @ rows.T, 0
    least = np.sort(scores.max(1))[0] * 0.5

    def window(k, low, high):
        assert (low <= scores[k]).all() and (high >= scores[k]).all()
        return high >= least

    seen = set()
    for k, need, exact in tree.walk(anchors, rows, window):
        assert (exact == scores[k][need]).all() and set(np.flatnonzero(scores[k] >= least)) <= set(need)
        seen.add(k)
        opened += len(need)
    assert seen == set(range(40)) and opened < 0.2 * scores.size
