import numpy as np
import pytest

from tallyridge.llm import topk

SCHEMA = "vec_id long, embedding array<float>, v string, score int"


def brute(rows, queries, k):
    def whole(v):
        return None if v is None or any(x is None or not np.isfinite(x) for x in v) else [int(np.floor(256 * float(np.float32(x)))) for x in v]

    valid = [(i, whole(v)) for i, v in rows if i is not None and whole(v)]
    sizes = [len(v) for _, v in valid]
    width = max(set(sizes), key=lambda n: (sizes.count(n), n)) if sizes else 0
    out = []
    for q, x in {(i, tuple(v)) for i, v in valid if len(v) == width and i in queries}:
        best = sorted({(-sum(a * b for a, b in zip(x, y)), i) for i, y in valid if len(y) == width and i != q})[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


def table(seed, n=200, width=6):
    rng = np.random.default_rng(seed)
    rows = [(int(i), rng.normal(size=width).tolist()) for i in range(n)]
    rows += [(1000 + i, rows[0][1]) for i in range(40)] + [(2000 + i, [0.0] * width) for i in range(10)]
    return rows + [(3000, None), (3001, [1.0, None] + [0.0] * (width - 2)), (3002, [float("nan")] * width), (3003, [float("inf")] * width), (3004, [1.0]), (None, rows[0][1])]


@pytest.mark.parametrize("settings", [topk.Settings(), topk.Settings(3, 5, 7, 4), topk.Settings(1, 1, 1000, 1)])
def test_equals_brute_force(spark, settings):
    rows = table(settings.pivots)
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    queries = {i for i, _ in rows if i is not None and i % 9 == 0}
    got = topk.search(df, df.where("vec_id % 9 = 0"), 5, settings)
    assert sorted(map(tuple, got.collect())) == brute(rows, queries, 5)


def test_few_candidates_and_empty_tables(spark):
    rows = [(0, [1.0, 2.0]), (9, [1.0, 2.0]), (3, [-1.0, 0.5])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    assert sorted(map(tuple, topk.search(df, df.where("vec_id % 9 = 0")).collect())) == brute(rows, {0, 9}, 5)
    assert topk.search(df.limit(0), df).count() == 0
    assert topk.search(df, df.limit(0)).count() == 0


def test_large_components_stay_exact():
    a = np.array([[2.0 ** 40, 3.0], [5.0, -(2.0 ** 20)]])
    assert topk.products(a[:, ::-1] // 2 ** 10, a // 2 ** 10).tolist() == (a[:, ::-1] // 2 ** 10).astype(int).dot((a // 2 ** 10).astype(int).T).tolist()


def test_repeated_rows_are_one_candidate(spark):
    v, far = [1.0, 0.5, 0.25], [0.25, 0.5, 1.0]
    rows = [(1, v)] * 8 + [(i, v) for i in range(2, 8)] + [(60, far), (61, far), (62, v), (62, v), (62, [1.0, 0.25, 0.75])]
    df = spark.createDataFrame([(i, x, "x", 1) for i, x in rows], SCHEMA)
    for divisor in (7, 60):
        queries = {i for i, _ in rows if i % divisor == 0}
        for settings in (topk.Settings(), topk.Settings(2, 3, 2, 1)):
            got = sorted(map(tuple, topk.search(df, df.where(f"vec_id % {divisor} = 0"), 5, settings).collect()))
            assert got == brute(rows, queries, 5)
    best = [r.vec_id for r in topk.search(df, df.where("vec_id = 7"), 5).orderBy("rank").collect()]
    assert best == [1, 2, 3, 4, 5]
