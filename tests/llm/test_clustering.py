import hashlib

import numpy as np
import pytest

from tallyridge.llm import clustering as C

SCHEMA = "vec_id long, embedding array<double>, cluster int, distance int, code string, v string"


def brute(rows, s):
    kept = [(i, [int(np.floor(s.scale * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == s.width and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{s.seed}{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centres = [list(v) for _, v in first[:s.clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(centres))

    for _ in range(s.rounds):
        own = [[] for _ in centres]
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        centres = [[sum(x) // len(o) for x in zip(*o)] if o else m for o, m in zip(own, centres)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    total = {c: sum(d for _, k, d in found if k == c) for c in range(len(centres))}
    return sorted(((i, c, d, total[c], sum(total.values()), centres[c]) for i, c, d in found), key=repr)


def table(seed, n, width):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=width).tolist()) for i in range(n)]
    rows += [(500 + i, rows[0][1]) for i in range(20)] + [rows[3]] * 3 + [(None, rows[1][1])] * 2 + [(700 + i, [0.0] * width) for i in range(5)]
    return rows + [(900, None), (901, [1.0] * (width - 1)), (902, [None] + [1.0] * (width - 1)), (903, [float("nan")] * width), (904, [float("inf")] * width), (905, [])]


@pytest.mark.parametrize("settings", [C.Settings(5, 3, 4, 64, 3, 50), C.Settings(16, 3, 8), C.Settings(7, 0, 3, 10, 1, 1), C.Settings(40, 2, 4, 8, 8, 10)])
def test_equals_brute_force(spark, settings):
    rows = table(settings.clusters, 150, settings.width)
    df = spark.createDataFrame([(i, v, 1, 2, "x", "y") for i, v in rows], SCHEMA).repartition(3)
    got = C.cluster(df, settings)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, settings)


def test_few_rows_only_null_ids_and_empty(spark):
    settings = C.Settings(8, 2, 3)
    for rows in ([(1, [1.0, 2.0, 3.0])], [(None, [1.0, 2.0, 3.0]), (None, [0.0, 2.0, 1.0])], []):
        df = spark.createDataFrame([(i, v, 1, 2, "x", "y") for i, v in rows], SCHEMA)
        assert sorted((tuple(r) for r in C.cluster(df, settings).collect()), key=repr) == brute(rows, settings)


def test_huge_components_stay_exact(spark):
    settings = C.Settings(3, 2, 2)
    rows = [(k, [(-1.0) ** k * 2.0 ** (14 + k), 1.5 * k]) for k in range(12)]
    df = spark.createDataFrame([(i, v, 1, 2, "x", "y") for i, v in rows], SCHEMA)
    assert sorted((tuple(r) for r in C.cluster(df, settings).collect()), key=repr) == brute(rows, settings)


def test_intervals_hold_and_most_vectors_stay_unfetched():
    rng = np.random.default_rng(1)
    centres = rng.integers(-60, 60, size=(6, 16))
    x = np.concatenate([c + rng.integers(-8, 9, size=(200, 16)) for c in centres])
    edges = np.ascontiguousarray(np.sort(x, axis=0)[np.arange(1, 16) * len(x) // 16].T)
    cells = C.Cells(edges, x.min(0), x.max(0), 4)
    import pyarrow as pa

    codes = cells.unpack(pa.array(cells.pack(x), pa.binary()))
    nearest = C.Nearest(centres.tolist(), cells)
    far = ((x[:, None] - centres[None]) ** 2).sum(2)
    low = sum(nearest.least[j][codes[:, j]] for j in range(16))
    high = sum(nearest.most[j][codes[:, j]] for j in range(16))
    assert (low <= far).all() and (far <= high).all()
    cluster, fetched = nearest.assign(codes, x)
    assert (cluster == far.argmin(1)).all() and len(fetched) < 0.1 * len(x)
