import random

import numpy as np
import pytest

from tallyridge.llm import jaccard
from tallyridge.llm.components import components

SCHEMA = "doc_id long, text string, node string, part int"


def shingles(text, size):
    w = (text or "").encode().lower().split()
    return {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def brute(rows, size, num, den):
    sets = [(i, shingles(t, size)) for i, t in rows]
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, (i, x) in enumerate(sets):
        for b, (j, y) in enumerate(sets[:a]):
            if x and y and i is not None and j is not None and den * len(x & y) >= num * len(x | y):
                up[root(a)] = root(b)
    links = [0] * len(sets)
    for a, (i, x) in enumerate(sets):
        for b, (j, y) in enumerate(sets):
            links[a] += a != b and bool(x and y) and i is not None and j is not None and den * len(x & y) >= num * len(x | y)
    least = {}
    for a, (i, _) in enumerate(sets):
        if i is not None:
            least[root(a)] = min(i, least.get(root(a), i))
    return sorted(((i, len(s), None if i is None else least[root(a)] if s else i, links[a]) for a, (i, s) in enumerate(sets)), key=repr)


def corpus(seed, n=150):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)] + ["É", "ß"]
    bases = [[rng.choice(words) for _ in range(rng.choice([4, 9, 12, 20, 45, 90, 140]))] for _ in range(12)]
    rows = []
    for i in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
            k = rng.randrange(len(w))
            w[k:k + rng.choice([0, 1, 1])] = [rng.choice(words)]
        rows.append((i * 3, rng.choice([" ", "\n"]).join(x.upper() if rng.random() < 0.2 else x for x in w)))
    rng.shuffle(rows)
    return rows + [(900, None), (901, ""), (902, "  "), (903, "a"), (904, "A"), (905, "a b"), (None, rows[0][1]), (906, "a b"), (906, "c d")]


@pytest.mark.parametrize("num,den", [(90, 100), (80, 100), (1, 2)])
def test_equals_brute_force(spark, num, den, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_MEMBERS", 8)
    monkeypatch.setattr(jaccard, "MEETING_ROWS", 5)
    rows = corpus(num)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    got = sorted(map(tuple, jaccard.join(docs, 3, num, den).collect()), key=repr)
    assert got == brute(rows, 3, num, den)


def test_empty_table(spark):
    assert jaccard.join(spark.createDataFrame([], SCHEMA)).count() == 0


def test_linked_sets_share_a_part():
    rng = np.random.default_rng(5)
    dealer = jaccard.Dealer(90, 100)
    met = 0
    for _ in range(3000):
        a = rng.integers(0, 1 << 60, rng.integers(9, 300)).astype(np.uint64)
        b = a.copy()
        drop = rng.integers(0, max(1, len(a) // 12) + 1)
        b[:drop] = rng.integers(0, 1 << 60, drop).astype(np.uint64)
        b = b[: len(b) - rng.integers(0, max(1, len(a) // 20))]
        x, y = set(a.tolist()), set(b.tolist())
        if 100 * len(x & y) >= 90 * len(x | y):
            met += 1
            assert np.intersect1d(dealer.parts(np.unique(a)), dealer.parts(np.unique(b))).size
    assert met > 500


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(6)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 60, rng.integers(1, 3000)).astype(np.uint64))
        b = np.unique(np.concatenate([a[: rng.integers(0, len(a)) + 1], rng.integers(0, 1 << 60, rng.integers(0, 900)).astype(np.uint64)]))
        pair = jaccard.Sketches([jaccard.sketch(a), jaccard.sketch(b)])
        for n in (8, int(pair.level.min())):
            x, y = pair.of(np.array([0, 1]), n)
            assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))
        assert not jaccard.close(pair, np.array([len(a), len(b)]), np.array([0]), np.array([1]), 9, 10)[0] or len(np.setxor1d(a, b)) < len(a) + len(b)


def test_components(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, 101), (7, 7), (200, 100), (31, 5)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in got} == {**{k: 0 for k in range(1, 32)}, 101: 100, 200: 100}
