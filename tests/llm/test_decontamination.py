import random

import pytest

from tallyridge.llm import decontamination as D

SCHEMA = "doc_id long, text string, item_id string"


def plain_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        left, row[0] = row[0], i
        for j, b in enumerate(text, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (a != b))
    return min(row)


def passage(rng, n):
    return " ".join("".join(rng.choice("abcdefghiklmnoprstué") for _ in range(rng.randrange(1, 9))) for _ in range(n))


def edited(rng, text, rate):
    return "".join(c if rng.random() >= rate else rng.choice(["", "x", c + "y"]) for c in text)


def test_distance_equals_the_plain_table():
    rng = random.Random(1)
    for _ in range(300):
        pattern = "".join(rng.choice("abé") for _ in range(rng.randrange(1, 90)))
        text = "".join(rng.choice("abé") for _ in range(rng.randrange(0, 120)))
        assert D.distance_in(pattern, text, 1000) == plain_distance(pattern, text)
        assert D.distance_in(pattern, text, 2) == min(3, plain_distance(pattern, text))


def test_distances_of_many_pairs_equal_those_of_each():
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abé語") for _ in range(n))
    pairs = [(word(rng.randrange(1, 300)), word(rng.randrange(0, 400))) for _ in range(300)] + [("a" * 128, "a" * 127), ("b" * 1500, "b" * 9), ("ab", "b" * 3000)]
    pairs += [(p, word(20) + p[:100] + word(3) + p[100:] + word(20)) for p, _ in pairs[:60]]
    assert D.distances(pairs) == [D.distance_in(p, t, 10**6) for p, t in pairs] and D.distances([]) == []


def test_recall_and_precision_against_brute_force(spark):
    rng = random.Random(2)
    items = [(k, passage(rng, rng.randrange(8, 60))) for k in range(60)] + [(99, "a b c"), (98, None), (97, "")]
    docs, want = [], set()
    for i in range(240):
        parts = [passage(rng, rng.randrange(0, 60)) for _ in range(3)]
        if i % 2 == 0:
            k = rng.randrange(60)
            parts.insert(rng.randrange(4), edited(rng, items[k][1], rng.choice([0, 0.02, 0.05])).upper())
        docs.append((i, "\n".join(parts)))
    for i, text in docs:
        for k, item in items[:60]:
            if D.distance_in(" ".join(item.split()), " ".join(text.lower().split()), 10**6) <= int(0.2 * len(item)):
                want.add((i, k))
    rows = docs + [(500, None), (501, ""), (502, "a b c")]
    d = spark.createDataFrame([(i, t, "z") for i, t in rows], SCHEMA)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in D.matches(d, b).collect()}
    assert got <= want and len(got) >= 0.97 * len(want) and len(want) >= 120
    kept = {r["doc_id"] for r in D.clean(d, b).collect()}
    assert kept == {i for i, _ in rows} - {i for i, _ in got}
    assert D.clean(d, b).columns == d.columns
    several = D.Settings(block_bytes=1000)
    assert {(r["doc_id"], r["item_id"]) for r in D.matches(d, b, several).collect()} == got


@pytest.mark.parametrize("docs,items", [([], [(1, "one two three four five six")]), ([(1, "x", "y")], [])])
def test_empty_tables(spark, docs, items):
    d, b = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string")
    assert D.matches(d, b).count() == 0
    assert D.clean(d, b).count() == len(docs)


@pytest.mark.parametrize("rate", [0.1, 0.15, 0.2])
def test_recall_up_to_the_largest_distance(rate):
    rng = random.Random(11)
    items = [(k, passage(rng, rng.randrange(12, 60))) for k in range(120)]
    index, hashes, got, want = D.Index(items, D.Settings()), D.WordHashes(), set(), set()
    texts = [" ".join((passage(rng, 40), edited(rng, t, rate), passage(rng, 40))) for _, t in items]
    for (k, item), text in zip(items, texts):
        if D.distance_in(item, " ".join(text.lower().split()), 10**6) <= int(0.2 * len(item)):
            want.add((k, k))
    got = {(d, i) for d, i, _ in index.matches([t.encode() for t in texts], hashes)}
    assert len(want) >= 60 and len(got & want) >= 0.9 * len(want)


def test_short_items_are_found_word_by_word(spark):
    items = spark.createDataFrame([(1, "Alpha beta"), (2, "x"), (3, "one two three four"), (4, " ")], "item_id long, text string")
    rows = [(1, "an ALPHA\nbeta here", ""), (2, "alphabeta", ""), (3, "beta alpha x", ""), (4, "one two three five", ""), (5, "so one two three four", ""), (6, None, "")]
    docs, own = spark.createDataFrame(rows, SCHEMA), D.Settings(short_items=True)
    assert {(r["doc_id"], r["item_id"], r["distance"]) for r in D.matches(docs, items, own).collect()} == {(1, 1, 0), (3, 2, 0), (5, 3, 0)}
    assert {r["doc_id"] for r in D.clean(docs, items, own).collect()} == {2, 4, 6}
