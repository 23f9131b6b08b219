import hashlib
import random

import pytest

from tallyridge.llm import substrings

SCHEMA = "doc_id long, text string, bucket int, h string"


def brute(rows, window):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    rank = lambda i: (i is not None, i or 0)
    for i, w in words:
        for s in range(len(w) - window + 1):
            key = tuple(w[s:s + window])
            first[key] = min(first.get(key, (rank(i), s)), (rank(i), s))
    out = []
    for i, w in words:
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s:s + window])] < (rank(i), s):
                gone.update(range(s, s + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), kept.decode()))
    return sorted(out, key=repr)


def corpus(seed, n=60):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(12)] + ["é", "ß,", "ſ"]
    line = lambda k: " ".join(rng.choice(words) for _ in range(k))
    shared = [line(rng.randrange(6, 40)) for _ in range(4)]
    rows = []
    for i in range(n):
        parts = [line(rng.randrange(0, 30)) for _ in range(rng.randrange(1, 4))]
        if i % 3 == 0:
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(shared))
        if i % 11 == 0:
            parts.append(shared[0] + "\n" + shared[0])
        rows.append((i, "\t".join(parts)))
    return rows + [(n, None), (n + 1, ""), (n + 2, "   x"), (3, "a " * 50), (3, "a " * 50), (3, rows[0][1]), (None, rows[1][1]), (n + 3, rows[1][1])]


@pytest.mark.parametrize("window,phrase,bucket_bytes", [(6, 3, 300), (5, 5, 1 << 20), (20, 10, 2000)])
def test_equals_brute_force(spark, window, phrase, bucket_bytes):
    rows = corpus(window)
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA)
    got = substrings.remove_repeats(docs, window, phrase, bucket_bytes=bucket_bytes)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, window)


def test_empty_table(spark):
    assert substrings.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_digest_of_kept_words(spark, tmp_path):
    from tallyridge.llm import catalog

    spark.createDataFrame([(1, "x y"), (2, None)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r["doc_id"]: r["kept_sha256"] for r in catalog.op1_repeated_phrases(spark, str(tmp_path)).collect()}
    assert rows == {1: hashlib.sha256(b"x y").hexdigest(), 2: hashlib.sha256(b"").hexdigest()}
