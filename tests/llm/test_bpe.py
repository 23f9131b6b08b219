import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from tallyridge.llm import bpe, catalog

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(reference, text):
    return np.array(reference.encode_ordinary(text or ""), "<u4").tobytes()


def hard_texts():
    draw = random.Random(5)
    letters = "abcdefgh éßжÜ中́'1 \n\t\U0001f600"
    texts = ["", None, " ", "\n\n  x", "it's we'll 12345 !?  ", "a" * 511, "a" * 512, "a" * 513, "ab" * 4000, "  x\x1c\x1dy", "<|endoftext|>"]
    return texts + ["".join(draw.choices(letters, k=draw.randint(1, 400))) for _ in range(300)] + ["".join(draw.choices("abcdef", k=3000))]


def test_ids_equal_tiktoken_and_decode_back(spark, reference):
    rows = [(k % 7, t, "mine", k) for k, t in enumerate(hard_texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int").repartition(3)
    coded = bpe.encode(docs, PATH, P.PATTERN)
    assert coded.columns == ["doc_id", "text", "n_tokens", "ids"]
    got = bpe.decode(coded, PATH).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.ids == ids(reference, r.text) and r.n_tokens == len(r.ids) // 4
        assert r.decoded == (r.text or "").encode()


def test_every_kind_of_character(reference):
    encoder = bpe.Encoder(PATH, P.PATTERN)
    texts = [f"a{chr(c)}b 1{chr(c)}2 {chr(c)}{chr(c)}'{chr(c)}\n" for c in [*range(0x20000), *range(0xE0000, 0xE0200)] if not 0xD800 <= c < 0xE000]
    for k in range(0, len(texts), 5000):
        assert encoder.texts(texts[k:k + 5000]) == [ids(reference, t) for t in texts[k:k + 5000]]


def test_bounds_of_the_tables_do_not_change_ids(reference, monkeypatch):
    texts = [t or "" for t in hard_texts()]
    for name, value in {"KNOWN_PIECES": 3, "KNOWN_CHARS": 2, "RUN_PIECES": 5, "MATRIX_CELLS": 64, "LONG_PIECE": 20}.items():
        monkeypatch.setattr(bpe, name, value)
    assert bpe.Encoder(PATH, P.PATTERN).texts(texts) == [ids(reference, t) for t in texts]


def test_overlapping_and_equal_ranks_take_the_leftmost(tmp_path):
    extra = [b"aa", b"ab", b"aab", b"ba", b"aaaa"]
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % n for n, t in enumerate([*(bytes([b]) for b in range(256)), *extra])))
    with open(path, "rb") as lines:
        own = tiktoken.Encoding("own", pat_str=r"[ab]+", mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, special_tokens={})
    encoder = bpe.Encoder(str(path), r"[ab]+")
    words = ["".join("ab"[n >> k & 1] for k in range(w)) for w in range(1, 11) for n in range(1 << w)]
    assert encoder.texts(words) == [ids(own, w) for w in words]
    assert [encoder.long(w.encode()) for w in words if w.encode() not in encoder.vocabulary.ranks] == [ids(own, w) for w in words if w.encode() not in encoder.vocabulary.ranks]


def test_empty_table_and_missing_byte(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(docs, PATH, P.PATTERN), PATH).count() == 0
    path = tmp_path / "ranks"
    path.write_bytes(base64.b64encode(b"a") + b" 0\n")
    with pytest.raises(ValueError, match="lacks the bytes"):
        bpe.Vocabulary(str(path))


def test_query_equals_tiktoken(spark, reference):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in catalog.op11_bpe_matrices(spark, folder).collect():
        want = ids(reference, texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(want) // 4, hashlib.sha256(want).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
