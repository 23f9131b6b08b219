import zlib

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from tallyridge.llm import packing

FILE = path("word_bpe_49k.json")
TEXTS = [None, "", " \n\t", "a", "Der Übermut, and 'tis 3.14 it's... ok.", "x" * 300, "word " * 5000, "ΑΣ. ΑΣ, <|endoftext|>b ñ́ İx ﬁ é. ́a", "héé, naïve. Straße ŒUVRE æ.",
         "日本語 テキスト。 emoji 🙂🙂, done."]


def expected(text):
    ids = Tokenizer.from_file(FILE).encode(text or "", add_special_tokens=False).ids + [2]
    return np.array(ids, "<u4")


@pytest.mark.parametrize("capacity", [8, 256, 4096])
def test_pieces_are_whole_and_bins_without_padding(spark, capacity):
    rows = [(k, t, "other") for k, t in enumerate(TEXTS)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string").repartition(2)
    got = packing.pack(docs, FILE, capacity, keep_ids=True).collect()
    assert packing.pack(docs, FILE, capacity).columns == [c.split()[0] for c in packing.SCHEMA.split(", ")]
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
        ids = np.array(r.ids, "<u4")
        assert len(ids) == r.length and zlib.crc32(ids.tobytes()) == r.ids_crc32
    for k, text in enumerate(TEXTS):
        ids, own = expected(text), sorted(by_doc[k], key=lambda r: r.start)
        assert sum(r.length for r in own) == 3 * len(ids) and {r.doc_tokens for r in own} == {len(ids)}
        assert all(list(ids[r.start:r.start + r.length]) == r.ids for r in own)
        assert sorted(r.start for r in own)[::3] == sorted({r.start for r in own})
    for own in by_sequence.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(q.length for q in own[:k]) for k in range(len(own))]
        total = sum(r.length for r in own)
        assert total <= capacity and total & (total - 1) == 0


def test_words_are_encoded_as_the_whole_text(spark):
    encoder = packing.WordEncoder(FILE, limit=7)  # the table is emptied all the time
    for text in TEXTS:
        assert encoder.ids((text or "").encode()) + b"\2\0\0\0" == expected(text).tobytes()
    for c in map(chr, range(0x21, 0x250)):
        word = f"a{c}b{c}."
        assert encoder.ids(word.encode()) == expected(word).tobytes()[:-4]


def test_empty_table_and_capacity(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(docs, FILE).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, FILE, 1000)
