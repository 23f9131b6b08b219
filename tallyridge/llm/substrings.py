"""Removal of repeated passages by repeated-phrase automata.

A passage is ``window`` consecutive words. Every passage contains at least one chosen phrase (``phrase`` words whose
hash is the smallest within the passage), and equal passages contain equal ones, so a passage can only recur if one of
its chosen phrases does:

1. chosen phrases are counted over all documents; those that occur twice or more are confirmed as recurring;
2. documents lie in buckets of a few megabytes. Each bucket compiles the recurring phrases that occur in it into an
   Aho-Corasick automaton of its own (a shard; it cannot outgrow its bucket) and streams its documents through it. Every
   passage around a located phrase is identified by 96 bits of hash; all but a bucket's first are settled at once;
3. the first ones of all buckets meet by identifier, in order of document and place. What has an earlier equal goes back
   to its bucket, where the covered words are cut out.

The texts are shuffled once, by bucket, and that exchange is read by all three steps. A phrase or passage that fills a
third of the corpus reaches the shuffles at most once per bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyridge.llm.tables import ODD, WordHashes, byte_slices, mixed, parts, phrase_hashes, raw_texts, runs

SECOND = np.uint64(0xD6E8FEB86659FD93)  # odd factor of the second passage hash
BUCKET_BYTES = 4 << 20
MOST_PARTITIONS = 20_000
HIGH_BITS, LOW_BITS, HIGH_FROM, LOW_FROM, BREAK = 9, 12, 0x100, 0x1000, 0x2FFF  # characters of a word


class Words:
    """Words of some documents in one array, with the place of each document."""

    def __init__(self, texts: list[bytes], hashes: WordHashes, keep: bool = False):
        lists = [t.split() for t in texts]  # ASCII white space only
        self.sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.hashes = np.concatenate([hashes.of(w) for w in lists]) if lists else np.empty(0, np.uint64)
        self.doc = np.repeat(np.arange(len(lists)), self.sizes)
        self.lists = lists if keep else None

    def whole(self, window: int) -> np.ndarray:
        """Whether a passage starts at each word and ends in the same document."""
        n = len(self.doc) - window + 1
        return self.doc[:n] == self.doc[window - 1:] if n > 0 else np.empty(0, bool)

    def symbols(self) -> str:
        """Two characters per word, of alphabets that do not overlap, and two breaks between documents; equal words have
        equal characters. Small alphabets keep the automaton's nodes narrow."""
        code = (self.hashes >> np.uint64(64 - HIGH_BITS - LOW_BITS)).astype(np.uint32)
        pair = np.stack([(code >> LOW_BITS) + HIGH_FROM, (code & ((1 << LOW_BITS) - 1)) + LOW_FROM], axis=1)
        return np.insert(pair, self.starts[1:], BREAK, axis=0).astype("<u2").tobytes().decode("utf-16-le")


def extreme(x: np.ndarray, width: int, pick) -> np.ndarray:
    """Smallest or largest of each ``width`` consecutive values, by doubling."""
    done, out = 1, x
    while done * 2 <= width:
        out, done = pick(out[:-done], out[done:]), done * 2
    rest = width - done
    return pick(out[:-rest], out[rest:]) if rest else out


def chosen_phrases(words: Words, window: int, phrase: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of the phrases that are the smallest of a passage that contains them."""
    whole = words.whole(window)
    if not whole.any():
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    span = window - phrase + 1
    hashes = phrase_hashes(words.hashes, phrase) | np.uint64(1)
    least = np.where(whole, extreme(hashes, span, np.minimum), np.uint64(0))
    edge = np.zeros(span - 1, np.uint64)
    reached = extreme(np.concatenate((edge, least, edge)), span, np.maximum)
    at = np.flatnonzero(reached == hashes)
    return at, hashes[at]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64), pa.int64())


def _ordered(table: pa.Table) -> tuple[list, list[bytes]]:
    """Ids and texts of a bucket by id (null first), then text: the row numbers that the steps share."""
    rows = sorted(zip(table["doc_id"].to_pylist(), raw_texts(table["text"].combine_chunks() if table.num_rows else pa.array([], pa.string()))),
                  key=lambda r: (r[0] is not None, r[0], r[1]))
    return [i for i, _ in rows], [t for _, t in rows]


def located(texts: list[bytes], ids: list, exemplars: list[tuple], window: int, phrase: int, hashes: WordHashes) -> tuple[Words, np.ndarray]:
    """The bucket's words and the starts of all passages that contain a recurring phrase."""
    words = Words(texts, hashes)
    symbols = words.symbols()
    shift = words.starts + np.arange(len(texts))  # place of each document's first word among words and breaks
    rows_of: dict = {}
    for r, i in enumerate(ids):
        rows_of.setdefault(i, []).append(r)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for i, place in exemplars:
        for r in rows_of.get(i, ()):
            if place + phrase <= words.sizes[r]:
                first = 2 * (int(shift[r]) + place)
                automaton.add_word(symbols[first:first + 2 * phrase], 1)
    if not len(automaton):
        return words, np.empty(0, np.int64)
    automaton.make_automaton()
    ends = np.fromiter((e for e, _ in automaton.iter(symbols)), np.int64)
    at = (ends + 1) // 2 - phrase
    at -= np.searchsorted(shift, at, side="right") - 1  # breaks are no words
    near = np.zeros(len(words.doc) + 2, np.int64)
    np.add.at(near, np.maximum(0, at - (window - phrase)), 1)
    np.add.at(near, at + 1, -1)
    whole = words.whole(window)
    return words, np.flatnonzero((np.cumsum(near)[:len(whole)] > 0) & whole)


def remove_repeats(docs: DataFrame, window: int = 20, phrase: int = 10, id_col: str = "doc_id", text_col: str = "text",
                   bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, n_words, n_removed, text): the documents without the words of passages that start earlier elsewhere.

    Words are runs of anything but ASCII white space; ``text`` has the kept ones joined by one space. Earlier means a
    smaller id (null ids first), or the same id and an earlier start; passages at the same id and start (repeated rows)
    are not earlier than each other. Null and empty texts have no words; one row is returned per row given. Other
    columns are ignored.
    """
    if not 1 <= phrase <= window:
        raise ValueError("a phrase has between one word and a whole window")
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    buckets = parts(rows, "text", bucket_bytes)
    spread = min(buckets, MOST_PARTITIONS)
    bucket_of = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(0))), F.lit(buckets)).cast("int")
    held = rows.withColumn("bucket", bucket_of).repartition(spread, "bucket")

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in byte_slices(batches, "text"):
            words = Words(raw_texts(batch.column("text")), hashes)
            at, h = chosen_phrases(words, window, phrase)
            if not len(at):
                continue
            own = words.doc[at]
            key = h ^ mixed(batch.column("bucket").to_numpy()[own].astype(np.uint64) + np.uint64(1))
            _, first, count = np.unique(key, return_index=True, return_counts=True)
            at, own, h = at[first], own[first], h[first]
            yield pa.RecordBatch.from_arrays(
                [_signed(h), batch.column("doc_id").take(pa.array(own)), pa.array((at - words.starts[own]).astype(np.int32)), pa.array(count > 1)],
                ["h", "doc_id", "place", "twice"])

    phrases = held.mapInArrow(choose, "h long, doc_id long, place int, twice boolean")
    by_phrase = Window.partitionBy("h")
    recurring = (phrases.withColumn("__n", F.count(F.lit(1)).over(by_phrase)).withColumn("__twice", F.max("twice").over(by_phrase))
                 .where("__n > 1 OR __twice").select("doc_id", "place").withColumn("bucket", bucket_of).repartition(spread, "bucket"))

    def identify(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        ids, texts = _ordered(left)
        words, at = located(texts, ids, list(zip(right["doc_id"].to_pylist(), right["place"].to_pylist())), window, phrase, WordHashes())
        h1 = phrase_hashes(words.hashes, window)[at]
        h2 = phrase_hashes(words.hashes, window, SECOND)[at] >> np.uint64(32)
        row = words.doc[at]
        start = at - words.starts[row]
        name = np.array([-(1 << 63) if i is None else i for i in ids], np.int64)[row]
        order = np.lexsort((at, h2, h1))
        new = np.ones(len(at), bool)
        s1, s2 = h1[order], h2[order]
        new[1:] = (s1[1:] != s1[:-1]) | (s2[1:] != s2[:-1])
        leader = order[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        same = np.empty(len(at), bool)
        same[order] = (name[order] == name[leader]) & (start[order] == start[leader])
        first = np.flatnonzero(same)  # the bucket's earliest passages of their wording
        flags = np.zeros(len(words.doc) + 1, bool)
        flags[at[~same]] = True
        a, b = runs(flags)
        own = words.doc[a]
        begin = a - words.starts[own]
        h1 = np.concatenate((h1[first], mixed(a.astype(np.uint64) * ODD + np.uint64(key[0].as_py() + 1))))
        h2 = np.concatenate((h2[first].astype(np.int64), np.full(len(a), -1, np.int64)))
        nulls = np.array([i is None for i in ids], bool)
        every_row = np.concatenate((row[first], own))
        every_id = pa.array(np.array([0 if i is None else i for i in ids], np.int64)[every_row], mask=nulls[every_row])
        return pa.table({"h1": _signed(h1), "h2": pa.array(h2), "doc_id": every_id, "start": pa.array(np.concatenate((start[first], begin)).astype(np.int32)),
                         "row": pa.array(every_row.astype(np.int32)), "n": pa.array(np.concatenate((np.zeros(len(first)), b - a)).astype(np.int32))})

    passages = held.groupBy("bucket").cogroup(recurring.groupBy("bucket")).applyInArrow(
        identify, "h1 long, h2 long, doc_id long, start int, row int, n int")
    earliest = Window.partitionBy("h1", "h2").orderBy("doc_id", "start").rowsBetween(Window.unboundedPreceding, 0)
    repeated = (passages.withColumn("__id", F.first("doc_id").over(earliest)).withColumn("__start", F.first("start").over(earliest))
                .where("n > 0 OR NOT (doc_id <=> __id AND start = __start)")
                .select("row", "start", F.greatest("n", F.lit(1)).alias("n"), bucket_of.alias("bucket")).repartition(spread, "bucket"))

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, texts = _ordered(left)
        if not ids:
            return pa.table({"doc_id": pa.array([], pa.int64()), "n_words": pa.array([], pa.int64()), "n_removed": pa.array([], pa.int64()), "text": pa.array([], pa.string())})
        lists = [t.split() for t in texts]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        base = np.cumsum(sizes) - sizes
        begin = base[right["row"].to_numpy()] + right["start"].to_numpy() if right.num_rows else np.empty(0, np.int64)
        cover = np.zeros(int(sizes.sum()) + 1, np.int64)
        np.add.at(cover, begin, 1)
        np.add.at(cover, begin + (right["n"].to_numpy() if right.num_rows else begin) + window - 1, -1)
        gone = np.cumsum(cover)[:-1] > 0
        before = np.concatenate(([0], np.cumsum(gone)))
        removed = before[base + sizes] - before[base]
        kept = []
        for words, at, size, less in zip(lists, base, sizes, removed):
            kept.append(b" ".join([w for w, g in zip(words, gone[at:at + size].tolist()) if not g] if less else words))
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(sizes), "n_removed": pa.array(removed, pa.int64()),
                         "text": pa.array(kept, pa.binary()).cast(pa.string())})

    return held.groupBy("bucket").cogroup(repeated.groupBy("bucket")).applyInArrow(cut, "doc_id long, n_words long, n_removed long, text string")
