"""Benchmark decontamination by CGK embeddings and bit-sampling.

The CGK walk reads a sequence with a random walk: at each step it notes the current word and, by a random bit of word
and step, stays on it or goes on. Sequences with few edits fall back into step, so edit distance becomes Hamming
distance between the notes. Every item is embedded from each of its words on (the anchors); every item-sized window of
a document that starts at an anchor is embedded likewise. A repetition samples one note of the embedding besides the
anchor itself; a window that agrees with an item in keys whose words say enough together is a candidate (a long word
says more than a short one, and each word counts once), and the exact edit distance between the item and the best
stretch of the window decides. Items too short for walks are looked up word by word.

Items are a bounded block of text (``block_bytes``) in each pass over the documents; more items mean more passes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyridge.llm.tables import ODD, WordHashes, byte_slices, mixed, raw_texts, runs

TABLE_BITS = 20
SLICE_BYTES = 2 << 20  # of text handled at once inside a worker
WORDS = 200_000  # whose hashes a worker keeps
NEAR = 8  # words
LONGEST = 1024, 2048  # code points of an item and of a stretch that are compared with others at once
TOGETHER = 16, 1024  # least and largest number of such pairs
SAMPLES = (2, 5, 9, 14)  # steps of a walk after which its note is read


@dataclass(frozen=True)
class Settings:
    """``errors`` is the largest edit distance as a share of the item's characters; items of fewer than ``least_words``
    words have no walks: with ``short_items`` they are found where their words stand unchanged, else they take no part.
    The words that a window shares with an item need ``bits`` together, or ``share`` of what the item has. Keys of
    two words with fewer than ``pair_bits`` are left out where an item has enough others. More ``repetitions`` and fewer
    ``bits`` raise the recall."""

    errors: float = 0.2
    least_words: int = 5
    short_items: bool = False
    repetitions: int = 20
    bits: float = 27.0
    share: float = 0.35
    pair_bits: float = 15.0
    block_bytes: int = 4 << 20


SPACES = np.zeros(256, bool)
SPACES[list(b" \t\n\r\x0b\x0c")] = True
LONG_WORD = 64  # bytes; up to there words are hashed together, eight bytes at a time


def split(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text, as ``bytes.split`` finds them."""
    return runs(~SPACES[np.frombuffer(data, np.uint8)])


def hashed(data: bytes, starts: np.ndarray, ends: np.ndarray, long: WordHashes) -> np.ndarray:
    """64-bit hash of each word, by its bytes alone."""
    size = ends - starts
    out = size.astype(np.uint64) * ODD
    padded = data + bytes(8)
    eights = np.ndarray((len(data) + 1,), np.uint64, padded, strides=(1,))
    which = np.flatnonzero(size <= LONG_WORD)
    for done in range(0, LONG_WORD, 8):
        which = which[size[which] > done]
        unused = np.maximum(8 - (size[which] - done), 0).astype(np.uint64) * np.uint64(8)
        h = (out[which] ^ (eights[starts[which] + done] << unused)) * ODD
        out[which] = h ^ (h >> np.uint64(31))
    out = mixed(out)
    which = np.flatnonzero(size > LONG_WORD)
    out[which] = long.of([data[a:b] for a, b in zip(starts[which].tolist(), ends[which].tolist())])
    return out


def seed(r: int) -> np.uint64:
    return np.uint64((int(ODD) * (2 * r + 1)) % (1 << 64))


def notes(hashes: np.ndarray, at: np.ndarray, last: np.ndarray, s: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each repetition the keys (anchor and sampled note) of walks that start at ``at`` and end at ``last``, and the
    places noted. A walk that is still at its anchor, or has left its text, has noted nothing else: its key is zero and
    counts for nothing. ``SAMPLES`` repetitions read one walk."""
    own, last, first = hashes[at] * ODD, last.astype(np.int32), at.astype(np.int32)
    for r in range(s.repetitions):
        if r % len(SAMPLES) == 0:
            now, done, turns = first.copy(), 0, mixed(hashes ^ seed(r)).astype(np.uint16)  # a bit for each step
        for t in range(done, SAMPLES[r % len(SAMPLES)]):
            now += (turns[np.minimum(now, last)] >> np.uint16(t)) & np.uint16(1)
        done = SAMPLES[r % len(SAMPLES)]
        seen = np.minimum(now, last)
        yield np.where((now > at) & (now <= last), mixed(own + hashes[seen]) | np.uint64(1), np.uint64(0)), seen


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values; ``values`` has at least one and is sorted in place."""
    values.sort()
    return values[np.concatenate(([True], values[1:] != values[:-1]))]


def weights(words: list[bytes]) -> np.ndarray:
    """Bits that each word counts for, by its length alone: results do not depend on how items are cut into blocks."""
    return np.minimum(12.0, 3.0 + 1.5 * np.fromiter(map(len, words), float, len(words)))


def distance_in(pattern: str, text: str, most: int) -> int:
    """Smallest edit distance between the pattern and any stretch of the text, or ``most + 1``; bit-parallel."""
    if pattern in text:
        return 0
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    where: dict[str, int] = {}
    for k, c in enumerate(pattern):
        where[c] = where.get(c, 0) | 1 << k
    up, down, score, least = full, 0, m, m
    for c in text:
        eq = where.get(c, 0)
        x = eq | down
        h = (((eq & up) + up) ^ up) | eq
        plus, minus = down | (full & ~(h | up)), up & h
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
            least = min(least, score)
        plus, minus = (plus << 1) & full, (minus << 1) & full
        up, down = minus | (full & ~(x | plus)), plus & x
    return min(least, most + 1)


def distances(pairs: list[tuple[str, str]]) -> list[int]:
    """``distance_in`` of each (pattern, text) without a limit. Pairs of similar size go through the bit-parallel steps
    together; large pairs and those without enough others like them go alone."""
    out = [0] * len(pairs)
    small = [k for k, (p, t) in enumerate(pairs) if 0 < len(p) <= LONGEST[0] and len(t) <= LONGEST[1]]
    alone = list(set(range(len(pairs))).difference(small))
    small.sort(key=lambda k: len(pairs[k][1]))
    while small:
        most = 64 + len(pairs[small[0]][1]) * 3 // 2
        size = next((n for n, k in enumerate(small) if n == TOGETHER[1] or len(pairs[k][1]) > most), len(small))
        if size < TOGETHER[0]:
            alone += small[:size]
        else:
            for k, found in zip(small[:size], steps_together([pairs[k] for k in small[:size]]).tolist()):
                out[k] = found
        small = small[size:]
    for k in alone:
        out[k] = distance_in(*pairs[k], len(pairs[k][0]))
    return out


def steps_together(pairs: list[tuple[str, str]]) -> np.ndarray:
    """Distances of several pairs: words of 64 pattern places x pairs, one place of all texts at a time. Texts are padded
    with what equals nothing, which leaves the least distance as it is."""
    one, last = np.uint64(1), np.uint64(63)
    sizes = np.array([len(p) for p, _ in pairs])
    width, length = (int(sizes.max()) + 63) // 64, max(len(t) for _, t in pairs)
    known, masks, entries = {}, [np.zeros((1, width), np.uint64)], 1
    codes = np.zeros((length, len(pairs)), np.int64)
    for k, (p, t) in enumerate(pairs):
        if p not in known:
            chars, which = np.unique(np.frombuffer(p.encode("utf-32-le"), np.int32), return_inverse=True)
            mask, at = np.zeros((len(chars), width), np.uint64), np.arange(len(p))
            np.add.at(mask, (which, at >> 6), one << (at & 63).astype(np.uint64))
            masks.append(mask)
            known[p], entries = (chars, entries), entries + len(chars)
        chars, start = known[p]
        text = np.frombuffer(t.encode("utf-32-le"), np.int32)
        near = np.minimum(np.searchsorted(chars, text), len(chars) - 1)
        codes[:len(text), k] = np.where(chars[near] == text, start + near, 0)
    table = np.ascontiguousarray(np.concatenate(masks).T)
    up, down = np.full((width, len(pairs)), ~np.uint64(0)), np.zeros((width, len(pairs)), np.uint64)
    top, bit, cols = (sizes - 1) >> 6, ((sizes - 1) & 63).astype(np.uint64), np.arange(len(pairs))
    score, least = sizes.copy(), sizes.copy()
    for code in codes:
        eq = table.take(code, axis=1)
        x, h = eq | down, (eq & up) + up
        carry = (h < up)[:-1]
        while carry.any():
            h[1:] += carry
            carry &= h[1:] == 0
            carry = np.concatenate((np.zeros((1, len(pairs)), bool), carry[:-1]))
        h = (h ^ up) | eq
        plus, minus = down | ~(h | up), up & h
        score += ((plus[top, cols] >> bit) & one).astype(np.int64) - ((minus[top, cols] >> bit) & one).astype(np.int64)
        np.minimum(least, score, out=least)
        rise, fall = plus << one, minus << one
        rise[1:] |= plus[:-1] >> last
        fall[1:] |= minus[:-1] >> last
        up, down = fall | ~(x | rise), rise & x
    return least


class Index:
    """Anchors and sampled notes of a block of items, as sorted arrays, and the short items by their first word."""

    def __init__(self, items: list[tuple[int, str]], s: Settings):
        self.s, self.items, self.short = s, [], {}
        long = WordHashes()

        def of(words: list[bytes]) -> np.ndarray:
            data = b" ".join(words)
            return hashed(data, *split(data), long)

        entry, keys, noted, needs = [], [[] for _ in range(s.repetitions)], [[] for _ in range(s.repetitions)], []
        known: dict[bytes, int] = {}
        for item, text in items:
            words = text.encode().lower().split()
            number = len(self.items)
            if len(words) < s.least_words:
                if words and s.short_items:
                    own = of(words)
                    self.short.setdefault(int(own[0]), []).append((number, own))
                    self.items.append((item, b" ".join(words).decode(), len(words)))
                    needs.append(0.0)
                continue
            h = of(words)
            at = np.arange(len(words))
            self.items.append((item, b" ".join(words).decode(), len(words)))
            ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
            last = np.full(len(at), len(h) - 1)
            worth = weights(words)
            needs.append(min(s.bits, s.share * float(weights(list(set(words))).sum())))
            rich = needs[-1] == s.bits
            for r, (key, place) in enumerate(notes(h, at, last, s)):
                keys[r].append(np.where(worth + worth[place] < s.pair_bits, np.uint64(0), key) if rich else key)
                noted[r].append(ids[place])
            entry.append(np.stack([np.full(len(at), number), at, ids], axis=1))
        self.entries = np.concatenate(entry) if entry else np.empty((0, 3), np.int64)
        self.needs, self.bits = np.array(needs), weights(list(known))
        self.anchors = np.unique(of(list(known)))
        self.firsts = np.sort(np.array(list(self.short), np.uint64))
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[self.anchors >> np.uint64(64 - TABLE_BITS)] = True
        self.keys, self.first, self.times, self.order, self.noted, self.tables = [], [], [], [], [], []
        for own, words in zip(keys, noted):
            flat = np.concatenate(own) if own else np.empty(0, np.uint64)
            order = np.argsort(flat, kind="stable")
            for kept, values in zip((self.keys, self.first, self.times), np.unique(flat[order], return_index=True, return_counts=True)):
                kept.append(values)
            self.order.append(order)
            self.noted.append(np.concatenate(words) if words else np.empty(0, np.int64))
            table = np.zeros(1 << TABLE_BITS, bool)
            table[flat >> np.uint64(64 - TABLE_BITS)] = True
            self.tables.append(table)

    def candidates(self, hashes: np.ndarray, doc: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Distinct (document, item, first word of the window), as rows."""
        at = np.flatnonzero(self.table[hashes >> np.uint64(64 - TABLE_BITS)])
        if not len(at) or not len(self.anchors):
            return np.empty((0, 3), np.int64)
        near = np.minimum(np.searchsorted(self.anchors, hashes[at]), len(self.anchors) - 1)
        at = at[self.anchors[near] == hashes[at]]
        last, found = ends[doc[at]] - 1, []
        for r, (key, _) in enumerate(notes(hashes, at, last, self.s)):
            own = np.flatnonzero((key > 0) & self.tables[r][key >> np.uint64(64 - TABLE_BITS)])
            near = np.minimum(np.searchsorted(self.keys[r], key[own]), len(self.keys[r]) - 1)
            same = self.keys[r][near] == key[own]
            own, near = own[same], near[same]
            lo, times = self.first[r][near], self.times[r][near]
            k = np.repeat(np.arange(len(own)), times)
            line = self.order[r][np.arange(len(k)) - np.repeat(np.cumsum(times) - times, times) + lo[k]]
            which, start = self.entries[line], at[own[k]]
            found.append(np.stack([doc[start], which[:, 0], start - which[:, 1], which[:, 2], self.noted[r][line]]))
        hits = np.concatenate(found, axis=1)
        if not hits.shape[1]:
            return np.empty((0, 3), np.int64)
        low = int(hits[2].min())
        span, n = (int(hits[2].max()) - low) // NEAR + 3, len(self.bits)
        enough = np.zeros(hits.shape[1], bool)
        for shift in (0, NEAR // 2):  # windows whose starts differ by inserted or missing words count together
            place = hits[1] * span + (hits[2] - low + shift) // NEAR
            words = distinct(np.concatenate([place * n + hits[3], place * n + hits[4]]))
            at = words // n
            first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
            sums, at = np.add.reduceat(self.bits[words - at * n], first), at[first]
            good = at[sums >= self.needs[at // span]]
            if len(good):
                enough |= good[np.minimum(np.searchsorted(good, place), len(good) - 1)] == place
        return np.unique(hits[:3, enough].T, axis=0)

    def unchanged(self, hashes: np.ndarray, left: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Short items and the words at which their words begin to stand in a text; ``left`` counts the words of the
        text from each word on."""
        if not self.short:
            return
        near = np.minimum(np.searchsorted(self.firsts, hashes), len(self.firsts) - 1)
        found = np.flatnonzero(self.firsts[near] == hashes)
        order = found[np.argsort(hashes[found], kind="stable")]
        for part in np.split(order, np.flatnonzero(np.diff(hashes[order])) + 1) if len(order) else []:
            for number, own in self.short[int(hashes[part[0]])]:
                at = part[left[part] >= len(own)]
                for k in range(1, len(own)):
                    at = at[hashes[at + k] == own[k]]
                yield number, at

    def matches(self, texts: list[bytes], hashes: WordHashes) -> Iterator[tuple[int, int, int]]:
        """(document, item number, distance) of all confirmed pairs, with the smallest distance found. ``hashes`` keeps
        those of very long words."""
        data = b"\n".join(texts).lower()
        begins, ends = split(data)
        flat = hashed(data, begins, ends, hashes)
        offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
        bounds = np.searchsorted(begins, offsets)
        starts, sizes = bounds[:-1], np.diff(bounds)
        doc = np.repeat(np.arange(len(texts)), sizes)

        def stretch(a: int, b: int) -> str:
            return b" ".join(data[x:y] for x, y in zip(begins[a:b].tolist(), ends[a:b].tolist())).decode("utf-8", "replace")

        best: dict[tuple[int, int], int] = {}
        asked: dict[tuple[str, str], list[tuple[int, int, int]]] = {}
        for number, at in self.unchanged(flat, bounds[1:][doc] - np.arange(len(flat))):
            _, text, n = self.items[number]
            for k in at.tolist():
                if (doc[k], number) not in best and stretch(k, k + n) == text:
                    best[int(doc[k]), number] = 0
        rows = self.candidates(flat, doc, bounds[1:])
        new = np.ones(len(rows), bool)  # neighbouring windows are compared as one
        new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1) | (rows[1:, 2] - rows[:-1, 2] > NEAR)
        tails = np.append(np.flatnonzero(new)[1:], len(rows)) - 1 if len(rows) else []
        for (d, item, first), final in zip(rows[new].tolist(), rows[tails, 2].tolist() if len(rows) else []):
            if best.get((d, item)) == 0:
                continue
            _, text, n = self.items[item]
            room = 2 + int(n * self.s.errors)
            most, low = int(len(text) * self.s.errors), int(starts[d])
            own = stretch(max(low, first - room), min(low + int(sizes[d]), max(low, final + n + room)))
            if text in own:
                best[d, item] = 0
            else:
                asked.setdefault((text, own), []).append((d, item, most))
        for found, askers in zip(distances(list(asked)), asked.values()):
            for d, item, most in askers:
                if found <= most:
                    best[d, item] = min(found, best.get((d, item), found))
        for (d, item), found in best.items():
            yield d, item, found


def blocks(items: DataFrame, s: Settings, id_col: str, text_col: str) -> list[list[tuple[int, str]]]:
    """The items in blocks of at most ``block_bytes`` of text (a larger item is a block of its own). Null ids and texts are left out."""
    out: list[list[tuple[int, str]]] = []
    room = 0
    rows = items.select(items[id_col].cast("long").alias("i"), items[text_col].cast("string").alias("t")).where("i IS NOT NULL AND t IS NOT NULL")
    for r in rows.distinct().orderBy("i", "t").toLocalIterator():
        size = len(r["t"].encode())
        if not out or size > room:
            out.append([])
            room = s.block_bytes
        out[-1].append((r["i"], r["t"]))
        room -= size
    return out


def matches(docs: DataFrame, items: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, distance, item_chars): every item found in a document, once per document row and item text.

    Texts are compared with A-Z in lower case and one space between words; ``distance`` counts code points and is at most
    ``errors`` of the item's. Null and empty texts contain nothing. Empty tables give no rows. Repeated rows repeat.
    """
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    out = None
    for block in blocks(items, settings, item_col, item_text_col):

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            index, hashes = Index(block, settings), WordHashes(WORDS)
            for batch in byte_slices(batches, "text", SLICE_BYTES):
                found = list(index.matches(raw_texts(batch.column("text")), hashes))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array([d for d, _, _ in found], pa.int64())), pa.array([index.items[i][0] for _, i, _ in found], pa.int64()),
                     pa.array([x for _, _, x in found], pa.int32()), pa.array([len(index.items[i][1]) for _, i, _ in found], pa.int32())],
                    ["doc_id", "item_id", "distance", "item_chars"])

        own = rows.mapInArrow(run, "doc_id long, item_id long, distance int, item_chars int")
        out = own if out is None else out.unionByName(own)
    return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, distance int, item_chars int") if out is None else out


def clean(docs: DataFrame, items: DataFrame, settings: Settings = Settings(), text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that contain no item, unchanged. The text column must be of type string."""
    for block in blocks(items, settings, item_col, item_text_col):

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            index, hashes = Index(block, settings), WordHashes(WORDS)
            for batch in byte_slices(batches, text_col, SLICE_BYTES):
                kept = np.ones(batch.num_rows, bool)
                kept[[d for d, _, _ in index.matches(raw_texts(batch.column(text_col)), hashes)]] = False
                yield batch.filter(pa.array(kept))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
