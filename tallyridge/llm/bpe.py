"""Byte-level BPE encoding and decoding on padded matrices.

A pattern cuts a text into pieces; every piece is a row of token ids, at first its bytes. Rows of similar length stand in
one matrix, padded on the right. In each round every row merges its leftmost pair of the lowest rank: pair ranks come
from an open-addressing hash table over all pairs whose bytes together are a token, the merged column is taken out of
all rows (compaction), and only the two pairs beside it are looked up again. Rows without a pair leave the matrix.

Nothing is shuffled: documents are independent, and a worker keeps the ids of pieces it has met in a bounded table.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyridge.llm.tables import ODD, byte_slices, raw_texts

NONE = np.int32(2 ** 31 - 1)
PAD = np.int32(-1)
EMPTY = np.uint64(2 ** 64 - 1)
RUN_PIECES = 1 << 16
MATRIX_CELLS = 1 << 20
#: Pieces of more bytes would need as many rounds over their whole row; they take the same merges from a heap.
LONG_PIECE = 512
#: Bounds of the table of known pieces; results do not depend on them.
KNOWN_PIECES, KNOWN_CHARS = 400_000, 48


class PairTable:
    """Hash table from (left id, right id) to the rank of their union, with linear probing and batch lookup."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        keys = self.key(left, right)
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys, self.ranks = np.full(1 << bits, EMPTY, np.uint64), np.full(1 << bits, NONE, np.int32)
        todo, slot = np.arange(len(keys)), self.slot(keys)
        while len(todo):
            free = self.keys[slot] == EMPTY
            self.keys[slot[free]] = keys[todo[free]]  # of several for one slot the last stays, the others go on
            placed = self.keys[slot] == keys[todo]
            self.ranks[slot[placed]] = rank[todo[placed]]
            todo, slot = todo[~placed], (slot[~placed] + 1) & self.mask

    @staticmethod
    def key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.uint32).astype(np.uint64) << np.uint64(32)) | right.astype(np.uint32).astype(np.uint64)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * ODD) >> self.shift).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = self.key(left, right).ravel()
        slot = self.slot(keys)
        held = self.keys[slot]
        out = np.where(held == keys, self.ranks[slot], NONE)
        todo = np.flatnonzero((held != keys) & (held != EMPTY))
        slot = slot[todo]
        while len(todo):
            slot = (slot + 1) & self.mask
            held = self.keys[slot]
            hit = held == keys[todo]
            out[todo[hit]] = self.ranks[slot[hit]]
            on = ~hit & (held != EMPTY)
            todo, slot = todo[on], slot[on]
        return out.reshape(left.shape)


class Vocabulary:
    """Tokens by rank, read from a file with one base64 token and its rank per line."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks the bytes {missing[:5]}")
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)

    def pair_table(self) -> PairTable:
        find, found = self.ranks.get, []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left = find(token[:cut])
                if left is not None and (right := find(token[cut:])) is not None:
                    found.append((left, right, rank))
        return PairTable(*np.array(found, np.int32).reshape(-1, 3).T)


def bucket(length: int) -> int:
    """Width of the matrix for a piece: its own length up to 16 bytes, then steps of an eighth of a power of two."""
    step = max(1, 1 << max(0, length.bit_length() - 4))
    return -(-length // step) * step


class Encoder:
    """Ids (little-endian unsigned 32 bits) of texts."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.vocabulary, self.pattern = Vocabulary(path), regex.compile(pattern)
        self.pairs, self.known = self.vocabulary.pair_table(), {}

    def merged(self, rows: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        """Ids of each row of a padded matrix, after all rounds."""
        out: list[bytes] = [b""] * len(rows)
        place = np.arange(len(rows))
        ranks = self.pairs(rows[:, :-1], rows[:, 1:])
        while len(rows):
            row = np.arange(len(rows))
            at = ranks.argmin(1) if ranks.shape[1] else np.zeros(len(rows), np.int64)  # the first, so the leftmost, of the lowest
            low = ranks[row, at] if ranks.shape[1] else np.full(len(rows), NONE)
            over = low == NONE
            if over.any():
                raw, wide = rows[over].astype("<u4").tobytes(), 4 * rows.shape[1]
                for k, (i, n) in enumerate(zip(place[over].tolist(), lengths[over].tolist())):
                    out[i] = raw[k * wide:k * wide + 4 * n]
                rows, ranks, place, lengths, at, low = (x[~over] for x in (rows, ranks, place, lengths, at, low))
                row = np.arange(len(rows))
                if not len(rows):
                    break
            rows[row, at] = low
            keep = np.ones(rows.shape, bool)
            keep[row, at + 1] = False
            rows = rows[keep].reshape(len(row), -1)
            keep = np.ones(ranks.shape, bool)
            keep[row, at] = False
            ranks = ranks[keep].reshape(len(row), -1)
            lengths = lengths - 1
            before, after = np.flatnonzero(at > 0), np.flatnonzero(at < ranks.shape[1])
            ranks[before, at[before] - 1] = self.pairs(rows[before, at[before] - 1], low[before])
            ranks[after, at[after]] = self.pairs(low[after], rows[after, at[after] + 1])
        return out

    def long(self, piece: bytes) -> bytes:
        """The same merges for one very long piece: a heap by (rank, place) over linked tokens."""
        find, n = self.vocabulary.ranks.get, len(piece)
        part = [piece[i:i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank, i) for i in range(n - 1) if (rank := find(part[i] + part[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if not part[i] or j >= n or find(part[i] + part[j]) != rank:
                continue  # one of the two was merged meanwhile
            part[i], part[j] = part[i] + part[j], b""
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (rank := find(part[i] + part[after[i]])) is not None:
                    heapq.heappush(heap, (rank, i))
            if before[i] >= 0 and (rank := find(part[before[i]] + part[i])) is not None:
                heapq.heappush(heap, (rank, before[i]))
        return np.array([find(p) for p in part if p], "<u4").tobytes()

    def pieces(self, pieces: Iterable[str]) -> dict[str, bytes]:
        """Ids of distinct pieces. A piece that is a token is that token."""
        out: dict[str, bytes] = {}
        buckets: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            raw = piece.encode()
            rank = self.vocabulary.ranks.get(raw)
            if rank is not None:
                out[piece] = rank.to_bytes(4, "little")
            elif len(raw) > LONG_PIECE:
                out[piece] = self.long(raw)
            else:
                buckets.setdefault(bucket(len(raw)), []).append((piece, raw))
        for width, group in buckets.items():
            size = max(1, MATRIX_CELLS // width)
            for start in range(0, len(group), size):
                names, raws = zip(*group[start:start + size])
                lengths = np.fromiter(map(len, raws), np.int64, len(raws))
                flat = self.vocabulary.of_byte[np.frombuffer(b"".join(raws), np.uint8)]
                rows = np.full((len(raws), width), PAD, np.int32)
                rows[np.arange(width) < lengths[:, None]] = flat
                out.update(zip(names, self.merged(rows, lengths)))
        return out

    def runs(self, text: str) -> Iterator[list[str]]:
        """The pieces of a text, of a very long one a run at a time."""
        if len(text) <= RUN_PIECES * 16:
            yield self.pattern.findall(text)
        else:
            found = (m.group() for m in self.pattern.finditer(text))
            while run := list(islice(found, RUN_PIECES)):
                yield run

    def texts(self, texts: list[str]) -> list[bytes]:
        out: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[int, list[str]]] = []
        held = 0

        def flush() -> None:
            if len(self.known) > KNOWN_PIECES:
                self.known.clear()
            new = self.pieces(set().union(*[run for _, run in waiting]) - self.known.keys())
            self.known.update(new)
            for i, run in waiting:
                out[i].append(b"".join(map(self.known.__getitem__, run)))
            for piece in [p for p in new if len(p) > KNOWN_CHARS]:
                del self.known[piece]
            waiting.clear()

        for i, text in enumerate(texts):
            for run in self.runs(text):
                waiting.append((i, run))
                held += len(run)
                if held >= 4 * RUN_PIECES:
                    flush()
                    held = 0
        flush()
        return [b"".join(parts) for parts in out]


def _fields(df: DataFrame, keep: list[str], *new: tuple[str, T.DataType]) -> T.StructType:
    names = {name for name, _ in new}
    return T.StructType([f for f in (df.schema[c] for c in keep) if f.name not in names] + [T.StructField(n, t) for n, t in new])


def encode(docs: DataFrame, rank_path: str, pattern: str, keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """The columns ``keep`` (all by default), ``n_tokens`` long and ``ids`` binary: little-endian unsigned 32-bit ids.

    Every match of ``pattern`` is encoded on its own by the ranks of the file at ``rank_path``, which every worker must
    be able to open; there are no special tokens. Null and empty texts have no ids. Columns of ``docs`` called
    ``n_tokens`` or ``ids`` are replaced. Rows stay as many as they are, repeated ones too; an empty table stays empty.
    """
    keep = [c for c in (keep or docs.columns) if c not in ("n_tokens", "ids")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for b in byte_slices(batches, "__text", 1 << 20):
            encoder = encoder or Encoder(rank_path, pattern)
            ids = encoder.texts([t.decode("utf-8", "replace") for t in raw_texts(b.column(len(keep)))])
            n = pa.array([len(i) // 4 for i in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], n, pa.array(ids, pa.binary())], [*keep, "n_tokens", "ids"])

    schema = _fields(docs, keep, ("n_tokens", T.LongType()), ("ids", T.BinaryType()))
    return docs.select(*keep, docs[text_col].alias("__text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, rank_path: str, keep: list[str] | None = None, ids_col: str = "ids") -> DataFrame:
    """The columns ``keep`` (all by default) and ``decoded`` binary: the tokens' bytes in order.

    Null and empty ids give empty bytes; an id that the vocabulary lacks is an error. A column ``decoded`` is replaced.
    """
    keep = [c for c in (keep or encoded.columns) if c != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = None
        for b in byte_slices(batches, "__ids", 1 << 20):
            find = find or Vocabulary(rank_path).tokens.__getitem__
            texts = [b"".join(map(find, np.frombuffer(i, "<u4").tolist())) for i in raw_texts(b.column(len(keep)))]
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], pa.array(texts, pa.binary())], [*keep, "decoded"])

    return encoded.select(*keep, encoded[ids_col].alias("__ids")).mapInArrow(run, _fields(encoded, keep, ("decoded", T.BinaryType())))
