"""Harmonic packing of token sequences.

Lengths are partitioned into classes by reciprocals of the capacity: a class takes pieces of ``capacity / j`` ids,
``j`` a power of two, and each of its bins holds exactly ``j`` pieces. A document is cut into whole capacities and
the binary digits of the rest, largest first, so every piece fits its class exactly and full bins have no padding.
Each worker fills the bins of its own partition; nothing is shuffled, and a lost task is simply run again. Bins left
open at the end of a partition are cut into sequences with a power of two of ids, which need no padding either.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tallyridge.llm.tables import raw_texts, slices

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
ID_BYTES = 4
SEQUENCES_PER_PARTITION = 1 << 33


#: Words of letters that have no combining marks and one lower-case form of one character each.
LATIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f]+")


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself, or the next free character from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(other)}


def pack_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordEncoder(dict):
    """Token ids (little-endian unsigned 32 bits) of white-space separated words, kept per worker.

    The tokenizer drops white space before it cuts words, so a text's ids are its words' ids in order. A full stop or
    comma after an ASCII letter or digit is a token of its own, so it is encoded apart; that keeps the table small.
    ``limit`` bounds the table, not the result.
    """

    def __init__(self, path: str, limit: int = 1_000_000):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.model, self.letters = self.tokenizer.model, byte_letters()

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        if len(word) > 1 and word[-1:] in b".," and word[-2:-1].isalnum():
            ids = self[word[:-1]] + self[word[-1:]]
        else:
            text = word.decode("utf-8", "replace")
            if LATIN.fullmatch(text):  # one word of the model, already composed
                ids = pack_ids([t.id for t in self.model.tokenize(text.lower().encode().decode("latin-1").translate(self.letters))])
            else:
                ids = pack_ids(self.tokenizer.encode(text, add_special_tokens=False).ids)
        self[word] = ids
        return ids

    def ids(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, text.split()))


def cuts(total: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of ``total`` ids: whole capacities, then the binary digits of the rest."""
    start = 0
    while total - start >= capacity:
        yield start, capacity
        start += capacity
    size = capacity >> 1
    while start < total:
        if (total - start) & size:
            yield start, size
            start += size
        size >>= 1


class Bins:
    """Open bins of one partition: at most ``capacity / size - 1`` waiting pieces per class."""

    def __init__(self, capacity: int, first_sequence: int):
        self.capacity, self.next_sequence, self.waiting = capacity, first_sequence, {}

    def _close(self, pieces: list[tuple], size: int) -> Iterator[tuple]:
        for k, piece in enumerate(pieces):
            yield (*piece, self.next_sequence, k * size)
        self.next_sequence += 1

    def add(self, piece: tuple, size: int) -> Iterator[tuple]:
        pieces = self.waiting.setdefault(size, [])
        pieces.append(piece)
        if len(pieces) * size == self.capacity:
            yield from self._close(self.waiting.pop(size), size)

    def finish(self) -> Iterator[tuple]:
        for size, pieces in sorted(self.waiting.items(), reverse=True):
            done = 0
            for _, count in cuts(len(pieces), self.capacity // size):
                yield from self._close(pieces[done:done + count], size)
                done += count


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 2, id_col: str = "doc_id",
         text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most ``capacity`` (a power of two) ids.

    A null or empty text is the end id alone. Repeated rows and repeated or null document ids are packed like any
    other row. An empty table gives no rows. Other columns are ignored. ``keep_ids`` adds the piece's ids as
    ``ids array<long>``.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    end = end_id.to_bytes(ID_BYTES, "little")
    types = [pa.int64()] * 7 + ([pa.list_(pa.int64())] if keep_ids else [])
    names = [c.split()[0] for c in SCHEMA.split(", ")] + (["ids"] if keep_ids else [])

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [()] * len(names)
        order = [0, 1, 2, 3, 4, 6, 7, 5] if keep_ids else range(7)
        return pa.RecordBatch.from_arrays([pa.array(columns[i], t) for i, t in zip(order, types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(tokenizer_path)
        bins = Bins(capacity, TaskContext.get().partitionId() * SEQUENCES_PER_PARTITION)
        for batch in slices(batches):
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1))):
                ids = encoder.ids(text) + end
                total = len(ids) // ID_BYTES
                for start, size in cuts(total, capacity):
                    own = ids[start * ID_BYTES:(start + size) * ID_BYTES]
                    piece = (doc, start, size, zlib.crc32(own), total)
                    if keep_ids:
                        piece += ([int.from_bytes(own[i:i + ID_BYTES], "little") for i in range(0, len(own), ID_BYTES)],)
                    rows.extend(bins.add(piece, size))
            if rows:
                yield table(rows)
        if rows := list(bins.finish()):
            yield table(rows)

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")).mapInArrow(
        run, SCHEMA + (", ids array<long>" if keep_ids else ""))
