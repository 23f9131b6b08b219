"""Small helpers shared by the operators: reading tables, sizes, Arrow batches, word arrays."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyridge.session import checkpoint_dir

SLICE_ROWS = 512  # rows handled at once inside a worker; results do not depend on it
ODD = np.uint64(0x9E3779B97F4A7C15)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, local_default: str | None = None) -> str:
    """A fresh folder below ``spark.checkpoint.dir``; a default only where a session runs in one process."""
    folder = checkpoint_dir(spark, local_default if spark.sparkContext.master.startswith("local[") else None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{folder.rstrip('/')}/llm-{uuid.uuid4().hex}"


def staged(df: DataFrame, local_default: str = "/tmp/tallyridge-checkpoints") -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark, local_default)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parts(docs: DataFrame, text_col: str, bytes_per_part: int) -> int:
    """Number of buckets so that one holds about ``bytes_per_part`` bytes of text."""
    total = docs.agg(F.sum(F.octet_length(text_col)).alias("n")).first()["n"] or 0
    return max(1, -(-total // bytes_per_part))


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def byte_slices(batches: Iterator[pa.RecordBatch], text_col: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``limit`` bytes of text each."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each value; null is empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


class WordHashes(dict):
    """64-bit hash of each word, computed once per worker and word; emptied when it grows beyond ``limit`` entries."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def phrase_hashes(words: np.ndarray, size: int, factor: np.uint64 = ODD) -> np.ndarray:
    """Hash of every run of ``size`` consecutive word hashes, by doubling."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, done = None, 0
    power, width, step = words, 1, np.array([factor], np.uint64)
    while True:
        if size & width:
            piece = power[done:done + n]
            out = piece.copy() if out is None else out * step + piece
            done += width
        if width * 2 > size:
            break
        power = power[:len(power) - width] * step + power[width:]
        step = step * step
        width *= 2
    return mixed(out)


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of true values."""
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
