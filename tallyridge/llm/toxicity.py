"""Toxicity scores: logistic regression fitted by FTRL-proximal over hashed word n-grams and skip-grams.

Every coordinate has its own learning rate, and the L1 term keeps most weights at exactly zero, so the model that
travels to the scoring tasks is a short list of (index, weight) pairs; it can never exceed ``2 ** bits`` pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyridge.llm.tables import ODD, WordHashes, byte_slices, mixed, slices

SLICE_BYTES = 1 << 20  # of text scored at once inside a worker
WORDS = 200_000  # whose hashes a worker keeps

WORD = re.compile(r"\w+")
#: One seed per kind of feature: single words, neighbours, pairs with one and with two words between them.
SEEDS = (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344), np.uint64(0xA4093822299F31D0), np.uint64(0x082EFA98EC4E6C89))


@dataclass(frozen=True)
class Settings:
    """``rows_per_class`` bounds the labelled rows that are fitted (expected number, chosen by a hash of the id)."""

    bits: int = 20
    rows_per_class: int = 8_000
    epochs: int = 4
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 5.0
    l2: float = 0.0


@dataclass(frozen=True)
class Model:
    indexes: np.ndarray
    weights: np.ndarray
    bias: float
    bits: int

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << self.bits, np.float32)
        out[self.indexes] = self.weights
        return out


def features(texts: list[str | None], hashes: WordHashes, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature index) of each word, neighbouring pair and skip pair of the texts, lower-cased."""
    words = [[w.encode() for w in WORD.findall(t.lower())] if t else [] for t in texts]
    rows = np.repeat(np.arange(len(texts)), [len(w) for w in words])
    h = hashes.of([x for w in words for x in w])
    shift = np.uint64(64 - bits)
    out = [(rows, mixed(h ^ SEEDS[0]) >> shift)]
    for gap, seed in enumerate(SEEDS[1:], 1):
        same = rows[:-gap] == rows[gap:]
        pair = (h[:-gap] * ODD + h[gap:]) ^ seed
        out.append((rows[:-gap][same], mixed(pair[same]) >> shift))
    return np.concatenate([r for r, _ in out]), np.concatenate([i for _, i in out]).astype(np.int64)


class Ftrl:
    """State of the learner; a row's features count once each."""

    def __init__(self, s: Settings):
        self.s, self.z, self.n = s, np.zeros((1 << s.bits) + 1), np.zeros((1 << s.bits) + 1)

    def weights(self, at) -> np.ndarray:
        z, s = self.z[at], self.s
        l1 = np.where(np.asarray(at) == len(self.z) - 1, 0.0, s.l1)  # the bias is not penalised
        w = (np.sign(z) * l1 - z) / ((s.beta + np.sqrt(self.n[at])) / s.alpha + s.l2)
        return np.where(np.abs(z) <= l1, 0.0, w)

    def learn(self, indexes: np.ndarray, label: int) -> None:
        at = np.append(indexes, len(self.z) - 1)
        w = self.weights(at)
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        grown = np.sqrt(self.n[at] + g * g)
        self.z[at] += g - (grown - np.sqrt(self.n[at])) / self.s.alpha * w
        self.n[at] += g * g


def sampled(labels: DataFrame, label_col: str, rows_per_class: int) -> DataFrame:
    """At most about ``rows_per_class`` rows of each class, by a hash of the id."""
    counts = {r[label_col]: r["n"] for r in labels.groupBy(label_col).agg(F.count(F.lit(1)).alias("n")).collect()}
    scale = 1 << 20
    share = F.lit(0)
    for label, n in counts.items():
        share = F.when(F.col(label_col) == label, F.lit(min(scale, scale * rows_per_class // n))).otherwise(share)
    return labels.where(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(scale)) < share)


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> Model:
    """Fit on the labelled documents (label 0 or 1; other labels and null texts are left out).

    The sampled labels are bounded by ``settings.rows_per_class``, so they are broadcast and their documents pass
    through one task in an order given by a hash; the task keeps their features for ``settings.epochs`` passes. Without labelled rows the model scores 0.5 everywhere.
    """
    marked = labels.select(labels[id_col].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("__y"))
    chosen = sampled(marked.where("__y IN (0, 1) AND doc_id IS NOT NULL"), "__y", settings.rows_per_class)
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")).where("text IS NOT NULL")
    order = F.xxhash64("doc_id", F.lit(29))
    rows = texts.join(F.broadcast(chosen), "doc_id").withColumn("__order", order)
    train = rows.repartition(1).sortWithinPartitions("__order", "doc_id", "text", "__y").select("text", "__y")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner, hashes, seen = Ftrl(settings), WordHashes(WORDS), []
        for batch in slices(batches, 128):
            rows, at = features(batch.column(0).to_pylist(), hashes, settings.bits)
            order = np.argsort(rows, kind="stable")
            ends = np.searchsorted(rows[order], np.arange(batch.num_rows + 1))
            for k, label in enumerate(batch.column(1).to_pylist()):
                seen.append((np.unique(at[order[ends[k]:ends[k + 1]]]).astype(np.int32), label))
        for _ in range(settings.epochs):
            for indexes, label in seen:
                learner.learn(indexes, label)
        w = learner.weights(np.arange(len(learner.z)))
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(w[at], pa.float64())], ["i", "w"])

    pairs = train.mapInArrow(learn, "i long, w double").toPandas()
    last = pairs["i"] == 1 << settings.bits
    own = pairs[~last].sort_values("i")
    return Model(own["i"].to_numpy(np.int64), own["w"].to_numpy(np.float32), float(pairs.loc[last, "w"].sum()), settings.bits)


def score(docs: DataFrame, model: Model, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``score`` (0 to 1), ``predicted`` (score >= threshold).

    A null or empty text has no features and gets the score of the bias. Columns of these names are replaced.
    """
    kept = docs.drop("score", "predicted")
    plain = kept.schema[text_col].dataType == T.StringType()
    read = text_col if plain else "__text"  # a text of type string is not sent twice

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, hashes = model.dense(), WordHashes(WORDS)
        for batch in byte_slices(batches, read, SLICE_BYTES):
            rows, at = features(batch.column(read).to_pylist(), hashes, model.bits)
            used = np.flatnonzero(weights[at])
            pairs = np.unique((rows[used].astype(np.int64) << model.bits) | at[used])
            total = np.bincount(pairs >> model.bits, weights[pairs & ((1 << model.bits) - 1)], batch.num_rows) + model.bias
            p = 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))
            out = batch if plain else batch.drop_columns([read])
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(p, pa.float64()), pa.array(p >= threshold).cast(pa.int32())],
                                             [*out.schema.names, "score", "predicted"])

    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    rows = kept if plain else kept.withColumn(read, F.col(text_col).cast("string"))
    return rows.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id", buckets: int = 3, chosen: int = 1):
    """Whether the row's label may not be learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % buckets == chosen, F.lit(False))
