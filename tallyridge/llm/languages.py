"""Language mixtures: the proportions of each document's languages, by expectation-maximisation.

A language is a smoothed distribution of letter trigrams inside words. The likelihoods of a word under every language
are those of its trigrams; EM over a document's words estimates how much of it each language wrote. The set of
languages is the one with the least penalised likelihood (each further language costs ``penalty * ln(words)``).
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

from tallyridge.llm.tables import mixed, slices

WORD = re.compile(r"[^\W\d_]+")
OPEN, CLOSE = "\x02", "\x03"
UNKNOWN = "und"


@dataclass(frozen=True)
class Model:
    """``logs[gram bucket, language]``: at most ``2 ** bits`` rows and one column per language."""

    languages: tuple[str, ...]
    logs: np.ndarray
    bits: int


def grams(words: list[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(start of each word's trigrams, trigram bucket); a word of n letters has n trigrams, its edges included."""
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    c = np.frombuffer("".join(f"{OPEN}{w}{CLOSE}" for w in words).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    h = mixed((c[:-2] << np.uint64(42)) ^ (c[1:-1] << np.uint64(21)) ^ c[2:]) >> np.uint64(64 - bits)
    whole = (c[:-2] != ord(CLOSE)) & (c[1:-1] != ord(CLOSE))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    return np.concatenate(([0], np.cumsum(sizes)[:-1])), h[whole].astype(np.int64)


def learn(docs: DataFrame, rows_per_language: int = 10_000, bits: int = 16, smoothing: float = 0.2, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang") -> Model:
    """Trigram counts of at most about ``rows_per_language`` documents of each language, chosen by a hash of the id.

    Null languages and texts are left out. The counts, at most ``2 ** bits`` per language, come to the driver.
    """
    rows = docs.select(docs[id_col].cast("string").alias("id"), docs[lang_col].cast("string").alias("lang"),
                       docs[text_col].cast("string").alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    scale, share = 1 << 20, F.lit(0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(min(scale, scale * rows_per_language // n))).otherwise(share)
    sample = rows.where(F.pmod(F.xxhash64("id", F.lit(11)), F.lit(scale)) < share).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in slices(batches):
            for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                own = totals.setdefault(lang, np.zeros(1 << bits, np.int64))
                own += np.bincount(grams(WORD.findall(text.lower()), bits)[1], minlength=1 << bits)
        for lang, own in totals.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(own[at])], ["lang", "gram", "n"])

    table = sample.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    names = tuple(sorted(set(table["lang"])))
    counts = np.zeros((1 << bits, len(names)))
    for k, name in enumerate(names):
        own = table[table["lang"] == name]
        counts[own["gram"].to_numpy(), k] = own["n"].to_numpy()
    logs = np.log((counts + smoothing) / (counts.sum(0) + smoothing * (1 << bits))) if names else counts
    return Model(names, logs.astype(np.float32), bits)


class WordLogs:
    """Row numbers and log likelihoods of the words seen by a worker; started anew beyond ``limit`` words."""

    def __init__(self, model: Model, limit: int = 300_000):
        self.model, self.limit = model, limit
        self.rows, self.logs = {}, np.empty((0, len(model.languages)), np.float32)

    def of(self, texts: list[list[str]]) -> list[np.ndarray]:
        if len(self.rows) > self.limit:
            self.rows, self.logs = {}, self.logs[:0]
        new = list(dict.fromkeys(w for t in texts for w in t if w not in self.rows))
        if new:
            self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new))))
            starts, at = grams(new, self.model.bits)
            self.logs = np.concatenate([self.logs, np.add.reduceat(self.model.logs[at], starts, axis=0)])
        return [self.logs[np.fromiter(map(self.rows.__getitem__, t), np.int64, len(t))] for t in texts]


def proportions(likelihoods: np.ndarray, start: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, float]:
    """EM for the mixing proportions; stops when no proportion moves by more than 0.001. Also the log likelihood."""
    share = start
    for _ in range(rounds):
        owner = likelihoods * share
        total = owner.sum(1)
        new = (owner / total[:, None]).mean(0)
        moved, share = np.abs(new - share).max(), new
        if moved < 1e-3:
            break
    return share, float(np.log((likelihoods * share).sum(1)).sum())


def mixture(logs: np.ndarray, penalty: float) -> np.ndarray:
    """Proportions of all languages (zero outside the chosen set) for one document's words."""
    best = logs.max(1, keepdims=True)
    likelihoods = np.exp(np.maximum(logs - best, -60.0)).astype(np.float64)
    n = logs.shape[1]
    full, fit = proportions(likelihoods, np.full(n, 1.0 / n))
    order, cost = np.argsort(-full, kind="stable"), penalty * np.log(max(2, len(logs)))
    chosen, least = full, np.inf
    for k in range(1, n + 1):
        keep = order[:k]
        if least <= -2 * fit + cost * (k - 1):
            break  # no larger set can pay for its languages
        own, value = proportions(likelihoods[:, keep], np.full(k, 1.0 / k))
        if -2 * value + cost * (k - 1) < least:
            least, chosen = -2 * value + cost * (k - 1), np.zeros(n)
            chosen[keep] = own
    return chosen


def identify(docs: DataFrame, model: Model, penalty: float = 4.0, text_col: str = "text") -> DataFrame:
    """All columns of ``docs``, ``languages map<string,double>`` (the chosen set with its proportions), ``lang_pred``
    (the largest; ties to the first name) and ``score`` (its proportion).

    A null text, one without a letter, or a model without languages gives ``und``, an empty map and score 0. Columns
    of these names are replaced.
    """
    kept = docs.drop("languages", "lang_pred", "score")
    names = model.languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordLogs(model)
        for batch in slices(batches):
            texts = [WORD.findall(t.lower()) if t else [] for t in batch.column("__text").to_pylist()]
            texts = [t if any(c.isalpha() for w in t for c in w) else [] for t in texts]
            maps, preds, scores = [], [], []
            for logs in known.of(texts) if names else [()] * len(texts):
                if not len(logs):
                    maps.append([]), preds.append(UNKNOWN), scores.append(0.0)
                    continue
                share = mixture(logs, penalty)
                top = int(share.argmax())
                maps.append([(names[k], float(share[k])) for k in np.flatnonzero(share)])
                preds.append(names[top]), scores.append(float(min(1.0, share[top])))
            out = batch.drop_columns(["__text"])
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(maps, pa.map_(pa.string(), pa.float64())), pa.array(preds, pa.string()), pa.array(scores, pa.float64())],
                [*out.schema.names, "languages", "lang_pred", "score"])

    schema = T.StructType([*kept.schema.fields, T.StructField("languages", T.MapType(T.StringType(), T.DoubleType())),
                           T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return kept.withColumn("__text", F.col(text_col).cast("string")).mapInArrow(run, schema)


def held_out(id_col: str = "doc_id", buckets: int = 4, chosen: int = 2):
    """Whether the row's language may not be learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % buckets == chosen, F.lit(False))
