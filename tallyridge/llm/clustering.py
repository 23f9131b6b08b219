"""Centroid clustering over a VA-file: few-bit cells per dimension in front of the full vectors.

Every vector is stored once with its approximation, the cell of each component packed into a few bits. For each round
two lookup tables hold, per dimension, cell and centroid, the least and the greatest squared difference; their sums
over a vector's cells are an interval for its distance to each centroid. A centroid whose interval begins beyond the
end of another's is out; a vector left with one centroid is assigned by its cells alone, and only where intervals
overlap is the full vector fetched from its row and measured.

Rows are never shuffled: a round is one scan whose tasks send sums per cluster and dimension. (New centroids are exact
means, so the update adds up every vector once in each round; no approximation can stand in for that.)
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyridge.llm.tables import staged

SMALL = 2 ** 24  # components up to this size keep distances and sums of a batch inside 64 bits


@dataclass(frozen=True)
class Settings:
    """``bits`` per component; cell borders are quantiles of ``sample`` vectors chosen by hash (they bound work, not results)."""

    clusters: int = 16
    rounds: int = 3
    width: int = 64
    scale: int = 64
    bits: int = 4
    sample: int = 4_096
    seed: str = "1:"


def kept(vectors: DataFrame, settings: Settings, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v array<long>) of the vectors with ``width`` components, none null or non-finite."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    rows = vectors.where(v.isNotNull() & (F.size(v) == settings.width)).where(~bad)
    return rows.select(F.col(id_col).alias("vec_id"), F.transform(v, lambda x: F.floor(x.cast("double") * settings.scale)).alias("v"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """64-bit rows, or rows of Python integers where those could overflow."""
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return x if not x.size or (x.max() <= SMALL and x.min() >= -SMALL) else x.astype(object)


class Cells:
    """Cell borders of each dimension. Cell c holds whole numbers from ``edges[c - 1]`` to ``edges[c] - 1``; ``low`` and
    ``high`` close the outer cells."""

    def __init__(self, edges: np.ndarray, low: np.ndarray, high: np.ndarray, bits: int):
        self.edges, self.bits = edges, bits
        self.least = np.concatenate([low[:, None], edges], axis=1).astype(np.float64)
        self.most = np.concatenate([edges.astype(np.float64) - 1, high[:, None].astype(np.float64)], axis=1)

    def pack(self, x: np.ndarray) -> list[bytes]:
        code = np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)
        split = (code[:, :, None] >> np.arange(self.bits)) & 1
        packed = np.packbits(split.reshape(len(x), -1).astype(np.uint8), axis=1)
        return [row.tobytes() for row in packed]

    def unpack(self, codes: pa.Array) -> np.ndarray:
        raw = np.frombuffer(b"".join(codes.to_pylist()), np.uint8).reshape(len(codes), -1)
        split = np.unpackbits(raw, axis=1)[:, :len(self.edges) * self.bits].reshape(len(codes), len(self.edges), self.bits)
        return split @ (1 << np.arange(self.bits))


class Nearest:
    """Lookup tables of one round and the assignment through them."""

    def __init__(self, centroids: list[list[int]], cells: Cells):
        self.exact = np.array(centroids, object)
        if all(abs(c) <= SMALL for row in centroids for c in row):
            self.exact = self.exact.astype(np.int64)
        m = np.array(centroids, np.float64)[:, :, None]
        inner = np.maximum(0.0, np.maximum(cells.least[None] - m, m - cells.most[None]))
        outer = np.maximum(np.abs(cells.least[None] - m), np.abs(cells.most[None] - m))
        self.least = np.ascontiguousarray((inner ** 2).transpose(1, 2, 0)) * (1 - 1e-9)  # dimension, cell, centroid
        self.most = np.ascontiguousarray((outer ** 2).transpose(1, 2, 0)) * (1 + 1e-9)

    def distances(self, x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        """Exact squared distances of rows to their own centroid."""
        gap = x - centroids
        return (gap * gap).sum(1)

    def assign(self, codes: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cluster of each row, and the rows whose full vectors were needed. ``x`` is only read at those rows."""
        shape = (len(codes), len(self.exact))
        low, high = np.zeros(shape), np.zeros(shape)
        for j in range(codes.shape[1]):
            low += self.least[j][codes[:, j]]
            high += self.most[j][codes[:, j]]
        open_ = low <= high.min(1, keepdims=True)
        cluster = open_.argmax(1)
        several = np.flatnonzero(open_.sum(1) > 1)
        if len(several):
            fetched = x[several]
            far = np.stack([self.distances(fetched, m) for m in self.exact], axis=1)
            if far.dtype == object:
                cluster[several] = [min((c for c in range(shape[1]) if o[c]), key=lambda c, row=row: (row[c], c)) for row, o in zip(far, open_[several])]
            else:
                cluster[several] = np.where(open_[several], far, np.iinfo(np.int64).max).argmin(1)  # the first, so the smaller number
        return cluster, several


def bounds(rows: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest component of each dimension; one row per task and dimension reaches the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for b in batches:
            if b.num_rows:
                x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                low, high = (x.min(0), x.max(0)) if low is None else (np.minimum(low, x.min(0)), np.maximum(high, x.max(0)))
        if low is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(low), pa.array(high)], ["j", "low", "high"])

    found = rows.select("v").mapInArrow(run, "j int, low long, high long").groupBy("j").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()
    ordered = sorted(found)
    return np.array([r["low"] for r in ordered], np.int64), np.array([r["high"] for r in ordered], np.int64)


def va_file(rows: DataFrame, settings: Settings) -> tuple[DataFrame, Cells | None]:
    """The stored table (vec_id, code, v) and its cells; no cells for an empty table."""
    low, high = bounds(rows, settings.width)
    if not len(low):
        return rows, None
    picks = rows.orderBy(F.xxhash64("v"), "v").limit(settings.sample).select("v").collect()  # a bounded number of vectors
    sample = np.sort(np.array([r["v"] for r in picks], np.int64), axis=0)
    places = (np.arange(1, 1 << settings.bits) * len(sample)) >> settings.bits
    cells = Cells(np.ascontiguousarray(sample[places].T), low, high, settings.bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, settings.width)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cells.pack(x), pa.binary()), b.column(1)], ["vec_id", "code", "v"])

    id_type = rows.schema["vec_id"].dataType.simpleString()
    return staged(rows.mapInArrow(run, f"vec_id {id_type}, code binary, v array<long>")), cells


def sums(table: DataFrame, nearest: Nearest, cells: Cells, width: int) -> dict[int, tuple[int, list[int], int]]:
    """Per cluster: rows, sum of each component, rows fetched. Tasks add up before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for b in batches:
            if not b.num_rows:
                continue
            x = matrix(b.column(1), width)
            cluster, fetched = nearest.assign(cells.unpack(b.column(0)), x)
            looked = np.bincount(cluster[fetched], minlength=len(nearest.exact))
            for c in np.unique(cluster).tolist():
                own = x[cluster == c]
                was = total.get(c, [0, [0] * width, 0])
                total[c] = [was[0] + len(own), [a + int(s) for a, s in zip(was[1], own.sum(0))], was[2] + int(looked[c])]
        flat = [(c, j, n, Decimal(s), f) for c, (n, own, f) in total.items() for j, s in enumerate(own)]
        cols = zip(*flat) if flat else ([], [], [], [], [])
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["cluster", "j", "n", "total", "fetched"])

    parts = table.select("code", "v").mapInArrow(run, "cluster int, j int, n long, total decimal(38,0), fetched long")
    out: dict[int, tuple[int, list[int], int]] = {}
    for r in parts.groupBy("cluster", "j").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("fetched").alias("fetched")).collect():  # clusters x width rows
        out.setdefault(r["cluster"], (r["n"], [0] * width, r["fetched"]))[1][r["j"]] = int(r["total"])
    return out


def start(rows: DataFrame, settings: Settings) -> list[list[int]]:
    """The vectors with the smallest sha256 of the seed and their id, in that order; ties by vector, null ids last."""
    digest = F.sha2(F.concat(F.lit(settings.seed), F.col("vec_id").cast("string")), 256)
    return [list(r["v"]) for r in rows.orderBy(digest.asc_nulls_last(), "v").limit(settings.clusters).select("v").collect()]


def cluster(vectors: DataFrame, settings: Settings = Settings(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid array<long>): one row per kept row.

    Components are ``floor(scale * x)``. Each round assigns every vector to its nearest centroid (squared Euclidean
    distance, ties to the smaller number) and moves every centroid that has vectors to ``floor(sum / count)`` of each
    component; a last assignment follows. Rows whose vector is null, has another length than ``width``, or holds a null
    or non-finite component are left out. Repeated rows are rows of their own and may start several centroids; rows
    with a null id are clustered and start centroids only after all others. With fewer rows than ``clusters`` there are
    as many centroids as rows; an empty table gives no rows. Components beyond 64 bits are held at their ends, as are
    distances. Other columns are ignored.
    """
    table, cells = va_file(kept(vectors, settings, id_col, vector_col), settings)
    id_type = table.schema["vec_id"].dataType.simpleString()
    if cells is None:
        return table.sparkSession.createDataFrame([], f"vec_id {id_type}, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>")
    centroids = start(table, settings)
    for _ in range(settings.rounds):
        found = sums(table, Nearest(centroids, cells), cells, settings.width)
        centroids = [[t // found[c][0] for t in found[c][1]] if c in found else own for c, own in enumerate(centroids)]
    return assigned(table, centroids, cells, settings, id_type)


def assigned(table: DataFrame, centroids: list[list[int]], cells: Cells, settings: Settings, id_type: str) -> DataFrame:
    nearest = Nearest(centroids, cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = matrix(b.column(2), settings.width)
            where, _ = nearest.assign(cells.unpack(b.column(1)), x)
            far = nearest.distances(x, nearest.exact[where])
            if far.dtype == object:
                far = np.array([min(int(d), 2 ** 63 - 1) for d in far], np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(where.astype(np.int32)), pa.array(far)], ["vec_id", "cluster", "distance"])

    rows = staged(table.select("vec_id", "code", "v").mapInArrow(run, f"vec_id {id_type}, cluster int, distance long"))
    inertia = {r["cluster"]: int(r["d"]) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    held = [(c, min(d, 2 ** 63 - 1), min(sum(inertia.values()), 2 ** 63 - 1), centroids[c]) for c, d in sorted(inertia.items())]
    facts = table.sparkSession.createDataFrame(held, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return rows.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")  # a row per cluster
