"""Exact largest inner products over a pivot-distance index.

A further coordinate gives all vectors the same length, so the largest inner product is the smallest distance. Each
vector is keyed by its nearest pivot and its distance to it, cut into annuli. A query starts with the annuli that may
hold its nearest vectors, which gives a score it has surely reached, and then opens only those annuli in which the
triangle inequality allows a better one: ``|d(q, p) - d(x, p)| <= d(q, x)``.

Equal vectors are kept once with their smallest ids, so a vector that fills a third of the table is one entry. Large
annuli are cut into blocks and queries into batches; no task holds more than one block and one batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CELL = ["pivot", "ring"]


@dataclass(frozen=True)
class Settings:
    """``pivots`` vectors are chosen by hash from the distinct vectors; everything is indexed."""

    pivots: int = 16
    rings: int = 8
    block_vectors: int = 16_384
    batch_queries: int = 2_048


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int = 256) -> DataFrame:
    """(vec_id, v array<double>) with whole numbers ``floor(scale * x)``; rows with a null id, a null vector or a null,
    infinite or NaN component take no part."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    rows = vectors.where(F.col(id_col).isNotNull() & v.isNotNull()).where(~bad)
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("double")).alias("v"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().reshape(-1, width) if isinstance(column, pa.ChunkedArray) else column.flatten().to_numpy().reshape(-1, width)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in doubles while no sum can leave their whole numbers, else in 64-bit integers."""
    largest = max(1.0, np.abs(a).max(initial=0)) * max(1.0, np.abs(b).max(initial=0)) * a.shape[1]
    if largest < 2 ** 53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


class Geometry:
    """Distances in the lengthened space; travels to the tasks (a bounded number of pivots)."""

    def __init__(self, pivots: np.ndarray, largest: float):
        self.pivots, self.largest = pivots, largest
        self.lift = np.sqrt(np.maximum(0.0, largest - (pivots ** 2).sum(1)))

    def of_vectors(self, x: np.ndarray) -> np.ndarray:
        lift = np.sqrt(np.maximum(0.0, self.largest - (x ** 2).sum(1)))
        square = 2 * self.largest - 2 * (x @ self.pivots.T) - 2 * np.outer(lift, self.lift)
        return np.sqrt(np.maximum(0.0, square))

    def of_queries(self, q: np.ndarray) -> np.ndarray:
        square = (q ** 2).sum(1)[:, None] + self.largest - 2 * (q @ self.pivots.T)
        return np.sqrt(np.maximum(0.0, square))

    def bounds(self, q: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """No vector of a cell (pivot, nearest, farthest) has a larger product with the query; rounding is allowed for."""
        d = self.of_queries(q)[:, cells[:, 0].astype(int)]
        gap = np.maximum(0.0, np.maximum(d - cells[:, 2], cells[:, 1] - d))
        room = (q ** 2).sum(1)[:, None] + self.largest
        return (room - gap ** 2) / 2 + 1e-9 * room + 1


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest (score, then smaller id) of one query; an id counts once per score."""
    if len(ids) > k and len(np.unique(ids)) < len(ids):
        scores, ids = np.unique(np.stack([scores, ids]), axis=1)
    if len(scores) > k:
        keep = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        scores, ids = scores[keep], ids[keep]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, settings: Settings = Settings(), id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest integer inner products of each query, ties to smaller ids.

    A query meets every row but those with its own id; with fewer candidates all are returned. Vectors of another
    length than the most common one (ties to the longer) take no part, nor do rows that ``quantised`` leaves out.
    Repeated rows are one candidate. Repeated queries with one id count once if their vectors are equal, else the results of all of them compete.
    Empty tables give no rows.
    """
    spark = vectors.sparkSession
    all_rows = quantised(vectors, id_col, vector_col)
    lengths = all_rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    width = lengths["n"] if lengths else 0
    if not width:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rows = all_rows.where(F.size("v") == width).distinct()  # a repeated row is one candidate
    rank = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    distinct = (rows.withColumn("__rank", rank).where(F.col("__rank") <= k + 1).groupBy("v")
                .agg(F.array_sort(F.collect_list("vec_id")).alias("ids")))  # at most k + 1 ids
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    largest = rows.agg(F.max(norm)).first()[0]
    picks = np.array([r["v"] for r in rows.select("v").distinct().orderBy(F.xxhash64("v"), "v").limit(settings.pivots).collect()])
    geometry, step = Geometry(picks, largest), max(1e-9, 2 * np.sqrt(largest) / settings.rings)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = geometry.of_vectors(matrix(b.column(0), width))
            pivot = d.argmin(1) if len(d) else np.empty(0, np.int64)
            near = d[np.arange(len(d)), pivot]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pivot.astype(np.int32)), pa.array((near // step).astype(np.int32)), pa.array(near)],
                                             ["v", "ids", "pivot", "ring", "distance"])

    index = distinct.mapInArrow(place, "v array<double>, ids array<long>, pivot int, ring int, distance double")
    cells = index.groupBy(*CELL).agg(F.min("distance").alias("least"), F.max("distance").alias("most"), F.count(F.lit(1)).alias("n")).orderBy(*CELL).toPandas()
    shape = cells[["pivot", "least", "most"]].to_numpy(float)
    shape[:, 1] -= 1e-6 * (1 + shape[:, 1])
    shape[:, 2] += 1e-6 * (1 + shape[:, 2])
    sizes = cells["n"].to_numpy()
    blocks = -(-sizes // settings.block_vectors)
    asked = quantised(queries, id_col, vector_col).where(F.size("v") == width).withColumnRenamed("vec_id", "query_id").distinct()
    batches_of_queries = max(1, -(-asked.count() // settings.batch_queries))
    numbered = spark.createDataFrame([(int(p), int(r), int(n)) for p, r, n in zip(cells["pivot"], cells["ring"], blocks)], "pivot int, ring int, blocks int")
    stored = (index.join(F.broadcast(numbered), CELL).withColumn("block", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int"))  # a row per cell
              .withColumn("batch", F.explode(F.sequence(F.lit(0), F.lit(batches_of_queries - 1)))).select(*CELL, "block", "batch", "v", "ids"))
    keys = [*CELL, "block", "batch"]

    def route(first: bool):
        """Cells that a query opens: at first the most promising ones with enough vectors, then all others that may
        hold a better score than the one it has reached."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                q = matrix(b.column(1), width)
                limit = geometry.bounds(q, shape)
                order = np.argsort(-limit, axis=1, kind="stable")
                before = np.cumsum(sizes[order], axis=1) - sizes[order]
                start = np.zeros(limit.shape, bool)
                np.put_along_axis(start, order, before < 4 * k + 4, axis=1)
                if first:
                    opened = start
                else:
                    reached = np.array([-np.inf if s is None else s for s in b.column(2).to_pylist()], float)
                    opened = ~start & (limit >= reached[:, None])
                row, cell = np.nonzero(opened)
                times = blocks[cell]
                row, cell = np.repeat(row, times), np.repeat(cell, times)
                block = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cells["pivot"].to_numpy()[cell], pa.int32()), pa.array(cells["ring"].to_numpy()[cell], pa.int32()), pa.array(block, pa.int32()),
                     b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row))], [*CELL, "block", "query_id", "v"])

        return run

    def visit(frame: DataFrame, first: bool) -> DataFrame:
        routed = frame.mapInArrow(route(first), "pivot int, ring int, block int, query_id long, v array<double>")
        routed = routed.withColumn("batch", F.pmod(F.xxhash64("query_id"), F.lit(batches_of_queries)).cast("int"))

        def compare(asked: pa.Table, held: pa.Table) -> pa.Table:
            out: list[tuple] = []
            if asked.num_rows and held.num_rows:
                x, ids = matrix(held["v"], width), held["ids"].to_pylist()
                counts = np.fromiter(map(len, ids), np.int64, len(ids))
                flat, owner = np.array([i for own in ids for i in own], np.int64), np.repeat(np.arange(len(ids)), counts)
                names, q = asked["query_id"].to_pylist(), matrix(asked["v"], width)
                for at in range(0, len(names), 256):
                    for name, row in zip(names[at:at + 256], products(q[at:at + 256], x)):
                        score = row[owner]
                        score, other = best(score[flat != name], flat[flat != name], k)
                        out.extend(zip([name] * len(score), other.tolist(), score.tolist()))
            return pa.table([pa.array(c, pa.int64()) for c in (zip(*out) if out else ([], [], []))], ["query_id", "vec_id", "score"])

        return routed.groupBy(*keys).cogroup(stored.groupBy(*keys)).applyInArrow(compare, "query_id long, vec_id long, score long")

    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def top(found: DataFrame) -> DataFrame:
        return found.distinct().withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)

    near = top(visit(asked.select("query_id", "v"), True)).select("query_id", "vec_id", "score")
    reached = near.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("reached"))
    rest = visit(asked.join(reached, "query_id", "left").select("query_id", "v", "reached"), False)
    return top(near.unionByName(rest)).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
