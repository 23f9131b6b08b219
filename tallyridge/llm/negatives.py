"""Hard negatives of anchors, found through bounds along a spanning tree of the anchors.

Anchors that lie near each other share a block, and a block's anchors form a minimum spanning tree by their distances.
A candidate's score with an anchor is known within ``distance(anchor, parent) * norm(candidate)`` of its score with the
parent, so the tree is walked from its root: intervals are taken over from the parent and widened by that bound, and
only candidates whose interval meets the anchor's window are scored again; theirs become exact.

The walk runs twice: for the best rows of the same label (window: from the k-th best lower bound upwards), and, once
these are known, for rows of other labels inside the score windows they set. Blocks of anchors meet blocks of
candidates in tasks of bounded size; every block keeps its best few rows, and only those are ranked afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyridge.llm.tables import staged


@dataclass(frozen=True)
class Settings:
    """``low`` and ``high`` are the window in percent of a positive's score. The other values bound tasks, not results."""

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95
    anchor_block: int = 512
    row_block: int = 8_192
    pivots: int = 64


def usable(vectors: DataFrame, id_col: str, label_col: str, vector_col: str, scale: int) -> DataFrame:
    """(row, vec_id, label, width, v array<long>): distinct rows with an id, a label and a finite vector."""
    v, id_, label = F.col(vector_col), F.col(id_col), F.col(label_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    rows = vectors.where(id_.isNotNull() & label.isNotNull() & v.isNotNull()).where((F.size(v) > 0) & ~bad)
    rows = rows.select(id_.cast("long").alias("vec_id"), label.cast("string").alias("label"),
                       F.transform(v, lambda x: F.floor(x.cast("double") * scale)).alias("v")).distinct()
    return rows.select(F.xxhash64("vec_id", "label", "v").alias("row"), "vec_id", "label", F.size("v").alias("width"), "v")


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of whole numbers: as doubles while every inner product stays exact in them, else as Python integers."""
    x = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    limit = int(np.sqrt(2.0 ** 52 / max(width, 1)))
    return x.astype(np.float64) if not x.size or (x.max() <= limit and x.min() >= -limit) else x.astype(object)


class Tree:
    """Minimum spanning tree over the rows of ``x`` (Prim), in an order that keeps few open branches."""

    def __init__(self, x: np.ndarray):
        x = x.astype(np.float64)
        n = len(x)
        self.parent, self.edge = np.zeros(n, np.int64), np.zeros(n)
        near, left = np.full(n, np.inf), np.ones(n, bool)
        squares = (x * x).sum(1)
        at, added = 0, [0] if n else []
        left[:1] = False
        for _ in range(n - 1):
            far = np.sqrt(np.maximum(0.0, squares + squares[at] - 2 * (x @ x[at])) + 1e-9 * (squares + squares[at]))
            closer = left & (far < near)
            near[closer], self.parent[closer] = far[closer], at
            at = int(np.where(left, near, np.inf).argmin())
            left[at] = False
            self.edge[at] = near[at]
            added.append(at)
        self.children: list[list[int]] = [[] for _ in range(n)]
        size = np.ones(n, np.int64)
        for k in reversed(added[1:]):
            size[self.parent[k]] += size[k]
            self.children[self.parent[k]].append(k)
        for own in self.children:
            own.sort(key=lambda k: size[k])

    def walk(self, x: np.ndarray, rows: np.ndarray, window) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(anchor, places of the candidates scored again, their exact scores) for every anchor.

        ``window(anchor, low, high)`` tells from the bounds which candidates matter. The largest branch comes last and
        takes its parent's arrays over, so at most log2(anchors) pairs of arrays are open.
        """
        if not len(x) or not len(rows):
            return
        norms = np.sqrt((rows.astype(np.float64) ** 2).sum(1)) * (1 + 1e-9)
        exact = (rows @ x[0])
        as_float = exact.astype(np.float64)
        slack = 1e-9 * np.abs(as_float) + (0 if rows.dtype == np.float64 and x.dtype == np.float64 else 1)
        stack = [(0, as_float - slack, as_float + slack)]
        while stack:
            k, low, high = stack.pop()
            if k:
                spread = self.edge[k] * norms + 1
                low, high = low - spread, high + spread
            need = np.flatnonzero(window(k, low, high))
            scores = (rows @ x[k])[need] if 2 * len(need) > len(rows) else rows[need] @ x[k]
            value = scores.astype(np.float64)
            low[need], high[need] = value - 1e-9 * np.abs(value), value + 1e-9 * np.abs(value)
            yield k, need, scores
            own = self.children[k]
            for child in own[::-1]:  # the largest is put first and so taken last
                stack.append((child, low, high))  # the widening above makes new arrays, so siblings share these


def first(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller id, then row key."""
    if scores.dtype == object:
        return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i], rows[i]))[:k], np.int64)
    if len(scores) > 4 * k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= floor)
        return some[np.lexsort((rows[some], ids[some], -scores[some]))[:k]]
    return np.lexsort((rows, ids, -scores))[:k]


def whole(values) -> pa.Array:
    """Scores as 64-bit integers; what lies beyond them is held at their ends."""
    return pa.array([min(max(int(s), -2 ** 63), 2 ** 63 - 1) for s in values], pa.int64())


def numbers(table: pa.Table, name: str) -> np.ndarray:
    return table[name].combine_chunks().to_numpy(zero_copy_only=False)


def positives_of(anchors: pa.Table, rows: pa.Table, width: int, k: int) -> pa.Table:
    """The k best rows of one block for each anchor; all have the anchor's label."""
    x, y, ids, keys = matrix(anchors["v"], width), matrix(rows["v"], width), numbers(rows, "vec_id"), numbers(rows, "row")
    own, own_keys = numbers(anchors, "vec_id"), numbers(anchors, "row")
    out: list[tuple] = []

    def window(a: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        other = ids != own[a]
        if other.sum() <= k:
            return other
        least = low[other]
        return other & (high >= np.partition(least, len(least) - k)[len(least) - k])

    for a, need, scores in Tree(x).walk(x, y, window):
        for i in first(scores, ids[need], keys[need], k):
            out.append((own_keys[a], keys[need[i]], ids[need[i]], scores[i]))
    key, row, vec_id, score = zip(*out) if out else ([], [], [], [])
    return pa.table([pa.array(key, pa.int64()), pa.array(row, pa.int64()), pa.array(vec_id, pa.int64()), whole(score)], ["anchor_row", "positive_row", "positive_id", "positive_score"])


def negatives_of(anchors: pa.Table, rows: pa.Table, width: int, settings: Settings) -> pa.Table:
    """For each anchor and positive the first rows of one block that have another label and a score in the window."""
    x, y, ids, keys = matrix(anchors["v"], width), matrix(rows["v"], width), numbers(rows, "vec_id"), numbers(rows, "row")
    labels, names = pa.concat_arrays([anchors["label"].combine_chunks(), rows["label"].combine_chunks()]).dictionary_encode(), numbers(anchors, "row")
    code = labels.indices.to_numpy()
    mine, theirs = code[:len(x)], code[len(x):]
    windows = []
    for pairs in anchors["positives"].to_pylist():
        limits = [(p["positive_row"], -(-settings.low * p["positive_score"] // 100), settings.high * p["positive_score"] // 100) for p in pairs]
        windows.append([w for w in limits if w[1] <= w[2]])
    out: list[tuple] = []

    def window(a: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        if not windows[a]:
            return np.zeros(len(low), bool)
        return (theirs != mine[a]) & (high >= float(min(w[1] for w in windows[a])) * (1 - 1e-12) - 1) & (low <= float(max(w[2] for w in windows[a])) * (1 + 1e-12) + 1)

    for a, need, scores in Tree(x).walk(x, y, window):
        for positive, least, most in windows[a]:
            inside = np.flatnonzero((scores >= least) & (scores <= most))
            for i in inside[first(scores[inside], ids[need[inside]], keys[need[inside]], settings.negatives)]:
                out.append((names[a], positive, keys[need[i]], ids[need[i]], scores[i]))
    anchor, positive, row, vec_id, score = zip(*out) if out else ([], [], [], [], [])
    return pa.table([*[pa.array(c, pa.int64()) for c in (anchor, positive, row, vec_id)], whole(score)],
                    ["anchor_row", "positive_row", "negative_row", "negative_id", "negative_score"])


def block(rows: int, count: str) -> Column:
    return F.ceil(F.col(count) / rows).cast("int")


def spread(key: str, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), key), F.greatest(blocks, F.lit(1))).cast("int")


def every(blocks: Column) -> Column:
    return F.explode(F.when(blocks > 0, F.sequence(F.lit(0), blocks - 1)))


def anew(df: DataFrame) -> DataFrame:
    """The same columns under new identities: both sides of a cogroup come from one table."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def mine(vectors: DataFrame, anchor: Column, settings: Settings = Settings(), id_col: str = "vec_id", label_col: str = "label",
         vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Scores are inner products of ``floor(scale * x)``. ``anchor`` marks anchors by ``vec_id``. The positives of an anchor
    are its best rows of the same label; for each of them the best rows of other labels follow whose score lies between
    ``low`` and ``high`` percent of the positive's, so a positive without such rows, or with a score below zero, gives
    none. Ties go to the smaller id. Rows with a null id, label or vector, an empty vector, or a null or non-finite
    component take no part; rows only meet rows with as many components and another id. Repeated rows count once; rows
    of one id that differ are rows of their own. Components and scores beyond 64 bits are held at their ends. Other
    columns are ignored, and an empty table gives no rows.
    """
    all_rows = staged(usable(vectors, id_col, label_col, vector_col, scale))
    marked = F.coalesce(anchor, F.lit(False))
    anchors = all_rows.where(marked)
    k, rank = settings.positives, lambda *by: F.row_number().over(Window.partitionBy(*by[0]).orderBy(*by[1]))

    counts = all_rows.groupBy("width", "label").agg(F.count(F.lit(1)).alias("n"), F.count_if(marked).alias("m")).where("m > 0")
    same = counts.select("width", "label", block(settings.row_block, "n").alias("rb"), block(settings.anchor_block, "m").alias("ab"))
    keys = ["width", "label", "ablock", "rblock"]
    asked = anchors.join(same, ["width", "label"]).withColumn("ablock", spread("row", F.col("ab"))).withColumn("rblock", every(F.col("rb")))
    held = all_rows.join(same, ["width", "label"]).withColumn("rblock", spread("row", F.col("rb"))).withColumn("ablock", every(F.col("ab")))

    def near(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return positives_of(left, right, key[0].as_py(), k)

    found = (asked.select(*keys, "row", "vec_id", "v").groupBy(*keys).cogroup(anew(held.select(*keys, "row", "vec_id", "v")).groupBy(*keys))
             .applyInArrow(near, "anchor_row long, positive_row long, positive_id long, positive_score long"))
    best = found.withColumn("place", rank(["anchor_row"], [F.desc("positive_score"), "positive_id", "positive_row"])).where(F.col("place") <= k).drop("place")
    best = staged(best)

    windows = best.groupBy(F.col("anchor_row").alias("row")).agg(F.collect_list(F.struct("positive_row", "positive_score")).alias("positives"))  # at most k
    asked = anchors.join(windows, "row").select("row", "vec_id", "label", "width", "v", "positives")
    asked = staged(near_each_other(asked, settings))
    cells = asked.groupBy("width", "cell").agg(F.count(F.lit(1)).alias("m")).select("width", "cell", block(settings.anchor_block, "m").alias("ab"))
    before = F.sum("ab").over(Window.partitionBy("width").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))  # at most 64 cells of a width
    cells = cells.withColumn("offset", F.coalesce(before, F.lit(0)).cast("int"))
    sizes = all_rows.groupBy("width").agg(F.count(F.lit(1)).alias("n")).select("width", block(settings.row_block, "n").alias("rb"))
    blocks = cells.groupBy("width").agg(F.sum("ab").cast("int").alias("abs")).join(sizes, "width")
    keys = ["width", "ablock", "rblock"]
    asked = (asked.join(cells, ["width", "cell"]).withColumn("ablock", F.col("offset") + spread("row", F.col("ab")))
             .join(sizes, "width").withColumn("rblock", every(F.col("rb"))))
    held = all_rows.join(blocks, "width").withColumn("rblock", spread("row", F.col("rb"))).withColumn("ablock", every(F.col("abs")))

    def apart(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return negatives_of(left, right, key[0].as_py(), settings)

    hard = (asked.select(*keys, "row", "label", "v", "positives").groupBy(*keys).cogroup(anew(held.select(*keys, "row", "vec_id", "label", "v")).groupBy(*keys))
            .applyInArrow(apart, "anchor_row long, positive_row long, negative_row long, negative_id long, negative_score long"))
    hard = hard.withColumn("rank", rank(["anchor_row", "positive_row"], [F.desc("negative_score"), "negative_id", "negative_row"]))
    hard = hard.where(F.col("rank") <= settings.negatives)
    named = anchors.select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id"))
    return hard.join(best, ["anchor_row", "positive_row"]).join(named, "anchor_row").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def near_each_other(anchors: DataFrame, settings: Settings) -> DataFrame:
    """Adds ``cell``: the nearest of at most ``pivots`` anchors of the same width, chosen by hash."""
    picks = anchors.select("row", "width", "v").orderBy(F.xxhash64("row"), "row").limit(settings.pivots).collect()
    pivots: dict[int, np.ndarray] = {}
    for w in {p["width"] for p in picks}:
        pivots[w] = np.array([p["v"] for p in picks if p["width"] == w], np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            widths, vectors = b.column("width").to_numpy(), b.column("v")
            cell = np.zeros(b.num_rows, np.int32)
            for w in np.unique(widths):
                if w in pivots:
                    at = np.flatnonzero(widths == w)
                    x = matrix(vectors.take(pa.array(at)), int(w)).astype(np.float64)
                    cell[at] = ((pivots[w] ** 2).sum(1) - 2 * (x @ pivots[w].T)).argmin(1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell)], [*b.schema.names, "cell"])

    return anchors.mapInArrow(run, T.StructType([*anchors.schema.fields, T.StructField("cell", T.IntegerType())]))
