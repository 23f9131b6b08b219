"""Random forest classifiers grown tree by tree.

The library grows a forest level by level over all rows: every partition sends statistics of all nodes, and the driver
splits them. Here the rows are binned once and packed (two bytes per value that is not zero). Every task gets all packed
rows and grows trees of its own on bootstraps of them, so cores never wait for each other and only finished trees leave
a task. The rules are those of the library: up to ``maxBins`` bins per feature, Gini impurity, a random subset of features
per node, Poisson bootstraps, minimum instances per node. The result is the library's own model.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkContext, StorageLevel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.linalg import SparseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyridge.operators.boosting import LOCAL_CHECKPOINTS
from tallyridge.session import checkpoint_dir

CELLS_IN_TASK = 128_000_000  # values of the packed table that one task holds: 256 MB; larger tables are left to the library
POINTS = 1024  # values per feature and partition that bins are chosen from; exact up to so many distinct ones
HISTOGRAM = 1 << 22  # sums held at once while a level is split


# ---------------------------------------------------------------- rows to packed blocks


def _unwrapped(df: DataFrame, features: str, label: str, weight: str | None) -> DataFrame:
    v = F.unwrap_udt(features)
    return df.select(F.coalesce(v["size"], F.size(v["values"])).alias("size"), v["indices"].alias("indices"), v["values"].alias("values"), F.col(label).cast("double").alias("y"),
                     (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"))


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and flat values of a list column."""
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]]
    lengths = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(offsets), 0)
    return lengths, flat


def _triples(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature and value of every value that is not zero."""
    lengths, values = _lists(batch.column("values"))
    some, indices = _lists(batch.column("indices"))
    row = np.repeat(np.arange(len(lengths)), lengths)
    feature = np.empty(len(values), np.int64)
    place = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    sparse = np.repeat((some > 0) | (lengths == 0), lengths)  # a dense vector has no indices
    feature[sparse], feature[~sparse] = indices, place[~sparse]
    kept = values != 0
    return row[kept], feature[kept], values[kept]


def _thinned(values: np.ndarray, counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``most`` of the sorted values, at even ranks, with the counts of the values up to them."""
    if len(values) <= most:
        return values, counts
    upto = np.cumsum(counts)
    at = np.unique(np.searchsorted(upto, np.linspace(0, upto[-1], most + 1)[1:], "left").clip(0, len(values) - 1))
    return values[at], np.diff(upto[at], prepend=0)


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Value counts per feature of a partition; feature -1 tells its rows (n) and the most values of a row, -2 its largest label, -3 the number of features."""
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    rows = widest = features = 0
    largest = 0.0
    for batch in batches:
        if not len(batch):
            continue
        if any(batch.column(c).null_count for c in ("size", "y", "w")):
            raise ValueError("a forest needs features, labels and weights without nulls")
        row, feature, value = _triples(batch)
        rows, widest, largest = rows + len(batch), max(widest, int(np.bincount(row).max(initial=0))), max(largest, batch.column("y").to_numpy().max())
        features = max(features, batch.column("size").to_numpy().max())
        order = np.lexsort((value, feature))
        feature, value = feature[order], value[order]
        first = np.flatnonzero(np.r_[True, (np.diff(feature) != 0) | (np.diff(value) != 0)]) if len(value) else np.zeros(0, int)
        counts, feature, value = np.diff(np.r_[first, len(value)]), feature[first], value[first]
        for f, a, z in zip(*_runs(feature)):
            v, n = value[a:z], counts[a:z]
            if f in held:
                v, back = np.unique(np.r_[held[f][0], v], return_inverse=True)
                n = np.bincount(back, np.r_[held[f][1], n]).astype(np.int64)
            held[f] = _thinned(v, n, POINTS)
    parts = [(np.full(len(v), f), v, n) for f, (v, n) in held.items()] + [([-1], [float(widest)], [rows]), ([-2], [largest], [rows]), ([-3], [float(features)], [rows])]
    f, v, n = (np.concatenate(x) for x in zip(*parts))
    yield pa.RecordBatch.from_arrays([pa.array(f, pa.int32()), pa.array(v, pa.float64()), pa.array(n, pa.int64())], ["feature", "value", "n"])


def _runs(sorted_keys: np.ndarray) -> tuple[list, np.ndarray, np.ndarray]:
    keys, first = np.unique(sorted_keys, return_index=True)
    return keys.tolist(), first, np.r_[first[1:], len(sorted_keys)]


def _thresholds(values: np.ndarray, counts: np.ndarray, bins: int) -> np.ndarray:
    """Midpoints between all distinct values, or between those at even ranks where there are more than ``bins``."""
    values, counts = _thinned(values, counts, POINTS * 4)
    ends = np.arange(len(values) - 1)
    if len(values) > bins:
        upto = np.cumsum(counts)
        ends = np.unique(np.abs(upto[:-1, None] - upto[-1] * np.arange(1, bins) / bins).argmin(0))
    return (values[ends] + values[ends + 1]) / 2


@dataclass
class Bins:
    """Cells of all features: one per bin but that of zero, numbered by feature and bin. ``edges[f]`` are a feature's thresholds."""

    edges: list[np.ndarray]
    classes: int
    width: int

    def __post_init__(self):
        size = np.array([len(e) for e in self.edges], np.int64)
        self.zero = np.array([int(np.searchsorted(e, 0.0, "left")) for e in self.edges], np.int64)
        self.start = np.cumsum(size) - size
        self.cells = int(size.sum())
        self.feature = np.repeat(np.arange(len(size)), size)
        place = np.arange(self.cells) - self.start[self.feature]
        self.below = place < self.zero[self.feature]  # cells of bins below that of zero
        self.threshold = np.concatenate([*self.edges, np.zeros(0)])
        # A cell below zero stands for the split after it, one above for the split before it: both are the threshold at its place.
        end = self.start + size
        own = np.arange(self.cells)
        self.low = np.where(self.below, self.start[self.feature], own)
        self.high = np.where(self.below, own + 1, end[self.feature])

    def numbered(self, feature: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Cell of each value, -1 for those in the bin of zero."""
        out = np.full(len(value), -1, np.int64)
        order = np.argsort(feature, kind="stable")
        for f, a, z in zip(*_runs(feature[order])):
            at = order[a:z]
            b = np.searchsorted(self.edges[f], value[at], "left")  # a value at a threshold goes left
            out[at] = np.where(b == self.zero[f], -1, self.start[f] + b - (b > self.zero[f]))
        return out


def _packed(bins: Bins):
    """Blocks of rows: the cells of every row (``width`` columns), its label and its weight."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            row, feature, value = _triples(batch)
            cell = bins.numbered(feature, value)
            row, cell = row[cell >= 0], cell[cell >= 0]
            each = np.bincount(row, minlength=len(batch))
            place = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
            table = np.full((bins.width, len(batch)), bins.cells, _kind(bins))
            table[place, row] = cell
            parts = table.tobytes(), batch.column("y").to_numpy().astype(np.uint16).tobytes(), batch.column("w").to_numpy().tobytes()
            key = hashlib.md5(b"".join(parts)).hexdigest()
            yield pa.RecordBatch.from_arrays([pa.array([key]), *[pa.array([p], pa.binary()) for p in parts]], ["key", "cells", "y", "w"])

    return run


def _kind(bins: Bins):
    return np.uint16 if (bins.cells + 1) * bins.classes < 1 << 16 else np.uint32


# ---------------------------------------------------------------- trees


FLAT = ("tree int, id int, prediction double, impurity double, stats array<double>, count bigint, gain double, left int, right int, feature int, threshold double")


def _splits(bins: Bins, sums: np.ndarray, total: np.ndarray, instances: np.ndarray | None, count: np.ndarray, chosen: np.ndarray, leaf: int):
    """Best cell of every node, or -1, its gain per unit of weight and the sums of its side.

    ``sums`` (nodes, cells, classes) become running sums over the bins beyond a split. Sides need ``leaf`` instances; without
    ``instances`` per cell a row's weight is that number (or ``leaf`` is 1 and some weight is enough)."""
    many = np.flatnonzero(np.diff(np.r_[bins.start, bins.cells]) > 1)
    for table in (sums, instances):
        if table is not None:
            for f in many:
                a, z = bins.start[f], bins.start[f] + len(bins.edges[f])
                mid = a + bins.zero[f]
                table[:, a:mid] = table[:, a:mid].cumsum(1)
                table[:, mid:z] = table[:, mid:z][:, ::-1].cumsum(1)[:, ::-1]
    node, cell = np.nonzero(chosen[:, bins.feature])
    side = sums[node, cell]
    some = side.sum(1) > 0
    node, cell, side = node[some], cell[some], side[some]
    whole = total[node]
    rest = whole - side
    one, other, every = side.sum(1), rest.sum(1), whole.sum(1)
    if leaf > 1:
        n = one if instances is None else instances[node, cell]
        good = (n >= leaf - 1e-6) & (count[node] - n >= leaf - 1e-6)
    else:
        good = other > 1e-9 * every
    node, cell, side, rest, whole, one, other, every = (x[good] for x in (node, cell, side, rest, whole, one, other, every))
    gain = ((side * side).sum(1) / one + (rest * rest).sum(1) / other - (whole * whole).sum(1) / every) / every
    best, of = np.full(len(total), -1), np.zeros(len(total))
    order = np.lexsort((cell, -gain, node))
    first = order[np.flatnonzero(np.r_[True, np.diff(node[order]) != 0])] if len(order) else order
    first = first[gain[first] > 1e-12]
    best[node[first]], of[node[first]] = cell[first], gain[first]
    return best, of


def grown_tree(bins: Bins, table: np.ndarray, y: np.ndarray, weight: np.ndarray, times: np.ndarray, depth: int, leaf: int, subset: int, rng) -> dict[str, np.ndarray]:
    """Nodes of one tree in level order. ``table`` has the cells of the rows, ``times`` how often each row was drawn."""
    drawn = np.flatnonzero(times)
    k, cells = bins.classes, bins.cells + 1
    plain = bool((weight == 1).all())
    table = [(c[drawn].astype(np.int32) * k + y[drawn]).astype(_kind(bins)) for c in table]
    y, times = y[drawn], times[drawn].astype(float)
    weight = times if plain else weight[drawn] * times
    node = np.zeros(len(drawn), np.int64)
    out: dict[str, list] = {name: [] for name in ("stats", "count", "gain", "left", "cell")}
    active, ended = 1, 0
    for level in range(depth + 1):
        total = np.bincount(node * k + y, weight, active * k)[:active * k].reshape(active, k)
        count = np.bincount(node, times, active)[:active]
        best, gain = np.full(active, -1), np.full(active, -1.0)
        if level < depth and bins.cells:
            open_ = np.flatnonzero((count >= 2 * leaf) & ((total > 0).sum(1) > 1))
            number = np.full(active + 1, -1)
            number[open_] = np.arange(len(open_))
            own = number[node]
            batch = max(1, HISTOGRAM // (cells * k))
            for a in range(0, len(open_), batch):
                z = min(a + batch, len(open_))
                at = None if z - a == active else np.flatnonzero((own >= a) & (own < z))
                here, w = (own, weight) if at is None else (own[at] - a, weight[at])
                base = here * (cells * k)
                sums = np.zeros((z - a) * cells * k)
                for c in table:
                    sums += np.bincount(base + (c if at is None else c[at]), w, len(sums))
                sums = sums.reshape(z - a, cells, k)[:, :-1]
                instances = None
                if leaf > 1 and not plain:
                    n, base = times if at is None else times[at], here * cells
                    instances = sum(np.bincount(base + (c if at is None else c[at]) // k, n, (z - a) * cells) for c in table).reshape(z - a, cells)[:, :-1]
                features = len(bins.edges)
                chosen = np.ones((z - a, features), bool)
                if subset < features:
                    chosen = np.zeros((z - a, features), bool)
                    np.put_along_axis(chosen, rng.random((z - a, features), np.float32).argpartition(subset, 1)[:, :subset], True, 1)
                nodes = open_[a:z]
                best[nodes], gain[nodes] = _splits(bins, sums, total[nodes], instances, count[nodes], chosen, leaf)
        split = best >= 0
        gain[~split] = -1.0
        children = int(split.sum())
        left = np.full(active, -1)
        left[split] = ended + active + 2 * np.arange(children)
        for name, x in zip(out, (total, count, gain, left, best)):
            out[name].append(x)
        if not children:
            break
        # Rows of split nodes move to a child: those with a cell beyond the threshold to one side, the others to the other side.
        first = np.full(active + 1, 2 * children)
        first[:active][split] = 2 * np.arange(children)
        low, high, below = (np.zeros(active + 1, t) for t in (np.int32, np.int32, bool))
        low[:active][split], high[:active][split], below[:active][split] = bins.low[best[split]] * k, bins.high[best[split]] * k, bins.below[best[split]]
        low, high = low[node].astype(table[0].dtype), high[node].astype(table[0].dtype)
        inside = np.zeros(len(node), bool)
        for c in table:
            inside |= (c >= low) & (c < high)
        child = first[node]
        child += (child < 2 * children) & (inside != below[node])
        done = child == 2 * children
        if done.any():
            keep = np.flatnonzero(~done)
            table, y, times, weight, child = [c[keep] for c in table], y[keep], times[keep], weight[keep], child[keep]
        node, ended, active = child, ended + active, 2 * children
    return _pruned({name: np.concatenate(x) for name, x in out.items()})


def _pruned(tree: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """As in the library, two leaves that predict the same class become one, again and again; nodes are numbered anew."""
    left, says = tree["left"].tolist(), tree["stats"].argmax(1).tolist()
    for i in range(len(left) - 1, -1, -1):  # children come after their parent
        a = left[i]
        if a >= 0 and left[a] < 0 and left[a + 1] < 0 and says[a] == says[a + 1]:
            left[i] = -1
    left, stays = np.array(left), np.zeros(len(left), bool)
    stays[0] = True
    reached = np.zeros(1, int)
    while len(reached):
        inner = left[reached][left[reached] >= 0]
        reached = np.concatenate([inner, inner + 1])
        stays[reached] = True
    number = np.cumsum(stays) - 1
    out = {name: x[stays] for name, x in tree.items()}
    out["left"] = np.where(left[stays] >= 0, number[left[stays]], -1)
    out["cell"] = np.where(left[stays] >= 0, out["cell"], -1)
    out["gain"] = np.where(left[stays] >= 0, out["gain"], -1.0)
    return out


def _trees(bins: Bins, trees: int, groups: dict[int, int], depth: int, leaf: int, subset: int, seed: int, bootstrap: bool):
    """All packed rows and the number of a group to the nodes of the group's trees."""

    def run(key, blocks):
        blocks = blocks.sort_values("key")
        table = np.concatenate([np.frombuffer(b, _kind(bins)).reshape(bins.width, -1) for b in blocks["cells"]], 1)
        y = np.concatenate([np.frombuffer(b, np.uint16) for b in blocks["y"]]).astype(np.int64)
        weight = np.concatenate([np.frombuffer(b) for b in blocks["w"]])
        sizes, keys = [len(b) // 8 for b in blocks["w"]], [int(x[:12], 16) for x in blocks["key"]]
        out = []
        for tree in range(groups[key[0]], trees, len(groups)):
            times = np.ones(len(y), np.int64)
            if bootstrap:
                times = np.concatenate([np.random.default_rng([seed, tree, place, x]).poisson(1.0, n) for place, (x, n) in enumerate(zip(keys, sizes))])
            grown = grown_tree(bins, table, y, weight, times, depth, leaf, subset, np.random.default_rng([seed, tree]))
            out.append(_as_nodes(bins, tree, grown))
        return pd.concat(out)

    return run


def _as_nodes(bins: Bins, tree: int, grown: dict[str, np.ndarray]) -> pd.DataFrame:
    stats, left, cell = grown["stats"], grown["left"], grown["cell"]
    every = stats.sum(1)
    impurity = 1 - (stats * stats).sum(1) / np.where(every > 0, every * every, 1)
    inner = cell >= 0
    return pd.DataFrame({
        "tree": tree, "id": np.arange(len(left)), "prediction": stats.argmax(1).astype(float), "impurity": impurity, "stats": list(stats),
        "count": np.round(grown["count"]).astype(np.int64), "gain": grown["gain"], "left": left, "right": np.where(inner, left + 1, -1),
        "feature": np.where(inner, bins.feature[cell] if bins.cells else -1, -1), "threshold": bins.threshold[cell] if bins.cells else 0.0})


# ---------------------------------------------------------------- the library's model


def _folder(spark: SparkSession) -> str | None:
    checkpoint_dir(spark, LOCAL_CHECKPOINTS if spark.sparkContext.master.startswith("local[") else None)
    folder = spark.sparkContext.getCheckpointDir()
    return f"{folder}/forest-{uuid4().hex}" if folder else None


def _subset(forest: RandomForestClassifier, features: int) -> int:
    kind = forest.getFeatureSubsetStrategy()
    if kind == "all" or kind == "auto" and forest.getNumTrees() == 1:
        return features
    if kind not in ("auto", "sqrt"):
        raise ValueError(f"no such subset of features here: {kind}")
    return math.ceil(math.sqrt(features))


def _stored(forest: RandomForestClassifier, nodes: DataFrame, features: int, classes: int, path: str) -> RandomForestClassificationModel:
    """A model of root nodes only, fitted by the library, is stored, its nodes are replaced, and it is read again."""
    spark = nodes.sparkSession
    weight = forest.getWeightCol() if forest.isDefined(forest.weightCol) else None
    names = [forest.getFeaturesCol(), forest.getLabelCol(), *([weight] if weight else [])]
    empty = spark.createDataFrame([(SparseVector(features, {}), float(c), 1.0)[:len(names)] for c in range(classes)], names).coalesce(1)
    forest.fit(empty).write().save(path)
    nodes.write.mode("overwrite").parquet(f"{path}/data")
    return RandomForestClassificationModel.load(path)


def _removed(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def bins_of(rows: DataFrame, most: int) -> tuple[Bins, int]:
    """Bins of all features, chosen from all rows, and the number of rows. ``rows`` are unwrapped."""
    found = rows.mapInArrow(_summary, "feature int, value double, n bigint").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        told = {r["feature"]: r for r in found.where("feature < 0").groupBy("feature").agg(F.max("value").alias("most"), F.sum("n").alias("n")).collect()}
        n = told[-1]["n"] if told else 0
        if not n:
            raise ValueError("a forest needs rows")

        def edges(points: pd.DataFrame) -> pd.DataFrame:
            by = points.groupby("value")["n"].sum()
            by[0.0] = n - by.sum()  # values of zero are not listed
            by = by[by > 0].sort_index()
            return pd.DataFrame({"feature": points["feature"].iloc[:1], "edges": [_thresholds(by.index.to_numpy(), by.to_numpy(), most).tolist()]})

        cuts = {r["feature"]: r["edges"] for r in found.where("feature >= 0").groupBy("feature").applyInPandas(edges, "feature int, edges array<double>").collect()}
    finally:
        found.unpersist()
    return Bins([np.array(cuts.get(f, []), float) for f in range(int(told[-3]["most"]))], int(told[-2]["most"]) + 1, max(1, int(told[-1]["most"]))), n


def _keys(spark: SparkSession, n: int) -> list[int]:
    """Numbers that a hash partitioning sends to n different partitions."""
    found: dict[int, int] = {}
    for r in spark.range(20 * n + 200).select(F.col("id").cast("int").alias("id"), F.pmod(F.hash(F.col("id").cast("int")), F.lit(n)).alias("p")).collect():
        found.setdefault(r["p"], r["id"])
    return list(found.values()) if len(found) == n else list(range(n))


def fitted(forest: RandomForestClassifier, df: DataFrame) -> RandomForestClassificationModel | None:
    """The forest, grown from ``df``; nothing if the table is too large for one task or there is no shared folder for the model."""
    spark, path = df.sparkSession, _folder(df.sparkSession)
    if path is None:
        return None
    weight = forest.getWeightCol() if forest.isDefined(forest.weightCol) else None
    with_cells = _unwrapped(df, forest.getFeaturesCol(), forest.getLabelCol(), weight).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        bins, n = bins_of(with_cells, forest.getMaxBins())
        if n * bins.width > CELLS_IN_TASK:
            return None
        trees = forest.getNumTrees()
        groups = min(trees, 2 * spark.sparkContext.defaultParallelism)
        keys = _keys(spark, groups)
        blocks = with_cells.mapInArrow(_packed(bins), "key string, cells binary, y binary, w binary")
        dealt = blocks.withColumn("group", F.explode(F.array(*[F.lit(k) for k in keys]))).repartition(groups, "group")
        grow = _trees(bins, trees, {k: i for i, k in enumerate(keys)}, forest.getMaxDepth(), forest.getMinInstancesPerNode(), _subset(forest, len(bins.edges)), forest.getSeed(), forest.getBootstrap())
        flat = dealt.groupBy("group").applyInPandas(grow, FLAT)
        nodes = flat.select(F.col("tree").alias("treeID"), F.struct(
            "id", "prediction", "impurity", F.col("stats").alias("impurityStats"), F.col("count").alias("rawCount"), "gain", F.col("left").alias("leftChild"),
            F.col("right").alias("rightChild"), F.struct(
                F.col("feature").alias("featureIndex"), F.when(F.col("feature") >= 0, F.array("threshold")).otherwise(F.array().cast("array<double>")).alias("leftCategoriesOrThreshold"),
                F.lit(-1).alias("numCategories")).alias("split")).alias("nodeData"))
        return _stored(forest, nodes, len(bins.edges), bins.classes, path)
    finally:
        with_cells.unpersist()
        _removed(spark, path)


def parts_of(model: RandomForestClassificationModel, sizes: list[int]) -> list[RandomForestClassificationModel]:
    """The trees of a model as several models with its parameters."""
    sc = SparkContext._active_spark_context
    kind, whole, at, out = sc._jvm.org.apache.spark.ml.classification, model._java_obj.trees(), 0, []
    for n in sizes:
        own = sc._gateway.new_array(kind.DecisionTreeClassificationModel, n)
        for i in range(n):
            own[i] = whole[at + i]
        at += n
        java = kind.RandomForestClassificationModel(f"{model.uid}_{len(out)}", own, model.numFeatures, model.numClasses)
        out.append(RandomForestClassificationModel(model._java_obj.copyValues(java, sc._jvm.org.apache.spark.ml.param.ParamMap.empty())))
        out[-1]._resetUid(java.uid())
        out[-1]._transfer_params_from_java()
        out[-1]._set(numTrees=n)
        out[-1]._transfer_params_to_java()
    return out
