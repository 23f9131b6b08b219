"""Imputation of one category by forest proximity.

A forest learns to tell real rows from rows with independently shuffled columns; two
rows are similar when many trees put them in the same leaf. Only leaf profiles matter,
so rows are reduced to distinct profiles with counts before anything is compared.
Blocks of profiles are compared by bit sets, and a query keeps its k best of each block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyridge.operators import forest as grown
from tallyridge.operators.boosting import LOCAL_CHECKPOINTS
from tallyridge.operators.models import SEED, dealt_out, encoders, held, permuted_columns
from tallyridge.session import checkpoint_dir

ROWS_ALONE = 20_000  # up to here a forest is fitted on the partitions there are


def fit_proximity_forest(df: DataFrame, row: str, measures, categories, trees: int = 200, depth: int = 10) -> PipelineModel:
    """Forest that separates the rows from their column-wise shuffles."""
    columns = [*measures, *categories]
    prep = Pipeline(stages=encoders(measures, categories)[:1]).fit(df)
    real = prep.transform(df.select(row, *columns))
    fake = permuted_columns(real, row, columns, "proximity")
    both = real.select(*columns, F.lit(1).alias("real")).unionByName(
        fake.select(*[F.col(f"{c}__perm").alias(c) for c in columns], F.lit(0).alias("real")))
    forest = RandomForestClassifier(labelCol="real", numTrees=trees, maxDepth=depth, minInstancesPerNode=2,
                                    featureSubsetStrategy="sqrt", seed=SEED, leafCol="leaves")
    encode = encoders(measures, categories)[1:]
    if 2 * df.count() <= ROWS_ALONE:
        return PipelineModel(stages=[prep, *Pipeline(stages=[*encode, forest]).fit(both).stages])
    with held(both, trees=True) as rows:  # the shuffles run once, and every core grows trees
        encoded = Pipeline(stages=encode).fit(rows)
        vectors = encoded.transform(rows)
        fitted = grown.fitted(forest, vectors) or forest.fit(vectors)
    return PipelineModel(stages=[prep, *encoded.stages, fitted])


def leaf_profiles(model: PipelineModel, df: DataFrame, keep) -> DataFrame:
    """Leaf number per tree, as an array."""
    leaves = F.transform(vector_to_array("leaves"), lambda x: x.cast("int"))
    return model.transform(dealt_out(df)).select(*keep, leaves.alias("profile"))


def _kth(pairs: DataFrame, k: int) -> DataFrame:
    """(query, floor): equal leaves of the k-th best row found so far; queries with fewer rows are left out."""
    order = Window.partitionBy("query").orderBy(F.desc("matches"), "known")
    few = pairs.withColumn("__place", F.row_number().over(order)).where(F.col("__place") <= k)  # every profile stands for a row at least
    upto = F.sum("rows").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return few.withColumn("__upto", upto).where(F.col("__upto") >= k).groupBy("query").agg(F.max("matches").alias("floor"))


KNOWN_BLOCKS = 6  # a block of known profiles has so many times the rows of a block of queries
KNOWN_AT_ONCE, QUERIES_AT_ONCE = 4096, 256  # pairs whose equal leaves are counted together stay in a core's cache
DIRECT = 4096  # leaf numbers below this are used as they are


def _numbered(theirs: np.ndarray, mine: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], list[int]]:
    """Leaves of the known profiles and of the queries per tree, numbered from 0, and how many numbers there are; a query's
    leaf that no known profile has gets the next number."""
    out = [], [], []
    for a, b in zip(theirs.T, mine.T):
        if a.min() < 0 or a.max() >= DIRECT:
            leaves, a = np.unique(a, return_inverse=True)
            at = np.searchsorted(leaves, b).clip(0, len(leaves) - 1)
            b = np.where(leaves[at] == b, at, len(leaves))
        n = int(a.max()) + 1
        for x, y in zip(out, (a.astype(np.uint16 if n < 1 << 16 else np.int64), np.where((b < 0) | (b > n), n, b), n)):
            x.append(y)
    return out


def _bits(leaf: np.ndarray, n: int, words: int) -> np.ndarray:
    """For every leaf, and one that nobody has, the bit set of the rows in it."""
    row = np.arange(len(leaf))
    return np.bincount(leaf.astype(np.int64) * 2 * words + row // 32, 2.0 ** (row % 32), (n + 1) * 2 * words).astype(np.uint32).view(np.uint64).reshape(n + 1, words)


def _counted(tables: list[np.ndarray], mine: list[np.ndarray], spare: list[np.ndarray]) -> list[np.ndarray]:
    """Numbers of equal leaves of all pairs, as planes of bits, lowest first. ``spare`` holds buffers, which are reused."""
    waiting: list[list[np.ndarray]] = []  # bit sets to be added, by their place value

    def add(place: int, bits: np.ndarray) -> None:
        if place == len(waiting):
            waiting.append([])
        waiting[place].append(bits)
        if len(waiting[place]) == 3:  # a full adder
            a, b, c = waiting[place]
            x = spare.pop()
            np.bitwise_xor(a, b, out=x)
            np.bitwise_and(a, b, out=b)
            np.bitwise_and(x, c, out=a)
            np.bitwise_or(a, b, out=a)
            np.bitwise_xor(x, c, out=x)
            spare.extend((b, c))
            waiting[place] = [x]
            add(place + 1, a)

    for table, leaf in zip(tables, mine):
        bits = spare.pop()
        np.take(table, leaf, axis=0, out=bits, mode="clip")
        add(0, bits)
    place = 0
    while place < len(waiting):
        if len(waiting[place]) == 2:
            a, b = waiting[place]
            x = spare.pop()
            np.bitwise_xor(a, b, out=x)
            np.bitwise_and(a, b, out=a)
            spare.append(b)
            waiting[place] = [x]
            add(place + 1, a)
        place += 1
    return [x[0] for x in waiting]


def _kth_value(planes: list[np.ndarray], some: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest number of every query among the rows of ``some``; 0 if there are fewer."""
    left, need, value = np.broadcast_to(some, planes[0].shape), np.full(len(planes[0]), k), np.zeros(len(planes[0]), np.int64)
    enough = np.bitwise_count(some).sum() >= k
    for place in range(len(planes) - 1, -1, -1):
        with_bit = left & planes[place]
        n = np.bitwise_count(with_bit).sum(1, dtype=np.int64)
        up = n >= need
        value += up.astype(np.int64) << place
        need = np.where(up, need, need - n)
        left = np.where(up[:, None], with_bit, left & ~planes[place])
    return value if enough else np.zeros_like(value)


def _at_least(planes: list[np.ndarray], floor: np.ndarray) -> np.ndarray:
    """Bit set of the rows whose number is at least the query's floor."""
    more, same = np.zeros_like(planes[0]), np.full_like(planes[0], ~np.uint64(0))
    for place in range(len(planes) - 1, -1, -1):
        bit = np.where(floor >> place & 1, ~np.uint64(0), np.uint64(0))[:, None]
        more |= same & planes[place] & ~bit
        same &= ~(planes[place] ^ bit)
    return np.where((floor >> len(planes))[:, None] > 0, np.uint64(0), more | same)


def _matches(theirs: np.ndarray, mine: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, known, equal leaves) of the pairs that reach the query's k-th best row, by their places.

    Equal leaves are counted for 64 pairs at once: the rows of a leaf are a bit set, and the bit sets of a query's leaves are
    added by full adders. A query's floor rises from part to part of the known profiles."""
    trees = theirs.shape[1]
    leaves, own, sizes = _numbered(theirs, mine)
    best = np.zeros((len(mine), trees + 1), np.int64)  # rows found so far by equal leaves
    floor = np.zeros(len(mine), np.int64)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    words = -(-min(KNOWN_AT_ONCE, len(theirs)) // 64)
    for start in range(0, len(theirs), KNOWN_AT_ONCE):
        n = min(KNOWN_AT_ONCE, len(theirs) - start)
        tables = [_bits(leaf[start:start + n], size, words) for leaf, size in zip(leaves, sizes)]
        some = _bits(np.zeros(n, np.int64), 1, words)[0]  # the rows there are
        weight = rows[start:start + n]
        for a in range(0, len(mine), QUERIES_AT_ONCE):
            z = min(a + QUERIES_AT_ONCE, len(mine))
            if not a or z - a != QUERIES_AT_ONCE:
                spare = [np.empty((z - a, words), np.uint64) for _ in range(3 * trees.bit_length() + 8)]
            planes = _counted(tables, [x[a:z] for x in own], spare)
            if not start:
                floor[a:z] = _kth_value(planes, some, k)  # every profile stands for a row at least
            enough = _at_least(planes, np.maximum(floor[a:z], 1)) & some
            at = np.flatnonzero(enough)
            bits = np.unpackbits(enough.ravel()[at].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            word, bit = np.nonzero(bits)
            at = at[word]
            equal = np.zeros(len(at), np.int64)
            for place, plane in enumerate(planes):
                equal += (plane.ravel()[at] >> bit.astype(np.uint64) & np.uint64(1)).astype(np.int64) << place
            query, known = at // words, at % words * 64 + bit
            spare.extend(planes)
            found.append((query + a, known + start, equal))
            best[a:z] += np.bincount(query * (trees + 1) + equal, weight[known], (z - a) * (trees + 1)).astype(np.int64).reshape(z - a, -1)
            reached = best[a:z, ::-1].cumsum(1) >= k
            floor[a:z] = np.where(reached[:, -1], trees - reached.argmax(1), 0)
    query, known, equal = (np.concatenate(x) for x in zip(*found))
    kept = equal >= np.maximum(floor, 1)[query]
    return query[kept], known[kept], equal[kept]


def _best_of_block(k: int):
    """Pairs of a block of queries and a block of known profiles; a query's pairs below its k-th best row of the block are left out."""

    def run(queries: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        place = other = equal = np.zeros(0, np.int64)
        trees = 0
        if len(queries) and len(known):
            theirs, mine = (np.stack(x["profile"].to_numpy()) for x in (known, queries))
            trees = theirs.shape[1]
            place, other, equal = _matches(theirs, mine, known["rows"].to_numpy(), k)
        return pd.DataFrame({"query": queries["query"].to_numpy()[place], "known": known["known"].to_numpy()[other], "matches": equal, "trees": trees})

    return run


def candidates(queries: DataFrame, known: DataFrame, k: int = 30, block_rows: int = 20_000) -> DataFrame:
    """(query, known, matches, trees): every pair of a distinct query profile and a distinct known profile that can be among the
    k most similar rows, with its number of equal leaves and of trees.

    ``queries`` has (query, profile) and ``known`` (known, profile, rows), one row per distinct profile. Both are dealt
    over blocks, of about ``block_rows`` queries and six times as many known profiles, and every block of queries meets
    every block of known profiles in a task of its own, which counts equal leaves of 64 pairs at once and hands on a
    query's best of the block. Work grows with queries times
    known profiles, memory and the pairs handed on do not. Profiles without an equal leaf are nobody's neighbours. The
    result is exact.
    """
    ours, theirs = queries.count(), known.count()
    cores = queries.sparkSession.sparkContext.defaultParallelism
    sides = max(1, -(-theirs // (KNOWN_BLOCKS * block_rows)))
    blocks = max(1, -(-ours // block_rows), min(4 * cores // sides, ours // 100))  # small tables use all cores too

    def dealt(df: DataFrame, key: str, own: str, n: int, other: str, times: int) -> DataFrame:
        df = df.withColumns({own: F.pmod(F.xxhash64(key), F.lit(n)).cast("int"), other: F.explode(F.sequence(F.lit(0), F.lit(times - 1)))})
        return df.repartition(blocks * sides, "block", "side").groupBy("block", "side")

    pairs = dealt(queries.select("query", "profile"), "query", "block", blocks, "side", sides).cogroup(
        dealt(known.select("known", "profile", "rows"), "known", "side", sides, "block", blocks)).applyInPandas(
            _best_of_block(k), "query string, known string, matches int, trees int")
    if sides == 1:
        return pairs  # the best of the only block
    checkpoint_dir(queries.sparkSession, LOCAL_CHECKPOINTS if queries.sparkSession.sparkContext.master.startswith("local[") else None)
    pairs = pairs.checkpoint()  # read twice, counted once
    floors = _kth(pairs.join(known.select("known", "rows"), "known"), k)
    return pairs.join(floors, "query", "left").where(F.col("matches") >= F.coalesce("floor", F.lit(1))).drop("floor")


def nearest_values(queries: DataFrame, known: DataFrame, k: int = 30, block_rows: int = 20_000) -> DataFrame:
    """Weighted votes of the k most similar known rows per distinct query profile.

    ``queries`` has ``profile``; ``known`` has ``profile`` and ``value``. Equal rows count with their multiplicity; ties
    at the border go by profile and value; rows without an equal leaf have no vote. Returns ``query`` (profile key),
    ``value`` and ``weight``.
    """
    key = F.md5(F.array_join("profile", ","))
    spark = queries.sparkSession
    checkpoint_dir(spark, LOCAL_CHECKPOINTS if spark.sparkContext.master.startswith("local[") else None)
    # Both tables are read several times; the forest that made them runs once.
    q = queries.select("profile").distinct().select("profile", key.alias("query")).checkpoint()
    r = known.groupBy("profile", "value").agg(F.count(F.lit(1)).alias("n")).withColumn("known", key).checkpoint()
    whole = r.groupBy("known", "profile").agg(F.sum("n").alias("rows"))
    found = candidates(q, whole, k, block_rows).join(r.select("known", "value", "n"), "known")
    order = Window.partitionBy("query").orderBy(F.desc("matches"), "known", "value")
    few = found.withColumn("__place", F.row_number().over(order)).where(F.col("__place") <= k)  # every row of it counts once at least
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    taken = few.withColumn("take", F.least(F.col("n"), k - before)).where("take > 0")
    return taken.groupBy("query", "value").agg(F.sum(F.col("matches") / F.col("trees") * F.col("take")).alias("weight"))


def proximity_impute(model: PipelineModel, train: DataFrame, df: DataFrame, row: str, target: str, k: int = 30, block_rows: int = 20_000) -> DataFrame:
    """Fill ``target`` by the strongest vote; the training mode where nothing is similar."""
    known = leaf_profiles(model, train.where(F.col(target).isNotNull()), [F.col(target).alias("value")])
    holes = leaf_profiles(model, df.where(F.col(target).isNull()), [row])
    votes = nearest_values(holes, known, k, block_rows)
    best = votes.groupBy("query").agg(F.min(F.struct((-F.col("weight")).alias("w"), F.col("value"))).alias("b")).select(
        "query", F.when(F.col("b.w") < 0, F.col("b.value")).alias("voted"))
    fallback = train.agg(F.mode(target, True)).scalar()
    filled = holes.withColumn("query", F.md5(F.array_join("profile", ","))).join(best, "query", "left").select(
        row, F.coalesce(F.col("voted"), fallback, F.lit("missing")).alias("__fill"))
    return df.join(filled, row, "left").withColumn(target, F.coalesce(F.col(target), F.col("__fill"))).drop("__fill")
