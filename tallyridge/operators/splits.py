"""Reproducible holdouts, folds and membership checks.

Shuffling is an md5 order of (row id, seed). Exact class shares need each row's rank in
that order; ranks come from :func:`exact_rank`, which cuts the order into hash buckets,
so no class is ever sorted by one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyridge.functions.hashing import hash_bucket, md5_key
from tallyridge.operators.prefix import exact_rank, null_safe_join


def shuffled_rank(df: DataFrame, by, row: str, seed, name: str = "rank") -> DataFrame:
    """Rank of each row in a seeded shuffle of its group (1-based), plus the group size."""
    keyed = df.withColumn("__key", md5_key(F.col(row), seed if isinstance(seed, Column) else str(seed)))
    return exact_rank(keyed, by, ["__key", row], hash_bucket(F.col("__key")), name).drop("__key")


def stratified_holdout(df: DataFrame, label: str, row: str, share: float, seed) -> DataFrame:
    """``split`` = test for round(n * share) rows of every class, else train."""
    ranked = shuffled_rank(df, [label], row, seed)
    test = F.col("rank") <= F.round(F.col("rank_of") * share)
    return ranked.withColumn("split", F.when(test, "test").otherwise("train")).drop("rank", "rank_of")


def stratified_folds(df: DataFrame, label, row: str, k: int, seed, name: str = "fold") -> DataFrame:
    """Deal the shuffled rows of each class over folds 1..k."""
    by = [label] if isinstance(label, str) else list(label)
    ranked = shuffled_rank(df, by, row, seed)
    return ranked.withColumn(name, (F.pmod(F.col("rank") - 1, F.lit(k)) + 1).cast("int")).drop("rank", "rank_of")


def _dealt(k: int, totals: list[int]):
    """Deal groups, given as (counts, groups with these counts) in order, to the fold that stays most even."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [[0] * len(totals) for _ in range(k)]
        total, squares = [0] * len(totals), [0] * len(totals)

        def place(counts: list[int]) -> int:
            best = None
            for f, own in enumerate(held):
                uneven = 0.0
                for c, n in enumerate(counts):
                    spread = k * (squares[c] + 2 * own[c] * n + n * n) - (total[c] + n) ** 2
                    uneven += math.sqrt(spread) / (k * totals[c]) if totals[c] else 0.0
                if best is None or (uneven, sum(own)) < best[:2]:
                    best = (uneven, sum(own), f)
            own = held[best[2]]
            for c, n in enumerate(counts):
                squares[c] += 2 * own[c] * n + n * n
                own[c] += n
                total[c] += n
            return best[2]

        for batch in batches:
            heads, cycles = [], []
            for counts, groups in zip(batch["counts"], batch["groups"]):
                counts, head, cycle = [int(n) for n in counts], [], []
                while len(head) < groups:
                    head.append(place(counts) + 1)
                    if len(set(head[-k:])) == k and groups - len(head) >= k:
                        cycle = head[-k:]  # every fold took one: nothing but the level has changed, so this repeats
                        break
                if cycle:
                    rounds, rest = divmod(groups - len(head), k)
                    for f, own in enumerate(held):
                        for c, n in enumerate(counts):
                            own[c] += n * rounds
                    for c, n in enumerate(counts):
                        total[c] += k * n * rounds
                        squares[c] = sum(own[c] ** 2 for own in held)
                    for _ in range(rest):
                        place(counts)
                heads.append(head)
                cycles.append(cycle)
            yield pd.DataFrame({"counts": batch["counts"], "head": heads, "cycle": cycles})

    return run


def group_folds(df: DataFrame, group: str, label: str, k: int, seed) -> DataFrame:
    """Whole groups per fold, class shares as even as greedy dealing makes them.

    Groups come in order of how unevenly they hold the classes (spread of their class counts, largest first; then
    counts, then a seeded key). Each goes to the fold where the mean over the classes of the standard deviation of
    the folds' class shares stays smallest; ties to the fold with fewer rows, then to the lower number. Groups with
    equal counts are dealt together: once every fold has taken one of them, the pattern repeats. So one ordered pass
    over the distinct count vectors, a stream through one task that holds k x classes numbers, settles all groups.
    Null labels are a class of their own; rows with a null group form one group; a table without rows stays empty.
    """
    classes = [r[0] for r in df.select(label).distinct().orderBy(label).collect()]  # the classes of a label are few
    if not classes:
        return df.withColumn("fold", F.lit(None).cast("int"))
    counts = F.array(*[F.count_if(F.col(label).eqNullSafe(F.lit(c))) for c in classes])
    groups = df.groupBy(group).agg(counts.alias("counts")).withColumn("__key", md5_key(F.coalesce(F.col(group).cast("string"), F.lit("")), str(seed)))
    totals = [r[0] for r in groups.select(F.posexplode("counts")).groupBy("pos").agg(F.sum("col").alias("n")).orderBy("pos").select("n").collect()]
    total = F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, n: a + n)
    squares = F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, n: a + n * n)
    kinds = groups.groupBy("counts").agg(F.count(F.lit(1)).alias("groups")).withColumn("__spread", len(classes) * squares - total * total)
    ordered = kinds.repartition(1).sortWithinPartitions(F.desc("__spread"), "counts").select("counts", "groups")
    dealt = ordered.mapInPandas(_dealt(k, totals), "counts array<bigint>, head array<int>, cycle array<int>")
    ranked = exact_rank(groups, ["counts"], ["__key", group], hash_bucket(F.col("__key"), 2)).withColumn("__at", (F.col("rank") - 1).cast("int"))
    later = F.pmod(F.col("__at") - F.size("head"), F.greatest(F.size("cycle"), F.lit(1)))
    fold = F.when(F.col("__at") < F.size("head"), F.get("head", F.col("__at"))).otherwise(F.get("cycle", later))
    folds = ranked.join(dealt, "counts").select(group, fold.alias("fold"))
    return null_safe_join(df, folds, [group])


def chronological_folds(days: DataFrame, k: int = 5, size: int = 28, day: str = "day") -> DataFrame:
    """Expanding training window, k consecutive validation windows of ``size`` days."""
    span = days.agg(F.min(day).alias("a"), F.date_add(F.max(day).cast("date"), 1).cast("timestamp_ntz").alias("b"))
    fold = span.select("a", "b", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("fold"))
    start = F.col("b") - F.make_dt_interval((F.lit(k) - F.col("fold") + 1) * size)
    table = fold.select("fold", F.col("a").alias("train_start"), start.alias("train_end"), start.alias("valid_start"),
                        (start + F.make_dt_interval(F.lit(size))).alias("valid_end"))
    return table.where("train_end > train_start")


def training_window(df: DataFrame, cutoff: str, years: int | None, day: str = "day") -> DataFrame:
    """Rows before the cutoff, optionally only the last ``years`` years."""
    end = F.lit(cutoff).cast("timestamp_ntz")
    rows = df.where(F.col(day) < end)
    return rows if years is None else rows.where(F.col(day) >= end - F.expr(f"INTERVAL {years} YEARS"))


def nested_folds(df: DataFrame, label: str, row: str, outer: int, inner: int, seed: int) -> DataFrame:
    """Long table (row, outer, inner): inner folds of each outer training set, seeded per outer fold."""
    assigned = stratified_folds(df, label, row, outer, seed, "own_fold")
    rows = assigned.select(row, label, "own_fold", F.explode(F.sequence(F.lit(1), F.lit(outer))).alias("outer"))
    training = rows.where(F.col("outer") != F.col("own_fold"))
    per_fold_seed = (F.lit(seed) + F.col("outer")).cast("string")
    ranked = shuffled_rank(training, ["outer", label], row, per_fold_seed)
    return ranked.select(row, label, "outer", (F.pmod(F.col("rank") - 1, F.lit(inner)) + 1).cast("int").alias("inner"))


def split_manifest(df: DataFrame, label: str, row: str, share: float, k: int, seed) -> DataFrame:
    """Membership table: split, order inside training and validation fold per training row."""
    split = stratified_holdout(df, label, row, share, seed)
    train = stratified_folds(split.where("split = 'train'"), label, row, k, f"{seed}-cv", "cv_validation_fold")
    ordered = shuffled_rank(train, [], row, f"{seed}-order", "o").withColumn("training_order", F.col("o") - 1)
    test = split.where("split = 'test'").withColumns({
        "training_order": F.lit(None).cast("bigint"), "cv_validation_fold": F.lit(None).cast("int")})
    cols = [row, label, "split", "training_order", "cv_validation_fold"]
    return ordered.select(*cols).unionByName(test.select(*cols))


def manifest_training(df: DataFrame, manifest: DataFrame, row: str) -> DataFrame:
    """Training rows with their declared order and fold."""
    keep = manifest.where("split = 'train'").select(row, "training_order", "cv_validation_fold")
    return df.join(keep, row)


def disjoint_report(df: DataFrame, split: str, row: str, group: str) -> DataFrame:
    """Rows and groups per split and how many sit in both: one pass over the membership."""

    def shared(key, name):
        sides = df.groupBy(key).agg(
            F.max((F.col(split) == "train").cast("int")).alias("tr"), F.max((F.col(split) == "test").cast("int")).alias("te"))
        return sides.agg(
            F.sum("tr").alias("train"), F.sum("te").alias("test"),
            F.coalesce(F.sum(F.col("tr") * F.col("te")), F.lit(0)).cast("bigint").alias("shared"), F.count(F.lit(1)).alias("all_keys"),
        ).select(F.lit(name).alias("unit"), "train", "test", "shared", "all_keys")

    return shared(row, "row").unionByName(shared(group, "group"))


def oof_faults(preds: DataFrame, membership: DataFrame, row: str = "source_row", model: str = "model", fold: str = "fold") -> DataFrame:
    """Out-of-fold integrity per model: repeated, missing and leaked rows.

    ``membership`` holds the validation fold of every row; a prediction is leaked when it
    was made by a fold that trained on the row.
    """
    total = membership.agg(F.count(F.lit(1))).scalar()
    own = membership.select(row, F.col(fold).alias("__own"))
    per_row = preds.join(own, row, "left").groupBy(model, row).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col(fold).eqNullSafe(F.col("__own"))).alias("leaked"))
    return per_row.groupBy(model).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("n") > 1).alias("repeated"),
        F.sum("leaked").alias("leaked")).select(
        model, "rows", "repeated", "leaked", (total - F.col("rows")).alias("missing"))


def simplest_within(scores: DataFrame, tolerance: float = 0.01, rank: str = "simplicity") -> DataFrame:
    """Lowest RMSE wins, unless a simpler model is less than ``tolerance`` worse."""
    best = F.min("rmse").over(Window.partitionBy("family"))
    ok = scores.withColumn("__best", best).where((F.col("rmse") == F.col("__best")) | (F.col("rmse") < F.col("__best") * (1 + tolerance)))
    return ok.groupBy("family").agg(F.min(F.struct(rank, "rmse", "model")).alias("p")).select("family", "p.model", "p.rmse", f"p.{rank}")
