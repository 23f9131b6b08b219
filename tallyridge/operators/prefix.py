"""Ranks, running totals and exact quantiles without one big sort per group.

A window over a whole group puts the group into one task. These helpers cut the
order into buckets first: totals per bucket are summed with map-side combine, a
window over the (few) buckets yields each bucket's offset, and only then a window
runs inside each bucket. The result equals the plain window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyridge.functions.numeric import order_bin


def null_safe_join(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Equi-join where null keys match each other; key columns appear once."""
    if not keys:
        raise ValueError("null_safe_join needs at least one key")
    renamed = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                           *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        piece = left[k].eqNullSafe(renamed[f"__r_{k}"])
        cond = piece if cond is None else cond & piece
    return left.join(renamed, cond, how).drop(*[f"__r_{k}" for k in keys])


def _with_offsets(binned: DataFrame, offsets: DataFrame, keys) -> DataFrame:
    """Each row with the offsets of its bucket. Rows are shuffled: read from small compressed files, a table can pass for
    one to broadcast, and then all of it would go through the driver."""
    return null_safe_join(binned.hint("merge"), offsets, keys)


def running_totals(df: DataFrame, by, order, amounts, bucket: Column, descending: bool = False) -> DataFrame:
    """Add ``<name>_cum`` (inclusive running sum) and ``<name>_all`` (group sum).

    ``bucket`` must be monotone in ``order``; ``order`` is one or more column names.
    """
    by = list(by)
    order = [order] if isinstance(order, str) else list(order)
    direction = F.desc if descending else F.asc
    binned = df.withColumn("__bin", bucket)
    per_bin = binned.groupBy(*by, "__bin").agg(*[F.sum(a).alias(a) for a in amounts])
    before = Window.partitionBy(*by).orderBy(direction("__bin")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    offsets = per_bin.select(
        *by, "__bin",
        *[F.coalesce(F.sum(a).over(before), F.lit(0)).alias(f"__off_{a}") for a in amounts],
        *[F.sum(a).over(whole).alias(f"{a}_all") for a in amounts],
    )
    inside = (Window.partitionBy(*by, "__bin").orderBy(*[direction(o) for o in order])
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    joined = _with_offsets(binned, offsets, [*by, "__bin"])
    for a in amounts:
        joined = joined.withColumn(f"{a}_cum", F.col(f"__off_{a}") + F.sum(a).over(inside))
    return joined.drop("__bin", *[f"__off_{a}" for a in amounts])


def exact_rank(df: DataFrame, by, order, bucket: Column, name: str = "rank") -> DataFrame:
    """``row_number`` over (by, order) computed bucket-wise; also adds ``<name>_of``.

    ``order`` is a list of column names; ``bucket`` is monotone in it.
    """
    by = list(by)
    binned = df.withColumn("__bin", bucket)
    per_bin = binned.groupBy(*by, "__bin").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*by).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bin.select(
        *by, "__bin",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"),
        F.sum("__n").over(Window.partitionBy(*by)).alias(f"{name}_of"),
    )
    inside = Window.partitionBy(*by, "__bin").orderBy(*order)
    return (
        _with_offsets(binned, offsets, [*by, "__bin"])
        .withColumn(name, F.row_number().over(inside) + F.col("__off"))
        .drop("__bin", "__off")
    )


def value_profile(df: DataFrame, by, value, quantiles: dict[str, float] | None = None,
                  rows: str = "rows", extra=()) -> DataFrame:
    """Counts, moments, bounds and exact quantiles of one measure per group.

    Works on the (group, value) counts, so repeated values are combined before the
    shuffle and no group is ever held by one task. Columns: ``rows`` (all rows),
    ``valid`` (non-null), ``mean``, ``sd``, ``minimum``, ``maximum`` and one per
    quantile (linear interpolation).
    """
    by = list(by)
    value = F.col(value) if isinstance(value, str) else value
    counts = df.groupBy(*by, value.cast("double").alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    counts = counts.select(
        *by, "__v", "__n",
        F.when(F.col("__v").isNotNull(), F.col("__n")).otherwise(F.lit(0).cast("bigint")).alias("__k"),
        (F.col("__v") * F.col("__n")).alias("__s"),
    )
    run = running_totals(counts, by, "__v", ["__k", "__s"], order_bin(F.col("__v")))
    v, n, k, upto, total = (F.col(c) for c in ("__v", "__n", "__k", "__k_cum", "__k_all"))
    mean = F.try_divide(F.col("__s_all"), total)
    aggs = [
        F.sum(n).alias(rows),
        F.max(total).alias("valid"),
        F.max(mean).alias("mean"),
        F.sqrt(F.try_divide(F.sum(k * (v - mean) * (v - mean)), F.max(total) - 1)).alias("sd"),
        F.min(v).alias("minimum"), F.max(v).alias("maximum"),
    ]
    for name, p in (quantiles or {}).items():
        spot = (total - 1) * F.lit(float(p))
        low, high = F.floor(spot), F.ceil(spot)
        at_low = F.max(F.when((k > 0) & (upto - k <= low) & (low < upto), v))
        at_high = F.max(F.when((k > 0) & (upto - k <= high) & (high < upto), v))
        aggs.append((at_low + (at_high - at_low) * F.max(spot - low)).alias(name))
    return run.groupBy(*by).agg(*aggs)


def melt(df: DataFrame, keep, columns, name: str = "column", value: str = "value", cast: str | None = None) -> DataFrame:
    """Wide to long, one row per (row, column), without a shuffle."""
    cols = [F.col(c).cast(cast).alias(c) if cast else F.col(c) for c in columns]
    return df.select(*keep, *cols).unpivot(list(keep), list(columns), name, value)
