"""Profiles of categorical study tables: counts, shares, crosstabs, moments.

Per-column facts come from one melted pass; categories are counted before anything is
shuffled, so repeated values cost nothing.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyridge.functions.numeric import add, ratio
from tallyridge.operators.prefix import melt, value_profile


def rows_n(name: str = "n") -> Column:
    return F.count(F.lit(1)).alias(name)


def missing_by_column(df: DataFrame, columns) -> DataFrame:
    one = df.agg(rows_n("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return one.unpivot(["__n"], list(columns), "column", "missing").select(
        "column", "missing", (F.col("missing") * 100.0 / F.col("__n")).alias("percent"))


def value_shares(df: DataFrame, by: str) -> DataFrame:
    counts = df.groupBy(by).agg(rows_n())
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("percent", F.col("n") * 100.0 / total)


def before_after(before: DataFrame, after: DataFrame, by: str) -> DataFrame:
    """Counts and shares per class on both sides of a step, and the loss."""
    a = value_shares(before, by).select(by, F.col("n").alias("n_before"), F.col("percent").alias("percent_before"))
    b = value_shares(after, by).select(by, F.col("n").alias("n_after"), F.col("percent").alias("percent_after"))
    full = a.join(b, by, "full").fillna(0, ["n_before", "n_after"]).fillna(0.0, ["percent_before", "percent_after"])
    return full.withColumn("loss_percent", ratio((F.col("n_before") - F.col("n_after")) * 100, F.col("n_before")))


def value_counts(df: DataFrame, columns, keep=()) -> DataFrame:
    """(column, value, n) for text columns, null kept as a value."""
    return melt(df, list(keep), columns, cast="string").groupBy(*keep, "column", "value").agg(rows_n())


def distinct_per_column(df: DataFrame, columns) -> DataFrame:
    return value_counts(df, columns).groupBy("column").agg(F.count("value").alias("distinct"))


def approximate_distinct(df: DataFrame, columns, rsd: float = 0.02) -> DataFrame:
    one = df.agg(*[F.approx_count_distinct(c, rsd).alias(c) for c in columns])
    return melt(one, [], columns, value="distinct")


def constant_columns(df: DataFrame, columns) -> DataFrame:
    return distinct_per_column(df, columns).where(F.col("distinct") <= 1)


def describe(df: DataFrame, columns) -> DataFrame:
    out = value_profile(melt(df, [], columns, cast="double"), ["column"], "value", {"q25": 0.25, "median": 0.5, "q75": 0.75})
    return out.select("column", F.col("valid").alias("n"), "mean", "sd", "minimum", "q25", "median", "q75", "maximum",
                      (F.col("mean") - F.col("median")).alias("mean_minus_median"))


def group_moments(df: DataFrame, by: str, columns) -> DataFrame:
    out = value_profile(melt(df, [by], columns, cast="double"), [by, "column"], "value", {"median": 0.5})
    return out.select(by, "column", "mean", "median", "sd")


def crosstab(df: DataFrame, row: str, col: str, levels, missing: str = "missing") -> DataFrame:
    """Counts per (row level, column level) and row percentages; null is a level."""
    level = F.coalesce(F.col(row), F.lit(missing)).alias("level")
    counts = df.groupBy(level).agg(rows_n("total"), *[F.count_if(F.col(col) == v).alias(f"n_{v}") for v in levels])
    return counts.select("*", *[(F.col(f"n_{v}") * 100.0 / F.col("total")).alias(f"percent_{v}") for v in levels])


def sparse_columns(df: DataFrame, columns, label: str, positive: str, limit: float = 80.0) -> DataFrame:
    """Columns with more than ``limit`` percent null: what is known, and the class share of known and unknown."""
    facts = value_counts(df.withColumn("__p", (F.col(label) == positive).cast("int")), columns, ["__p"])
    known, n, p = F.col("value").isNotNull(), F.col("n"), F.col("__p")
    zero = F.lit(0)
    per_value = facts.groupBy("column", "value").agg(F.sum("n").alias("n"), F.sum(n * p).alias("pos"))
    out = per_value.groupBy("column").agg(
        F.sum("n").alias("rows"), F.sum(F.when(known, n).otherwise(zero)).alias("known"), F.count("value").alias("distinct"),
        F.sum(F.when(known, F.col("pos")).otherwise(zero)).alias("kp"), F.sum(F.when(~known, F.col("pos")).otherwise(zero)).alias("up"))
    unknown = F.col("rows") - F.col("known")
    return out.where(unknown * 100.0 / F.col("rows") > limit).select(
        "column", "known", "distinct", ratio(F.col("kp") * 100, F.col("known")).alias("percent_known"),
        ratio(F.col("up") * 100, unknown).alias("percent_unknown"))


def label_conflicts(df: DataFrame, inputs, label: str) -> DataFrame:
    """Input combinations (nulls equal) that carry more than one label."""
    groups = df.groupBy(*inputs).agg((F.min(label) != F.max(label)).alias("__clash"), rows_n("__n"))
    clash = F.coalesce(F.col("__clash"), F.lit(False))
    return groups.agg(F.count_if(clash).alias("conflicting_inputs"),
                      F.coalesce(F.sum(F.when(clash, F.col("__n"))), F.lit(0)).alias("rows"))


def duplicate_profile(df: DataFrame, content, label: str) -> DataFrame:
    return df.groupBy(*content).agg(rows_n("__n")).groupBy(label).agg(F.sum(F.col("__n") - 1).alias("repeated_rows"))


def combination_counts(df: DataFrame, columns) -> DataFrame:
    return df.groupBy(*columns).agg(rows_n())


def modes(df: DataFrame, columns) -> DataFrame:
    """Most frequent known value per column; ties go to the smallest value."""
    known = value_counts(df, columns).where(F.col("value").isNotNull())
    best = F.min(F.struct((-F.col("n")).alias("k"), F.col("value"))).alias("b")
    return known.groupBy("column").agg(best).select("column", F.col("b.value").alias("mode"), (-F.col("b.k")).alias("n"))


def correlations(df: DataFrame, columns) -> DataFrame:
    """Pearson r per pair of measures from a single pass (rows with a null in the pair are skipped)."""
    pairs = list(combinations_with_replacement(columns, 2))
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}~{b}") for a, b in pairs])
    long = melt(one, [], one.columns, "pair", "r")
    parts = F.split("pair", "~")
    upper = long.select(parts[0].alias("a"), parts[1].alias("b"), "r")
    return upper.unionByName(upper.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"), "r"))


def missing_count(columns) -> Column:
    """Number of empty fields in a row."""
    return add([F.col(c).isNull().cast("int") for c in columns])

