"""Mergeable sketches: stored once per part of a table, merged when they are read.

A part is whatever arrives or is rebuilt together (a month, a source file). Its sketches are a few kilobytes per group,
so distinct counts and quantiles over any choice of parts are read from them without the rows. A changed part replaces
its own sketches only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyridge.operators.prefix import melt

LOG_REGISTERS = 12  # standard error of a distinct count about 1.04 / sqrt(2^12): 1.6 %
QUANTILE_SIZE = 400  # error of a rank below 1 % with 99 % confidence


def distinct_parts(df: DataFrame, part: str, columns, log_registers: int = LOG_REGISTERS) -> DataFrame:
    """(part, column, sketch) of the values of each column, compared as text; nulls are not values."""
    long = melt(df, [part], columns, cast="string").where("value IS NOT NULL")
    return long.groupBy(part, "column").agg(F.hll_sketch_agg("value", log_registers).alias("sketch"))


def merged_distinct(parts: DataFrame, by=("column",)) -> DataFrame:
    """Estimated distinct values per group, over all parts given."""
    return parts.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct"))


def quantile_parts(df: DataFrame, part: str, value: Column, by=(), size: int = QUANTILE_SIZE) -> DataFrame:
    """(part, *by, rows, valid, sketch) of one measure; nulls count as rows only. Parts without a value have no sketch."""
    valid = F.count(value)
    return df.groupBy(part, *by).agg(F.count(F.lit(1)).alias("rows"), valid.alias("valid"),
                                     F.when(valid > 0, F.kll_sketch_agg_double(value.cast("double"), size)).alias("sketch"))


def merged_quantiles(parts: DataFrame, by, ranks: dict[str, float]) -> DataFrame:
    """Rows, valid rows and one estimated quantile per name, over all parts given; null for groups without a value."""
    merged = parts.groupBy(*by).agg(F.sum("rows").alias("rows"), F.sum("valid").alias("valid"), F.kll_merge_agg_double("sketch").alias("sketch"))
    known = F.col("valid") > 0
    return merged.select(*by, "rows", "valid", *[F.when(known, F.kll_sketch_get_quantile_double("sketch", F.lit(float(q)))).alias(name) for name, q in ranks.items()])
