"""Encoders, imputers and derived measures fitted on training rows only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyridge.functions.numeric import ratio
from tallyridge.operators.prefix import melt, value_profile
from tallyridge.operators.profile import modes


def one_hot(df: DataFrame, vocabulary: dict[str, list[str]]) -> DataFrame:
    """0/1 columns for declared values; a value outside the list raises."""
    blocks = {}
    for column, values in vocabulary.items():
        seen = F.col(column).isin(*values)
        for v in values:
            blocks[f"{column}_{v}".lower()] = F.when(seen, (F.col(column) == v).cast("int")).otherwise(
                F.raise_error(F.concat(F.lit(f"value outside the vocabulary of {column}: "), F.coalesce(F.col(column), F.lit("null")))).cast("int"))
    return df.withColumns(blocks)


def _by_column(table: DataFrame, column: str, field: str) -> Column:
    return table.where(F.col("column") == column).select(field).scalar()


def fitted_medians(train: DataFrame, columns) -> DataFrame:
    return value_profile(melt(train, [], columns, cast="double"), ["column"], "value", {"median": 0.5}).select("column", "median")


def impute_median(df: DataFrame, train: DataFrame, columns) -> DataFrame:
    table = fitted_medians(train, columns)
    return df.withColumns({c: F.coalesce(F.col(c), _by_column(table, c, "median")) for c in columns})


def impute_mode(df: DataFrame, train: DataFrame, columns, fallback: str = "missing") -> DataFrame:
    table = modes(train, columns)
    return df.withColumns({c: F.coalesce(F.col(c), _by_column(table, c, "mode"), F.lit(fallback)) for c in columns})


def impute_constant(df: DataFrame, columns, level: str = "missing") -> DataFrame:
    return df.fillna({c: level for c in columns})


def missing_indicators(df: DataFrame, columns) -> DataFrame:
    return df.withColumns({f"{c}_missing": F.col(c).isNull().cast("int") for c in columns})


def geometry(df: DataFrame, cap: str, height: str, width: str) -> DataFrame:
    """Cap over stem height, and slenderness (height in cm against width in mm)."""
    h, w = F.when(F.col(height) > 0, F.col(height)), F.when(F.col(width) > 0, F.col(width))
    return df.withColumns({"cap_to_stem_height": ratio(F.col(cap), h), "stem_slenderness": ratio(F.col(height) * 10, w)})


def standard_scale(df: DataFrame, train: DataFrame, columns) -> DataFrame:
    """z-scores with the training mean and population deviation; a constant column becomes 0."""
    facts = train.agg(*[F.avg(c).alias(f"{c}_m") for c in columns], *[F.stddev_pop(c).alias(f"{c}_s") for c in columns])

    def z(c):
        sd = facts.select(f"{c}_s").scalar()
        return (F.col(c) - facts.select(f"{c}_m").scalar()) / F.when(sd == 0, F.lit(1.0)).otherwise(sd)

    return df.withColumns({f"{c}_z": z(c) for c in columns})


def polynomial2(df: DataFrame, columns) -> DataFrame:
    return df.withColumns({f"{a}_x_{b}": F.col(a) * F.col(b) for i, a in enumerate(columns) for b in columns[i:]})


def column_subset(df: DataFrame, drop) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in set(drop)])


def training_levels(df: DataFrame, train: DataFrame, columns) -> DataFrame:
    """Keep only category values the training rows know; others become null."""
    out = df
    for c in columns:
        known = train.where(F.col(c).isNotNull()).select(F.col(c).alias("__level")).distinct()
        out = out.join(known, out[c] == known["__level"], "left").withColumn(c, F.col("__level")).drop("__level")
    return out.select(*df.columns)
