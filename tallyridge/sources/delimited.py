"""Delimited text sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accepted shape of an hour label (local, no zone).
HOUR_LABEL = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:00(:00(\.0+)?)?$"
HISTORY_COLUMNS = ("timestamp", "rides", "area")


def read_semicolon(spark: SparkSession, path: str, schema: T.StructType, missing: str = "?") -> DataFrame:
    return spark.read.csv(path, sep=";", header=True, schema=schema, nullValue=missing, enforceSchema=False)


def hour_label(name: str) -> Column:
    """The hour a label names; null if there is no such hour."""
    return F.regexp_replace(name, "T", " ").try_cast("timestamp_ntz")


def history_reject_reason(area: str) -> Column:
    """First broken rule of an uploaded history row, null when the row is fine."""
    count = F.trim("rides").try_cast("double")
    bad = count.isNull() | F.isnan(count) | (F.abs(count) == float("inf")) | (count < 0)
    return (
        F.when(~F.col("area").eqNullSafe(F.lit(area)), "foreign area")
        .when(~F.coalesce(F.col("timestamp").rlike(HOUR_LABEL), F.lit(False)) | hour_label("timestamp").isNull(), "not a local hour label")
        .when(bad, "invalid count")
    )


def read_history(spark: SparkSession, path: str, area: str) -> tuple[DataFrame, DataFrame]:
    """Uploaded hourly counts: accepted rows (typed) and rejected rows with the reason.

    The header must name each required column exactly once, in any order; other columns
    are ignored. Rows with a different number of fields are rejected.
    """
    first = spark.read.text(path).limit(1).first()
    header = [h.strip().strip('"') for h in (first.value if first else "").lstrip("﻿").split(",")]
    if any(header.count(c) != 1 for c in HISTORY_COLUMNS):
        raise ValueError("history needs exactly one timestamp, rides and area column")
    names = [h if h in HISTORY_COLUMNS else f"_extra{i}" for i, h in enumerate(header)]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "_corrupt"]])
    rows = spark.read.csv(path, schema=schema, header=True, columnNameOfCorruptRecord="_corrupt", mode="PERMISSIVE",
                          ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True, enforceSchema=True, quote='"', escape='"')
    reason = F.when(F.col("_corrupt").isNotNull(), "wrong number of fields").otherwise(history_reject_reason(area))
    marked = rows.withColumn("reject_reason", reason)
    good = marked.where(F.col("reject_reason").isNull()).select(
        hour_label("timestamp").alias("timestamp"),
        F.col("rides").cast("double").alias("rides"), "area")
    return good, marked.where(F.col("reject_reason").isNotNull()).select(*HISTORY_COLUMNS, "reject_reason")
