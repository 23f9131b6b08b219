"""Sinks: partitioned parquet, reports and guarded overwrites."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyridge.operators.dedup import signed_counts


def write_partitioned(df: DataFrame, path: str, by=("area", "year", "month"), mode: str = "overwrite", whole: bool = False) -> None:
    """ZSTD parquet, one folder per partition; overwriting replaces only the partitions written, or the ``whole`` table.

    Rows are brought together by partition; the rebalance lets adaptive execution split a partition that holds most of
    the data over many tasks and merge small ones.
    """
    (df.hint("rebalance", *by).write.mode(mode).partitionBy(*by).option("compression", "zstd")
     .option("partitionOverwriteMode", "static" if whole else "dynamic").parquet(path))


def write_report(df: DataFrame, path: str, kind: str = "csv") -> None:
    """Small report tables as CSV with header or as JSON lines."""
    writer = df.write.mode("overwrite")
    if kind == "csv":
        writer.option("header", True).csv(path)
    elif kind == "json":
        writer.json(path)
    else:
        raise ValueError(f"unknown report kind {kind!r}")


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def write_guarded(df: DataFrame, path: str) -> bool:
    """Write once; later calls only pass when the stored rows are the same. True if written."""
    spark = df.sparkSession
    if not path_exists(spark, path):
        df.write.option("compression", "zstd").parquet(path)
        return True
    stored = spark.read.parquet(path)
    if stored.dtypes != df.dtypes or signed_counts(stored, df, df.columns).where("surplus <> 0").take(1):
        raise ValueError(f"stored data at {path} differs from the new rows")
    return False
