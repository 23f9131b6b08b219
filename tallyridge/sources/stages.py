"""Stage-aware scans, provenance, fingerprints and incremental work lists."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STAGES = ("development", "validation", "test")


@dataclass(frozen=True)
class StagePeriods:
    """First day of validation, first day of test and the end of test (exclusive)."""

    validation_start: str
    test_start: str
    test_end: str

    def bounds(self, stage: str) -> tuple[str | None, str]:
        if stage not in STAGES:
            raise ValueError(f"unknown stage {stage!r}")
        return {"development": (None, self.validation_start), "validation": (self.validation_start, self.test_start),
                "test": (self.test_start, self.test_end)}[stage]

    def label(self, day: Column) -> Column:
        def at(text):
            return F.lit(text).cast("timestamp_ntz")

        return (F.when(day < at(self.validation_start), "development").when(day < at(self.test_start), "validation")
                .when(day < at(self.test_end), "test"))


def stage_rows(df: DataFrame, area: str, stage: str, periods: StagePeriods, when: str = "started_at",
               selection_locked: bool = False) -> DataFrame:
    """Rows of one area and stage; the test stage stays closed until selection is locked."""
    if stage == "test" and not selection_locked:
        raise PermissionError("the test stage opens only after the selection is locked")
    first, stop = periods.bounds(stage)
    keep = (F.col("area") == area) & (F.col(when) < F.lit(stop).cast("timestamp_ntz"))
    if first:
        keep = keep & (F.col(when) >= F.lit(first).cast("timestamp_ntz"))
    return df.where(keep)


def stage_scan(spark: SparkSession, path: str, area: str, stage: str, periods: StagePeriods, when: str = "started_at",
               selection_locked: bool = False) -> DataFrame:
    """Rows of one area and stage from month partitions (area, year, month).

    Partitions whose month overlaps the stage are read, and rows outside its bounds are left out, so a bound inside a
    month keeps the stages apart. A scan without rows is an error.
    """
    first, stop = periods.bounds(stage)
    month = F.make_date(F.col("year"), F.col("month"), F.lit(1))
    overlap = month.cast("timestamp_ntz") < F.lit(stop).cast("timestamp_ntz")
    if first:
        overlap = overlap & (F.add_months(month, 1) > F.lit(first[:10]).cast("date"))
    rows = stage_rows(spark.read.parquet(path).where(overlap), area, stage, periods, when, selection_locked)
    if not rows.take(1):
        raise ValueError(f"no rows of {area} in the {stage} stage")
    return rows


def require_area(df: DataFrame, area: str) -> DataFrame:
    """Areas never mix: a foreign row is an error."""
    if df.where(~F.col("area").eqNullSafe(F.lit(area))).take(1):
        raise ValueError(f"rows of another area found next to {area}")
    return df


def with_file(df: DataFrame, name: str = "filename") -> DataFrame:
    return df.withColumn(name, F.col("_metadata.file_path"))


def partition_fingerprints(df: DataFrame, keys, columns) -> DataFrame:
    """Order-free content digest per partition: additive hashes plus the row count."""
    h = F.xxhash64(*columns)
    folded = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor(h).alias("__x"),
        F.sum(h.cast("decimal(38,0)")).alias("__s"))
    text = F.concat_ws("|", *keys, "rows", F.col("__x").cast("string"), F.col("__s").cast("string"))
    return folded.select(*keys, "rows", F.sha2(text, 256).alias("digest"))


def dataset_fingerprint(partitions: DataFrame, keys) -> str:
    """One digest over the partition digests (one short row per partition)."""
    one = partitions.agg(F.sha2(F.concat_ws("\n", F.sort_array(F.collect_list(F.concat_ws("|", *keys, "digest")))), 256).alias("d"))
    return one.first().d


def pending_work(work: DataFrame, receipts: DataFrame, keys=("area", "period", "signature")) -> DataFrame:
    """Work items without an intact receipt for the same inputs."""
    good = receipts.where("intact") if "intact" in receipts.columns else receipts
    return work.join(good.select(*keys), list(keys), "left_anti")


def checked_receipts(receipts: DataFrame, actual: DataFrame, keys=("area", "period")) -> DataFrame:
    """Receipts with ``intact``: does the stored output still have the recorded digest?"""
    now = actual.select(*keys, F.col("digest").alias("__now"))
    return receipts.join(now, list(keys), "left").withColumn(
        "intact", F.col("digest") == F.coalesce("__now", F.lit("none"))).drop("__now")
