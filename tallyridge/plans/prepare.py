"""Archive preparation as one run: inventory, scan, clean, dedup, month alignment, write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyridge.columns import CANONICAL_TRIP_COLUMNS, TRIPS
from tallyridge.operators import dedup as D
from tallyridge.operators.clean import clean_trips
from tallyridge.operators.summaries import quality
from tallyridge.sources import archives, sinks, stages


OUTPUT = ("area", "year", "month")


def output_digests(trips: DataFrame) -> DataFrame:
    """(area, period, digest) of the stored trips."""
    content = [*D.CONTENT, "source_month", TRIPS.valid_demand, TRIPS.valid_duration]
    return stages.partition_fingerprints(trips, ["area", "target_month"], content).select("area", F.col("target_month").alias("period"), "digest")


def prepare(spark: SparkSession, source: str, target: str, patterns, alias_areas=()) -> DataFrame:
    """Archives below ``source`` to month-aligned parquet below ``target``; returns the receipts.

    ``patterns`` are (pattern, area) pairs for archive names; other names stop the run. In ``alias_areas``, copies of an
    id that differ only below the second are one ride; elsewhere they are a conflict and stop the run.

    The inventory is written first, so archives are listed and hashed once. Work items with an intact receipt (same
    inputs, and the stored output has the recorded digest) are not scanned again. Cleaned rows go to ``target/staged``,
    and everything after reads that table. The trips of all areas are written anew as one table, so no partition keeps
    rows that have moved away; what was removed and moved is written to ``target/audit``.
    """
    archives.require_sound(archives.inventory(spark, source, patterns)).write.mode("overwrite").parquet(f"{target}/inventory")
    rows = spark.read.parquet(f"{target}/inventory")
    items = archives.work_items(rows)
    receipts_path, trips_path, staged = f"{target}/receipts", f"{target}/trips", f"{target}/staged"
    todo = items
    if sinks.path_exists(spark, receipts_path) and sinks.path_exists(spark, trips_path):
        known = stages.checked_receipts(spark.read.parquet(receipts_path), output_digests(spark.read.parquet(trips_path)))
        todo = stages.pending_work(items, known)
        if not todo.take(1) and not known.join(items, ["area", "period"], "left_anti").take(1):
            return spark.read.parquet(receipts_path)
    raw = archives.scan(rows.join(todo.select("area", "period"), ["area", "period"], "left_semi"))
    version = F.concat_ws("::", "path", "nested", "representation")
    typed = clean_trips(raw.withColumn("version", version), F.col("period"), F.col("area"))
    marked = typed.withColumn("month_key", F.col("source_month")).join(
        todo.select("area", F.col("period").alias("source_month"), "signature"), ["area", "source_month"])
    sinks.write_partitioned(marked, staged, ("area", "month_key"))
    # Staged rows of inputs that have changed or gone are not read.
    current = items.select("area", F.col("period").alias("source_month"), "signature")
    table = (spark.read.parquet(staged).join(current, ["area", "source_month", "signature"], "left_semi").drop("signature")
             .withColumn("filename", F.concat_ws("/", "area", "source_month")))

    content = [*CANONICAL_TRIP_COLUMNS, TRIPS.duration]
    if archives.representation_faults(table, "version", content, ("area", "source_month")).take(1):
        raise ValueError("source representations are not equivalent")
    one = archives.keep_one_version(table, "version", ("area", "source_month"))
    month_content = [*D.CONTENT, "source_month"]
    clash = one.where(F.col("ride_id").isNotNull()).select(*month_content).distinct().groupBy(
        "area", "source_month", "ride_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if clash.take(1):
        raise ValueError("conflicting ids inside one source month")
    kept, removed = [], []
    for area in sorted(r.area for r in items.select("area").distinct().collect()):  # one entry per declared area
        part, loose = one.where(F.col("area") == area), area in alias_areas
        if D.proof_conflicts(part, alias_precision=loose).take(1):
            raise ValueError(f"conflicting ids across source months of {area}")
        kept.append(D.align_months(part, alias_precision=loose))
        removed.append(D.removed_rows(part, alias_precision=loose))
    aligned = D.union_all(*kept).withColumns({
        "year": F.split_part("target_month", F.lit("-"), F.lit(1)).cast("int"),
        "month": F.split_part("target_month", F.lit("-"), F.lit(2)).cast("int")})
    sinks.write_partitioned(aligned.drop("month_key", "version"), trips_path, OUTPUT, whole=True)
    trips = spark.read.parquet(trips_path)
    D.union_all(*removed).select(*one.columns).write.mode("overwrite").parquet(f"{target}/audit/removed")
    moved = trips.where("source_month <> target_month").groupBy("area", "source_month", "target_month").agg(F.count(F.lit(1)).alias("rows"))
    moved.write.mode("overwrite").parquet(f"{target}/audit/moved")
    counts = quality(trips, ["area", "target_month"]).withColumnRenamed("target_month", "period")
    done = items.join(counts, ["area", "period"], "left").join(output_digests(trips), ["area", "period"], "left")
    done.withColumn("digest", F.coalesce("digest", F.lit("none"))).write.mode("overwrite").parquet(receipts_path)
    return spark.read.parquet(receipts_path)
