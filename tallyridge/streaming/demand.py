"""The batch rules on Structured Streaming.

Sinks write through ``foreachBatch`` into folders keyed by batch id, so a batch that is
replayed after a failure replaces its own output.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyridge.columns import TRIPS, TripColumns
from tallyridge.functions import clock
from tallyridge.operators import scoring, series
from tallyridge.operators.dedup import dedup_first
from tallyridge.operators.summaries import quality_counters


def work_folder(spark: SparkSession, local: str | None = None) -> str:
    """A fresh folder below the cluster's shared checkpoint folder; below ``local`` only in a session of one process."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or (local if spark.sparkContext.master.startswith("local[") else None)
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    return f"{shared.rstrip('/')}/stream-{uuid.uuid4().hex}"


def file_stream(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """Parquet below ``path`` (a folder, one file or a glob) as a stream of files."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def drain(stream: DataFrame, folder: str, write, mode: str = "append") -> None:
    """Process what is available now and stop."""
    query = (stream.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint")
             .foreachBatch(write).trigger(availableNow=True).start())
    query.awaitTermination()


def hourly_demand(trips: DataFrame, folder: str, cols: TripColumns = TRIPS) -> DataFrame:
    """Hourly counts; rows count whenever they arrive.

    Each batch writes its own counts, which add up when they are read. There is no watermark, so
    nothing is late, and a batch that is replayed replaces its part.
    """
    spark = trips.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        series.hourly_demand(batch, cols=cols).write.mode("overwrite").parquet(f"{folder}/rows/batch={batch_id}")

    drain(trips, folder, write)
    parts = spark.read.parquet(f"{folder}/rows")
    return parts.groupBy("area", "timestamp").agg(F.sum("rides").alias("rides"))


def dedup(trips: DataFrame, folder: str, cols: TripColumns = TRIPS, columns=None) -> DataFrame:
    """The earliest version per id over all batches, whatever the order of arrival; rows without id all stay.

    A batch keeps the earliest version of each of its ids; the earliest of those is picked on reading.
    """
    spark = trips.sparkSession
    columns = list(columns or trips.columns)

    def write(batch: DataFrame, batch_id: int) -> None:
        dedup_first(batch, cols, columns).write.mode("overwrite").parquet(f"{folder}/rows/batch={batch_id}")

    drain(trips, folder, write)
    return dedup_first(spark.read.parquet(f"{folder}/rows").drop("batch"), cols, columns)


def quality(trips: DataFrame, folder: str, by=("source_month",), cols: TripColumns = TRIPS) -> DataFrame:
    """Additive counters per batch, merged by summing."""
    counters = quality_counters(cols)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.groupBy(*by).agg(*[e.alias(k) for k, e in counters.items()]).write.mode("overwrite").parquet(f"{folder}/rows/batch={batch_id}")

    drain(trips, folder, write)
    per_batch = trips.sparkSession.read.parquet(f"{folder}/rows")
    return per_batch.groupBy(*by).agg(*[F.sum(k).alias(k) for k in counters])


def route_months(trips: DataFrame, folder: str, cols: TripColumns = TRIPS) -> tuple[DataFrame, DataFrame]:
    """Rows to the partition of their own month; rows outside their source month also to quarantine."""
    month = F.date_format(cols.started_at, "yyyy-MM")

    def write(batch: DataFrame, batch_id: int) -> None:
        routed = batch.withColumn("event_month", month)
        routed.write.mode("overwrite").partitionBy("event_month").parquet(f"{folder}/rows/batch={batch_id}")
        late = routed.where(F.col(cols.started_at).isNull() | ~F.col(cols.valid_demand))
        late.write.mode("overwrite").parquet(f"{folder}/late/batch={batch_id}")

    drain(trips, folder, write)
    spark = trips.sparkSession
    return spark.read.parquet(f"{folder}/rows"), spark.read.parquet(f"{folder}/late")


def day_ahead(hours: DataFrame, folder: str, start: str, score=scoring.seasonal_naive) -> DataFrame:
    """Score days as observations arrive, in any order.

    A day's features reach ``HISTORY_DAYS`` back, so a batch scores its own days again and every known day that its
    observations reach. Of a day's scores the one of the latest batch stands. Observations lie in one folder per day;
    a batch reads only the days that those features can reach.
    """
    spark = hours.sparkSession
    reach = series.HISTORY_DAYS

    def write(batch: DataFrame, batch_id: int) -> None:
        day = clock.trunc("day", F.col("timestamp")).cast("date")
        batch.withColumn("day", day).write.mode("overwrite").partitionBy("day").parquet(f"{folder}/seen/batch={batch_id}")
        span = batch.agg(F.min(day).alias("a"), F.max(day).alias("b")).first()
        if span.a is None:
            return
        near = F.col("day").between(F.date_sub(F.lit(span.a), reach), F.date_add(F.lit(span.b), reach))
        seen = spark.read.option("basePath", f"{folder}/seen").parquet(f"{folder}/seen").where((F.col("batch") <= batch_id) & near).drop("batch", "day")
        again = F.col("day").cast("date").between(F.lit(span.a), F.date_add(F.lit(span.b), reach))
        scored = scoring.rolling_origin(series.demand_frame(seen).where(again), start, score)
        scored.write.mode("overwrite").parquet(f"{folder}/rows/batch={batch_id}")

    drain(hours, folder, write)
    rows = spark.read.parquet(f"{folder}/rows")
    latest = rows.groupBy("area", "timestamp").agg(F.max("batch").alias("batch"))
    return rows.join(latest, ["area", "timestamp", "batch"], "left_semi").drop("batch")
