"""Registered replays: the streaming operators over the event table, read as a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyridge.plans.catalog import query
from tallyridge.operators.dedup import CONTENT
from tallyridge.plans.demand import ORIGIN, RESIDUAL_SQL
from tallyridge.plans.sources import LOCAL_WORK
from tallyridge.plans.trips import COUNTERS_SQL, DEDUP_SQL
from tallyridge.plans.views import Views
from tallyridge.streaming import demand as L


FILES = 6


class Replay(Views):
    """The same views with ``events`` read as a stream: rewritten as several files in an order that is not that of time,
    one file per batch."""

    def __init__(self, spark, sf_dir, folder):
        super().__init__(spark, sf_dir)
        self.folder = folder

    def table(self, name):
        if name != "events":
            return super().table(name)
        path = f"{self.folder}/events"
        super().table(name).repartition(FILES, F.xxhash64("event_id")).write.mode("ignore").parquet(path)
        return L.file_stream(self.spark, path, 1)


def replay(v):
    folder = L.work_folder(v.spark, LOCAL_WORK)
    return Replay(v.spark, v.sf_dir, folder), folder


@query("stream_hourly_demand", "SELECT area, timestamp, rides FROM hours")
def _(v):
    live, folder = replay(v)
    return L.hourly_demand(live.trips, folder)


@query("stream_dedup_rides", DEDUP_SQL)
def _(v):
    live, folder = replay(v)
    return L.dedup(live.trips_dup, folder, columns=CONTENT)


@query("stream_quality_counters", f"SELECT source_month, {COUNTERS_SQL} FROM trips GROUP BY 1")
def _(v):
    live, folder = replay(v)
    return L.quality(live.trips, folder)


@query("stream_month_routing", """
SELECT strftime(started_at, '%Y-%m') AS event_month, count(*) AS rows, count_if(started_at IS NULL OR NOT valid_demand)::BIGINT AS late_rows FROM trips_dup GROUP BY 1""")
def _(v):
    live, folder = replay(v)
    rows, late = L.route_months(live.trips_dup, folder)
    n = rows.groupBy(F.col("event_month").cast("string").alias("event_month")).agg(F.count(F.lit(1)).alias("rows"))
    m = late.groupBy(F.col("event_month").cast("string").alias("event_month")).agg(F.count(F.lit(1)).alias("late_rows"))
    return n.join(m, "event_month", "left").fillna(0, ["late_rows"])


@query("stream_day_ahead", f"WITH {RESIDUAL_SQL} SELECT area, timestamp, rides, predicted_rides, residual FROM residuals")
def _(v):
    folder = L.work_folder(v.spark, LOCAL_WORK)
    day = F.date_format("timestamp", "yyyy-MM-dd")
    v.hourly.repartition(FILES, F.xxhash64(day)).write.mode("overwrite").parquet(f"{folder}/hourly")
    return L.day_ahead(L.file_stream(v.spark, f"{folder}/hourly", 1), f"{folder}/run", ORIGIN).select("area", "timestamp", "rides", "predicted_rides", "residual")
