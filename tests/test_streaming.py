from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyridge.operators import clean as C
from tallyridge.operators import dedup as D
from tallyridge.operators import scoring as G
from tallyridge.operators import series as S
from tallyridge.operators import summaries as A
from tallyridge.session import checkpoint_dir
from tallyridge.streaming import demand as L

T0 = datetime(2024, 1, 31, 20)
SCHEMA = ("ride_id string, started_at timestamp_ntz, ended_at timestamp_ntz, start_lat double, start_lng double, end_lat double, end_lng double, "
          "start_station_id string, end_station_id string, member_casual string, rideable_type string, reported_duration_seconds double, source_month string")


def trips(spark, folder):
    """Three files, read one per micro-batch; the last one brings late and repeated rows."""
    def row(i, ride, minutes):
        t = T0 + timedelta(minutes=minutes)
        return (ride, t, t + timedelta(minutes=9), 40.7, -74.0, 40.7, -74.0, "1", None, "member", "classic_bike", None, "2024-01")

    files = [[row(i, f"r{i}", 10 * i) for i in range(12)], [row(i, f"r{i}", 10 * i) for i in range(12, 40)],
             [row(3, "r3", 30), row(7, None, 235), row(8, None, 235), row(9, "late", 200)]]
    for n, rows in enumerate(files):
        base = spark.createDataFrame(rows, SCHEMA).withColumns({"area": F.lit("NYC"), "missing_started_at": F.lit(False), "missing_ended_at": F.lit(False)})
        C.with_trip_flags(base, F.col("source_month")).coalesce(1).write.mode("append" if n else "overwrite").parquet(folder)
    return spark.read.parquet(folder)


@pytest.fixture
def batch(spark, tmp_path):
    folder = str(tmp_path / "in")
    return trips(spark, folder), lambda: L.file_stream(spark, folder, 1), lambda name: str(tmp_path / name)


def same(a, b):
    return a.exceptAll(b.select(*a.columns)).count() == 0 and b.exceptAll(a.select(*b.columns)).count() == 0


def test_hourly_counts_equal_batch(batch):
    rows, stream, at = batch
    assert same(L.hourly_demand(stream(), at("h")), S.hourly_demand(rows))


def test_dedup_equals_batch_although_the_earliest_version_comes_last(spark, tmp_path):
    folder = str(tmp_path / "in")
    rows = trips(spark, folder)
    early = rows.where("ride_id = 'r20'").withColumn("started_at", F.expr("started_at - INTERVAL 40 DAYS"))
    early.coalesce(1).write.mode("append").parquet(folder)
    out = L.dedup(L.file_stream(spark, folder, 1), str(tmp_path / "d"))
    whole = spark.read.parquet(folder)
    assert same(out, D.dedup_first(whole)) and out.where("ride_id IS NULL").count() == 2
    assert out.where("ride_id = 'r20'").first().started_at < T0 - timedelta(days=30)


def test_hours_count_however_late_their_file_comes(spark, tmp_path):
    folder = str(tmp_path / "in")
    for n, hour in enumerate((10, 20, 3)):
        part = spark.createDataFrame([("NYC", datetime(2024, 1, 1, hour, 5), True)], "area string, started_at timestamp_ntz, valid_demand boolean")
        part.coalesce(1).write.mode("append" if n else "overwrite").parquet(folder)
    out = L.hourly_demand(L.file_stream(spark, folder, 1), str(tmp_path / "h"))
    assert sorted((r.timestamp.hour, r.rides) for r in out.collect()) == [(3, 1), (10, 1), (20, 1)]


def test_counters_add_up(batch):
    rows, stream, at = batch
    assert same(L.quality(stream(), at("q")), A.quality(rows, ["source_month"]))


def test_rows_go_to_their_own_month(batch):
    rows, stream, at = batch
    routed, late = L.route_months(stream(), at("m"))
    want = {r.m: r["count"] for r in rows.groupBy(F.date_format("started_at", "yyyy-MM").alias("m")).count().collect()}
    assert {str(r.event_month): r["count"] for r in routed.groupBy("event_month").count().collect()} == want
    assert late.count() == rows.where("NOT valid_demand").count() > 0


def test_day_ahead_equals_the_batch_pass(spark, tmp_path):
    hours = [(datetime(2024, 1, 1) + timedelta(hours=i), i % 53, "NYC") for i in range(18 * 24)]
    series = spark.createDataFrame(hours, "timestamp timestamp_ntz, rides long, area string")
    folder = str(tmp_path / "days")
    for n, (a, b) in enumerate([(1, 15), (16, 19), (15, 16)]):  # the middle day comes last
        part = series.where(f"day(timestamp) >= {a} AND day(timestamp) < {b}").coalesce(1)
        part.write.mode("append" if n else "overwrite").parquet(folder)
    out = L.day_ahead(L.file_stream(spark, folder, 1), str(tmp_path / "run"), "2024-01-15")
    want = G.rolling_origin(S.demand_frame(series), "2024-01-15")
    got = out.select("timestamp", "predicted_rides").toPandas().set_index("timestamp").predicted_rides
    expect = want.select("timestamp", "predicted_rides").toPandas().set_index("timestamp").predicted_rides
    assert got.sort_index().equals(expect.sort_index()) and len(got) == 4 * 24


def test_checkpoint_folder_prefers_the_cluster_setting(spark, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert checkpoint_dir(spark, str(tmp_path)) == (shared or str(tmp_path))
    assert L.work_folder(spark, str(tmp_path))
    if not shared:
        with pytest.raises(ValueError):
            L.work_folder(spark)
