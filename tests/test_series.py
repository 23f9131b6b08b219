from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyridge.functions import clock
from tallyridge.operators import joins as J
from tallyridge.operators import scoring as G
from tallyridge.operators import series as S
from tallyridge.operators import splits as P
from tallyridge.operators import summaries as A


def history(spark, days=20, start=datetime(2024, 1, 1), areas=("NYC",), value=lambda i: float(i % 97)):
    rows = [(start + timedelta(hours=i), value(i), a) for a in areas for i in range(days * 24)]
    return spark.createDataFrame(rows, "timestamp timestamp_ntz, rides double, area string")


def starts(spark, *times):
    return spark.createDataFrame([(datetime.fromisoformat(t), True, "NYC") for t in times], "started_at timestamp_ntz, valid_demand boolean, area string")


def test_zero_fill_stays_inside_present_months(spark):
    hours = S.hourly_demand(starts(spark, "2024-01-05 10:10:00", "2024-01-05 10:50:00", "2024-03-01 00:00:00"))
    full = S.calendar_fill(hours)
    assert full.count() == (31 + 31) * 24
    assert full.where("timestamp = timestamp_ntz'2024-01-05 10:00:00'").first().rides == 2
    with pytest.raises(ValueError, match="2024-02"):
        S.require_gapless(hours)


def test_every_day_has_24_labels_over_clock_changes(spark):
    full = S.calendar_fill(S.hourly_demand(starts(spark, "2024-03-10 12:00:00", "2024-11-03 12:00:00")))
    assert full.groupBy(F.to_date("timestamp").alias("d")).count().where("count <> 24").count() == 0
    marks = {str(r[0]): r[1] for r in full.select(F.date_format("timestamp", "MM-dd HH"), clock.clock_hours(F.col("timestamp"))).collect() if r[1] != 1}
    assert marks == {"03-10 02": 0, "11-03 01": 2}


def test_features_of_a_day_do_not_see_it(spark):
    series = history(spark)
    cut = "timestamp >= timestamp_ntz'2024-01-17'"
    changed = series.withColumn("rides", F.when(F.expr(cut), F.col("rides") * 3 + 1).otherwise(F.col("rides")))
    cols = ["timestamp", *S.FEATURES]
    a, b = (S.demand_frame(s).where("day <= timestamp_ntz'2024-01-17'").select(*cols) for s in (series, changed))
    assert a.count() == 72 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_features_equal_pandas(spark):
    series = history(spark)
    got = S.demand_frame(series).toPandas().set_index("timestamp").sort_index()
    x = series.toPandas().set_index("timestamp").rides.sort_index()
    day = x.groupby(x.index.normalize()).sum()
    for t in got.index[::37]:
        assert got.loc[t, "lag_14d"] == x[t - pd.Timedelta(days=14)]
        assert got.loc[t, "same_hour_mean_7d"] == pytest.approx(x[[t - pd.Timedelta(days=k) for k in range(1, 8)]].mean())
        assert got.loc[t, "previous_day_total"] == day[t.normalize() - pd.Timedelta(days=1)]


def test_rolling_mean_needs_every_value(spark):
    series = history(spark, 9).withColumn("rides", F.when(F.expr("timestamp <> timestamp_ntz'2024-01-03 05:00:00'"), F.col("rides")))
    out = S.same_hour_mean(series).where("hour(timestamp) = 5").orderBy("timestamp").collect()
    assert all(r.same_hour_mean_7d is None for r in out)
    total = S.previous_day_total(series).where("timestamp = timestamp_ntz'2024-01-04 00:00:00'").first()
    assert total.previous_day_total is None


def test_areas_never_mix(spark):
    both = history(spark, 16, areas=("NYC",)).unionByName(history(spark, 16, areas=("JC",), value=lambda i: 1000.0))
    frame = S.demand_frame(both)
    assert frame.where("area = 'JC'").agg(F.min("same_hour_mean_7d"), F.max("lag_7d")).first()[:] == (1000.0, 1000.0)
    alone = S.demand_frame(history(spark, 16))
    assert frame.where("area = 'NYC'").exceptAll(alone.select(*frame.columns)).count() == 0


def test_contract(spark):
    good = history(spark, 14)
    S.require_contract(good)
    for bad in (good.where("timestamp <> timestamp_ntz'2024-01-04 05:00:00'"), good.unionByName(good.limit(1)),
                good.withColumn("rides", F.lit(-1.0)), good.where("hour(timestamp) < 23 OR timestamp < timestamp_ntz'2024-01-14'")):
        with pytest.raises(ValueError, match="contract"):
            S.require_contract(bad)
    ahead = S.future_scaffold(good)
    S.require_contract(ahead, future_day=True)
    with pytest.raises(ValueError):
        S.require_contract(ahead)


def test_gap_hour_must_be_zero(spark):
    series = history(spark, 3, datetime(2024, 3, 9), value=lambda i: 1.0)
    with pytest.raises(ValueError, match="gap_hour"):
        S.require_contract(series)


def test_day_ahead_has_24_labels_and_last_weeks_values(spark):
    out = G.day_ahead(history(spark, 20)).toPandas().sort_values("timestamp")
    assert len(out) == 24 and out.timestamp.iloc[0] == datetime(2024, 1, 21)
    assert out.predicted_rides.tolist() == [float((13 * 24 + h) % 97) for h in range(24)]


def test_operational_rule(spark):
    df = spark.createDataFrame([(-3.0, 1), (5.0, 0), (4.0, 2)], "p double, h int")
    assert [r[0] for r in df.select(G.operational(F.col("p"), F.col("h"))).collect()] == [0.0, 0.0, 4.0]
    with pytest.raises(Exception, match="not finite"):
        spark.createDataFrame([(float("nan"), 1)], "p double, h int").select(G.operational(F.col("p"), F.col("h"))).collect()


def test_chronological_folds(spark):
    days = spark.createDataFrame([(datetime(2024, 1, 1) + timedelta(days=i),) for i in range(200)], "day timestamp_ntz")
    folds = P.chronological_folds(days).orderBy("fold").collect()
    assert len(folds) == 5 and folds[-1].valid_end == datetime(2024, 1, 1) + timedelta(days=200)
    assert all(f.train_end == f.valid_start and (f.valid_end - f.valid_start).days == 28 for f in folds)
    assert [(b.valid_start - a.valid_start).days for a, b in zip(folds, folds[1:])] == [28] * 4
    roles = J.fold_membership(days, P.chronological_folds(days)).groupBy("fold", "role").count().collect()
    assert {(r.fold, r.role): r["count"] for r in roles}[(5, "train")] == 172


def test_weekly_autocorrelation_needs_full_weeks(spark):
    out = A.weekly_autocorrelation(history(spark, 24, value=lambda i: float(i % 168))).collect()
    assert len(out) == 2 and all(r.r == pytest.approx(1.0) for r in out)


def test_autocorrelation_equals_pandas(spark):
    series = history(spark, 12)
    x = series.toPandas().sort_values("timestamp").rides.reset_index(drop=True)
    for r in A.autocorrelation(series, [1, 24, 168]).collect():
        assert r.r == pytest.approx(x.autocorr(r["lag"]))
