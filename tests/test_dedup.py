from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyridge.columns import CANONICAL_TRIP_COLUMNS
from tallyridge.operators import clean as C
from tallyridge.operators import dedup as D

TYPES = {"started_at": "timestamp_ntz", "ended_at": "timestamp_ntz", "start_lat": "double", "start_lng": "double",
         "end_lat": "double", "end_lng": "double", "reported_duration_seconds": "double"}
SCHEMA = ", ".join(f"{c} {TYPES.get(c, 'string')}" for c in CANONICAL_TRIP_COLUMNS) + ", source_month string, filename string"
T0 = datetime(2024, 1, 31, 23, 50)


def trips(spark, *rows):
    base = {**dict.fromkeys(CANONICAL_TRIP_COLUMNS), "started_at": T0, "ended_at": T0 + timedelta(minutes=20), "rideable_type": "classic_bike",
            "member_casual": "member", "start_station_name": "A", "start_lat": 40.7, "start_lng": -74.0, "source_month": "2024-01"}
    full = [{**base, **r} for r in rows]
    full = [tuple({**r, "filename": r["source_month"]}.values()) for r in full]
    df = spark.createDataFrame(full, SCHEMA).withColumn("area", F.lit("NYC"))
    return C.with_trip_flags(df, F.col("source_month"))


def test_rows_without_id_keep_their_multiplicity(spark):
    out = D.dedup_first(trips(spark, {}, {}, {"ride_id": "a"}, {"ride_id": "a"}))
    assert sorted(str(r.ride_id) for r in out.collect()) == ["None", "None", "a"]


def test_first_start_wins(spark):
    out = D.dedup_first(trips(spark, {"ride_id": "a", "started_at": T0 + timedelta(hours=1)}, {"ride_id": "a"}))
    assert out.first().started_at == T0


def test_conflicts_stop_the_run(spark):
    rows = trips(spark, {"ride_id": "a"}, {"ride_id": "a", "member_casual": "casual"}, {"ride_id": "b"}, {"ride_id": "b"})
    assert [r.ride_id for r in D.conflicting_ids(rows, D.CONTENT).collect()] == ["a"]
    with pytest.raises(ValueError, match="conflicting"):
        D.require_no_conflicts(rows, D.CONTENT)
    D.require_no_conflicts(rows.where("ride_id = 'b'"), D.CONTENT)


def test_precision_alias_keeps_the_finer_version(spark):
    fine = {"started_at": T0 + timedelta(milliseconds=250), "ended_at": T0 + timedelta(minutes=20, milliseconds=750)}
    rows = trips(spark, {"ride_id": "a"}, {"ride_id": "a", **fine}, {"ride_id": "b"}, {"ride_id": "b"}, {"ride_id": "c", **fine},
                 {"ride_id": "c", "started_at": T0 + timedelta(seconds=2)})
    aliases = D.time_alias_ids(rows)
    assert [r.ride_id for r in aliases.collect()] == ["a"]
    kept = {r.ride_id: r for r in D.preferred_version(rows, aliases).collect()}
    assert kept["a"].started_at == fine["started_at"]
    assert [r.ride_id for r in D.proof_conflicts(rows).collect()] == ["c"]


def test_station_serialisation_is_no_conflict(spark):
    rows = trips(spark, {"ride_id": "a", "start_station_id": "4632.1"}, {"ride_id": "a", "start_station_id": "4632.10"})
    assert D.conflicting_ids(rows, D.CONTENT).count() == 1
    assert D.proof_conflicts(rows).count() == 0


def test_multiset_equality_counts_copies(spark):
    a = spark.createDataFrame([("x", None), ("x", None), ("y", 1)], "k string, v int")
    b = spark.createDataFrame([("x", None), ("y", 1), ("y", 1)], "k string, v int")
    row = D.multiset_difference(a, b, ["k", "v"]).first()
    assert (row.only_left, row.only_right, row.equal) == (1, 1, False)
    assert D.multiset_difference(a, a, ["k", "v"]).first().equal
    with pytest.raises(ValueError):
        D.require_equivalent(a, b, ["k", "v"])


def test_month_boundary(spark):
    feb = {"started_at": datetime(2024, 2, 1, 0, 5), "ended_at": datetime(2024, 2, 1, 0, 15)}
    far = {"started_at": datetime(2024, 5, 1, 0, 5), "ended_at": datetime(2024, 5, 1, 0, 15)}
    rows = trips(
        spark,
        {"ride_id": "a", **feb}, {"ride_id": "a", **feb, "source_month": "2024-02"},  # id in both months: the valid one stays
        {**feb}, {**feb, "source_month": "2024-02"}, {**feb, "source_month": "2024-02"},  # off-month copy is contained: goes
        {"ride_id": "m", **feb, "member_casual": "casual"},  # only off-month: moves
        {"ride_id": "f", **far},  # its month is not present: stays flagged
        {"ride_id": "j"})
    out = D.align_months(rows).collect()
    months = sorted((str(r.ride_id), r.target_month, r.valid_demand) for r in out)
    assert months == [("None", "2024-02", True), ("None", "2024-02", True), ("a", "2024-02", True), ("f", "2024-01", False),
                      ("j", "2024-01", True), ("m", "2024-02", True)]


def test_unproven_segment_moves_whole(spark):
    feb = {"started_at": datetime(2024, 2, 1, 0, 5), "ended_at": datetime(2024, 2, 1, 0, 15)}
    rows = trips(spark, {**feb}, {**feb}, {**feb, "source_month": "2024-02"}, {"ride_id": "j"})
    proof = D.segment_containment(rows).first()
    assert (proof.rows, proof.unmatched_rows, proof.proven_copy) == (2, 1, False)
    assert D.align_months(rows).where("target_month = '2024-02'").count() == 3


def test_inconsistent_fields_count_nulls_as_values(spark):
    rows = trips(spark, {"ride_id": "a", "bike_id": "1"}, {"ride_id": "a"}, {"ride_id": "b", "bike_id": "1"}, {"ride_id": "b", "bike_id": "1"})
    got = {r["column"]: r["ids"] for r in D.inconsistent_fields(rows, ["bike_id", "member_casual"]).collect()}
    assert got == {"bike_id": 1, "member_casual": 0}
