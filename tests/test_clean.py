from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyridge.columns import CANONICAL_TRIP_COLUMNS
from tallyridge.functions import text
from tallyridge.operators import clean as C
from tallyridge.sources.archives import canonical_columns, canonical_name

RAW = ", ".join(f"{c} string" for c in CANONICAL_TRIP_COLUMNS)


def raw(spark, *rows):
    blank = dict.fromkeys(CANONICAL_TRIP_COLUMNS)
    return spark.createDataFrame([tuple({**blank, **r}.values()) for r in rows], RAW)


def cleaned(spark, *rows, month="2024-01"):
    return C.clean_trips(raw(spark, *rows), F.lit(month), F.lit("NYC")).collect()


def test_bad_fields_are_flagged_and_rows_kept(spark):
    ok = {"started_at": "2024-01-05 10:00:00", "ended_at": "2024-01-05 10:30:00"}
    a, b, c, d = cleaned(
        spark, {**ok, "start_lat": "200", "start_lng": "-74"}, {**ok, "started_at": "nonsense"}, {**ok, "ended_at": " "},
        {**ok, "started_at": "2024-02-01 00:00:00"})
    assert a.valid_demand and not a.valid_start_coordinates and a.valid_duration and a.duration_minutes == 30
    assert b.started_at is None and not b.valid_demand and not b.missing_started_at
    assert c.missing_ended_at and c.valid_demand and not c.valid_duration
    assert not d.valid_demand and d.started_at is not None


def test_flags_are_never_null(spark):
    row = cleaned(spark, {})[0]
    flags = ("missing_started_at", "missing_ended_at", "valid_demand", "valid_start_coordinates", "valid_end_coordinates", "valid_duration", "long_duration_flag")
    assert all(isinstance(row[f], bool) for f in flags)


def test_legacy_ids_lose_serialised_zero_but_keep_leading_zeros(spark):
    old, new = cleaned(spark, {"bike_id": "7", "start_station_id": "0012.0"}, {"start_station_id": "0012.0"})
    assert old.start_station_id == "0012" and new.start_station_id == "0012.0"


def test_values_are_mapped(spark):
    rows = cleaned(spark, {"member_casual": "Subscriber"}, {"member_casual": "customer "}, {"member_casual": "guest"}, {"rideable_type": " Docked_Bike "})
    assert [r.member_casual for r in rows] == ["member", "casual", "unknown", "unknown"]
    assert [r.rideable_type for r in rows] == ["unknown"] * 3 + ["docked_bike"]


@pytest.mark.parametrize("written, want", [
    ("2024-01-05 10:20:30.5", datetime(2024, 1, 5, 10, 20, 30, 500000)), ("2024-01-05 10:20:30", datetime(2024, 1, 5, 10, 20, 30)),
    ("2024-01-05 10:20", datetime(2024, 1, 5, 10, 20)), ("1/5/2024 9:03", datetime(2024, 1, 5, 9, 3)),
    ("01/05/2024 09:03:07", datetime(2024, 1, 5, 9, 3, 7)), ("01/05/2024 09:03:07.123456", datetime(2024, 1, 5, 9, 3, 7, 123456)),
    ("2024-13-05 10:20:30", None), ("2024-01-05T10:20:30", None), ("", None), ("5 Jan 2024", None)])
def test_clock_layouts(spark, written, want):
    assert spark.createDataFrame([(written,)], "t string").select(text.parse_clock(F.col("t"))).first()[0] == want


def duration(spark, *rows, cutoff="2026-05-01"):
    df = spark.createDataFrame(
        [(datetime.fromisoformat(a), datetime.fromisoformat(b), s, True, "NYC") for a, b, s in rows],
        "started_at timestamp_ntz, ended_at timestamp_ntz, reported_duration_seconds double, valid_demand boolean, area string")
    return C.physical_duration(df, cutoff).collect()


def test_duration_across_clock_changes(spark):
    spring, autumn, told, late, infinite = duration(
        spark, ("2024-03-10 01:50:00", "2024-03-10 03:10:00", None), ("2024-11-03 01:30:00", "2024-11-03 02:30:00", None),
        ("2024-11-03 01:30:00", "2024-11-03 01:40:00", 4200.0), ("2026-04-30 23:50:00", "2026-05-01 00:10:00", None),
        ("2024-01-01 00:00:00", "2024-01-01 01:00:00", float("inf")))
    assert spring.duration_minutes == 20 and spring.valid_duration
    assert autumn.duration_ambiguous and not autumn.valid_duration
    assert told.duration_minutes == 70 and told.valid_duration
    assert not late.valid_duration and not infinite.valid_duration


def test_canonical_names_and_columns(spark):
    assert canonical_name(" Start  Station ID ") == "start_station_id"
    assert canonical_name("tripduration") == "reported_duration_seconds"
    df = spark.createDataFrame([("1", "2", "007")], "starttime string, stoptime string, bikeid string")
    row = canonical_columns(df).first()
    assert (row.started_at, row.ended_at, row.bike_id, row.ride_id) == ("1", "2", "007", None)
    with pytest.raises(ValueError):
        canonical_columns(spark.createDataFrame([("1", "2")], "starttime string, started_at string"))


def test_tidy_names_and_vocabulary(spark):
    df = spark.createDataFrame([("a", "x"), ("b", None), ("z", "x")], ["Cap-Shape ", "ring"])
    assert C.tidy_column_names(df).columns == ["cap_shape", "ring"]
    bad = C.unexpected_values(C.tidy_column_names(df), {"cap_shape": ["a", "b"], "ring": ["x"]}).collect()
    assert [(r["column"], r["value"], r["n"]) for r in bad] == [("cap_shape", "z", 1)]


def test_trailing_zero_ids_need_a_known_place(spark):
    df = spark.createDataFrame([("4632.10", True), ("4632.10", False), ("100", True), ("5.0", True)], "id string, known boolean")
    got = [r[0] for r in df.select(text.trailing_zero_id(F.col("id"), F.col("known"))).collect()]
    assert got == ["4632.1", "4632.10", "100", "5"]
