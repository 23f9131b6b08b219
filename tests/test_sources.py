import io
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyridge.plans.prepare import prepare
from tallyridge.sources import archives as Z
from tallyridge.sources import delimited, sinks, stages

AREAS = ((r"^JC-", "JC"), (r"^(\d{4}|\d{6})-city-", "NYC"))

MODERN = "ride_id,rideable_type,started_at,ended_at,start_station_name,start_station_id,end_station_name,end_station_id,start_lat,start_lng,end_lat,end_lng,member_casual"
LEGACY = "tripduration,starttime,stoptime,start station id,start station name,start station latitude,start station longitude,end station id,end station name,end station latitude,end station longitude,bikeid,usertype,birth year,gender"


def modern(i, day="2024-01-05"):
    return f"r{i},electric_bike,{day} 10:{i % 60:02d}:00,{day} 11:00:00,\"Main, St\",007.10,B,12,40.7,-74.0,40.8,-73.9,member"


def legacy(day="1/5/2014"):
    return f"600,{day} 10:00,{day} 10:10,72.0,W 52 St,40.7,-73.9,79,Franklin,40.7,-74.0,22,Subscriber,1980,1"


def text(header, *rows, eol="\n"):
    return eol.join([header, *rows]) + eol


def pack(members: dict) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, body in members.items():
            z.writestr(name, body)
    return out.getvalue()


@pytest.fixture
def folder(tmp_path):
    def put(**files):
        for name, body in files.items():
            (tmp_path / name).write_bytes(body)
        return str(tmp_path)

    return put


def write(tmp_path, files):
    for name, body in files.items():
        (tmp_path / name).write_bytes(body)
    return str(tmp_path)


def test_nested_archive_and_junk_members(spark, tmp_path):
    inner = pack({"202401.csv": "﻿" + text(MODERN, modern(1), modern(2), eol="\r\n"), "__MACOSX/202401.csv": "junk", "._202401.csv": "junk"})
    src = write(tmp_path, {"2024-city-tripdata.zip": pack({"202401.zip": inner, "__MACOSX/x.zip": b"junk"})})
    rows = Z.require_sound(Z.inventory(spark, src, AREAS))
    r = rows.collect()
    assert [(x.area, x.period, x.nested, x.member) for x in r] == [("NYC", "2024-01", "202401.zip", "202401.csv")]
    assert len(r[0].sha256) == 64 and r[0].crc > 0
    got = Z.scan(rows).orderBy("ride_id").collect()
    assert [g.ride_id for g in got] == ["r1", "r2"]
    assert got[0].start_station_id == "007.10" and got[0].start_station_name == "Main, St" and got[0].bike_id is None
    assert got[0].member_casual == "member"


@pytest.mark.parametrize("block", [1, 50, 97, 1 << 20])
def test_blocks_read_every_row_once(spark, tmp_path, block):
    body = text(MODERN, *[modern(i) for i in range(23)])
    lines = body.splitlines(keepends=True) if isinstance(body, bytes) else body.encode().splitlines(keepends=True)
    blocks = list(Z.line_blocks(io.BytesIO(b"".join(lines)), block))
    assert b"".join(blocks) == b"".join(lines[1:]) and all(x.endswith(b"\n") for x in blocks[:-1])
    src = write(tmp_path, {"JC-202401-trips.zip": pack({"JC-202401.csv": body})})
    assert sorted(r.ride_id for r in Z.scan(Z.inventory(spark, src, AREAS)).collect()) == sorted(f"r{i}" for i in range(23))


def test_null_markers(spark, tmp_path):
    body = text("started_at,ended_at,member_casual,bikeid,usertypex", "NULL,null,\\N,,x")
    src = write(tmp_path, {"JC-202401-trips.zip": pack({"JC-202401.csv": body})})
    r = Z.scan(Z.inventory(spark, src, AREAS)).first()
    assert (r.started_at, r.ended_at, r.member_casual, r.bike_id) == (None, None, None, None)


def test_names(spark):
    df = spark.createDataFrame([("a/202401-x.csv",), ("202401/202402.csv",), ("x.csv",), ("20240101.csv",), ("__MACOSX/a.csv",), ("d/._a.csv",)], "n string")
    period, problem = Z.member_period(F.col("n"), F.lit(None).cast("string"))
    got = {r.n: (r.p, r.e, r.u) for r in df.select("n", period.alias("p"), problem.alias("e"), Z.useful_member(F.col("n")).alias("u")).collect()}
    assert got["a/202401-x.csv"] == ("2024-01", None, True)
    assert got["202401/202402.csv"] == (None, "conflicting periods", True)
    assert got["x.csv"][1] == "no period" and got["20240101.csv"][1] == "no period"
    assert not got["__MACOSX/a.csv"][2] and not got["d/._a.csv"][2]
    areas = spark.createDataFrame([("JC-2024.zip",), ("202401-city-tripdata.zip",), ("other.zip",)], "n string")
    assert [r[0] for r in areas.select(Z.source_area(F.col("n"), AREAS)).collect()] == ["JC", "NYC", None]


def test_representations(spark, tmp_path):
    whole, parts = [legacy(), legacy()], [legacy()]
    same = pack({"201401-trips.csv": text(LEGACY, *whole), "201401-trips_1.csv": text(LEGACY, *parts), "201401-trips_2.csv": text(LEGACY, *parts)})
    src = write(tmp_path, {"201401-city-tripdata.zip": same})
    rows = Z.inventory(spark, src, AREAS)
    assert sorted({r.representation for r in rows.collect()}) == [".::parts", ".::whole"]
    raw = Z.scan(rows)
    content = ["started_at", "ended_at", "bike_id"]
    assert Z.representation_faults(raw, "representation", content).count() == 0
    assert Z.keep_one_version(raw, "representation").count() == 2
    fewer = raw.where("NOT member LIKE '%_2.csv'")
    assert Z.representation_faults(fewer, "representation", content).count() == 1


def test_unsound_sources_stop(spark, tmp_path):
    src = write(tmp_path, {"JC-202401-trips.zip": pack({"JC-202401.csv": text("a,b", "1,2")})})
    with pytest.raises(ValueError, match="schema"):
        Z.require_sound(Z.inventory(spark, src, AREAS))


def test_preparation_run_and_receipts(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    write(src, {
        "202401-city-tripdata.zip": pack({"202401-trips.csv": text(MODERN, modern(1), modern(1), modern(2), modern(9, "2024-02-01"))}),
        "202402-city-tripdata.zip": pack({"202402-trips.csv": text(MODERN, modern(3, "2024-02-07"))})})
    out = str(tmp_path / "out")
    receipts = prepare(spark, str(src), out, AREAS)
    trips = spark.read.parquet(f"{out}/trips")
    assert sorted((r.ride_id, r.year, r.month, r.valid_demand) for r in trips.collect()) == [
        ("r1", 2024, 1, True), ("r2", 2024, 1, True), ("r3", 2024, 2, True), ("r9", 2024, 2, True)]
    assert sorted((r.period, r["rows"]) for r in receipts.collect()) == [("2024-01", 2), ("2024-02", 2)]
    work = Z.work_items(Z.inventory(spark, str(src), AREAS))
    assert stages.pending_work(work, receipts).count() == 0
    old = receipts.withColumn("signature", F.when(F.col("period") == "2024-01", "other").otherwise(F.col("signature")))
    assert [r.period for r in stages.pending_work(work, old).collect()] == ["2024-01"]
    plan = stages.stage_scan(spark, f"{out}/trips", "NYC", "validation", stages.StagePeriods("2024-02-01", "2024-03-01", "2024-04-01"))
    assert sorted(r.ride_id for r in plan.collect()) == ["r3", "r9"]


def test_rows_do_not_stay_where_they_have_moved_from(spark, tmp_path):
    """A January archive with a February ride, then the February archive: the ride is in February only."""
    src, out = tmp_path / "src", str(tmp_path / "out")
    src.mkdir()
    write(src, {"202401-city-tripdata.zip": pack({"202401-trips.csv": text(MODERN, modern(9, "2024-02-01"))})})
    prepare(spark, str(src), out, AREAS)
    assert [(r.ride_id, r.month) for r in spark.read.parquet(f"{out}/trips").collect()] == [("r9", 1)]
    write(src, {"202402-city-tripdata.zip": pack({"202402-trips.csv": text(MODERN, modern(3, "2024-02-07"))})})
    receipts = prepare(spark, str(src), out, AREAS)
    assert sorted((r.ride_id, r.month) for r in spark.read.parquet(f"{out}/trips").collect()) == [("r3", 2), ("r9", 2)]
    assert [(r.source_month, r.target_month, r["rows"]) for r in spark.read.parquet(f"{out}/audit/moved").collect()] == [("2024-01", "2024-02", 1)]
    assert sorted((r.period, r.digest == "none") for r in receipts.collect()) == [("2024-01", True), ("2024-02", False)]
    before = {r.period: r.digest for r in receipts.collect()}
    damaged = spark.read.parquet(f"{out}/trips").where("ride_id <> 'r3'").collect()
    spark.createDataFrame(damaged, spark.read.parquet(f"{out}/trips").schema).write.mode("overwrite").partitionBy("area", "year", "month").parquet(f"{out}/trips")
    again = prepare(spark, str(src), out, AREAS)
    assert {r.period: r.digest for r in again.collect()} == before
    assert spark.read.parquet(f"{out}/trips").where("ride_id = 'r3'").count() == 1


def test_precision_aliases_only_in_declared_areas(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    fine = modern(1).replace("10:01:00", "10:01:00.250")
    write(src, {"202401-city-tripdata.zip": pack({"202401-trips.csv": text(MODERN, modern(1))}),
                "202402-city-tripdata.zip": pack({"202402-trips.csv": text(MODERN, fine)})})
    with pytest.raises(ValueError, match="conflicting ids across"):
        prepare(spark, str(src), str(tmp_path / "a"), AREAS)
    prepare(spark, str(src), str(tmp_path / "b"), AREAS, alias_areas=("NYC",))
    assert spark.read.parquet(str(tmp_path / "b" / "trips")).count() == 1


def test_stage_scan_keeps_stages_apart_inside_a_month(spark, tmp_path):
    rows = spark.sql("""SELECT IF(id % 3 = 0, 'JC', 'NYC') AS area, id, timestamp_ntz'2023-12-20 00:00:00' + make_dt_interval(CAST(id AS INT)) AS started_at FROM range(60)""")
    rows = rows.withColumns({"year": F.year("started_at"), "month": F.month("started_at")})
    sinks.write_partitioned(rows, str(tmp_path / "t"))
    periods = stages.StagePeriods("2024-01-15", "2024-01-25", "2024-02-10")
    for area in ("NYC", "JC"):
        for stage in ("development", "validation"):
            got = stages.stage_scan(spark, str(tmp_path / "t"), area, stage, periods)
            assert {r.id for r in got.collect()} == {r.id for r in stages.stage_rows(rows, area, stage, periods).collect()}
    plan = stages.stage_scan(spark, str(tmp_path / "t"), "NYC", "validation", periods)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "make_date" in plan
    with pytest.raises(PermissionError):
        stages.stage_scan(spark, str(tmp_path / "t"), "NYC", "test", periods)
    with pytest.raises(ValueError):
        stages.stage_scan(spark, str(tmp_path / "t"), "LA", "validation", periods)


def test_receipt_digests(spark):
    receipts = spark.createDataFrame([("NYC", "2024-01", "s", "d1"), ("NYC", "2024-02", "s", "d2")], "area string, period string, signature string, digest string")
    actual = spark.createDataFrame([("NYC", "2024-01", "d1"), ("NYC", "2024-02", "broken")], "area string, period string, digest string")
    checked = stages.checked_receipts(receipts, actual)
    assert [r.period for r in stages.pending_work(receipts, checked).collect()] == ["2024-02"]


def test_fingerprint_ignores_order_but_not_copies(spark):
    a = spark.createDataFrame([("p", 1, "x"), ("p", 2, None)], "k string, i int, s string")
    b = a.orderBy(F.desc("i")).repartition(3)
    one, two, three = (stages.partition_fingerprints(d, ["k"], ["i", "s"]).first().digest for d in (a, b, a.union(a.limit(1))))
    assert one == two != three
    assert len(stages.dataset_fingerprint(stages.partition_fingerprints(a, ["k"], ["i", "s"]), ["k"])) == 64


def test_test_stage_is_closed(spark):
    df = spark.createDataFrame([("NYC",)], "area string").withColumn("started_at", F.expr("timestamp_ntz'2024-03-05'"))
    periods = stages.StagePeriods("2024-02-01", "2024-03-01", "2024-04-01")
    with pytest.raises(PermissionError):
        stages.stage_rows(df, "NYC", "test", periods)
    assert stages.stage_rows(df, "NYC", "test", periods, selection_locked=True).count() == 1
    with pytest.raises(ValueError):
        stages.stage_rows(df, "NYC", "other", periods)
    with pytest.raises(ValueError):
        stages.require_area(df, "JC")


def test_semicolon_file_and_provenance(spark, tmp_path):
    (tmp_path / "m.csv").write_text("class;cap\np;?\ne;3.5\n")
    schema = T.StructType([T.StructField("class", T.StringType()), T.StructField("cap", T.DoubleType())])
    df = stages.with_file(delimited.read_semicolon(spark, str(tmp_path / "m.csv"), schema))
    assert [(r["class"], r.cap, r.filename.endswith("m.csv")) for r in df.collect()] == [("p", None, True), ("e", 3.5, True)]


def test_history_upload(spark, tmp_path):
    p = tmp_path / "h.csv"
    p.write_bytes("﻿area,timestamp,rides\r\nNYC,2026-04-29 08:00:00,\"12\"\r\nNYC,2026-04-29T09:00,0\r\nJC,2026-04-29 10:00:00,1\r\nNYC,2026-04-29 10:30:00,1\r\nNYC,2026-04-29 11:00:00Z,1\r\nNYC,2026-04-29 12:00:00,-1\r\nNYC,2026-04-29 13:00:00\r\n".encode())
    good, bad = delimited.read_history(spark, str(p), "NYC")
    assert sorted(r.rides for r in good.collect()) == [0.0, 12.0]
    assert sorted(r.reject_reason for r in bad.collect()) == ["foreign area", "invalid count", "not a local hour label", "not a local hour label", "wrong number of fields"]
    (tmp_path / "x.csv").write_text("timestamp,rides\n2026-04-29 08:00:00,1\n")
    with pytest.raises(ValueError):
        delimited.read_history(spark, str(tmp_path / "x.csv"), "NYC")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("NYC", 2024, 1, "a"), ("NYC", 2024, 2, "b")], "area string, year int, month int, v string")
    out = str(tmp_path / "t")
    sinks.write_partitioned(df, out)
    sinks.write_partitioned(df.where("month = 2").withColumn("v", F.lit("c")), out)
    assert sorted(r.v for r in spark.read.parquet(out).collect()) == ["a", "c"]
    guarded = str(tmp_path / "g")
    assert sinks.write_guarded(df, guarded) is True
    assert sinks.write_guarded(df.orderBy(F.desc("month")), guarded) is False
    with pytest.raises(ValueError):
        sinks.write_guarded(df.withColumn("v", F.lit("z")), guarded)
    sinks.write_report(df, str(tmp_path / "r"), "csv")
    sinks.write_report(df, str(tmp_path / "j"), "json")
    assert spark.read.option("header", True).csv(str(tmp_path / "r")).count() == spark.read.json(str(tmp_path / "j")).count() == 2
