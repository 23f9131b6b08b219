"""Registered queries for sources and sinks, on files Spark derives from the tables.

Archives, delimited files and partitioned tables are written below the shared work
folder by Spark tasks and read back with the library's sources.
"""

from __future__ import annotations

import io
import zipfile

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyridge.operators import clean as C
from tallyridge.operators import dedup as D
from tallyridge.operators import features as E
from tallyridge.operators import series as S
from tallyridge.plans.catalog import query
from tallyridge.plans.items import CONTENT
from tallyridge.sources import archives as Z
from tallyridge.sources import delimited, sinks, stages
from tallyridge.streaming.demand import work_folder

LOCAL_WORK = "/tmp/tallyridge-work"  # of sessions in one process without spark.checkpoint.dir

HEADER = "ride_id,rideable_type,started_at,ended_at,start_station_name,start_station_id,member_casual"
ROWS_PER_ARCHIVE = 2000
AREAS = ((r"^JC[- ]", "JC"),)


def _uri(folder: str) -> str:
    return folder if "://" in folder else f"file://{folder}"


def archive_folder(v) -> str:
    """Trips as ZIP archives of 2,000 rows in two part files each, every third one nested."""
    folder = work_folder(v.spark, LOCAL_WORK) + "/archives"
    fs, base = pafs.FileSystem.from_uri(_uri(folder))
    fs.create_dir(base)
    lines = v.trips.select(
        F.floor(F.col("event_id") / ROWS_PER_ARCHIVE).cast("int").alias("archive"), F.pmod("event_id", F.lit(2)).cast("int").alias("part"),
        F.to_csv(F.struct("ride_id", "rideable_type", F.date_format("started_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("a"),
                          F.date_format("ended_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("b"), "start_station_name", "start_station_id", "member_casual"),
                 {"emptyValue": "", "nullValue": ""}).alias("line"))

    def pack(key, frame: pd.DataFrame) -> pd.DataFrame:
        archive = int(key[0])
        members = {f"JC-202401-{archive}_{p + 1}.csv": "\n".join([HEADER, *part["line"]]) + "\n" for p, part in frame.groupby("part")}
        members["__MACOSX/JC-202401.csv"] = "junk"
        body = io.BytesIO()
        with zipfile.ZipFile(body, "w", zipfile.ZIP_DEFLATED) as z:
            for name, text in members.items():
                z.writestr(name, text)
        data = body.getvalue()
        if archive % 3 == 0:
            outer = io.BytesIO()
            with zipfile.ZipFile(outer, "w") as z:
                z.writestr("JC-202401.zip", data)
            data = outer.getvalue()
        target, root = pafs.FileSystem.from_uri(_uri(folder))
        with target.open_output_stream(f"{root}/JC-202401-trips-{archive}.zip") as out:
            out.write(data)
        return pd.DataFrame({"archive": [archive], "bytes": [len(data)]})

    lines.groupBy("archive").applyInPandas(pack, "archive int, bytes long").agg(F.sum("bytes")).collect()
    return folder


@query("src_archive_inventory", """
SELECT area, period, nested, representation, member, 7::INT AS columns, CAST(NULL AS VARCHAR) AS problem FROM (
  SELECT DISTINCT 'JC' AS area, '2024-01' AS period, CASE WHEN (event_id // 2000) % 3 = 0 THEN 'JC-202401.zip' END AS nested, '.' AS representation,
    'JC-202401-' || (event_id // 2000) || '_' || (event_id % 2 + 1) || '.csv' AS member FROM events)""")
def _(v):
    rows = Z.inventory(v.spark, archive_folder(v), AREAS)
    return rows.select("area", "period", "nested", "representation", "member", F.size("columns").alias("columns"), "problem")


@query("src_zip_csv_scan", """
SELECT ride_id, rideable_type, strftime(started_at, '%Y-%m-%d %H:%M:%S.%f') AS started_at, strftime(ended_at, '%Y-%m-%d %H:%M:%S.%f') AS ended_at, start_station_name, start_station_id, member_casual,
  CAST(NULL AS VARCHAR) AS bike_id, 'JC' AS area, '2024-01' AS period FROM trips""")
def _(v):
    rows = Z.require_sound(Z.inventory(v.spark, archive_folder(v), AREAS))
    return Z.scan(rows).select("ride_id", "rideable_type", "started_at", "ended_at", "start_station_name", "start_station_id",
                                                     "member_casual", "bike_id", "area", "period")


NAMES_SQL = """
names AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN '__MACOSX/' WHEN 1 THEN 'sub/' ELSE '' END
  || CASE WHEN event_id % 7 = 0 THEN '._' ELSE '' END || CASE WHEN event_id % 5 = 0 THEN 'JC-' ELSE '' END
  || CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y%m') WHEN 1 THEN strftime(ts, '%Y%m%d') ELSE strftime(ts, '%Y%m') || '-202402' END
  || CASE WHEN event_id % 6 < 3 THEN '_' || (event_id % 6 + 1) ELSE '' END || '.csv' AS name FROM events)"""


def names(v):
    e = F.col("event_id")
    month = F.date_format("ts", "yyyyMM")
    name = F.concat(
        F.when(e % 4 == 0, "__MACOSX/").when(e % 4 == 1, "sub/").otherwise(""), F.when(e % 7 == 0, "._").otherwise(""), F.when(e % 5 == 0, "JC-").otherwise(""),
        F.when(e % 3 == 0, month).when(e % 3 == 1, F.date_format("ts", "yyyyMMdd")).otherwise(F.concat(month, F.lit("-202402"))),
        F.when(e % 6 < 3, F.concat(F.lit("_"), (e % 6 + 1).cast("string"))).otherwise(""), F.lit(".csv"))
    return v.table("events").select("event_id", name.alias("member"))


@query("src_member_filter", f"""
WITH {NAMES_SQL} SELECT event_id, NOT starts_with(name, '__MACOSX/') AND NOT starts_with(regexp_extract(name, '([^/]*)$', 1), '.') AS useful FROM names""")
def _(v):
    return names(v).select("event_id", Z.useful_member(F.col("member")).alias("useful"))


@query("src_member_classify", f"""
WITH {NAMES_SQL}, b AS (SELECT event_id, regexp_extract(name, '([^/]*)$', 1) AS base FROM names)
SELECT event_id, CASE WHEN regexp_matches(base, '^JC[- ]') THEN 'JC' END AS area,
  CASE WHEN event_id % 3 = 0 THEN '2024-01' WHEN event_id % 3 = 1 THEN '1999-12' END AS period, CASE WHEN event_id % 3 = 2 THEN 'conflicting periods' END AS problem FROM b""")
def _(v):
    period, problem = Z.member_period(F.col("member"), F.lit("1999-12"))
    return names(v).select("event_id", Z.source_area(Z.base_name(F.col("member")), AREAS).alias("area"), period.alias("period"), problem.alias("problem"))


@query("src_logical_groups", f"""
WITH {NAMES_SQL}, m AS (SELECT DISTINCT event_id % 50 AS path, name AS member, CASE WHEN strpos(name, '/') > 0 THEN regexp_extract(name, '^(.*)/[^/]*$', 1) ELSE '.' END AS parent,
  regexp_matches(lower(name), '(_[0-9]+|-part[0-9]+)\\.csv$') AS p FROM names),
 k AS (SELECT path, parent, bool_or(p) AS pp, bool_or(NOT p) AS w FROM m GROUP BY 1, 2)
SELECT m.path::BIGINT AS path, member, m.parent || CASE WHEN pp AND w THEN (CASE WHEN p THEN '::parts' ELSE '::whole' END) ELSE '' END AS representation
FROM m JOIN k ON k.path = m.path AND k.parent = m.parent""")
def _(v):
    members = names(v).select((F.col("event_id") % 50).alias("path"), "member").distinct()
    return Z.logical_groups(members, ("path",)).select("path", "member", "representation")


@query("src_canonical_columns", """
SELECT ride_id, strftime(started_at, '%Y') AS started_at, strftime(ended_at, '%Y') AS ended_at, start_station_id, bike_id, CAST(NULL AS VARCHAR) AS rideable_type FROM trips""")
def _(v):
    old = v.trips.select(F.col("ride_id").alias("Ride ID"), F.date_format("started_at", "yyyy").alias("starttime"), F.date_format("ended_at", "yyyy").alias(" Stop Time".strip()),
                         F.col("start_station_id").alias("start station id"), F.col("bike_id").alias("bikeid"), F.col("filename").alias("gender"))
    old = old.withColumnRenamed("Stop Time", "stoptime")
    return Z.canonical_columns(old).select("ride_id", "started_at", "ended_at", "start_station_id", "bike_id", "rideable_type")


@query("src_csv_semicolon_na", """
SELECT row_id, label, cap_diameter, kind, color FROM items""")
def _(v):
    path = work_folder(v.spark, LOCAL_WORK) + "/semicolon"
    v.items.select("row_id", "label", "cap_diameter", "kind", "color").write.mode("overwrite").option("header", True).option("sep", ";").option("nullValue", "?").csv(path)
    schema = T.StructType([T.StructField("row_id", T.LongType()), T.StructField("label", T.StringType()), T.StructField("cap_diameter", T.DoubleType()),
                           T.StructField("kind", T.StringType()), T.StructField("color", T.StringType())])
    return delimited.read_semicolon(v.spark, path, schema)


@query("src_file_provenance", "SELECT 'events.parquet' AS source, count(*) AS rows FROM events")
def _(v):
    found = F.regexp_extract("filename", r"(events\.parquet)", 1).alias("source")
    return stages.with_file(v.table("events")).groupBy(found).agg(F.count(F.lit(1)).alias("rows"))


@query("src_incremental_receipts", """
WITH w AS (SELECT area, source_month AS period, md5(concat_ws('|', count(*)::VARCHAR, max(event_id)::VARCHAR)) AS signature FROM trips_dup GROUP BY 1, 2),
 r AS (SELECT area, source_month AS period, md5(concat_ws('|', count(*)::VARCHAR, max(event_id)::VARCHAR)) AS signature FROM trips GROUP BY 1, 2)
SELECT w.area, w.period, w.signature FROM w LEFT JOIN r ON r.area = w.area AND r.period = w.period AND r.signature = w.signature WHERE r.area IS NULL""")
def _(v):
    def signed(df):
        mark = F.md5(F.concat_ws("|", F.count(F.lit(1)).cast("string"), F.max("event_id").cast("string")))
        return df.groupBy("area", F.col("source_month").alias("period")).agg(mark.alias("signature"))

    return stages.pending_work(signed(v.trips_dup), signed(v.trips))


@query("sink_parquet_partitioned", """
SELECT area, year(started_at)::INT AS year, month(started_at)::INT AS month, count(*) AS rows, sum(event_id)::BIGINT AS ids FROM dst_trips GROUP BY 1, 2, 3""")
def _(v):
    path = work_folder(v.spark, LOCAL_WORK) + "/partitioned"
    sinks.write_partitioned(v.dst_trips.withColumns({"year": F.year("started_at"), "month": F.month("started_at")}), path)
    return v.spark.read.parquet(path).groupBy("area", "year", "month").agg(F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("ids"))


@query("sink_csv_json_reports", """
SELECT source_month, count(*) AS rows, 'csv' AS kind FROM trips GROUP BY 1 UNION ALL SELECT source_month, count(*), 'json' FROM trips GROUP BY 1""")
def _(v):
    folder = work_folder(v.spark, LOCAL_WORK)
    report = v.trips.groupBy("source_month").agg(F.count(F.lit(1)).alias("rows"))
    sinks.write_report(report, f"{folder}/csv", "csv")
    sinks.write_report(report, f"{folder}/json", "json")
    schema = "source_month string, rows long"
    back = [v.spark.read.schema(schema).option("header", True).csv(f"{folder}/csv").withColumn("kind", F.lit("csv")),
            v.spark.read.schema(schema).json(f"{folder}/json").withColumn("kind", F.lit("json"))]
    return back[0].unionByName(back[1])


@query("sink_guarded_overwrite", "SELECT row_id, label FROM items")
def _(v):
    path = work_folder(v.spark, LOCAL_WORK) + "/guarded"
    rows = v.items.select("row_id", "label")
    sinks.write_guarded(rows, path)
    sinks.write_guarded(rows, path)
    return v.spark.read.parquet(path)


@query("clean_column_names", "SELECT row_id, cap_diameter, stem_height, has_ring FROM items")
def _(v):
    messy = v.items.select(F.col("row_id").alias("Row_ID"), F.col("cap_diameter").alias(" Cap-Diameter"), F.col("stem_height").alias("Stem-Height "), F.col("has_ring").alias("HAS-RING"))
    return C.tidy_column_names(messy)


@query("feat_column_subset", f"SELECT row_id, {', '.join(c for c in CONTENT if c not in ('veil', 'color'))} FROM items")
def _(v):
    return E.column_subset(v.items, ["veil", "color"])


@query("feat_no_leakage_check", "SELECT 0::BIGINT AS only_left, 0::BIGINT AS only_right, true AS equal")
def _(v):
    """Changing the data from a day on must leave the features up to that day unchanged."""
    day = F.expr("timestamp_ntz'2024-01-22'")
    changed = v.hourly.withColumn("rides", F.when(F.col("timestamp") >= day, F.col("rides") * 7 + 3).otherwise(F.col("rides")))
    keep = ["area", "timestamp", *S.FEATURES]
    one, two = (S.demand_frame(x).where(F.col("day") <= day).select(*keep) for x in (v.hourly, changed))
    return D.multiset_difference(one, two, keep)
