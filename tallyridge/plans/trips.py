"""Registered queries over the trip views: cleaning, quality, copies, summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyridge.functions import clock, hashing, numeric, text
from tallyridge.operators import clean as C
from tallyridge.operators import dedup as D
from tallyridge.operators import series as S
from tallyridge.operators import sketches as K
from tallyridge.operators import summaries as A
from tallyridge.plans.catalog import query
from tallyridge.sources import stages

COUNT_SQL = "SELECT area, date_trunc('day', started_at) AS day, count(*) AS n"
CONTENT_SQL = ", ".join(D.CONTENT)

# ---------------------------------------------------------------- cleaning


@query("clean_blank_to_null", """
SELECT event_id, nullif(trim(station_text), '') AS station_id FROM raw_texts""")
def _(v):
    return v.raw_texts.select("event_id", text.blank_to_null(F.col("station_text")).alias("station_id"))


@query("clean_default_unknown", """
SELECT event_id, coalesce(nullif(lower(trim(vehicle_text)), ''), 'unknown') AS rideable_type FROM raw_texts""")
def _(v):
    return v.raw_texts.select("event_id", text.default_unknown(F.col("vehicle_text")).alias("rideable_type"))


@query("clean_parse_timestamp_multi", """
SELECT event_id, started_text, try_strptime(trim(started_text), ['%Y-%m-%d %H:%M:%S.%f', '%Y-%m-%d %H:%M:%S', '%Y-%m-%d %H:%M',
  '%m/%d/%Y %H:%M:%S', '%m/%d/%Y %H:%M', '%m/%d/%Y %H:%M:%S.%f']) AS started_at FROM raw_texts""")
def _(v):
    return v.raw_texts.select("event_id", "started_text", text.parse_clock(F.col("started_text")).alias("started_at"))


@query("clean_legacy_station_id", r"""
SELECT event_id, CASE WHEN bike_id IS NOT NULL THEN nullif(regexp_replace(trim(station_text), '\.0+$', ''), '')
  ELSE nullif(trim(station_text), '') END AS start_station_id FROM raw_texts""")
def _(v):
    return v.raw_texts.select("event_id", text.integer_suffix_stripped(F.col("station_text"), F.col("bike_id").isNotNull()).alias("start_station_id"))


@query("clean_round_coordinates", "SELECT event_id, round(try_cast(lat_text AS DOUBLE), 7) * 10 AS lat10 FROM raw_texts")
def _(v):
    return v.raw_texts.select("event_id", (C.rounded_coordinate(F.col("lat_text")) * 10).alias("lat10"))


@query("clean_category_map", """
SELECT event_id, CASE lower(trim(member_text)) WHEN 'subscriber' THEN 'member' WHEN 'customer' THEN 'casual'
  WHEN 'member' THEN 'member' WHEN 'casual' THEN 'casual' ELSE 'unknown' END AS member_casual FROM raw_texts""")
def _(v):
    return v.raw_texts.select("event_id", text.map_values(F.col("member_text"), C.MEMBER_VALUES, "unknown").alias("member_casual"))


@query("flag_missing_vs_unparseable", """
WITH p AS (SELECT started_text, try_strptime(trim(started_text), ['%Y-%m-%d %H:%M:%S.%f', '%Y-%m-%d %H:%M:%S', '%Y-%m-%d %H:%M',
  '%m/%d/%Y %H:%M:%S', '%m/%d/%Y %H:%M', '%m/%d/%Y %H:%M:%S.%f']) AS t FROM raw_texts)
SELECT (started_text IS NULL OR trim(started_text) = '') AS missing,
  (t IS NULL AND NOT (started_text IS NULL OR trim(started_text) = '')) AS unparseable, count(*) AS n FROM p GROUP BY ALL""")
def _(v):
    raw = F.col("started_text")
    missing = C.is_blank(raw)
    return v.raw_texts.select(missing.alias("missing"), (text.parse_clock(raw).isNull() & ~missing).alias("unparseable")).groupBy(
        "missing", "unparseable").agg(F.count(F.lit(1)).alias("n"))


@query("derive_duration_minutes", "SELECT event_id, round(duration_minutes, 6) AS duration_minutes FROM trips")
def _(v):
    return v.trips.select("event_id", "duration_minutes")


@query("flag_valid_demand", "SELECT source_month, valid_demand, count(*) AS n FROM trips GROUP BY ALL")
def _(v):
    return v.trips.groupBy("source_month", "valid_demand").agg(F.count(F.lit(1)).alias("n"))


@query("flag_valid_coordinates", """
SELECT valid_start_coordinates, valid_end_coordinates, count(*) AS n FROM trips GROUP BY ALL""")
def _(v):
    return v.trips.groupBy("valid_start_coordinates", "valid_end_coordinates").agg(F.count(F.lit(1)).alias("n"))


@query("flag_duration_quality", "SELECT event_id, valid_duration, long_duration_flag FROM trips")
def _(v):
    return v.trips.select("event_id", "valid_duration", "long_duration_flag")


DST_SQL = """
WITH z AS (SELECT *,
  coalesce((month(started_at) = 11 AND day(started_at) <= 7 AND isodow(started_at) = 7 AND hour(started_at) = 1)
    OR (month(ended_at) = 11 AND day(ended_at) <= 7 AND isodow(ended_at) = 7 AND hour(ended_at) = 1), false) AS duration_ambiguous,
  (epoch_us(timezone('America/New_York', ended_at)) - epoch_us(timezone('America/New_York', started_at))) / 60000000.0::DOUBLE AS wall
  FROM dst_trips),
 physical AS (SELECT *, CASE WHEN reported_duration_seconds IS NOT NULL THEN reported_duration_seconds / 60.0 ELSE wall END AS duration_minutes FROM z)
"""

@query("dst_physical_duration", DST_SQL + """
SELECT event_id, round(duration_minutes, 6) AS duration_minutes FROM physical
WHERE NOT duration_ambiguous OR reported_duration_seconds IS NOT NULL""")
def _(v):
    rows = C.physical_duration(v.dst_trips).where(
        "NOT duration_ambiguous OR reported_duration_seconds IS NOT NULL")
    return rows.select("event_id", "duration_minutes")


@query("dst_ambiguous_flag", DST_SQL + "SELECT event_id, duration_ambiguous FROM physical")
def _(v):
    return C.physical_duration(v.dst_trips).select("event_id", "duration_ambiguous")


@query("label_availability_cutoff", """
SELECT event_id, coalesce(valid_demand AND ended_at < TIMESTAMP '2024-01-20' AND isfinite(d) AND d > 0, false) AS usable FROM (
  SELECT *, CASE WHEN reported_duration_seconds IS NOT NULL THEN reported_duration_seconds / 60.0 ELSE duration_minutes END AS d FROM trips)""")
def _(v):
    return C.physical_duration(v.trips, cutoff="2024-01-20").select("event_id", F.col("valid_duration").alias("usable"))


@query("norm_station_serialization", r"""
WITH s AS (SELECT event_id, start_station_name, start_lat, start_lng, (event_id % 90)::VARCHAR || '.' || (event_id % 7)::VARCHAR || '0' AS id FROM trips)
SELECT event_id, id, CASE WHEN regexp_full_match(id, '[0-9]+\.[0-9]+') AND start_station_name IS NOT NULL AND start_lat IS NOT NULL AND start_lng IS NOT NULL
  THEN rtrim(rtrim(id, '0'), '.') ELSE id END AS canonical_id FROM s""")
def _(v):
    e = F.col("event_id")
    made = F.concat((e % 90).cast("string"), F.lit("."), (e % 7).cast("string"), F.lit("0"))
    known = F.col("start_station_name").isNotNull() & F.col("start_lat").isNotNull() & F.col("start_lng").isNotNull()
    return v.trips.select("event_id", made.alias("id"), "start_station_name", "start_lat", "start_lng").select(
        "event_id", "id", text.trailing_zero_id(F.col("id"), known).alias("canonical_id"))


ALIAS_SQL = """
dup_ids AS (SELECT ride_id FROM trips_dup WHERE ride_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1),
alias_ids AS (SELECT ride_id FROM trips_dup WHERE ride_id IN (SELECT ride_id FROM dup_ids) GROUP BY ride_id
  HAVING (count(DISTINCT started_at) > 1 OR count(DISTINCT ended_at) > 1)
    AND count(DISTINCT date_trunc('second', started_at)) = 1 AND count(DISTINCT date_trunc('second', ended_at)) = 1
    AND count(*) FILTER (WHERE started_at = date_trunc('second', started_at) AND ended_at = date_trunc('second', ended_at)) > 0)"""


@query("norm_second_precision", f"""
WITH {ALIAS_SQL}
SELECT event_id, filename, CASE WHEN a THEN date_trunc('second', started_at) ELSE started_at END AS started_at,
  CASE WHEN a THEN date_trunc('second', ended_at) ELSE ended_at END AS ended_at,
  round(CASE WHEN a THEN (epoch_us(date_trunc('second', ended_at)) - epoch_us(date_trunc('second', started_at))) / 60000000.0::DOUBLE ELSE duration_minutes END, 6) AS duration_minutes
FROM (SELECT *, coalesce(ride_id IN (SELECT ride_id FROM alias_ids), false) AS a FROM trips_dup)""")
def _(v):
    rows = C.segment_normalised(v.trips_dup, D.time_alias_ids(v.trips_dup))
    return rows.select("event_id", "filename", "started_at", "ended_at", "duration_minutes")


@query("filter_bounding_box", """
SELECT event_id FROM trips WHERE start_lat BETWEEN 40 AND 41.5 AND start_lng BETWEEN -74 AND -73.6""")
def _(v):
    return C.in_box(v.trips, "start_lat", "start_lng", (40, 41.5, -74, -73.6)).select("event_id")


@query("check_history_contract", """
SELECT area, count(*) AS rows, count(*) FILTER (WHERE step = 0) AS duplicate_labels, count(*) FILTER (WHERE step > 1) AS gaps,
  count(*) FILTER (WHERE step > 0 AND step < 1) AS off_grid, (hour(min(timestamp)) <> 0)::INT AS starts_mid_day, (hour(max(timestamp)) <> 23)::INT AS ends_mid_day,
  count(*) FILTER (WHERE rides IS NULL OR rides < 0) AS bad_counts, 0::BIGINT AS future_filled, 0::BIGINT AS gap_hour_nonzero
FROM (SELECT *, (epoch_us(timestamp) - epoch_us(lag(timestamp) OVER (PARTITION BY area ORDER BY timestamp))) / 3600000000.0 AS step FROM hours)
GROUP BY area""")
def _(v):
    return S.contract_violations(v.hours)


# ---------------------------------------------------------------- counters and summaries

# Counters by what makes a row count; the names are the fixed output.
_BLANK = {"start_station_id": "missing_start_station", "end_station_id": "missing_end_station", "ride_id": "missing_ride_id"}
_MARKED = {"valid_demand": "valid_demand", "valid_duration": "valid_duration", "long_duration_flag": "long_duration"}
_LIMITS = {"negative_duration": "duration_minutes < 0", "nonpositive_duration": "NOT duration_minutes > 0",
           "reported_duration_mismatch": "@(reported_duration_seconds - 60 * duration_minutes) > 1",
           "outside_source_month": "NOT (valid_demand OR started_at IS NULL)",
           "unknown_bike_category": "rideable_type NOT IN ('classic_bike', 'docked_bike', 'electric_bike', 'unknown')"}


def _row_flags() -> dict[str, str]:
    flags = {name: f"{column} IS NULL" for column, name in _BLANK.items()} | {name: column for column, name in _MARKED.items()} | _LIMITS
    for side, column in (("start", "started_at"), ("end", "ended_at")):
        flags[f"missing_{column}"] = f"missing_{column}"
        flags[f"invalid_{side}"] = f"{column} IS NULL"
        flags[f"unparseable_{side}"] = f"NOT (missing_{column} OR {column} IS NOT NULL)"
        flags[f"bad_{side}_coordinates"] = f"NOT valid_{side}_coordinates"
    for short, column in (("member", "member_casual"), ("bike", "rideable_type")):
        flags[f"unknown_{short}"] = f"{column} = 'unknown'"
    return flags


QUALITY_SQL = {"rows": "count(*)"} | {name: f"sum(coalesce({flag}, false)::INT)" for name, flag in _row_flags().items()}
COUNTERS_SQL = ", ".join(f"({e})::BIGINT AS {k}" for k, e in QUALITY_SQL.items())


@query("agg_quality_counters", f"SELECT source_month, {COUNTERS_SQL} FROM trips GROUP BY 1")
def _(v):
    return A.quality(v.trips, ["source_month"])


@query("agg_monthly_summary", """
SELECT date_trunc('month', started_at) AS period, count(*) AS rides, round(quantile_cont(duration_minutes, 0.5) FILTER (WHERE valid_duration), 6) AS median_duration
FROM trips WHERE valid_demand GROUP BY 1""")
def _(v):
    return A.monthly_summary(v.trips)


@query("agg_user_bike", """
SELECT member_casual, rideable_type, count(*) AS rides, round(avg(duration_minutes) FILTER (WHERE valid_duration), 6) AS mean_duration,
  round(quantile_cont(duration_minutes, 0.5) FILTER (WHERE valid_duration), 6) AS median_duration
FROM trips WHERE valid_demand GROUP BY 1, 2""")
def _(v):
    return A.member_vehicle(v.trips)


@query("agg_type_pivot", """
SELECT rideable_type, count_if(member_casual = 'member')::BIGINT AS member, count_if(member_casual = 'casual')::BIGINT AS casual,
  count_if(member_casual = 'unknown')::BIGINT AS unknown, count(*) AS total FROM trips WHERE valid_demand GROUP BY 1""")
def _(v):
    return A.type_matrix(v.trips, ["member", "casual", "unknown"])


@query("agg_top_start_stations", """
SELECT start_station_id, count(*) AS rides, count(DISTINCT start_station_name) AS name_variants, count(DISTINCT year(started_at)) AS active_years,
  min(start_station_name) AS example_name FROM trips WHERE valid_demand AND start_station_id IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25""")
def _(v):
    return A.top_start_stations(v.trips)


@query("agg_top_end_stations", """
SELECT end_station_id, count(*) AS rides, min(end_station_name) AS example_name FROM trips
WHERE valid_demand AND end_station_id IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25""")
def _(v):
    return A.top_end_stations(v.trips)


@query("agg_top_routes", """
SELECT start_station_id, end_station_id, count(*) AS rides FROM trips
WHERE valid_demand AND start_station_id IS NOT NULL AND end_station_id IS NOT NULL GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 20""")
def _(v):
    return A.top_routes(v.trips)


@query("agg_net_flow", """
SELECT station_id, sum(net)::BIGINT AS net_inflow FROM (
  SELECT start_station_id AS station_id, -count(*) AS net FROM trips WHERE valid_demand AND start_station_id IS NOT NULL GROUP BY 1
  UNION ALL SELECT end_station_id, count(*) FROM trips WHERE valid_demand AND end_station_id IS NOT NULL GROUP BY 1)
GROUP BY 1 ORDER BY abs(sum(net)) DESC, 1 LIMIT 25""")
def _(v):
    return A.net_flow(v.trips)


DAILY_SQL = """SELECT date_trunc('day', started_at) AS day, member_casual, count(*) AS rides, avg(duration_minutes) AS mean_duration,
  quantile_cont(duration_minutes, 0.5) AS median_duration FROM trips WHERE valid_duration AND member_casual IN ('member', 'casual') GROUP BY 1, 2"""


@query("agg_duration_daily", f"""
SELECT * REPLACE (round(mean_duration, 6) AS mean_duration, round(median_duration, 6) AS median_duration) FROM ({DAILY_SQL})""")
def _(v):
    return A.duration_daily(v.trips)


@query("agg_duration_statistics", """
SELECT count(*) AS rides, round(avg(d), 6) AS mean, round(stddev_samp(d), 6) AS sd, round(quantile_cont(d, .25), 6) AS q25, round(quantile_cont(d, .5), 6) AS q50,
  round(quantile_cont(d, .75), 6) AS q75, round(quantile_cont(d, .95), 6) AS q95, round(quantile_cont(d, .99), 6) AS q99,
  round(min(d), 6) AS minimum, round(max(d), 6) AS maximum FROM (SELECT duration_minutes AS d FROM trips WHERE valid_duration)""")
def _(v):
    return A.duration_statistics(v.trips)


@query("agg_coordinate_quality", """
SELECT year(started_at)::INT AS year, count(*) AS rides, count_if(valid_start_coordinates AND valid_end_coordinates)::BIGINT AS valid_coordinates,
  count_if(start_station_id IS NULL)::BIGINT AS missing_start_station, count_if(end_station_id IS NULL)::BIGINT AS missing_end_station
FROM trips WHERE valid_demand GROUP BY 1""")
def _(v):
    return A.coordinate_quality(v.trips)


@query("agg_duration_policy", DST_SQL + """
SELECT count_if(duration_ambiguous AND reported_duration_seconds IS NULL)::BIGINT AS uncertain_physical_duration,
  count_if(valid_demand AND duration_minutes > 0 AND (reported_duration_seconds IS NOT NULL OR NOT duration_ambiguous))::BIGINT AS usable_physical_duration
FROM physical""")
def _(v):
    return A.duration_policy(C.physical_duration(v.dst_trips))


@query("agg_time_bounds", """
SELECT area, count(*) AS rows, min(started_at) AS first_start, max(started_at) AS last_start FROM trips WHERE valid_demand GROUP BY 1""")
def _(v):
    return A.time_bounds(v.trips, ["area"])


@query("agg_id_conflicts", f"""
SELECT ride_id, count(*) AS versions FROM (SELECT DISTINCT {CONTENT_SQL} FROM trips_dup WHERE ride_id IS NOT NULL) GROUP BY 1 HAVING count(*) > 1""")
def _(v):
    return D.conflicting_ids(v.trips_dup, D.CONTENT)


@query("agg_time_alias_ids", f"WITH {ALIAS_SQL} SELECT ride_id FROM alias_ids")
def _(v):
    return D.time_alias_ids(v.trips_dup)


@query("agg_segment_counts", """
SELECT filename, strftime(started_at, '%Y-%m') AS natural_month, count(*) AS n FROM trips_dup WHERE started_at IS NOT NULL AND NOT valid_demand GROUP BY 1, 2""")
def _(v):
    return D.spill_rows(v.trips_dup).groupBy("filename", "natural_month").agg(F.count(F.lit(1)).alias("n"))


@query("agg_uncovered_boundary", """
SELECT count(*) AS uncovered_rows FROM dst_trips WHERE strftime(started_at, '%Y-%m') NOT IN ('2024-02', '2024-03', '2024-10')""")
def _(v):
    months = v.spark.createDataFrame([("2024-02",), ("2024-03",), ("2024-10",)], "natural_month string")
    rows = v.dst_trips.select(F.date_format("started_at", "yyyy-MM").alias("natural_month"))
    return rows.join(months, "natural_month", "left_anti").agg(F.count(F.lit(1)).alias("uncovered_rows"))


PREFER_SQL = f"""{ALIAS_SQL},
ranked AS (SELECT *, row_number() OVER (PARTITION BY ride_id ORDER BY
    CASE WHEN ride_id IN (SELECT ride_id FROM alias_ids)
      AND (started_at <> date_trunc('second', started_at) OR ended_at <> date_trunc('second', ended_at)) THEN 0 ELSE 1 END,
    valid_demand DESC, filename, {CONTENT_SQL}) AS rn FROM trips_dup WHERE ride_id IS NOT NULL),
spills AS (SELECT *, strftime(started_at, '%Y-%m') AS natural_month FROM trips_dup WHERE started_at IS NOT NULL AND NOT valid_demand)"""
NO_ID = ", ".join(c for c in D.CONTENT if c != "ride_id")
SAME = " AND ".join(f"n.{c} IS NOT DISTINCT FROM s.{c}" for c in D.CONTENT if c != "ride_id")
CONTAIN_SQL = f"""
seg AS (SELECT filename, natural_month, {NO_ID}, count(*) AS need FROM spills WHERE ride_id IS NULL GROUP BY ALL),
nat AS (SELECT strftime(started_at, '%Y-%m') AS natural_month, {NO_ID}, count(*) AS have FROM trips_dup WHERE valid_demand AND ride_id IS NULL GROUP BY ALL),
proof AS (SELECT s.filename, s.natural_month, sum(need)::BIGINT AS rows, sum(greatest(need - coalesce(have, 0), 0))::BIGINT AS unmatched_rows
  FROM seg s LEFT JOIN nat n ON n.natural_month = s.natural_month AND {SAME} GROUP BY 1, 2)"""
ALIGN_SQL = f"""{PREFER_SQL}, {CONTAIN_SQL},
months AS (SELECT DISTINCT source_month AS m FROM trips_dup),
kept AS (SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1 UNION ALL SELECT * FROM trips_dup WHERE ride_id IS NULL),
survivors AS (SELECT k.*, CASE WHEN strftime(k.started_at, '%Y-%m') IN (SELECT m FROM months) THEN strftime(k.started_at, '%Y-%m') ELSE k.source_month END AS target_month
  FROM kept k WHERE NOT (k.ride_id IS NULL AND NOT k.valid_demand AND EXISTS (SELECT 1 FROM proof p
    WHERE p.unmatched_rows = 0 AND p.filename = k.filename AND p.natural_month = strftime(k.started_at, '%Y-%m'))))"""


@query("set_multiset_contained", f"""
WITH {PREFER_SQL}, {CONTAIN_SQL} SELECT *, unmatched_rows = 0 AS proven_copy FROM proof""")
def _(v):
    return D.segment_containment(v.trips_dup)


@query("set_month_reassignment", f"""
WITH {ALIGN_SQL} SELECT event_id, source_month, target_month, coalesce(strftime(started_at, '%Y-%m') = target_month, false) AS valid_demand,
  coalesce(strftime(started_at, '%Y-%m') = target_month AND duration_minutes > 0, false) AS valid_duration FROM survivors""")
def _(v):
    return D.align_months(v.trips_dup).select("event_id", "source_month", "target_month", "valid_demand", "valid_duration")


@query("agg_partition_reconciliation", f"""
WITH {ALIGN_SQL},
 gone AS (SELECT source_month FROM ranked WHERE rn > 1 UNION ALL
   SELECT t.source_month FROM spills t JOIN proof p ON p.filename = t.filename AND p.natural_month = t.natural_month AND p.unmatched_rows = 0 WHERE t.ride_id IS NULL),
 facts AS (SELECT source_month AS m, 1 AS raw, 0 AS came, 0 AS went, 0 AS stayed, 0 AS dropped FROM trips_dup
   UNION ALL SELECT source_month, 0, 0, (source_month <> target_month)::INT, 0, 0 FROM survivors
   UNION ALL SELECT target_month, 0, (source_month <> target_month)::INT, 0, 1, 0 FROM survivors
   UNION ALL SELECT source_month, 0, 0, 0, 0, 1 FROM gone)
SELECT m AS source_month, sum(raw)::BIGINT AS raw_rows, sum(came)::BIGINT AS moved_in, sum(went)::BIGINT AS moved_out, sum(stayed)::BIGINT AS retained_rows,
  sum(dropped)::BIGINT AS removed_rows, sum(raw) + sum(came) - sum(went) = sum(stayed) + sum(dropped) AS balanced FROM facts GROUP BY 1""")
def _(v):
    return A.reconciliation(v.trips_dup, D.align_months(v.trips_dup), D.removed_rows(v.trips_dup))


@query("agg_manifest_by_area", f"""
WITH q AS (SELECT area, source_month, {COUNTERS_SQL} FROM trips GROUP BY ALL),
 s AS (SELECT area, {', '.join(f'sum({k})::BIGINT AS {k}' for k in QUALITY_SQL)} FROM q GROUP BY 1)
SELECT area, counter, total FROM (UNPIVOT s ON {', '.join(QUALITY_SQL)} INTO NAME counter VALUE total)""")
def _(v):
    parts = A.quality(v.trips, ["area", "source_month"])
    total = parts.groupBy("area").agg(*[F.sum(k).alias(k) for k in A.quality_counters()])
    return total.unpivot(["area"], list(A.quality_counters()), "counter", "total")


@query("agg_extreme_counts", """
SELECT count(*) AS rows, count_if(duration_minutes > 1440)::BIGINT AS over_24h, count_if(duration_minutes > 10080)::BIGINT AS over_7days,
  round(quantile_cont(duration_minutes, 0.5), 6) AS median_minutes, round(max(duration_minutes), 6) AS maximum_minutes FROM trips WHERE valid_duration""")
def _(v):
    return A.extreme_counts(v.trips.where("valid_duration"))


FIELDS = ("rideable_type", "started_at", "ended_at", "start_station_id", "start_lng", "bike_id", "reported_duration_seconds", "filename")


@query("agg_inconsistent_field_counts", f"""
WITH g AS (SELECT ride_id, {', '.join(f"(count(DISTINCT {c}) + (CASE WHEN count({c}) < count(*) THEN 1 ELSE 0 END) > 1)::INT AS {c}" for c in FIELDS)}
  FROM trips_dup WHERE ride_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1),
 s AS (SELECT {', '.join(f'sum({c})::BIGINT AS {c}' for c in FIELDS)} FROM g)
SELECT "column", ids FROM (UNPIVOT s ON {', '.join(FIELDS)} INTO NAME "column" VALUE ids)""")
def _(v):
    return D.inconsistent_fields(v.trips_dup, FIELDS)


@query("agg_histogram_bins", """
WITH b AS (SELECT min(duration_minutes) AS lo, max(duration_minutes) AS hi FROM trips WHERE valid_duration),
 t AS (SELECT duration_minutes AS d FROM trips WHERE valid_duration)
SELECT 'linear' AS scale, least(1 + floor((d - lo) / (hi - lo) * 20), 20)::BIGINT AS bin, count(*) AS n FROM t, b GROUP BY ALL
UNION ALL SELECT 'log', least(1 + floor((ln(d) - ln(lo)) / (ln(hi) - ln(lo)) * 20), 20)::BIGINT, count(*) FROM t, b GROUP BY ALL""")
def _(v):
    rows = v.trips.where("valid_duration")
    lo, hi = rows.agg(F.min("duration_minutes")).scalar(), rows.agg(F.max("duration_minutes")).scalar()
    parts = [A.equal_width_bins(rows, "duration_minutes", lo, hi, 20, log).select(F.lit(name).alias("scale"), "bin", "n")
             for name, log in (("linear", False), ("log", True))]
    return parts[0].unionByName(parts[1])


@query("agg_spatial_bins", """
SELECT floor(round(start_lat / 0.05, 6))::BIGINT AS lat_bin, floor(round(start_lng / 0.05, 6))::BIGINT AS lng_bin, count(*) AS n FROM trips
WHERE start_lat BETWEEN 40 AND 41.5 AND start_lng BETWEEN -75 AND -73 GROUP BY 1, 2""")
def _(v):
    return A.spatial_bins(C.in_box(v.trips, "start_lat", "start_lng", (40, 41.5, -75, -73)), "start_lat", "start_lng", 0.05)


@query("agg_hexagon_bins", """
WITH p AS (SELECT (start_lng + 75) / (2 / 45.0::DOUBLE) AS x, (start_lat - 40) / (1.5::DOUBLE / 25) AS y FROM trips WHERE start_lat BETWEEN 40 AND 41.5 AND start_lng BETWEEN -75 AND -73),
 c AS (SELECT x, y, floor(x + 0.5) AS x1, floor(y + 0.5) AS y1, floor(x) + 0.5::DOUBLE AS x2, floor(y) + 0.5::DOUBLE AS y2 FROM p),
 d AS (SELECT *, round(power(x - x1, 2) + 3 * power(y - y1, 2), 9) <= round(power(x - x2, 2) + 3 * power(y - y2, 2), 9) AS plain FROM c)
SELECT round(40 + CASE WHEN plain THEN y1 ELSE y2 END * (1.5::DOUBLE / 25), 6) AS lat, round(-75 + CASE WHEN plain THEN x1 ELSE x2 END * (2 / 45.0::DOUBLE), 6) AS lng, count(*) AS n
FROM d GROUP BY 1, 2""")
def _(v):
    box = (40, 41.5, -75, -73)
    return A.hexagon_bins(C.in_box(v.trips, "start_lat", "start_lng", box), "start_lat", "start_lng", box)


@query("agg_monthly_sketches", """
SELECT date_trunc('month', started_at) AS period, count(*) AS rides, count_if(valid_duration)::BIGINT AS valid, true AS near_median FROM trips WHERE valid_demand GROUP BY 1""")
def _(v):
    """Medians per month merged from the sketches of seven parts: their ranks lie within 2 % of one half."""
    minutes = A.usable_minutes()
    rows = v.trips.where("valid_demand").withColumn("period", clock.trunc("month", F.col("started_at")))
    parts = K.quantile_parts(rows.withColumn("part", F.dayofmonth("started_at") % 7), "part", minutes, ["period"])
    marks = K.merged_quantiles(parts, ["period"], {"median": 0.5})
    placed = rows.select("period", minutes.alias("__m")).join(marks.select("period", "median"), "period").groupBy("period").agg(
        F.avg((F.col("__m") < F.col("median")).cast("int")).alias("below"), F.avg((F.col("__m") <= F.col("median")).cast("int")).alias("upto"))
    near = (F.col("below") <= 0.52) & (F.col("upto") >= 0.48)
    return marks.join(placed, "period").select("period", F.col("rows").alias("rides"), "valid", near.alias("near_median"))


@query("agg_box_stats", """
WITH t AS (SELECT member_casual, duration_minutes AS d FROM trips WHERE valid_duration),
 q AS (SELECT member_casual, quantile_cont(d, .25) AS q1, quantile_cont(d, .5) AS median, quantile_cont(d, .75) AS q3 FROM t GROUP BY 1)
SELECT member_casual, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  round(min(d) FILTER (WHERE d BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5), 6) AS whisker_low,
  round(max(d) FILTER (WHERE d BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5), 6) AS whisker_high
FROM t JOIN q USING (member_casual) GROUP BY ALL""")
def _(v):
    return A.box_stats(v.trips.where("valid_duration"), "member_casual", "duration_minutes")


# ---------------------------------------------------------------- copies, sets


@query("join_semi_duplicate_ids", """
SELECT event_id, ride_id, filename FROM trips_dup WHERE ride_id IN (SELECT ride_id FROM trips_dup WHERE ride_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)""")
def _(v):
    return D.duplicate_rows(v.trips_dup).select("event_id", "ride_id", "filename")


@query("join_anti_not_exists", f"""
WITH {PREFER_SQL}, {CONTAIN_SQL}, gone AS (SELECT filename, ride_id FROM ranked WHERE rn > 1)
SELECT s.event_id, s.filename, s.natural_month FROM spills s
WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.filename = s.filename AND g.ride_id = s.ride_id)
  AND NOT EXISTS (SELECT 1 FROM proof p WHERE p.unmatched_rows = 0 AND p.filename = s.filename AND p.natural_month = s.natural_month AND s.ride_id IS NULL)""")
def _(v):
    rows = v.trips_dup
    best = D.preferred_version(rows, D.time_alias_ids(rows))
    key = ["filename", "ride_id"]
    surplus = D.signed_counts(rows.where("ride_id IS NOT NULL"), best, key).where("surplus > 0")
    proven = D.segment_containment(rows).where("proven_copy")
    return D.accepted_spills(rows, surplus, proven).select("event_id", "filename", "natural_month")


DEDUP_SQL = f"""
SELECT {', '.join(f'round({c}, 6) AS {c}' if c in ('duration_minutes', 'start_lat', 'start_lng', 'end_lat', 'end_lng', 'reported_duration_seconds') else c for c in D.CONTENT)} FROM (
 SELECT {CONTENT_SQL} FROM trips_dup WHERE ride_id IS NULL UNION ALL
 SELECT {CONTENT_SQL} FROM (SELECT *, row_number() OVER (PARTITION BY ride_id ORDER BY started_at,
   {', '.join(c + ' NULLS FIRST' for c in D.CONTENT)}) AS rn FROM trips_dup WHERE ride_id IS NOT NULL) WHERE rn = 1)"""


@query("win_dedup_first", DEDUP_SQL)
def _(v):
    return D.dedup_first(v.trips_dup, columns=D.CONTENT)


@query("win_dedup_preference", f"""
WITH {PREFER_SQL} SELECT ride_id, filename, valid_demand, started_at FROM ranked WHERE rn = 1""")
def _(v):
    rows = v.trips_dup
    best = D.preferred_version(rows, D.time_alias_ids(rows))
    return best.select("ride_id", "filename", "valid_demand", "started_at")


@query("set_multiset_equal", f"""
WITH a AS (SELECT {CONTENT_SQL} FROM trips), b AS (SELECT {CONTENT_SQL} FROM trips_dup),
 l AS (SELECT count(*) AS n FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)), r AS (SELECT count(*) AS n FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a))
SELECT l.n AS only_left, r.n AS only_right, l.n = 0 AND r.n = 0 AS equal FROM l, r""")
def _(v):
    return D.multiset_difference(v.trips, v.trips_dup, D.CONTENT)


@query("set_union_all", """
SELECT event_id, filename, started_at FROM trips WHERE ride_id IS NULL UNION ALL
SELECT event_id, filename, started_at FROM trips_dup WHERE NOT valid_demand""")
def _(v):
    cols = ["event_id", "filename", "started_at"]
    return D.union_all(v.trips.where("ride_id IS NULL").select(*cols), v.trips_dup.where("NOT valid_demand").select(*cols))


# ---------------------------------------------------------------- sampling

SAMPLE_KEY = "concat_ws('|', strftime(started_at, '%Y-%m-%d %H:%M:%S.%f'), strftime(ended_at, '%Y-%m-%d %H:%M:%S.%f'), ride_id, bike_id)"
SAMPLE_SQL = f"""
sample AS (SELECT ride_id, bike_id, started_at, ended_at, start_station_id, member_casual, round(duration_minutes, 6) AS duration_minutes, md5({SAMPLE_KEY}) AS key
FROM trips_dup WHERE valid_duration AND ('0x' || substr(md5({SAMPLE_KEY}), 1, 8))::BIGINT % 10 = 0)"""


def sample_rows(v, share: int = 10):
    stamp = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    parts = [F.date_format("started_at", stamp), F.date_format("ended_at", stamp), F.col("ride_id"), F.col("bike_id")]
    rows = v.trips_dup.where(F.col("valid_duration") & (hashing.hash_mod(share, *parts) == 0))
    return rows.select("ride_id", "bike_id", "started_at", "ended_at", "start_station_id", "member_casual",
                       F.round("duration_minutes", 6).alias("duration_minutes"), hashing.md5_key(*parts).alias("key"))


@query("sample_hash_deterministic", f"WITH {SAMPLE_SQL} SELECT * FROM sample")
def _(v):
    return sample_rows(v)


@query("sample_duplicate_audit", f"""
WITH {SAMPLE_SQL} SELECT sum(n)::BIGINT AS sample_rows, sum(n - 1)::BIGINT AS duplicate_rows FROM (SELECT count(*) AS n FROM sample GROUP BY ALL
  HAVING true) WHERE n IS NOT NULL""".replace("SELECT count(*) AS n FROM sample GROUP BY ALL\n  HAVING true",
  "SELECT count(*) AS n FROM sample GROUP BY ride_id, bike_id, started_at, ended_at, start_station_id, member_casual, duration_minutes, key"))
def _(v):
    sample = sample_rows(v)
    return sample.groupBy(*sample.columns).agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").alias("sample_rows"), F.sum(F.col("n") - 1).alias("duplicate_rows"))


@query("topk_extremes", """
SELECT event_id, started_at, ended_at, round(duration_minutes, 6) AS duration_minutes, member_casual, rideable_type FROM trips WHERE valid_duration
ORDER BY trips.duration_minutes DESC, event_id LIMIT 10""")
def _(v):
    return A.extremes(v.trips.where("valid_duration"), "duration_minutes",
                      ["event_id", "started_at", "ended_at", "duration_minutes", "member_casual", "rideable_type"], "event_id")


# ---------------------------------------------------------------- stages, coverage


@query("src_parquet_stage_scan", """
WITH t AS (SELECT CASE WHEN event_id % 5 = 0 THEN 'JC' ELSE 'NYC' END AS area, started_at FROM trips)
SELECT area, CASE WHEN started_at < TIMESTAMP '2024-01-15' THEN 'development' ELSE 'validation' END AS stage, count(*) AS n,
  min(started_at) AS first_start, max(started_at) AS last_start FROM t WHERE started_at < TIMESTAMP '2024-01-25' GROUP BY ALL""")
def _(v):
    from tallyridge.plans.sources import LOCAL_WORK
    from tallyridge.sources.sinks import write_partitioned
    from tallyridge.streaming.demand import work_folder

    periods = stages.StagePeriods("2024-01-15", "2024-01-25", "2024-02-01")
    path = work_folder(v.spark, LOCAL_WORK) + "/trips"
    rows = v.trips.select(F.when(F.col("event_id") % 5 == 0, "JC").otherwise("NYC").alias("area"), "event_id", "started_at",
                          F.year("started_at").alias("year"), F.month("started_at").alias("month"))
    write_partitioned(rows, path, ["area", "year", "month"])
    out = [stages.stage_scan(v.spark, path, area, stage, periods).select("area", F.lit(stage).alias("stage"), "started_at")
           for area in ("NYC", "JC") for stage in ("development", "validation")]
    return D.union_all(*out).groupBy("area", "stage").agg(
        F.count(F.lit(1)).alias("n"), F.min("started_at").alias("first_start"), F.max("started_at").alias("last_start"))


@query("split_stage_periods", """
SELECT CASE WHEN started_at < TIMESTAMP '2024-01-15' THEN 'development' WHEN started_at < TIMESTAMP '2024-01-25' THEN 'validation'
  WHEN started_at < TIMESTAMP '2024-02-01' THEN 'test' END AS stage, count(*) AS n FROM trips GROUP BY 1""")
def _(v):
    periods = stages.StagePeriods("2024-01-15", "2024-01-25", "2024-02-01")
    return v.trips.groupBy(periods.label(F.col("started_at")).alias("stage")).agg(F.count(F.lit(1)).alias("n"))


@query("src_manifest_coverage", """
WITH m AS (SELECT DISTINCT area, date_trunc('month', started_at) AS month FROM dst_trips),
 s AS (SELECT area, min(month) AS a, max(month) AS b FROM m GROUP BY 1),
 f AS (SELECT area, unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS month FROM s),
 x AS (SELECT area, count(*) AS n, string_agg(strftime(month, '%Y-%m'), ',' ORDER BY month) AS t FROM (SELECT * FROM f EXCEPT SELECT area, month FROM m) GROUP BY 1)
SELECT s.area, strftime(a, '%Y-%m') AS first_month, strftime(b, '%Y-%m') AS last_month, coalesce(n, 0) AS missing_count, coalesce(t, '') AS missing_months
FROM s LEFT JOIN x ON x.area = s.area""")
def _(v):
    months = v.dst_trips.select("area", clock.trunc("month", F.col("started_at")).alias("month")).distinct()
    return S.month_coverage(months)


@query("src_dataset_fingerprint")
def _(v):
    return stages.partition_fingerprints(v.trips, ["area", "source_month"], list(D.CONTENT))


@query("src_history_csv_validate", r"""
WITH t AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:00:00') WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:00') WHEN 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
    WHEN 3 THEN strftime(ts, '%Y-%m-%d %H:00:00') || 'Z' ELSE strftime(ts, '%Y-%m-%d %H:00:00.000') END AS timestamp,
  CASE event_id % 7 WHEN 0 THEN '' WHEN 1 THEN '-3' WHEN 2 THEN 'many' WHEN 3 THEN 'Infinity' ELSE user_id::VARCHAR END AS rides,
  CASE WHEN event_id % 11 = 0 THEN 'JC' ELSE 'NYC' END AS area FROM events)
SELECT event_id, CASE WHEN area <> 'NYC' THEN 'foreign area'
  WHEN NOT regexp_full_match(timestamp, '\d{4}-\d{2}-\d{2}[T ]\d{2}:00(:00(\.0+)?)?') THEN 'not a local hour label'
  WHEN try_cast(rides AS DOUBLE) IS NULL OR NOT isfinite(try_cast(rides AS DOUBLE)) OR try_cast(rides AS DOUBLE) < 0 THEN 'invalid count' END AS reject_reason FROM t""")
def _(v):
    from tallyridge.sources.delimited import history_reject_reason

    e, ts = F.col("event_id"), F.col("ts")
    hour = F.date_format(ts, "yyyy-MM-dd HH:00:00")
    rows = v.table("events").select(
        e,
        F.when(e % 6 == 0, hour).when(e % 6 == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:00")).when(e % 6 == 2, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
         .when(e % 6 == 3, F.concat(hour, F.lit("Z"))).otherwise(F.concat(hour, F.lit(".000"))).alias("timestamp"),
        F.when(e % 7 == 0, "").when(e % 7 == 1, "-3").when(e % 7 == 2, "many").when(e % 7 == 3, "Infinity")
         .otherwise(F.col("user_id").cast("string")).alias("rides"),
        F.when(e % 11 == 0, "JC").otherwise("NYC").alias("area"))
    return rows.select("event_id", history_reject_reason("NYC").alias("reject_reason"))
