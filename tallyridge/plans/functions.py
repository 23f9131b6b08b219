"""One registered query per scalar-function family."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyridge.functions import clock, hashing, numeric
from tallyridge.plans.catalog import query


@query("fn_string", r"""
SELECT event_id, lower(trim(member_text)) AS lowered, nullif(trim(station_text), '') AS trimmed, coalesce(vehicle_text, 'none') AS filled,
  regexp_replace(coalesce(started_text, ''), '[0-9]+', '#', 'g') AS masked, regexp_full_match(coalesce(bike_id, ''), '[0-9]+') AS numeric_id,
  rtrim(lat_text, '0') AS rtrimmed, len(regexp_extract_all(coalesce(started_text, ''), '[0-9]+')) AS numbers,
  array_to_string(list_transform(string_split('[' || coalesce(vehicle_text, '') || ', x]', ','), lambda t: trim(t, ' []')), '|') AS cleaned FROM raw_texts""")
def _(v):
    text = F.coalesce("started_text", F.lit(""))
    listed = F.concat(F.lit("["), F.coalesce("vehicle_text", F.lit("")), F.lit(", x]"))
    return v.raw_texts.select(
        "event_id", F.lower(F.trim("member_text")).alias("lowered"), F.nullif(F.trim("station_text"), F.lit("")).alias("trimmed"),
        F.coalesce("vehicle_text", F.lit("none")).alias("filled"), F.regexp_replace(text, "[0-9]+", "#").alias("masked"),
        F.coalesce("bike_id", F.lit("")).rlike("^[0-9]+$").alias("numeric_id"), F.rtrim("lat_text", F.lit("0")).alias("rtrimmed"),
        F.size(F.regexp_extract_all(text, F.lit("[0-9]+"), F.lit(0))).cast("bigint").alias("numbers"),
        F.array_join(F.transform(F.split(listed, ","), lambda t: F.btrim(t, F.lit(" []"))), "|").alias("cleaned"))


@query("fn_datetime", """
SELECT event_id, year(ts)::INT AS y, month(ts)::INT AS m, day(ts)::INT AS d, (isodow(ts) - 1)::INT AS weekday, hour(ts)::INT AS h, dayofyear(ts)::INT AS doy, date_trunc('hour', ts) AS hour_label,
  date_trunc('week', ts)::TIMESTAMP AS monday, strftime(ts, '%Y-%m') AS month_text, round(epoch_us(ts) / 60000000.0, 6) AS minutes, epoch_us(timezone('America/New_York', ts)) AS instant,
  CASE WHEN month(ts) IN (12, 1, 2) THEN 'winter' WHEN month(ts) IN (3, 4, 5) THEN 'spring' WHEN month(ts) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season FROM events""")
def _(v):
    ts = F.col("ts")
    return v.table("events").select(
        "event_id", F.year(ts).alias("y"), F.month(ts).alias("m"), F.dayofmonth(ts).alias("d"), F.weekday(ts).alias("weekday"), F.hour(ts).alias("h"), F.dayofyear(ts).alias("doy"),
        clock.trunc("hour", ts).alias("hour_label"), clock.monday_of(ts).alias("monday"), F.date_format(ts, "yyyy-MM").alias("month_text"),
        (clock.micros(ts) / 60_000_000.0).alias("minutes"), F.unix_micros(F.to_utc_timestamp(ts.cast("timestamp"), clock.ZONE)).alias("instant"), clock.season(ts).alias("season"))


@query("fn_math", """
SELECT event_id, round(value, 1) AS rounded, abs(value - 100) AS gap, isfinite(value) AS finite, round(sin(2 * pi() * hour(ts) / 24), 6) + 0 AS s, round(cos(2 * pi() * hour(ts) / 24), 6) + 0 AS c,
  greatest(least(value, 50.0), 5.0)::DOUBLE AS clipped, round(value / (nullif(user_id, 0) + 0.5), 6) AS ratio FROM events""")
def _(v):
    x = F.col("value")
    angle = F.hour("ts") * (2 * F.pi() / 24)
    return v.table("events").select(
        "event_id", F.round(x, 1).alias("rounded"), F.abs(x - 100).alias("gap"), numeric.finite(x).alias("finite"), F.sin(angle).alias("s"), F.cos(angle).alias("c"),
        F.greatest(F.least(x, F.lit(50.0)), F.lit(5.0)).alias("clipped"), numeric.ratio(x, F.nullif(F.col("user_id"), F.lit(0).cast("bigint")) + 0.5).alias("ratio"))


@query("fn_array", """
SELECT event_id, round(0.5 * value + 0.3 * user_id + 0.2 * (event_id % 10), 6) AS weighted, list_max([value, user_id::DOUBLE]) AS top, len([user_id, event_id]) AS n FROM events""")
def _(v):
    parts = F.array(F.col("value"), F.col("user_id").cast("double"), (F.col("event_id") % 10).cast("double"))
    weights = F.array(F.lit(0.5), F.lit(0.3), F.lit(0.2))
    return v.table("events").select(
        "event_id", F.aggregate(F.zip_with(parts, weights, lambda a, b: a * b), F.lit(0.0), lambda s, t: s + t).alias("weighted"),
        F.array_max(F.array(F.col("value"), F.col("user_id").cast("double"))).alias("top"), F.size(F.array("user_id", "event_id")).cast("bigint").alias("n"))


@query("fn_conditional", """
SELECT event_id, CASE WHEN user_id % 13 <= 2 THEN '0-2' WHEN user_id % 13 <= 4 THEN '3-4' ELSE '5+' END AS bin, try_cast(lat_text AS DOUBLE) IS NULL AS bad, coalesce(try_cast(bike_id AS BIGINT), -1) AS bike
FROM raw_texts JOIN (SELECT event_id, user_id FROM events) USING (event_id)""")
def _(v):
    users = v.table("events").select("event_id", "user_id")
    n = F.col("user_id") % 13
    return v.raw_texts.join(users, "event_id").select(
        "event_id", F.when(n <= 2, "0-2").when(n <= 4, "3-4").otherwise("5+").alias("bin"), F.col("lat_text").try_cast("double").isNull().alias("bad"),
        F.coalesce(F.col("bike_id").try_cast("bigint"), F.lit(-1).cast("bigint")).alias("bike"))


@query("fn_hash", """
SELECT event_id, md5(event_type) AS m, sha256(event_type) AS s, ('0x' || substr(md5(concat_ws('|', event_id::VARCHAR, '7')), 1, 8))::BIGINT % 1000 AS slot FROM events""")
def _(v):
    return v.table("events").select("event_id", F.md5("event_type").alias("m"), F.sha2("event_type", 256).alias("s"), hashing.hash_mod(1000, F.col("event_id"), "7").alias("slot"))


@query("fn_json", """
SELECT event_id, (props->>'k')::BIGINT AS k, '{"id":' || event_id || ',"type":"' || event_type || '"}' AS doc FROM events""")
def _(v):
    parsed = F.from_json("props", "k bigint")
    return v.table("events").select("event_id", parsed["k"].alias("k"), F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type"))).alias("doc"))


@query("fn_map", """
SELECT row_id, CASE label WHEN 'e' THEN 0 WHEN 'p' THEN 1 END::INT AS y, CASE kind WHEN 'SMALL' THEN 's' WHEN 'LARGE' THEN 'l' END AS code FROM items""")
def _(v):
    y = F.create_map(F.lit("e"), F.lit(0), F.lit("p"), F.lit(1))
    code = F.create_map(F.lit("SMALL"), F.lit("s"), F.lit("LARGE"), F.lit("l"))
    return v.items.select("row_id", F.try_element_at(y, F.col("label")).alias("y"), F.try_element_at(code, F.col("kind")).alias("code"))
