"""The tables the registered queries run on, in Spark and as SQL text.

Every view is derived from the given parquet tables; ids, nulls, copies and
conflicts come from modular arithmetic so both engines build the same rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyridge.functions import clock
from tallyridge.session import prepare_session

TRIP_FIELDS = (
    "ride_id", "rideable_type", "started_at", "ended_at", "start_station_id", "start_station_name",
    "end_station_id", "end_station_name", "start_lat", "start_lng", "end_lat", "end_lng",
    "member_casual", "bike_id", "reported_duration_seconds",
)
MODELS = ("rf", "gb", "lr")

_FLAGS_SQL = """
  missing_started_at, missing_ended_at, 'NYC' AS area, source_month, filename,
  (epoch_us(ended_at) - epoch_us(started_at)) / 60000000.0::DOUBLE AS duration_minutes,
  coalesce(strftime(started_at, '%Y-%m') = source_month, false) AS valid_demand,
  coalesce(start_lat BETWEEN -90 AND 90 AND start_lng BETWEEN -180 AND 180, false) AS valid_start_coordinates,
  coalesce(end_lat BETWEEN -90 AND 90 AND end_lng BETWEEN -180 AND 180, false) AS valid_end_coordinates,
  coalesce(strftime(started_at, '%Y-%m') = source_month AND epoch_us(ended_at) > epoch_us(started_at), false) AS valid_duration,
  coalesce((epoch_us(ended_at) - epoch_us(started_at)) / 60000000.0 > 1440, false) AS long_duration_flag
"""

VIEW_SQL = {
    "base_trips": """
SELECT event_id, CASE WHEN event_id % 13 <> 0 THEN event_id::VARCHAR END AS ride_id,
  CASE event_id % 3 WHEN 0 THEN 'electric_bike' WHEN 1 THEN 'classic_bike' ELSE 'unknown' END AS rideable_type,
  ts AS started_at,
  CASE WHEN event_id % 41 <> 0 THEN ts + to_microseconds(round(value * 100)::BIGINT * 600000 *
    (CASE WHEN event_id % 211 = 0 THEN 30 WHEN event_id % 223 = 0 THEN -1 ELSE 1 END)) END AS ended_at,
  CASE WHEN event_id % 17 <> 0 THEN 'S' || (user_id % 50)::VARCHAR END AS start_station_id,
  CASE WHEN event_id % 17 <> 0 THEN (CASE WHEN event_id % 31 = 0 THEN 'STOP ' ELSE 'Stop ' END) || (user_id % 50)::VARCHAR END AS start_station_name,
  CASE WHEN event_id % 19 <> 0 THEN 'S' || ((user_id * 7 + event_id) % 50)::VARCHAR END AS end_station_id,
  CASE WHEN event_id % 19 <> 0 THEN 'Stop ' || ((user_id * 7 + event_id) % 50)::VARCHAR END AS end_station_name,
  CASE WHEN user_id % 29 = 0 THEN 200.0::DOUBLE ELSE 40 + (user_id % 200) / 100.0::DOUBLE END AS start_lat,
  CASE WHEN event_id % 23 <> 0 THEN -74 + (user_id % 100) / 200.0::DOUBLE END AS start_lng,
  CASE WHEN event_id % 19 <> 0 THEN 40.5::DOUBLE + (user_id % 7) / 10.0::DOUBLE END AS end_lat,
  -74 + (event_id % 100) / 200.0::DOUBLE AS end_lng,
  CASE WHEN event_type IN ('click', 'view') THEN 'member' WHEN event_type IN ('purchase', 'signup') THEN 'casual' ELSE 'unknown' END AS member_casual,
  CASE WHEN event_id % 4 = 0 THEN user_id::VARCHAR END AS bike_id,
  CASE WHEN event_id % 4 = 0 THEN value * 60 + (event_id % 5) END AS reported_duration_seconds,
  false AS missing_started_at, (event_id % 82 = 0) AS missing_ended_at,
  CASE WHEN event_id % 37 = 0 THEN '2023-12' ELSE '2024-01' END AS source_month,
  CASE WHEN event_id % 37 = 0 THEN 'p/2023-12' ELSE 'p/2024-01' END AS filename
FROM events""",
    "raw_texts": """
SELECT event_id, CASE event_id % 8 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f') WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
    WHEN 2 THEN strftime(ts, '%Y-%m-%d %H:%M') WHEN 3 THEN ' ' || strftime(ts, '%m/%d/%Y %H:%M:%S') || ' '
    WHEN 4 THEN strftime(ts, '%-m/%-d/%Y %-H:%M') WHEN 5 THEN 'not a time ' || event_id WHEN 6 THEN '  ' END AS started_text,
  CASE WHEN event_id % 3 = 0 THEN (user_id % 50)::VARCHAR || '.0' WHEN event_id % 3 = 1 THEN ' 0' || (user_id % 50)::VARCHAR ELSE ' ' END AS station_text,
  CASE WHEN event_id % 4 = 0 THEN user_id::VARCHAR END AS bike_id,
  CASE WHEN event_id % 5 = 0 THEN 'n/a' ELSE (40 + value / 100000)::DECIMAL(18, 9)::VARCHAR END AS lat_text,
  CASE event_type WHEN 'click' THEN 'Subscriber' WHEN 'view' THEN ' customer' WHEN 'purchase' THEN 'MEMBER' WHEN 'signup' THEN 'casual ' ELSE event_type END AS member_text,
  CASE event_id % 3 WHEN 0 THEN ' Electric_Bike ' WHEN 1 THEN '' END AS vehicle_text
FROM events""",
    "trips": f"SELECT event_id, {', '.join(TRIP_FIELDS)}, {_FLAGS_SQL} FROM base_trips",
    "trips_dup": f"""
SELECT event_id, {', '.join(TRIP_FIELDS)}, {_FLAGS_SQL} FROM (
  SELECT * FROM base_trips
  UNION ALL SELECT * REPLACE ('2024-02' AS source_month, 'p/2024-02' AS filename) FROM base_trips WHERE event_id % 10 = 0
  UNION ALL SELECT * REPLACE ('2024-02' AS source_month, 'p/2024-02' AS filename, ended_at + INTERVAL 1 MINUTE AS ended_at)
    FROM base_trips WHERE event_id % 97 = 0
  UNION ALL SELECT * REPLACE ('2023-12' AS source_month, 'p/2023-12' AS filename,
    date_trunc('second', started_at) AS started_at, date_trunc('second', ended_at) AS ended_at)
    FROM base_trips WHERE event_id % 53 = 0)""",
    "dst_trips": """
SELECT event_id * 2 + k AS event_id, ts + to_days(shift) AS started_at,
  ts + to_days(shift) + to_microseconds(round(value * 100)::BIGINT * 600000) AS ended_at,
  CASE WHEN event_id % 4 = 0 THEN value * 60 END AS reported_duration_seconds,
  true AS valid_demand, 'NYC' AS area
FROM events CROSS JOIN (VALUES (0, 55), (1, 290)) AS spans(k, shift)""",
    "hours": """
SELECT area, date_trunc('hour', started_at) AS timestamp, count(*) AS rides FROM trips WHERE valid_demand GROUP BY ALL""",
    "hour_grid": """
SELECT area, unnest(generate_series(m, m + INTERVAL 1 MONTH - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS timestamp
FROM (SELECT DISTINCT area, date_trunc('month', timestamp) AS m FROM hours)""",
    "hourly": """
SELECT g.area, g.timestamp, coalesce(h.rides, 0) AS rides
FROM hour_grid g LEFT JOIN hours h ON h.area = g.area AND h.timestamp = g.timestamp""",
    "daily_orders": """
SELECT d.day, coalesce(c.n, 0) AS n FROM (
  SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS day FROM orders) d
LEFT JOIN (SELECT o_orderdate AS day, count(*) AS n FROM orders GROUP BY 1) c ON c.day = d.day""",
    "base_items": """
SELECT p_partkey,
  CASE WHEN ('0x' || substr(md5(concat_ws('|', p_partkey::VARCHAR, 'label')), 1, 8))::BIGINT % 100 < 20 + p_size THEN 'p' ELSE 'e' END AS label,
  (CASE WHEN p_partkey % 13 = 0 THEN 0 ELSE p_size END)::DOUBLE AS cap_diameter,
  round(p_retailprice - 900, 2) AS stem_height,
  ((p_partkey % 17) - (CASE WHEN p_partkey % 101 = 0 THEN 1 ELSE 0 END))::DOUBLE AS stem_width,
  CASE WHEN p_partkey % 7 <> 0 THEN p_brand END AS brand,
  CASE WHEN p_partkey % 11 <> 0 THEN p_type END AS kind,
  CASE WHEN p_partkey % 7 = 0 THEN split_part(p_name, ' ', 1) END AS color,
  CASE WHEN p_partkey % 2 = 0 THEN 't' ELSE 'f' END AS has_ring,
  CASE WHEN p_partkey % 5 = 0 THEN 'f' ELSE 'x' END AS ring_type,
  'only' AS veil
FROM part""",
    "items": """
SELECT p_partkey * 2 AS row_id, * EXCLUDE (p_partkey) FROM base_items
UNION ALL SELECT p_partkey * 2 + 1 AS row_id, * EXCLUDE (p_partkey)
  REPLACE (CASE WHEN p_partkey % 45 = 0 THEN (CASE label WHEN 'p' THEN 'e' ELSE 'p' END) ELSE label END AS label)
FROM base_items WHERE p_partkey % 9 = 0""",
    "preds": """
SELECT o_orderkey AS source_row, (o_orderkey % 5 + 1)::INT AS fold, true_class, model, probability_p, 0.5::DOUBLE AS threshold,
  (probability_p > 0.5)::INT AS prediction, o_orderpriority AS grp FROM (
  SELECT o_orderkey, o_orderpriority, (o_orderstatus = 'F')::INT AS true_class, model,
    ((('0x' || substr(md5(concat_ws('|', o_orderkey::VARCHAR, model)), 1, 8))::BIGINT % 1000) * w
      + (CASE WHEN o_orderstatus = 'F' THEN (10 - w) * 1000 ELSE 0 END)) // 10 / 1000.0::DOUBLE AS probability_p
  FROM orders CROSS JOIN (VALUES ('rf', 6), ('gb', 7), ('lr', 8)) AS m(model, w))""",
    "labelled": """
SELECT l.doc_id, l.quality, l.toxic, d.lang, d.source, d.n_chars FROM labels l JOIN documents d ON d.doc_id = l.doc_id""",
}


class Views:
    """Lazily built test views over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare_session(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def base_trips(self) -> DataFrame:
        length = "cast(round(value * 100) AS bigint) * 600000 * CASE WHEN event_id % 211 = 0 THEN 30 WHEN event_id % 223 = 0 THEN -1 ELSE 1 END"
        end_no = "cast((user_id * 7 + event_id) % 50 AS string)"
        start_no = "cast(user_id % 50 AS string)"
        return self.table("events").selectExpr(
            "event_id",
            "CASE WHEN event_id % 13 <> 0 THEN cast(event_id AS string) END AS ride_id",
            "CASE event_id % 3 WHEN 0 THEN 'electric_bike' WHEN 1 THEN 'classic_bike' ELSE 'unknown' END AS rideable_type",
            "ts AS started_at",
            f"CASE WHEN event_id % 41 <> 0 THEN cast(timestamp_micros(unix_micros(cast(ts AS timestamp)) + {length}) AS timestamp_ntz) END AS ended_at",
            f"CASE WHEN event_id % 17 <> 0 THEN concat('S', {start_no}) END AS start_station_id",
            f"CASE WHEN event_id % 17 <> 0 THEN concat(CASE WHEN event_id % 31 = 0 THEN 'STOP ' ELSE 'Stop ' END, {start_no}) END AS start_station_name",
            f"CASE WHEN event_id % 19 <> 0 THEN concat('S', {end_no}) END AS end_station_id",
            f"CASE WHEN event_id % 19 <> 0 THEN concat('Stop ', {end_no}) END AS end_station_name",
            "CASE WHEN user_id % 29 = 0 THEN 200D ELSE 40 + (user_id % 200) / 100D END AS start_lat",
            "CASE WHEN event_id % 23 <> 0 THEN -74 + (user_id % 100) / 200D END AS start_lng",
            "CASE WHEN event_id % 19 <> 0 THEN 40.5D + (user_id % 7) / 10D END AS end_lat",
            "-74 + (event_id % 100) / 200D AS end_lng",
            "CASE WHEN event_type IN ('click', 'view') THEN 'member' WHEN event_type IN ('purchase', 'signup') THEN 'casual' ELSE 'unknown' END AS member_casual",
            "CASE WHEN event_id % 4 = 0 THEN cast(user_id AS string) END AS bike_id",
            "CASE WHEN event_id % 4 = 0 THEN value * 60 + (event_id % 5) END AS reported_duration_seconds",
            "false AS missing_started_at",
            "event_id % 82 = 0 AS missing_ended_at",
            "CASE WHEN event_id % 37 = 0 THEN '2023-12' ELSE '2024-01' END AS source_month",
            "CASE WHEN event_id % 37 = 0 THEN 'p/2023-12' ELSE 'p/2024-01' END AS filename",
            "'NYC' AS area",
        )

    @cached_property
    def raw_texts(self) -> DataFrame:
        e, u, ts = F.col("event_id"), F.col("user_id"), F.col("ts")
        kind = F.col("event_type")
        return self.table("events").select(
            e,
            F.when(e % 8 == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")).when(e % 8 == 1, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
             .when(e % 8 == 2, F.date_format(ts, "yyyy-MM-dd HH:mm"))
             .when(e % 8 == 3, F.concat(F.lit(" "), F.date_format(ts, "MM/dd/yyyy HH:mm:ss"), F.lit(" ")))
             .when(e % 8 == 4, F.date_format(ts, "M/d/yyyy H:mm"))
             .when(e % 8 == 5, F.concat(F.lit("not a time "), e.cast("string"))).when(e % 8 == 6, "  ").alias("started_text"),
            F.when(e % 3 == 0, F.concat((u % 50).cast("string"), F.lit(".0")))
             .when(e % 3 == 1, F.concat(F.lit(" 0"), (u % 50).cast("string"))).otherwise(" ").alias("station_text"),
            F.when(e % 4 == 0, u.cast("string")).alias("bike_id"),
            F.when(e % 5 == 0, "n/a").otherwise((40 + F.col("value") / 100000).cast("decimal(18,9)").cast("string")).alias("lat_text"),
            F.when(kind == "click", "Subscriber").when(kind == "view", " customer").when(kind == "purchase", "MEMBER")
             .when(kind == "signup", "casual ").otherwise(kind).alias("member_text"),
            F.when(e % 3 == 0, " Electric_Bike ").when(e % 3 == 1, "").alias("vehicle_text"),
        )

    @cached_property
    def trips(self) -> DataFrame:
        from tallyridge.operators.clean import with_trip_flags

        return with_trip_flags(self.base_trips, F.col("source_month"))

    @cached_property
    def trips_dup(self) -> DataFrame:
        """Every row (v = 0), exact copies (1), conflicting copies (2), whole-second copies (3)."""
        from tallyridge.operators.clean import with_trip_flags

        versions = ("explode(filter(array(0, 1, 2, 3), v -> v = 0 OR v = 1 AND event_id % 10 = 0 "
                    "OR v = 2 AND event_id % 97 = 0 OR v = 3 AND event_id % 53 = 0)) AS v")
        month = "CASE WHEN v IN (1, 2) THEN '2024-02' WHEN v = 3 THEN '2023-12' ELSE source_month END"
        changed = {
            "started_at": "CASE WHEN v = 3 THEN cast(date_trunc('second', started_at) AS timestamp_ntz) ELSE started_at END AS started_at",
            "ended_at": "CASE WHEN v = 3 THEN cast(date_trunc('second', ended_at) AS timestamp_ntz) WHEN v = 2 THEN ended_at + INTERVAL 1 MINUTE ELSE ended_at END AS ended_at",
            "source_month": f"{month} AS source_month",
            "filename": f"concat('p/', {month}) AS filename",
        }
        base = self.base_trips
        rows = base.selectExpr("*", versions).selectExpr(*[changed.get(c, c) for c in base.columns])
        return with_trip_flags(rows, F.col("source_month"))

    @cached_property
    def dst_trips(self) -> DataFrame:
        spans = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.expr(f"INTERVAL {d} DAYS").alias("shift"))
                                    for k, d in ((0, 55), (1, 290))])).alias("span")
        length = F.round(F.col("value") * 100).cast("bigint") * 600_000
        start = F.col("ts") + F.col("span.shift")
        return self.table("events").select("*", spans).select(
            (F.col("event_id") * 2 + F.col("span.k")).alias("event_id"),
            start.alias("started_at"),
            clock.from_micros(clock.micros(start) + length).alias("ended_at"),
            F.when(F.col("event_id") % 4 == 0, F.col("value") * 60).alias("reported_duration_seconds"),
            F.lit(True).alias("valid_demand"),
            F.lit("NYC").alias("area"),
        )

    @cached_property
    def hours(self) -> DataFrame:
        from tallyridge.operators.series import hourly_demand

        return hourly_demand(self.trips)

    @cached_property
    def hourly(self) -> DataFrame:
        from tallyridge.operators.series import calendar_fill

        return calendar_fill(self.hours)

    @cached_property
    def daily_orders(self) -> DataFrame:
        from tallyridge.operators.series import fill_days

        counts = self.table("orders").groupBy(F.col("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
        return fill_days(counts, "day", "n")

    @cached_property
    def base_items(self) -> DataFrame:
        draw = "cast(conv(substr(md5(concat_ws('|', cast(p_partkey AS string), 'label')), 1, 8), 16, 10) AS bigint)"
        return self.table("part").selectExpr(
            "p_partkey",
            f"CASE WHEN {draw} % 100 < 20 + p_size THEN 'p' ELSE 'e' END AS label",
            "cast(CASE WHEN p_partkey % 13 = 0 THEN 0 ELSE p_size END AS double) AS cap_diameter",
            "round(p_retailprice - 900, 2) AS stem_height",
            "cast((p_partkey % 17) - CASE WHEN p_partkey % 101 = 0 THEN 1 ELSE 0 END AS double) AS stem_width",
            "CASE WHEN p_partkey % 7 <> 0 THEN p_brand END AS brand",
            "CASE WHEN p_partkey % 11 <> 0 THEN p_type END AS kind",
            "CASE WHEN p_partkey % 7 = 0 THEN split_part(p_name, ' ', 1) END AS color",
            "CASE WHEN p_partkey % 2 = 0 THEN 't' ELSE 'f' END AS has_ring",
            "CASE WHEN p_partkey % 5 = 0 THEN 'f' ELSE 'x' END AS ring_type",
            "'only' AS veil",
        )

    @cached_property
    def items(self) -> DataFrame:
        """Every part once, and a second time (sometimes with the other label) for each ninth."""
        base = self.base_items
        copies = "explode(CASE WHEN p_partkey % 9 = 0 THEN array(0, 1) ELSE array(0) END) AS v"
        label = "CASE WHEN v = 1 AND p_partkey % 45 = 0 THEN CASE label WHEN 'p' THEN 'e' ELSE 'p' END ELSE label END AS label"
        rest = [c for c in base.columns if c not in ("p_partkey", "label")]
        return base.selectExpr("*", copies).selectExpr(label, *rest, "p_partkey * 2 + v AS row_id")

    @cached_property
    def preds(self) -> DataFrame:
        models = "explode(array(named_struct('model', 'rf', 'w', 6), named_struct('model', 'gb', 'w', 7), named_struct('model', 'lr', 'w', 8))) AS m"
        draw = "cast(conv(substr(md5(concat_ws('|', cast(o_orderkey AS string), m.model)), 1, 8), 16, 10) AS bigint) % 1000"
        score = f"(({draw}) * m.w + CASE WHEN o_orderstatus = 'F' THEN (10 - m.w) * 1000 ELSE 0 END) div 10 / 1000D"
        rows = self.table("orders").selectExpr("o_orderkey", "o_orderpriority", "o_orderstatus", models).selectExpr(
            "o_orderkey AS source_row", "cast(o_orderkey % 5 + 1 AS int) AS fold", "cast(o_orderstatus = 'F' AS int) AS true_class",
            "m.model AS model", f"{score} AS probability_p", "0.5D AS threshold", "o_orderpriority AS grp")
        return rows.selectExpr("*", "cast(probability_p > 0.5D AS int) AS prediction")

    @cached_property
    def labelled(self) -> DataFrame:
        docs = self.table("documents").select("doc_id", "lang", "source", "n_chars")
        return self.table("labels").join(docs, "doc_id").select("doc_id", "quality", "toxic", "lang", "source", "n_chars")
