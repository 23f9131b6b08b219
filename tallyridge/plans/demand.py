"""Registered queries over hourly demand: calendar, windows, features."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyridge.functions import clock
from tallyridge.operators import joins as J
from tallyridge.operators import scoring as G
from tallyridge.operators import series as S
from tallyridge.operators import splits as P
from tallyridge.operators import stats as T
from tallyridge.operators import summaries as A
from tallyridge.plans.catalog import query
from tallyridge.plans.trips import DAILY_SQL

FEATURE_SQL = """
WITH w AS (
  SELECT *, date_trunc('day', timestamp) AS day, hour(timestamp) AS h, isodow(timestamp) - 1 AS wd, dayofyear(timestamp) - 1 AS yd,
    CASE WHEN month(timestamp) = 3 AND day(timestamp) BETWEEN 8 AND 14 AND isodow(timestamp) = 7 AND hour(timestamp) = 2 THEN 0
         WHEN month(timestamp) = 11 AND day(timestamp) <= 7 AND isodow(timestamp) = 7 AND hour(timestamp) = 1 THEN 2 ELSE 1 END AS ch,
    lag(rides, 1) OVER s AS l1, lag(rides, 2) OVER s AS l2, lag(rides, 7) OVER s AS l7, lag(rides, 14) OVER s AS l14,
    CASE WHEN count(rides) OVER r = 7 THEN avg(rides) OVER r END AS m7
  FROM {series}
  WINDOW s AS (PARTITION BY area, hour(timestamp) ORDER BY timestamp),
         r AS (PARTITION BY area, hour(timestamp) ORDER BY timestamp ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)),
t AS (SELECT area, day, lag(CASE WHEN n = 24 THEN s END) OVER (PARTITION BY area ORDER BY day) AS pt FROM (
  SELECT area, date_trunc('day', timestamp) AS day, count(rides) AS n, sum(rides) AS s FROM {series} GROUP BY ALL))
SELECT w.area, timestamp, rides, w.day, round(sin(2*pi()*h/24), 6)+0 AS hour_sin, round(cos(2*pi()*h/24), 6)+0 AS hour_cos,
  round(sin(2*pi()*wd/7), 6)+0 AS weekday_sin, round(cos(2*pi()*wd/7), 6)+0 AS weekday_cos,
  round(sin(2*pi()*yd/365.2425), 6)+0 AS year_sin, round(cos(2*pi()*yd/365.2425), 6)+0 AS year_cos,
  (wd >= 5)::INT AS is_weekend, ch::INT AS clock_hours, l1::DOUBLE AS lag_1d, l2::DOUBLE AS lag_2d, l7::DOUBLE AS lag_7d, l14::DOUBLE AS lag_14d,
  round(m7, 6) AS same_hour_mean_7d, pt::DOUBLE AS previous_day_total
FROM w JOIN t ON t.area = w.area AND t.day = w.day WHERE l14 IS NOT NULL AND m7 IS NOT NULL AND pt IS NOT NULL
"""


@query("feat_demand_frame", FEATURE_SQL.format(series="hourly"))
def _(v):
    return S.demand_frame(v.hourly)


@query("agg_hourly_demand", "SELECT area, timestamp, rides FROM hours")
def _(v):
    return v.hours


@query("join_calendar_fill", "SELECT area, timestamp, rides FROM hourly")
def _(v):
    return v.hourly


# ---------------------------------------------------------------- windows


LAG_SQL = "PARTITION BY area, hour(timestamp) ORDER BY timestamp"


@query("win_lag_days", f"""
SELECT area, timestamp, rides, lag(rides, 1) OVER w::DOUBLE AS lag_1d, lag(rides, 2) OVER w::DOUBLE AS lag_2d,
  lag(rides, 7) OVER w::DOUBLE AS lag_7d, lag(rides, 14) OVER w::DOUBLE AS lag_14d FROM hourly WINDOW w AS ({LAG_SQL})""".replace("OVER w::DOUBLE", "OVER w"))
def _(v):
    lagged = S.lag_days(v.hourly)
    return lagged.select("area", "timestamp", "rides", *[F.col(f"lag_{k}d").cast("bigint").alias(f"lag_{k}d") for k in S.LAGS])


@query("win_rolling_same_hour", f"""
SELECT area, timestamp, rides, CASE WHEN count(rides) OVER w = 7 THEN round(avg(rides) OVER w, 6) END AS same_hour_mean_7d
FROM hourly WINDOW w AS ({LAG_SQL} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""")
def _(v):
    return S.same_hour_mean(v.hourly)


@query("win_previous_day_total", """
WITH d AS (SELECT area, date_trunc('day', timestamp) AS day, sum(rides) AS s FROM hourly GROUP BY ALL),
 l AS (SELECT area, day, lag(s) OVER (PARTITION BY area ORDER BY day) AS p FROM d)
SELECT h.area, timestamp, rides, p::DOUBLE AS previous_day_total FROM hourly h JOIN l ON l.area = h.area AND l.day = date_trunc('day', h.timestamp)""")
def _(v):
    return S.previous_day_total(v.hourly)


@query("win_rolling_28d", """
SELECT day, n, CASE WHEN count(n) OVER w = 28 THEN round(avg(n) OVER w, 6) END AS mean_28d FROM daily_orders
WINDOW w AS (ORDER BY day ROWS BETWEEN 27 PRECEDING AND CURRENT ROW)""")
def _(v):
    w = Window.partitionBy(F.lit("orders")).orderBy("day")
    return v.daily_orders.select("day", "n", S.trailing_mean(F.col("n"), w, -27, 0).alias("mean_28d"))


@query("win_shift_168", "SELECT area, timestamp, rides, lag(rides, 168) OVER (PARTITION BY area ORDER BY timestamp) AS previous_week FROM hourly")
def _(v):
    return A.shift_hours(v.hourly, 168, "previous_week")


@query("win_autocorrelation", """
WITH m AS (SELECT area, avg(rides) AS m, var_pop(rides) * count(*) AS ss FROM hourly GROUP BY 1)
SELECT a.area, k::INT AS lag, round(corr(a.rides, b.rides), 6) AS r, round(sum((a.rides - m) * (b.rides - m)) / max(ss), 6) AS acf, count(*) AS pairs
FROM hourly a CROSS JOIN (SELECT unnest(generate_series(1, 336)) AS k) JOIN hourly b ON b.area = a.area AND b.timestamp = a.timestamp + to_hours(k) JOIN m ON m.area = a.area
GROUP BY ALL""")
def _(v):
    return A.autocorrelation(v.hourly, range(1, 337))


# ---------------------------------------------------------------- joins on the series


@query("join_lag_lookup", """
SELECT a.area, a.timestamp, a.rides, b.rides AS week_ago FROM hours a LEFT JOIN hours b ON b.area = a.area AND b.timestamp = a.timestamp - INTERVAL 7 DAYS""")
def _(v):
    return J.lag_lookup(v.hours, 7, "week_ago")


SPLIT_SQL = """
lastday AS (SELECT date_trunc('day', max(timestamp)) - INTERVAL 6 DAYS AS d FROM hourly),
train AS (SELECT * FROM hourly WHERE timestamp < (SELECT d FROM lastday)),
test AS (SELECT * FROM hourly WHERE timestamp >= (SELECT d FROM lastday))"""


def split_week(v):
    late = S.last_days(v.hourly, 7)
    return v.hourly.where(~late), v.hourly.where(late)


@query("split_last_days", f"""
WITH {SPLIT_SQL} SELECT 'train' AS part, count(*) AS n, min(timestamp) AS first, max(timestamp) AS last FROM train
UNION ALL SELECT 'test', count(*), min(timestamp), max(timestamp) FROM test""")
def _(v):
    part = F.when(S.last_days(v.hourly, 7), "test").otherwise("train").alias("part")
    return v.hourly.groupBy(part).agg(F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))


SLOT_SQL = f"""
WITH {SPLIT_SQL}, slots AS (SELECT isodow(timestamp) - 1 AS weekday, hour(timestamp) AS hour, avg(rides) AS m FROM train
  WHERE NOT (isodow(timestamp) = 3 AND hour(timestamp) < 6) GROUP BY 1, 2)
SELECT t.area, t.timestamp, t.rides, (isodow(t.timestamp) - 1)::INT AS weekday, hour(t.timestamp)::INT AS hour,
  round(coalesce(m, (SELECT avg(rides) FROM train WHERE NOT (isodow(timestamp) = 3 AND hour(timestamp) < 6))), 6) AS predicted
FROM test t LEFT JOIN slots ON slots.weekday = isodow(t.timestamp) - 1 AND slots.hour = hour(t.timestamp)"""


@query("join_slot_mean_fallback", SLOT_SQL)
def _(v):
    train, test = split_week(v)
    known = train.where(~((F.weekday("timestamp") == 2) & (F.hour("timestamp") < 6)))
    return J.slot_mean_fallback(test, known)


@query("model_slot_mean", SLOT_SQL.replace("WHERE NOT (isodow(timestamp) = 3 AND hour(timestamp) < 6)", ""))
def _(v):
    train, test = split_week(v)
    return J.slot_mean_fallback(test, train)


@query("model_global_mean", f"""
WITH {SPLIT_SQL} SELECT area, timestamp, rides, round((SELECT avg(rides) FROM train), 6) AS predicted FROM test""")
def _(v):
    train, test = split_week(v)
    return G.global_mean(test, train)


FOLDS, FOLD_DAYS = 3, 3
FRAME_SQL = FEATURE_SQL.format(series="hourly")
FOLD_SQL = f"""
frame AS ({FRAME_SQL}), span AS (SELECT min(day) AS a, max(day) + INTERVAL 1 DAY AS b FROM frame),
folds AS (SELECT f::INT AS fold, a AS train_start, b - to_days((({FOLDS} - f + 1) * {FOLD_DAYS})::INT) AS train_end, b - to_days((({FOLDS} - f + 1) * {FOLD_DAYS})::INT) AS valid_start,
  b - to_days((({FOLDS} - f) * {FOLD_DAYS})::INT) AS valid_end FROM span CROSS JOIN (SELECT unnest(generate_series(1, {FOLDS})) AS f))"""


@query("split_chronological", f"WITH {FOLD_SQL} SELECT * FROM folds")
def _(v):
    return P.chronological_folds(S.demand_frame(v.hourly), FOLDS, FOLD_DAYS)


@query("join_fold_range", f"""
WITH {FOLD_SQL} SELECT fold, CASE WHEN day < train_end THEN 'train' ELSE 'validation' END AS role, count(*) AS n, min(day) AS first_day, max(day) AS last_day, sum(rides)::BIGINT AS rides
FROM frame JOIN folds ON day >= train_start AND day < valid_end GROUP BY ALL""")
def _(v):
    frame = S.demand_frame(v.hourly)
    rows = J.fold_membership(frame, P.chronological_folds(frame, FOLDS, FOLD_DAYS))
    return rows.groupBy("fold", "role").agg(
        F.count(F.lit(1)).alias("n"), F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.sum("rides").alias("rides"))


@query("split_train_windows", """
SELECT w.years, count(*) AS days, min(day) AS first_day, sum(n)::BIGINT AS n FROM daily_orders
JOIN (VALUES ('2', TIMESTAMP '1999-01-01'), ('5', TIMESTAMP '1996-01-01'), ('all', TIMESTAMP '1900-01-01')) AS w(years, start) ON day >= w.start
WHERE day < TIMESTAMP '2001-01-01' GROUP BY 1""")
def _(v):
    parts = [P.training_window(v.daily_orders, "2001-01-01", y).withColumn("years", F.lit(str(y or "all"))) for y in (2, 5, None)]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.groupBy("years").agg(F.count(F.lit(1)).alias("days"), F.min("day").alias("first_day"), F.sum("n").alias("n"))


# ---------------------------------------------------------------- aggregates on the series

SHARE_SQL = """SELECT area, date_trunc('day', timestamp) AS day, sum(rides)::BIGINT AS rides,
  sum(CASE WHEN hour(timestamp) BETWEEN 7 AND 9 THEN rides ELSE 0 END)::BIGINT AS morning,
  100.0 * sum(CASE WHEN hour(timestamp) BETWEEN 7 AND 9 THEN rides ELSE 0 END) / nullif(sum(rides), 0) AS share FROM hourly GROUP BY ALL"""


@query("agg_daily_share", f"SELECT * REPLACE (round(share, 6) AS share) FROM ({SHARE_SQL})")
def _(v):
    return A.daily_share(v.hourly)


@query("agg_complete_weeks", f"""
SELECT area, day, rides, date_trunc('week', day)::TIMESTAMP AS week FROM ({SHARE_SQL}) QUALIFY count(*) OVER (PARTITION BY area, date_trunc('week', day)) = 7""")
def _(v):
    return A.complete_weeks(A.daily_share(v.hourly)).select("area", "day", "rides", "week")


@query("agg_weekly_effect", f"""
SELECT area, week, round(avg(share) FILTER (WHERE isodow(day) < 6) - avg(share) FILTER (WHERE isodow(day) >= 6), 6) AS effect FROM (
  SELECT *, date_trunc('week', day)::TIMESTAMP AS week FROM ({SHARE_SQL}) QUALIFY count(*) OVER (PARTITION BY area, date_trunc('week', day)) = 7) GROUP BY ALL""")
def _(v):
    return A.weekly_effect(A.daily_share(v.hourly))


@query("agg_weekly_autocorr", """
SELECT area, date_trunc('week', timestamp)::TIMESTAMP AS week, round(corr(rides, p), 6) AS r FROM (
  SELECT *, lag(rides, 168) OVER (PARTITION BY area ORDER BY timestamp) AS p FROM hourly) WHERE p IS NOT NULL GROUP BY ALL HAVING count(*) = 168""")
def _(v):
    return A.weekly_autocorrelation(v.hourly)


@query("agg_paired_pivot", f"""
WITH d AS ({DAILY_SQL}), w AS (SELECT day, max(median_duration) FILTER (WHERE member_casual = 'casual') AS c, max(median_duration) FILTER (WHERE member_casual = 'member') AS m FROM d GROUP BY 1),
 p AS (SELECT *, date_trunc('week', day)::TIMESTAMP AS week FROM w WHERE c IS NOT NULL AND m IS NOT NULL)
SELECT week, round(avg(c - m), 6) AS effect FROM (SELECT * FROM p QUALIFY count(*) OVER (PARTITION BY week) = 7) GROUP BY 1""")
def _(v):
    return A.paired_difference(A.duration_daily(v.trips), "casual", "member")


@query("agg_hour_weekday_matrix", f"""
SELECT (isodow(timestamp) - 1)::INT AS weekday, {', '.join(f'round(avg(rides) FILTER (WHERE hour(timestamp) = {h}), 6) AS h{h:02d}' for h in range(24))} FROM hourly GROUP BY 1""")
def _(v):
    return A.hour_weekday_matrix(v.hourly)


@query("agg_day_type_pattern", """
SELECT hour(timestamp)::INT AS hour, round(avg(rides) FILTER (WHERE isodow(timestamp) < 6), 6) AS working_day, round(avg(rides) FILTER (WHERE isodow(timestamp) >= 6), 6) AS weekend FROM hourly GROUP BY 1""")
def _(v):
    return A.day_type_pattern(v.hourly)


@query("agg_resample_daily", "SELECT area, date_trunc('day', timestamp) AS day, sum(rides)::BIGINT AS rides FROM hourly GROUP BY ALL")
def _(v):
    return A.daily_totals(v.hourly)


# ---------------------------------------------------------------- features


@query("feat_calendar_cyclic", """
SELECT area, timestamp, round(sin(2*pi()*hour(timestamp)/24), 6)+0 AS hour_sin, round(cos(2*pi()*hour(timestamp)/24), 6)+0 AS hour_cos,
  round(sin(2*pi()*(isodow(timestamp)-1)/7), 6)+0 AS weekday_sin, round(cos(2*pi()*(isodow(timestamp)-1)/7), 6)+0 AS weekday_cos,
  round(sin(2*pi()*(dayofyear(timestamp)-1)/365.2425), 6)+0 AS year_sin, round(cos(2*pi()*(dayofyear(timestamp)-1)/365.2425), 6)+0 AS year_cos,
  (isodow(timestamp) >= 6)::INT AS is_weekend FROM hourly""")
def _(v):
    return S.calendar_features(v.hourly).select("area", "timestamp", *S.CALENDAR[:7])


@query("feat_clock_hours", """
WITH m AS (SELECT DISTINCT date_trunc('month', started_at) AS m FROM dst_trips),
 g AS (SELECT unnest(generate_series(m, m + INTERVAL 1 MONTH - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS timestamp FROM m)
SELECT timestamp, (CASE WHEN month(timestamp) = 3 AND day(timestamp) BETWEEN 8 AND 14 AND isodow(timestamp) = 7 AND hour(timestamp) = 2 THEN 0
  WHEN month(timestamp) = 11 AND day(timestamp) <= 7 AND isodow(timestamp) = 7 AND hour(timestamp) = 1 THEN 2 ELSE 1 END)::INT AS clock_hours FROM g""")
def _(v):
    grid = S.calendar_fill(S.hourly_demand(v.dst_trips))
    return grid.select("timestamp", clock.clock_hours(F.col("timestamp")).alias("clock_hours"))


SCAFFOLD_SQL = """
ahead AS (SELECT area, timestamp, rides FROM hourly UNION ALL
  SELECT area, unnest(generate_series(d, d + INTERVAL 23 HOURS, INTERVAL 1 HOUR)), NULL FROM (SELECT area, date_trunc('day', max(timestamp)) + INTERVAL 1 DAY AS d FROM hourly GROUP BY 1))"""
AHEAD_SQL = FEATURE_SQL.format(series="ahead")


@query("feat_future_day_scaffold", f"WITH {SCAFFOLD_SQL} SELECT * FROM ({AHEAD_SQL}) WHERE rides IS NULL")
def _(v):
    return S.demand_frame(S.future_scaffold(v.hourly)).where("rides IS NULL")


# ---------------------------------------------------------------- scoring with the naive model


@query("model_seasonal_naive", f"SELECT area, timestamp, rides, CASE WHEN clock_hours = 0 THEN 0 ELSE lag_7d END AS predicted_rides FROM ({FRAME_SQL})")
def _(v):
    return G.seasonal_naive(S.demand_frame(v.hourly)).select("area", "timestamp", "rides", "predicted_rides")


@query("score_operational", f"""
SELECT area, timestamp, CASE WHEN clock_hours = 0 THEN 0 ELSE greatest(round(2 * lag_7d - lag_14d, 6), 0) END AS predicted_rides FROM ({FRAME_SQL})""")
def _(v):
    frame = S.demand_frame(v.hourly)
    return frame.select("area", "timestamp", G.operational(F.col("lag_7d") * 2 - F.col("lag_14d"), F.col("clock_hours")).alias("predicted_rides"))


@query("score_day_ahead", f"WITH {SCAFFOLD_SQL} SELECT area, timestamp, clock_hours, lag_7d AS predicted_rides FROM ({AHEAD_SQL}) WHERE rides IS NULL")
def _(v):
    return G.day_ahead(v.hourly)


ORIGIN = "2024-01-20"
RESIDUAL_SQL = f"""
residuals AS (SELECT area, timestamp, rides, lag_7d AS predicted_rides, rides - lag_7d AS residual, abs(rides - lag_7d) AS absolute_error,
  hour(timestamp)::INT AS hour, (isodow(timestamp) - 1)::INT AS weekday, month(timestamp)::INT AS month, CASE WHEN month(timestamp) IN (12, 1, 2) THEN 'winter'
    WHEN month(timestamp) IN (3, 4, 5) THEN 'spring' WHEN month(timestamp) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season
  FROM ({FRAME_SQL}) WHERE day >= TIMESTAMP '{ORIGIN}')"""


def naive_residuals(v):
    return G.rolling_origin(S.demand_frame(v.hourly), ORIGIN)


@query("score_rolling_origin", f"WITH {RESIDUAL_SQL} SELECT area, timestamp, rides, predicted_rides, residual FROM residuals")
def _(v):
    return naive_residuals(v).select("area", "timestamp", "rides", "predicted_rides", "residual")


@query("score_residual_table", f"WITH {RESIDUAL_SQL} SELECT * FROM residuals")
def _(v):
    return naive_residuals(v)


@query("score_daily_total", f"""
WITH {RESIDUAL_SQL} SELECT area, date_trunc('day', timestamp) AS day, round(sum(predicted_rides), 6) AS total,
  string_agg(printf('%.3f', predicted_rides), ',' ORDER BY timestamp) AS hourly FROM residuals GROUP BY ALL""")
def _(v):
    return G.daily_forecast(naive_residuals(v))


@query("agg_error_by_segment", f"""
WITH {RESIDUAL_SQL} {' UNION ALL '.join(f"SELECT '{s}' AS segment, {s}::VARCHAR AS level, round(avg(absolute_error), 6) AS mae, round(avg(residual), 6) AS bias, count(*) AS n FROM residuals GROUP BY {s}" for s in ('hour', 'weekday', 'season'))}""")
def _(v):
    return A.segment_errors(naive_residuals(v), ["hour", "weekday", "season"])


@query("agg_worst_segment", f"""
WITH {RESIDUAL_SQL}, e AS ({' UNION ALL '.join(f"SELECT '{s}' AS segment, {s}::VARCHAR AS level, avg(absolute_error) AS mae FROM residuals GROUP BY {s}" for s in ('hour', 'weekday', 'season'))})
SELECT segment, level, round(mae, 6) AS mae FROM e QUALIFY row_number() OVER (PARTITION BY segment ORDER BY mae DESC, level) = 1""")
def _(v):
    return A.worst_segments(A.segment_errors(naive_residuals(v), ["hour", "weekday", "season"]))


@query("agg_residual_summary", f"""
WITH {RESIDUAL_SQL} SELECT round(avg(residual), 6) AS mean_bias, round(quantile_cont(absolute_error, 0.5), 6) AS median_absolute_error, count(*) AS n FROM residuals""")
def _(v):
    return A.residual_summary(naive_residuals(v))


@query("agg_regression_metrics", f"""
WITH {RESIDUAL_SQL} SELECT area, round(sqrt(avg(residual * residual)), 6) AS rmse, round(avg(absolute_error), 6) AS mae,
  round(1 - sum(residual * residual) / (var_pop(rides) * count(*)), 6) AS r2, count(*) AS n FROM residuals GROUP BY 1""")
def _(v):
    return A.regression_metrics(naive_residuals(v), "rides", "predicted_rides", ["area"])


@query("topk_largest_errors", f"""
WITH {RESIDUAL_SQL} SELECT timestamp, rides, predicted_rides, absolute_error FROM residuals ORDER BY absolute_error DESC, timestamp LIMIT 10""")
def _(v):
    return A.extremes(naive_residuals(v), "absolute_error", ["timestamp", "rides", "predicted_rides", "absolute_error"], "timestamp")


CANDIDATES_SQL = f"""
c AS (SELECT rides, lag_7d AS seasonal_naive, same_hour_mean_7d AS same_hour_mean, (lag_7d + lag_14d) / 2 AS two_weeks, (lag_1d + lag_2d + lag_7d) / 3 AS recent FROM ({FRAME_SQL})),
u AS (SELECT model, sqrt(avg((rides - p) * (rides - p))) AS rmse FROM (UNPIVOT c ON seasonal_naive, same_hour_mean, two_weeks, recent INTO NAME model VALUE p) GROUP BY 1),
s AS (SELECT *, (CASE model WHEN 'seasonal_naive' THEN 0 WHEN 'same_hour_mean' THEN 1 WHEN 'two_weeks' THEN 1 ELSE 2 END)::INT AS simplicity FROM u)"""


def candidate_scores(v):
    frame = S.demand_frame(v.hourly).select(
        "rides", F.col("lag_7d").alias("seasonal_naive"), F.col("same_hour_mean_7d").alias("same_hour_mean"),
        ((F.col("lag_7d") + F.col("lag_14d")) / 2).alias("two_weeks"), ((F.col("lag_1d") + F.col("lag_2d") + F.col("lag_7d")) / 3).alias("recent"))
    long = frame.unpivot(["rides"], ["seasonal_naive", "same_hour_mean", "two_weeks", "recent"], "model", "p")
    rank = F.when(F.col("model") == "seasonal_naive", 0).when(F.col("model").isin("same_hour_mean", "two_weeks"), 1).otherwise(2)
    return A.regression_metrics(long, "rides", "p", ["model"]).select(F.lit("demand").alias("family"), "model", "rmse", rank.alias("simplicity"))


@query("select_simplest_within_1pct", f"""
WITH {CANDIDATES_SQL}, e AS (SELECT * FROM s WHERE rmse = (SELECT min(rmse) FROM s) OR rmse < (SELECT min(rmse) FROM s) * 1.01)
SELECT 'demand' AS family, model, round(rmse, 6) AS rmse, simplicity FROM e ORDER BY simplicity, rmse, model LIMIT 1""")
def _(v):
    return P.simplest_within(candidate_scores(v))


# ---------------------------------------------------------------- statistics

REPS, PERMUTATIONS, GAIN_REPS = 20_000, 9_999, 10_000


def h(*parts):
    return f"('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8))::BIGINT"


ORDER_EFFECT_SQL = """
ow AS (SELECT day, n, date_trunc('week', day)::TIMESTAMP AS week FROM daily_orders QUALIFY count(*) OVER (PARTITION BY date_trunc('week', day)) = 7),
effects AS (SELECT week, avg(n) FILTER (WHERE isodow(day) < 6) - avg(n) FILTER (WHERE isodow(day) >= 6) AS effect FROM ow GROUP BY 1),
numbered AS (SELECT *, row_number() OVER (ORDER BY week DESC) AS rn, count(*) OVER () AS cnt FROM effects WHERE effect IS NOT NULL),
blocks AS (SELECT ((rn - 1) // 4)::INT AS block, avg(effect) AS effect FROM numbered WHERE rn <= (cnt // 4) * 4 GROUP BY 1)"""
FLIP_SQL = f"""
flips AS (SELECT rep, avg(CASE WHEN {h('rep::VARCHAR', 'block::VARCHAR', "'42'")} % 2 = 0 THEN effect ELSE -effect END) AS m
  FROM (SELECT unnest(generate_series(1, {REPS})) AS rep) CROSS JOIN blocks GROUP BY 1),
flip AS (SELECT (1 + count_if(abs(m) >= abs((SELECT avg(effect) FROM blocks)) - 1e-12)) / (1.0 + count(*))::DOUBLE AS p_value FROM flips)"""


def BOOT_SQL(source, reps):
    return f"""
picks AS (SELECT rep, i.block AS i, {h('rep::VARCHAR', 'i.block::VARCHAR', "'boot42'")} % (SELECT count(*) FROM {source}) AS pick
  FROM (SELECT unnest(generate_series(1, {reps})) AS rep) CROSS JOIN {source} i),
boots AS (SELECT rep, avg(effect) AS m FROM picks JOIN {source} b ON b.block = pick GROUP BY 1),
boot AS (SELECT quantile_cont(m, 0.025) AS ci_low, quantile_cont(m, 0.975) AS ci_high FROM boots)"""


def order_effects(v):
    return A.weekly_effect(v.daily_orders, "n", ())


@query("stat_block_signflip", f"""
WITH {ORDER_EFFECT_SQL}, {FLIP_SQL} SELECT round((SELECT avg(effect) FROM blocks), 6) AS observed, (SELECT count(*) FROM blocks)::INT AS blocks, round(p_value, 6) AS p_value FROM flip""")
def _(v):
    return T.sign_flip(T.week_blocks(order_effects(v)), REPS)


@query("stat_block_bootstrap_ci", f"""
WITH {ORDER_EFFECT_SQL}, {BOOT_SQL('blocks', REPS)} SELECT (SELECT count(*) FROM blocks)::INT AS blocks, round(ci_low, 6) AS ci_low, round(ci_high, 6) AS ci_high FROM boot""")
def _(v):
    return T.bootstrap_ci(T.week_blocks(order_effects(v)), REPS)


@query("stat_standardized_effect", f"""
WITH {ORDER_EFFECT_SQL} SELECT count(*) AS blocks, round(avg(effect), 6) AS mean, round(stddev_samp(effect), 6) AS sd, round(avg(effect) / stddev_samp(effect), 6) AS standardized FROM blocks""")
def _(v):
    return T.standardized_effect(T.week_blocks(order_effects(v)))


@query("stat_hypothesis_gate", f"""
WITH {ORDER_EFFECT_SQL}, {FLIP_SQL}, {BOOT_SQL('blocks', REPS)}
SELECT 'weekday' AS label, round(p_value, 6) AS holm_p, round(ci_low, 6) AS ci_low, p_value < 0.05 AND ci_low > 0.3 AS selected FROM flip, boot""")
def _(v):
    tests = T.block_test(order_effects(v), "weekday", repetitions=REPS).withColumn("family", F.lit("targets"))
    return T.hypothesis_gate(T.holm(tests), "weekday")


GAIN_SQL = """
base AS (SELECT day, n, lag(n, 7) OVER (ORDER BY day) AS b, avg(n) OVER (ORDER BY day ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) AS p,
  count(n) OVER (ORDER BY day ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) AS k FROM daily_orders),
gains AS (SELECT datediff('day', DATE '1970-01-05', date_trunc('week', day)::DATE) // 7 AS wk, avg((n - b) * (n - b) - (n - p) * (n - p)) AS effect FROM base WHERE k = 28 GROUP BY 1),
weeks AS (SELECT (row_number() OVER (ORDER BY wk) - 1) AS block, effect FROM gains)"""


@query("stat_weekly_mse_gain_ci", f"""
WITH {GAIN_SQL}, {BOOT_SQL('weeks', GAIN_REPS)} SELECT (SELECT count(*) FROM weeks)::INT AS blocks, round(ci_low, 6) AS ci_low, round(ci_high, 6) AS ci_high FROM boot""")
def _(v):
    w = Window.partitionBy(F.lit("orders")).orderBy("day")
    rows = v.daily_orders.select("day", "n", F.lag("n", 7).over(w).alias("b"), S.trailing_mean(F.col("n"), w, -28, -1).alias("p")).where("p IS NOT NULL")
    return T.bootstrap_ci(T.weekly_gain(rows, "day", "n", "b", "p"), GAIN_REPS)


@query("stat_permutation_two_sample", f"""
WITH {SPLIT_SQL}, d AS (SELECT date_trunc('day', timestamp) AS day, sum(rides) AS s, sum(CASE WHEN hour(timestamp) IN (7, 8) THEN rides ELSE 0 END) AS m FROM train GROUP BY 1 HAVING sum(rides) > 0),
 x AS (SELECT row_number() OVER (ORDER BY day) - 1 AS i, m / s AS share, isodow(day) < 6 AS wd FROM d),
 z AS (SELECT rep, share, row_number() OVER (PARTITION BY rep ORDER BY md5(concat_ws('|', rep::VARCHAR, i::VARCHAR, '42'))) AS rn
   FROM (SELECT unnest(generate_series(1, {PERMUTATIONS})) AS rep) CROSS JOIN x),
 o AS (SELECT avg(share) FILTER (WHERE wd) - avg(share) FILTER (WHERE NOT wd) AS obs, count_if(wd) AS n1, count_if(NOT wd) AS n2 FROM x),
 g AS (SELECT rep, avg(share) FILTER (WHERE rn <= (SELECT n1 FROM o)) - avg(share) FILTER (WHERE rn > (SELECT n1 FROM o)) AS gap FROM z GROUP BY 1)
SELECT round(max(obs), 6) AS observed, max(n1)::INT AS first_n, max(n2)::INT AS second_n, round((1 + count_if(gap >= obs - 1e-12)) / (1.0 + count(*))::DOUBLE, 6) AS p_value FROM g, o""")
def _(v):
    train, _test = split_week(v)
    days = A.daily_share(train, 7, 8).where("rides > 0").select("day", (F.col("morning") / F.col("rides")).alias("share"))
    return T.permutation_two_sample(days, "share", F.weekday("day") < 5, "day", PERMUTATIONS)
