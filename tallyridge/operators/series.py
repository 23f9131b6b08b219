"""Gap-free hourly series and the day-ahead feature frame."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyridge.columns import SERIES, TRIPS, SeriesColumns, TripColumns
from tallyridge.functions import clock

CALENDAR = ("hour_sin", "hour_cos", "weekday_sin", "weekday_cos", "year_sin", "year_cos", "is_weekend", "clock_hours")
LAGS = (1, 2, 7, 14)
FEATURES = (*CALENDAR, *[f"lag_{k}d" for k in LAGS], "same_hour_mean_7d", "previous_day_total")
HISTORY_DAYS = 14


def hourly_demand(trips: DataFrame, cols: TripColumns = TRIPS) -> DataFrame:
    """Starts per clock hour and area; only rows whose start is valid count."""
    return (
        trips.where(F.col(cols.valid_demand))
        .groupBy(F.col(cols.area).alias("area"), clock.trunc("hour", F.col(cols.started_at)).alias("timestamp"))
        .agg(F.count(F.lit(1)).alias("rides"))
    )


def present_months(hours: DataFrame, cols: SeriesColumns = SERIES, sources: DataFrame | None = None) -> DataFrame:
    """(area, month) of the source partitions; without a list of them, of the counted hours."""
    if sources is not None:
        return sources.select(cols.area, clock.trunc("month", F.col("month").cast("timestamp_ntz")).alias("month")).distinct()
    return hours.select(cols.area, clock.trunc("month", F.col(cols.timestamp)).alias("month")).distinct()


def calendar_fill(hours: DataFrame, cols: SeriesColumns = SERIES, sources: DataFrame | None = None) -> DataFrame:
    """Zero-fill inside the months that are present; absent months stay absent.

    ``sources`` (area, month) lists the source partitions: one of them without any counted hour is zero throughout, and
    counted hours outside them are left out. Without it, the months that have counted hours are the present ones.

    Each hour stretches to the label before the next one of its month (the first one also
    back to the start of the month), so the counts are read once and nothing is joined.
    """
    ts, month, hour = F.col(cols.timestamp), F.col("__month"), F.expr("INTERVAL 1 HOUR")
    rows = hours.withColumn("__month", clock.trunc("month", ts))
    w = Window.partitionBy(cols.area, "__month").orderBy(cols.timestamp)
    start = F.when(F.lag(ts).over(w).isNull(), month).otherwise(ts)
    stop = F.coalesce(F.lead(ts).over(w), month + F.expr("INTERVAL 1 MONTH")) - hour
    bounded = rows.select(cols.area, ts.alias("__at"), cols.value, start.alias("__from"), stop.alias("__to"))
    spread = bounded.select("*", F.explode(F.sequence("__from", "__to", hour)).alias(cols.timestamp))
    zero = F.lit(0).cast(hours.schema[cols.value].dataType)
    filled = spread.select(cols.area, cols.timestamp, F.when(ts == F.col("__at"), F.col(cols.value)).otherwise(zero).alias(cols.value))
    if sources is None:
        return filled
    known = present_months(hours, cols, sources)
    silent = known.join(present_months(hours, cols), [cols.area, "month"], "left_anti")
    empty = silent.select(cols.area, F.explode(F.sequence(F.col("month"), F.col("month") + F.expr("INTERVAL 1 MONTH") - hour, hour)).alias(cols.timestamp), zero.alias(cols.value))
    inside = filled.withColumn("month", clock.trunc("month", ts)).join(known, [cols.area, "month"], "left_semi").drop("month")
    return inside.unionByName(empty)


def fill_days(counts: DataFrame, day: str, value: str) -> DataFrame:
    """One row per calendar day between the first and the last, zero where absent."""
    one = F.expr("INTERVAL 1 DAY")
    w = Window.partitionBy(F.lit(1)).orderBy(day)
    stop = F.coalesce(F.lead(day).over(w) - one, F.col(day))
    bounded = counts.select(F.col(day).alias("__at"), value, stop.alias("__to"))
    spread = bounded.select("*", F.explode(F.sequence("__at", "__to", one)).alias(day))
    zero = F.lit(0).cast(counts.schema[value].dataType)
    return spread.select(day, F.when(F.col(day) == F.col("__at"), F.col(value)).otherwise(zero).alias(value))


def month_coverage(months: DataFrame, area: str = "area", month: str = "month") -> DataFrame:
    """First and last month per area and the months missing in between (one row per month comes in)."""
    one = F.expr("INTERVAL 1 MONTH")
    m = F.col(month)
    after = F.lead(m).over(Window.partitionBy(area).orderBy(month))
    gap = F.when(after > m + one, F.sequence(m + one, after - one, one)).otherwise(F.array().cast("array<timestamp_ntz>"))
    rows = months.select(area, month, F.transform(gap, lambda g: F.date_format(g, "yyyy-MM")).alias("gap"))
    # At most one entry per calendar month ends in the list.
    missing = F.sort_array(F.flatten(F.collect_list("gap")))
    return rows.groupBy(area).agg(
        F.date_format(F.min(month), "yyyy-MM").alias("first_month"), F.date_format(F.max(month), "yyyy-MM").alias("last_month"),
        F.sum(F.size("gap")).alias("missing_count"), F.array_join(missing, ",").alias("missing_months"))


def require_gapless(hours: DataFrame, cols: SeriesColumns = SERIES, sources: DataFrame | None = None) -> DataFrame:
    """Stop on a missing month; unknown counts are never filled with zero. With ``sources``, so is an hour outside them."""
    if sources is not None and (stray := present_months(hours, cols).join(present_months(hours, cols, sources), [cols.area, "month"], "left_anti").take(1)):
        raise ValueError(f"hours of {stray[0][cols.area]} outside the source months")
    bad = month_coverage(present_months(hours, cols, sources), cols.area).where("missing_count > 0").take(1)
    if bad:
        raise ValueError(f"missing source months for {bad[0][cols.area]}: {bad[0].missing_months}")
    return hours


def contract_violations(series: DataFrame, future_day: bool = False, cols: SeriesColumns = SERIES) -> DataFrame:
    """One row per area of violation counters; all zero means the history is usable.

    With ``future_day`` the last 24 labels must be empty and are not checked as history.
    """
    ts, v, a = F.col(cols.timestamp), F.col(cols.value).cast("double"), cols.area
    near = Window.partitionBy(a).orderBy(cols.timestamp)
    step = (clock.micros(ts) - clock.micros(F.lag(ts).over(near))) / 3_600_000_000
    last = F.max(ts).over(Window.partitionBy(a))
    ahead = (ts > last - F.expr("INTERVAL 24 HOURS")) if future_day else F.lit(False)
    bad = F.coalesce(F.isnan(v) | (F.abs(v) == float("inf")) | (v < 0), F.lit(True))
    rows = series.select(a, ts.alias("t"), v.alias("v"), step.alias("step"), ahead.alias("ahead"),
                         bad.alias("bad"), clock.clock_hours(ts).alias("h"))
    old = ~F.col("ahead")
    return rows.groupBy(a).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("step") == 0).alias("duplicate_labels"),
        F.count_if(F.col("step") > 1).alias("gaps"),
        F.count_if((F.col("step") > 0) & (F.col("step") < 1)).alias("off_grid"),
        F.when(F.hour(F.min("t")) != 0, 1).otherwise(0).alias("starts_mid_day"),
        F.when(F.hour(F.max("t")) != 23, 1).otherwise(0).alias("ends_mid_day"),
        F.count_if(old & F.col("bad")).alias("bad_counts"),
        F.count_if(~old & F.col("v").isNotNull()).alias("future_filled"),
        F.count_if(old & (F.col("h") == 0) & (F.col("v") != 0)).alias("gap_hour_nonzero"),
    )


def require_contract(series: DataFrame, future_day: bool = False, cols: SeriesColumns = SERIES) -> DataFrame:
    report = contract_violations(series, future_day, cols)
    faults = [c for c in report.columns if c not in (cols.area, "rows")]
    wrong = report.where(" OR ".join(f"{c} > 0" for c in faults)).take(1)
    if wrong:
        found = {c: wrong[0][c] for c in faults if wrong[0][c]}
        raise ValueError(f"history of {wrong[0][cols.area]} breaks its contract: {found}")
    return series


def cyclic(name: str, position: Column, period: float) -> dict[str, Column]:
    angle = position * F.lit(2 * math.pi / period)
    return {f"{name}_sin": F.sin(angle), f"{name}_cos": F.cos(angle)}


def calendar_features(series: DataFrame, cols: SeriesColumns = SERIES) -> DataFrame:
    """Calendar position of each clock label; known long before the day itself."""
    ts = F.col(cols.timestamp)
    return series.withColumns({
        "day": clock.trunc("day", ts),
        **cyclic("hour", F.hour(ts), 24),
        **cyclic("weekday", F.weekday(ts), 7),
        **cyclic("year", F.dayofyear(ts) - 1, 365.2425),
        "is_weekend": (F.weekday(ts) >= 5).cast("int"),
        "clock_hours": clock.clock_hours(ts),
    })


def same_hour_window(cols: SeriesColumns = SERIES):
    """Days of one clock hour in order: 24 short windows per area instead of one long one."""
    return Window.partitionBy(cols.area, F.hour(cols.timestamp)).orderBy(cols.timestamp)


def lag_days(series: DataFrame, days=LAGS, cols: SeriesColumns = SERIES) -> DataFrame:
    w = same_hour_window(cols)
    return series.withColumns({f"lag_{k}d": F.lag(cols.value, k).over(w).cast("double") for k in days})


def trailing_mean(value: Column, window, first: int, last: int) -> Column:
    """Mean over a row frame, null until the frame holds all its values."""
    frame = window.rowsBetween(first, last)
    return F.when(F.count(value).over(frame) == last - first + 1, F.avg(value).over(frame))


def same_hour_mean(series: DataFrame, days: int = 7, cols: SeriesColumns = SERIES) -> DataFrame:
    mean = trailing_mean(F.col(cols.value), same_hour_window(cols), -days, -1)
    return series.withColumn(f"same_hour_mean_{days}d", mean)


def previous_day_total(series: DataFrame, cols: SeriesColumns = SERIES) -> DataFrame:
    """Yesterday's sum on every hour of today, only if yesterday had 24 values."""
    day = Window.partitionBy(cols.area, clock.trunc("day", F.col(cols.timestamp)))
    total = F.when(F.count(cols.value).over(day) == 24, F.sum(cols.value).over(day))
    return (
        series.withColumn("__total", total)
        .withColumn("previous_day_total", F.lag("__total", 1).over(same_hour_window(cols)).cast("double"))
        .drop("__total")
    )


def demand_frame(series: DataFrame, cols: SeriesColumns = SERIES) -> DataFrame:
    """All features for day D from days before D; rows without full history are dropped."""
    framed = previous_day_total(same_hour_mean(lag_days(calendar_features(series, cols), LAGS, cols), 7, cols), cols)
    return framed.dropna(subset=list(FEATURES))


def future_scaffold(series: DataFrame, cols: SeriesColumns = SERIES) -> DataFrame:
    """Append 24 empty labels for the day after each area's last one."""
    first = F.date_add(F.max(cols.timestamp).cast("date"), 1).cast("timestamp_ntz")
    ahead = series.groupBy(cols.area).agg(first.alias("d")).select(
        cols.area,
        F.explode(F.sequence("d", F.col("d") + F.expr("INTERVAL 23 HOURS"), F.expr("INTERVAL 1 HOUR"))).alias(cols.timestamp),
        F.lit(None).cast(series.schema[cols.value].dataType).alias(cols.value))
    return series.select(cols.area, cols.timestamp, cols.value).unionByName(ahead)


def last_days(series: DataFrame, days: int = 7, cols: SeriesColumns = SERIES) -> Column:
    """True for labels in the last ``days`` days of the whole series (a scalar bound)."""
    top = series.agg(clock.trunc("day", F.max(cols.timestamp)).alias("d")).scalar()
    return F.col(cols.timestamp) >= top - F.expr(f"INTERVAL {days - 1} DAYS")
