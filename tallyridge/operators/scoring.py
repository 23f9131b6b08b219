"""Operational scoring rules, naive models and residual tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyridge.columns import SERIES, SeriesColumns
from tallyridge.functions import clock
from tallyridge.functions.numeric import finite
from tallyridge.operators.series import FEATURES, HISTORY_DAYS, demand_frame, future_scaffold


def operational(prediction: Column, hours: Column) -> Column:
    """Clipped at zero, zero where the label has no physical hour; not finite is an error."""
    p = prediction.cast("double")
    safe = F.when(finite(p), p).when(p.isNull(), F.lit(None).cast("double")).otherwise(
        F.raise_error(F.lit("model gave a prediction that is not finite")).cast("double"))
    return F.when(hours == 0, F.lit(0.0)).otherwise(F.greatest(safe, F.lit(0.0)))


def seasonal_naive(frame: DataFrame) -> DataFrame:
    return frame.withColumn("predicted_rides", operational(F.col("lag_7d"), F.col("clock_hours")))


def global_mean(rows: DataFrame, train: DataFrame, cols: SeriesColumns = SERIES) -> DataFrame:
    return rows.withColumn("predicted", train.agg(F.avg(cols.value)).scalar())


def day_ahead(series: DataFrame, score=seasonal_naive, cols: SeriesColumns = SERIES) -> DataFrame:
    """Forecast of the day after the history: 24 labels per area.

    ``score`` turns a feature frame into one with ``predicted_rides``. Only the last 14
    days are read by the features, whatever the length of the history.
    """
    first = clock.trunc("day", F.max(cols.timestamp)) - F.expr(f"INTERVAL {HISTORY_DAYS - 1} DAYS")
    recent = series.join(series.groupBy(cols.area).agg(first.alias("__from")), cols.area).where(
        F.col(cols.timestamp) >= F.col("__from")).drop("__from")
    frame = demand_frame(future_scaffold(recent, cols), cols).where(F.col(cols.value).isNull())
    return score(frame).select(cols.area, cols.timestamp, "clock_hours", "predicted_rides")


def rolling_origin(frame: DataFrame, start: str, score=seasonal_naive, cols: SeriesColumns = SERIES) -> DataFrame:
    """Every day from ``start`` on, scored with earlier days only.

    The features of day D hold nothing of day D, so one pass over the frame equals the
    day-by-day loop of forecasting, observing and moving on.
    """
    rows = frame.where(F.col("day") >= F.lit(start).cast("timestamp_ntz"))
    return residual_table(score(rows), cols.value, "predicted_rides", cols)


def residual_table(scored: DataFrame, actual: str = "rides", predicted: str = "predicted_rides", cols: SeriesColumns = SERIES) -> DataFrame:
    ts = F.col(cols.timestamp)
    gap = F.col(actual) - F.col(predicted)
    return scored.select(
        cols.area, cols.timestamp, actual, predicted, gap.alias("residual"), F.abs(gap).alias("absolute_error"),
        F.hour(ts).alias("hour"), F.weekday(ts).alias("weekday"), F.month(ts).alias("month"), clock.season(ts).alias("season"))


def daily_forecast(scored: DataFrame, cols: SeriesColumns = SERIES) -> DataFrame:
    """Day total next to the 24 hourly values in clock order (a day has 24 labels)."""
    hours = F.array_sort(F.collect_list(F.struct(F.hour(cols.timestamp).alias("h"), F.round("predicted_rides", 3).alias("p"))))
    text = F.array_join(F.transform(hours, lambda s: F.format_string("%.3f", s["p"])), ",")
    return scored.groupBy(cols.area, clock.trunc("day", F.col(cols.timestamp)).alias("day")).agg(
        F.sum("predicted_rides").alias("total"), text.alias("hourly"))


def decision(score: Column) -> Column:
    """Score policy: at or above one half is suspect, below is uncertain, invalid is null."""
    ok = score.between(0, 1) & ~F.isnan(score)
    return F.when(ok & (score >= 0.5), "suspected").when(ok, "uncertain")


def with_decision(df: DataFrame, score: str) -> tuple[DataFrame, DataFrame]:
    """Decided rows, and the quarantine of rows whose score is not a probability."""
    marked = df.withColumn("decision", decision(F.col(score)))
    return marked.where(F.col("decision").isNotNull()), marked.where(F.col("decision").isNull()).drop("decision")


def parity(first: DataFrame, second: DataFrame, key: str, score: str) -> DataFrame:
    """Largest difference between two scorings of the same rows, and rows only one has."""
    both = first.select(key, F.col(score).alias("a")).join(second.select(key, F.col(score).alias("b")), key, "full")
    return both.agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.abs(F.col("a") - F.col("b"))).alias("max_difference"),
        F.count_if(F.col("a").isNull() | F.col("b").isNull()).alias("unmatched"))


FEATURE_COLUMNS = list(FEATURES)
