"""Named joins: lookups, fills, alignments and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyridge.columns import PREDICTIONS, SERIES, PredictionColumns, SeriesColumns
from tallyridge.functions import clock
from tallyridge.operators.prefix import null_safe_join


def lag_lookup(series: DataFrame, days: int, name: str, cols: SeriesColumns = SERIES) -> DataFrame:
    """Value at the same label ``days`` earlier, by key; null where that label is unknown."""
    earlier = series.select(cols.area, (F.col(cols.timestamp) + F.expr(f"INTERVAL {days} DAYS")).alias(cols.timestamp),
                            F.col(cols.value).alias(name))
    return series.join(earlier, [cols.area, cols.timestamp], "left")


def slot_means(train: DataFrame, cols: SeriesColumns = SERIES) -> DataFrame:
    ts = F.col(cols.timestamp)
    return train.groupBy(F.weekday(ts).alias("weekday"), F.hour(ts).alias("hour")).agg(F.avg(cols.value).alias("slot_mean"))


def slot_mean_fallback(rows: DataFrame, train: DataFrame, cols: SeriesColumns = SERIES) -> DataFrame:
    """Training mean of the same weekday and hour, else the training mean."""
    ts = F.col(cols.timestamp)
    keyed = rows.withColumns({"weekday": F.weekday(ts), "hour": F.hour(ts)})
    everything = train.agg(F.avg(cols.value)).scalar()
    joined = keyed.join(slot_means(train, cols), ["weekday", "hour"], "left")
    return joined.withColumn("predicted", F.coalesce(F.col("slot_mean"), everything)).drop("slot_mean")


def one_to_one(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join that stops when a key repeats on either side.

    Both sides are reduced to one row per key first; a repeated key raises inside the
    job that uses the result, so no extra pass is needed.
    """

    def unique(df: DataFrame) -> DataFrame:
        rest = [c for c in df.columns if c != key]
        packed = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), F.min(F.struct(*rest)).alias("__r"))
        ok = F.when(F.col("__n") == 1, F.col("__r")).otherwise(F.raise_error(F.concat(F.lit("key is not unique: "), F.col(key).cast("string"))))
        return packed.select(key, ok.alias("__r")).select(key, "__r.*")

    return unique(left).join(unique(right), key, how)


def lookup_dimension(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Attach names to group metrics; groups without a name stay."""
    return facts.join(dimension, key, "left")


def aligned_predictions(preds: DataFrame, first: str, second: str, cols: PredictionColumns = PREDICTIONS) -> DataFrame:
    """Two models side by side on the same rows, without a self-join: one pass, one group per row."""
    def pick(model, field):
        return F.max(F.when(F.col(cols.model) == model, F.col(field)))

    rows = preds.where(F.col(cols.model).isin(first, second)).groupBy(cols.row).agg(
        F.max(cols.truth).alias(cols.truth), F.max(cols.fold).alias(cols.fold),
        pick(first, cols.label).alias("first_label"), pick(second, cols.label).alias("second_label"),
        pick(first, cols.score).alias("first_score"), pick(second, cols.score).alias("second_score"))
    return rows.where(F.col("first_label").isNotNull() & F.col("second_label").isNotNull())


def error_cross_tab(aligned: DataFrame, cols: PredictionColumns = PREDICTIONS) -> DataFrame:
    truth = F.col(cols.truth)
    return aligned.groupBy((F.col("first_label") == truth).alias("first_correct"),
                           (F.col("second_label") == truth).alias("second_correct")).agg(F.count(F.lit(1)).alias("n"))


def attribute_map(rows: DataFrame, attributes: DataFrame, key: str) -> DataFrame:
    return rows.join(attributes, key, "left")


def block_consistency(rows: DataFrame, row_no: str, size: int, reference: DataFrame, label: str, columns) -> DataFrame:
    """Compare rows with the reference entry of their block (``row_no // size``).

    ``reference`` has ``block``, the label and list-valued text such as ``[a, b]`` per
    column. Returns violation counts per check.
    """
    block = F.floor(F.col(row_no) / size).cast("bigint")
    named = reference.select("block", F.col(label).alias("__label"), *[F.col(c).alias(f"__{c}") for c in columns])
    joined = rows.withColumn("block", block).join(named, "block", "left")
    allowed = {c: F.transform(F.split(F.col(f"__{c}"), ","), lambda v: F.btrim(v, F.lit(" []"))) for c in columns}
    checks = {
        "unknown_block": F.col("__label").isNull(),
        "class_mismatch": F.col(label) != F.col("__label"),
        **{c: F.col(c).isNotNull() & ~F.coalesce(F.array_contains(allowed[c], F.col(c)), F.lit(False)) for c in columns},
    }
    one = joined.agg(*[F.count_if(F.coalesce(v, F.lit(False))).alias(k) for k, v in checks.items()])
    return one.unpivot([], list(checks), "check", "violations")


def content_overlap(part: DataFrame, other: DataFrame, columns) -> DataFrame:
    """Rows of ``part`` whose content also occurs in ``other`` (null equals null)."""
    return null_safe_join(part, other.select(*columns).distinct().withColumn("__hit", F.lit(True)), list(columns)).drop("__hit")


def metric_difference(left: DataFrame, right: DataFrame, key: str, metrics) -> DataFrame:
    r = right.select(key, *[F.col(m).alias(f"__{m}") for m in metrics])
    return left.join(r, key).select(key, *[F.col(m) for m in metrics], *[(F.col(f"__{m}") - F.col(m)).alias(f"{m}_difference") for m in metrics])


def tolerance_report(stored: DataFrame, recomputed: DataFrame, key: str, metrics, eps: float) -> DataFrame:
    """Per key and metric: stored value, recomputed value and whether they agree."""
    s = stored.select(key, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot([key], list(metrics), "metric", "stored")
    r = recomputed.select(key, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot([key], list(metrics), "metric", "recomputed")
    gap = F.abs(F.col("stored") - F.col("recomputed"))
    return s.join(r, [key, "metric"], "full").select(
        key, "metric", "stored", "recomputed", F.coalesce(gap < eps, F.lit(False)).alias("agrees"))


def fold_membership(rows: DataFrame, bounds: DataFrame, day: str = "day") -> DataFrame:
    """Train/validation role of each row per fold.

    Fold bounds come as days, so membership is an equi-join on the day: each bound row
    is expanded to the days it covers, which keeps the join hashable.
    """
    one_day = F.expr("INTERVAL 1 DAY")
    roles = bounds.select("fold", F.explode(F.array(
        F.struct(F.lit("train").alias("role"), F.sequence("train_start", F.col("train_end") - one_day, one_day).alias("days")),
        F.struct(F.lit("validation").alias("role"), F.sequence("valid_start", F.col("valid_end") - one_day, one_day).alias("days")))).alias("r"))
    days = roles.select("fold", "r.role", F.explode("r.days").alias(day))
    return rows.join(days, day)


def weekly_baseline(series: DataFrame, cols: SeriesColumns = SERIES) -> DataFrame:
    """Last week's value per label, zero where the label has no physical hour."""
    rows = lag_lookup(series, 7, "baseline_rides", cols)
    return rows.withColumn("baseline_rides", zero_in_gap(F.col("baseline_rides"), clock.clock_hours(F.col(cols.timestamp))))


def zero_in_gap(value: Column, hours: Column) -> Column:
    return F.when(hours == 0, F.lit(0).cast("double")).otherwise(value.cast("double"))
