"""Typing, flags and cleaning rules. Bad fields are flagged; rows are kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyridge.columns import CANONICAL_TRIP_COLUMNS, TRIPS, TripColumns
from tallyridge.functions import clock, numeric, text
from tallyridge.operators.prefix import melt, null_safe_join, value_profile

# Member categories of old and new schemas.
MEMBER_VALUES = {"subscriber": "member", "customer": "casual", "member": "member", "casual": "casual"}
LONG_MINUTES = 1440


def clean_trips(raw: DataFrame, month: Column, area: Column) -> DataFrame:
    """Canonical all-text trips to typed trips with quality flags.

    ``month`` is the source period as ``yyyy-MM``. Raw text and parsed value give two
    different flags: missing and unparseable.
    """
    c = F.col
    legacy = c("bike_id").isNotNull()
    typed = raw.select(
        text.blank_to_null(c("ride_id")).alias("ride_id"),
        text.default_unknown(c("rideable_type")).alias("rideable_type"),
        text.parse_clock(c("started_at")).alias("started_at"),
        text.parse_clock(c("ended_at")).alias("ended_at"),
        *[expr for end in ("start", "end") for expr in (
            text.integer_suffix_stripped(c(f"{end}_station_id"), legacy).alias(f"{end}_station_id"),
            text.blank_to_null(c(f"{end}_station_name")).alias(f"{end}_station_name"),
            rounded_coordinate(c(f"{end}_lat")).alias(f"{end}_lat"),
            rounded_coordinate(c(f"{end}_lng")).alias(f"{end}_lng"))],
        text.map_values(c("member_casual"), MEMBER_VALUES, "unknown").alias("member_casual"),
        text.blank_to_null(c("bike_id")).alias("bike_id"),
        numeric.try_double(c("reported_duration_seconds")).alias("reported_duration_seconds"),
        is_blank(c("started_at")).alias("missing_started_at"),
        is_blank(c("ended_at")).alias("missing_ended_at"),
        *[c(x) for x in raw.columns if x not in (*CANONICAL_TRIP_COLUMNS, "source_month", "area")],
        month.alias("source_month"), area.alias("area"),
    )
    return with_trip_flags(typed, c("source_month"))


def is_blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def rounded_coordinate(c: Column) -> Column:
    return F.round(numeric.try_double(c), 7)


def with_trip_flags(df: DataFrame, month: Column, cols: TripColumns = TRIPS) -> DataFrame:
    """Duration and the validity flags; none of the flags is ever null."""
    start = F.col(cols.started_at)
    minutes = F.col(cols.duration)
    return (
        df.withColumn(cols.duration, clock.minutes_between(start, F.col(cols.ended_at)))
        .withColumns({
            cols.valid_demand: F.coalesce(F.date_format(start, "yyyy-MM") == month, F.lit(False)),
            "valid_start_coordinates": valid_point(F.col(cols.start_lat), F.col(cols.start_lng)),
            "valid_end_coordinates": valid_point(F.col(cols.end_lat), F.col(cols.end_lng)),
        })
        .withColumns({
            cols.valid_duration: F.coalesce(F.col(cols.valid_demand) & (minutes > 0), F.lit(False)),
            "long_duration_flag": F.coalesce(minutes > LONG_MINUTES, F.lit(False)),
        })
    )


def valid_point(lat: Column, lng: Column) -> Column:
    return F.coalesce(lat.between(-90, 90) & lng.between(-180, 180), F.lit(False))


def physical_duration(df: DataFrame, cutoff: str | None = None, cols: TripColumns = TRIPS) -> DataFrame:
    """Reported seconds first, else elapsed time across clock changes.

    Rows in the repeated autumn hour without a reported duration are marked
    ``duration_ambiguous`` and never count as valid; with ``cutoff`` neither do trips
    that had not ended by then.
    """
    start, end, told = F.col(cols.started_at), F.col(cols.ended_at), F.col(cols.reported_seconds)
    ambiguous = F.coalesce(clock.autumn_repeat_label(start) | clock.autumn_repeat_label(end), F.lit(False))
    minutes = F.when(told.isNotNull(), told / 60.0).otherwise(clock.physical_minutes(start, end))
    known = F.col(cols.reported_seconds).isNotNull() | ~F.col("duration_ambiguous")
    ok = F.col(cols.valid_demand) & numeric.finite(F.col(cols.duration)) & (F.col(cols.duration) > 0) & known
    if cutoff:
        ok = ok & (end < F.lit(cutoff).cast("timestamp_ntz"))
    return (
        df.withColumns({"duration_ambiguous": ambiguous, cols.duration: minutes})
        .withColumn(cols.valid_duration, F.coalesce(ok, F.lit(False)))
    )


def zero_to_null(df: DataFrame, columns) -> DataFrame:
    return df.withColumns({c: F.nullif(F.col(c), F.lit(0).cast("double")) for c in columns})


def tidy_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower().replace("-", "_") for c in df.columns])


def fill_missing_category(df: DataFrame, columns, level: str) -> DataFrame:
    return df.fillna({c: level for c in columns})


def unexpected_values(df: DataFrame, allowed: dict[str, list[str]]) -> DataFrame:
    """Values outside each column's declared list, with their counts."""
    lists = F.create_map(*[x for k, v in allowed.items() for x in (F.lit(k), F.array(*[F.lit(i) for i in v]))])
    seen = melt(df, [], list(allowed)).where(F.col("value").isNotNull())
    return (
        seen.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        .where(~F.array_contains(F.try_element_at(lists, F.col("column")), F.col("value")))
    )


def contradictions(df: DataFrame, rule: Column, by: str) -> DataFrame:
    return df.where(rule).groupBy(by).agg(F.count(F.lit(1)).alias("n"))


def negative_counts(df: DataFrame, columns) -> DataFrame:
    one = df.agg(*[F.count_if(F.col(c) < 0).alias(c) for c in columns])
    return melt(one, [], columns, value="negatives")


def complete_rows(df: DataFrame) -> DataFrame:
    """Rows left if every column had to be filled, next to all rows."""
    full = F.lit(True)
    for c in df.columns:
        full = full & F.col(c).isNotNull()
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(full).alias("complete_rows"))


def in_box(df: DataFrame, lat: str, lng: str, box) -> DataFrame:
    south, north, west, east = box
    return df.where(F.col(lat).between(south, north) & F.col(lng).between(west, east))


def column_bounds(df: DataFrame, columns, low: float, high: float) -> DataFrame:
    """Two quantiles per column in one pass over the melted measures."""
    long = melt(df, [], columns, cast="double")
    return value_profile(long, ["column"], "value", {"low_q": low, "high_q": high}).select("column", "low_q", "high_q")


def _bound(bounds: DataFrame, column: str, field: str) -> Column:
    """One bound as a scalar subquery: a single value, computed once."""
    return bounds.where(F.col("column") == column).select(field).scalar()


def iqr_flags(df: DataFrame, columns, flag: str = "is_outlier") -> tuple[DataFrame, DataFrame]:
    """Rows marked when any measure leaves [Q1 - 1.5 IQR, Q3 + 1.5 IQR], plus the bounds."""
    spread = (F.col("high_q") - F.col("low_q")) * 1.5
    bounds = column_bounds(df, columns, 0.25, 0.75).select(
        "column", F.round(F.col("low_q") - spread, 6).alias("lower"), F.round(F.col("high_q") + spread, 6).alias("upper"))
    outside = F.lit(False)
    for c in columns:
        outside = outside | F.coalesce((F.col(c) < _bound(bounds, c, "lower")) | (F.col(c) > _bound(bounds, c, "upper")), F.lit(False))
    return df.withColumn(flag, outside), bounds


def clip_to_quantiles(df: DataFrame, columns, low: float = 0.005, high: float = 0.995) -> tuple[DataFrame, DataFrame]:
    """Measures pulled back to their own quantiles, plus the bounds used."""
    bounds = column_bounds(df, columns, low, high)
    clipped = df.withColumns({
        c: F.when(F.col(c).isNotNull(), F.least(F.greatest(F.col(c), _bound(bounds, c, "low_q")), _bound(bounds, c, "high_q")))
        for c in columns})
    return clipped, bounds


def effect_report(before: DataFrame, after: DataFrame, key: str, categories, measures, unknown: str) -> DataFrame:
    """Rows, repeats, empty cells, explicit unknowns and changed measures, before and after."""

    def facts(df: DataFrame, tag: str) -> DataFrame:
        content = [c for c in df.columns if c != key]
        groups = df.groupBy(*content).agg(F.count(F.lit(1)).alias("__n"))
        nulls = numeric.add([F.col(c).isNull().cast("int") for c in content])
        unknowns = numeric.add([F.coalesce((F.col(c) == unknown).cast("int"), F.lit(0)) for c in categories])
        one = groups.agg(
            F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("repeated_rows"),
            F.coalesce(F.sum(nulls * F.col("__n")), F.lit(0)).alias("empty_cells"),
            F.coalesce(F.sum(unknowns * F.col("__n")), F.lit(0)).alias("explicit_unknown"))
        return melt(one, [], one.columns, "check", tag, cast="bigint")

    pairs = after.join(before.select(key, *[F.col(m).alias(f"__b_{m}") for m in measures]), key)
    changed = numeric.add([(~F.col(m).eqNullSafe(F.col(f"__b_{m}"))).cast("int") for m in measures])
    moved = pairs.agg(F.coalesce(F.sum(changed), F.lit(0)).alias("after")).select(
        F.lit("changed_measures").alias("check"), F.lit(0).cast("bigint").alias("before"), "after")
    return facts(before, "before").join(facts(after, "after"), "check").unionByName(moved)


def segment_normalised(df: DataFrame, alias_ids: DataFrame, cols: TripColumns = TRIPS) -> DataFrame:
    """Serialisation-neutral form of possible copies, for comparing them.

    Station ids lose fractional trailing zeros where name and place are known; ids in
    ``alias_ids`` get whole-second clocks and a duration computed from those.
    """
    c = F.col
    known = {
        end: c(name).isNotNull() & c(lat).isNotNull() & c(lng).isNotNull()
        for end, name, lat, lng in ((cols.start_station, cols.start_name, cols.start_lat, cols.start_lng),
                                    (cols.end_station, cols.end_name, cols.end_lat, cols.end_lng))
    }
    flags = alias_ids.select(c(cols.ride_id), F.lit(True).alias("__alias"))
    keyed = df.where(c(cols.ride_id).isNotNull()).join(flags, cols.ride_id, "left")
    marked = keyed.unionByName(df.where(c(cols.ride_id).isNull()), allowMissingColumns=True)
    alias = F.coalesce(c("__alias"), F.lit(False))
    start, end = clock.trunc("second", c(cols.started_at)), clock.trunc("second", c(cols.ended_at))
    return marked.withColumns({
        **{station: text.trailing_zero_id(c(station), ok) for station, ok in known.items()},
        cols.duration: F.when(alias, clock.minutes_between(start, end)).otherwise(c(cols.duration)),
        cols.started_at: F.when(alias, start).otherwise(c(cols.started_at)),
        cols.ended_at: F.when(alias, end).otherwise(c(cols.ended_at)),
    }).drop("__alias").select(*df.columns)
