"""Summary tables over trips and hourly series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyridge.columns import SERIES, TRIPS, SeriesColumns, TripColumns
from tallyridge.functions import clock, numeric
from tallyridge.operators.prefix import value_profile

# Vehicle categories the sources are known to use.
KNOWN_VEHICLES = ("unknown", "classic_bike", "electric_bike", "docked_bike")


def quality_counters(cols: TripColumns = TRIPS) -> dict[str, Column]:
    """Every quality counter as an additive aggregate, so partial results can be merged."""
    c = F.col
    start, end, minutes = c(cols.started_at), c(cols.ended_at), c(cols.duration)
    n = F.count_if
    return {
        "rows": F.count(F.lit(1)),
        "valid_demand": n(c(cols.valid_demand)),
        "invalid_start": n(start.isNull()),
        "invalid_end": n(end.isNull()),
        "outside_source_month": n(start.isNotNull() & ~c(cols.valid_demand)),
        "missing_start_station": n(c(cols.start_station).isNull()),
        "missing_end_station": n(c(cols.end_station).isNull()),
        "bad_start_coordinates": n(~c("valid_start_coordinates")),
        "bad_end_coordinates": n(~c("valid_end_coordinates")),
        "nonpositive_duration": n(minutes <= 0),
        "long_duration": n(c("long_duration_flag")),
        "valid_duration": n(c(cols.valid_duration)),
        "unknown_member": n(c(cols.member) == "unknown"),
        "unknown_bike": n(c(cols.vehicle) == "unknown"),
        "missing_ride_id": n(c(cols.ride_id).isNull()),
        "missing_started_at": n(c("missing_started_at")),
        "missing_ended_at": n(c("missing_ended_at")),
        "unparseable_start": n(start.isNull() & ~c("missing_started_at")),
        "unparseable_end": n(end.isNull() & ~c("missing_ended_at")),
        "reported_duration_mismatch": n(F.abs(c(cols.reported_seconds) - minutes * 60) > 1),
        "negative_duration": n(minutes < 0),
        "unknown_bike_category": n(~c(cols.vehicle).isin(*KNOWN_VEHICLES)),
    }


def quality(df: DataFrame, by=(), cols: TripColumns = TRIPS) -> DataFrame:
    return df.groupBy(*by).agg(*[e.alias(k) for k, e in quality_counters(cols).items()])


def usable_minutes(cols: TripColumns = TRIPS) -> Column:
    return F.when(F.col(cols.valid_duration), F.col(cols.duration))


def monthly_summary(trips: DataFrame, cols: TripColumns = TRIPS) -> DataFrame:
    rows = trips.where(F.col(cols.valid_demand)).withColumn("period", clock.trunc("month", F.col(cols.started_at)))
    return value_profile(rows, ["period"], usable_minutes(cols), {"median_duration": 0.5}, rows="rides").select(
        "period", "rides", "median_duration")


def member_vehicle(trips: DataFrame, cols: TripColumns = TRIPS) -> DataFrame:
    rows = trips.where(F.col(cols.valid_demand))
    out = value_profile(rows, [cols.member, cols.vehicle], usable_minutes(cols), {"median_duration": 0.5}, rows="rides")
    return out.select(cols.member, cols.vehicle, "rides", F.col("mean").alias("mean_duration"), "median_duration").orderBy(
        F.desc("rides"), cols.member, cols.vehicle)


def approximate_monthly(trips: DataFrame, accuracy: int = 10_000, cols: TripColumns = TRIPS) -> DataFrame:
    """Sketch-based variant of :func:`monthly_summary` for one-pass dashboards."""
    return (
        trips.where(F.col(cols.valid_demand)).groupBy(clock.trunc("month", F.col(cols.started_at)).alias("period"))
        .agg(F.count(F.lit(1)).alias("rides"),
             F.percentile_approx(usable_minutes(cols), 0.5, accuracy).alias("median_duration"))
    )


def type_matrix(trips: DataFrame, members, cols: TripColumns = TRIPS) -> DataFrame:
    """Vehicle x member counts with zero for absent pairs."""
    return (
        trips.where(F.col(cols.valid_demand)).groupBy(cols.vehicle)
        .agg(*[F.count_if(F.col(cols.member) == m).alias(m) for m in members], F.count(F.lit(1)).alias("total"))
    )


def top_start_stations(trips: DataFrame, limit: int = 25, cols: TripColumns = TRIPS) -> DataFrame:
    station = F.col(cols.start_station)
    return (
        trips.where(F.col(cols.valid_demand) & station.isNotNull()).groupBy(cols.start_station)
        .agg(F.count(F.lit(1)).alias("rides"),
             F.count_distinct(F.col(cols.start_name)).alias("name_variants"),
             F.count_distinct(F.year(cols.started_at)).alias("active_years"),
             F.min(cols.start_name).alias("example_name"))
        .orderBy(F.desc("rides"), cols.start_station).limit(limit)
    )


def top_end_stations(trips: DataFrame, limit: int = 25, cols: TripColumns = TRIPS) -> DataFrame:
    return (
        trips.where(F.col(cols.valid_demand) & F.col(cols.end_station).isNotNull()).groupBy(cols.end_station)
        .agg(F.count(F.lit(1)).alias("rides"), F.min(cols.end_name).alias("example_name"))
        .orderBy(F.desc("rides"), cols.end_station).limit(limit)
    )


def top_routes(trips: DataFrame, limit: int = 20, cols: TripColumns = TRIPS) -> DataFrame:
    a, b = cols.start_station, cols.end_station
    return (
        trips.where(F.col(cols.valid_demand) & F.col(a).isNotNull() & F.col(b).isNotNull())
        .groupBy(a, b).agg(F.count(F.lit(1)).alias("rides"))
        .orderBy(F.desc("rides"), a, b).limit(limit)
    )


def net_flow(trips: DataFrame, limit: int = 25, cols: TripColumns = TRIPS) -> DataFrame:
    """Arrivals minus departures per station: one scan, both ends as signed rows."""
    ends = F.explode(F.array(
        F.struct(F.col(cols.start_station).alias("station_id"), F.lit(-1).cast("bigint").alias("net")),
        F.struct(F.col(cols.end_station).alias("station_id"), F.lit(1).cast("bigint").alias("net")))).alias("e")
    return (
        trips.where(F.col(cols.valid_demand)).select(ends).select("e.*").where(F.col("station_id").isNotNull())
        .groupBy("station_id").agg(F.sum("net").alias("net_inflow"))
        .orderBy(F.desc(F.abs("net_inflow")), "station_id").limit(limit)
    )


def duration_daily(trips: DataFrame, members=("member", "casual"), since: str | None = None, cols: TripColumns = TRIPS) -> DataFrame:
    rows = trips.where(F.col(cols.valid_duration) & F.col(cols.member).isin(*members))
    if since:
        rows = rows.where(F.col(cols.started_at) >= F.lit(since).cast("timestamp_ntz"))
    rows = rows.withColumn("day", clock.trunc("day", F.col(cols.started_at)))
    return value_profile(rows, ["day", cols.member], cols.duration, {"median_duration": 0.5}, rows="rides").select(
        "day", cols.member, "rides", F.col("mean").alias("mean_duration"), "median_duration")


def duration_statistics(trips: DataFrame, cols: TripColumns = TRIPS) -> DataFrame:
    marks = {"q25": 0.25, "q50": 0.5, "q75": 0.75, "q95": 0.95, "q99": 0.99}
    out = value_profile(trips.where(F.col(cols.valid_duration)), [], cols.duration, marks, rows="rides")
    return out.select("rides", "mean", "sd", *marks, "minimum", "maximum")


def coordinate_quality(trips: DataFrame, cols: TripColumns = TRIPS) -> DataFrame:
    return (
        trips.where(F.col(cols.valid_demand)).groupBy(F.year(cols.started_at).alias("year"))
        .agg(F.count(F.lit(1)).alias("rides"),
             F.count_if(F.col("valid_start_coordinates") & F.col("valid_end_coordinates")).alias("valid_coordinates"),
             F.count_if(F.col(cols.start_station).isNull()).alias("missing_start_station"),
             F.count_if(F.col(cols.end_station).isNull()).alias("missing_end_station"))
    )


def duration_policy(physical: DataFrame, cols: TripColumns = TRIPS) -> DataFrame:
    return physical.agg(
        F.count_if(F.col("duration_ambiguous") & F.col(cols.reported_seconds).isNull()).alias("uncertain_physical_duration"),
        F.count_if(F.col(cols.valid_duration)).alias("usable_physical_duration"))


def time_bounds(trips: DataFrame, by=(), cols: TripColumns = TRIPS) -> DataFrame:
    return trips.where(F.col(cols.valid_demand)).groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.min(cols.started_at).alias("first_start"), F.max(cols.started_at).alias("last_start"))


def reconciliation(raw: DataFrame, kept: DataFrame, removed: DataFrame, part: str = "source_month", target: str = "target_month") -> DataFrame:
    """raw + in - out = retained + removed, per partition.

    ``kept`` holds the surviving rows with the partition they came from and the one they end in, ``removed`` the rows
    that were dropped. The three tables are counted on their own, so a lost row leaves its partition unbalanced.
    """
    counts = {"raw_rows": raw.select(F.col(part).alias("p"), F.lit("raw_rows").alias("what")),
              "removed_rows": removed.select(F.col(part).alias("p"), F.lit("removed_rows").alias("what"))}
    moves = kept.groupBy(part, target).agg(F.count(F.lit(1)).alias("n"))
    hop = F.col(part) != F.col(target)
    flows = moves.select(F.explode(F.array(
        F.struct(F.col(target).alias("p"), F.lit("retained_rows").alias("what"), "n"),
        F.struct(F.when(hop, F.col(part)).alias("p"), F.lit("moved_out").alias("what"), "n"),
        F.struct(F.when(hop, F.col(target)).alias("p"), F.lit("moved_in").alias("what"), "n"))).alias("s")).select("s.*").where("p IS NOT NULL")
    own = counts["raw_rows"].unionByName(counts["removed_rows"]).groupBy("p", "what").agg(F.count(F.lit(1)).alias("n"))
    names = ["raw_rows", "moved_in", "moved_out", "retained_rows", "removed_rows"]
    wide = own.unionByName(flows).groupBy(F.col("p").alias(part)).pivot("what", names).agg(F.sum("n")).fillna(0, names)
    return wide.select(part, *names, (F.col("raw_rows") + F.col("moved_in") - F.col("moved_out") == F.col("retained_rows") + F.col("removed_rows")).alias("balanced"))


def daily_share(series: DataFrame, first_hour: int = 7, last_hour: int = 9, cols: SeriesColumns = SERIES) -> DataFrame:
    """Day totals and the percentage that falls in the morning hours."""
    ts = F.col(cols.timestamp)
    morning = F.when(F.hour(ts).between(first_hour, last_hour), F.col(cols.value)).otherwise(0)
    day = series.groupBy(cols.area, clock.trunc("day", ts).alias("day")).agg(
        F.sum(cols.value).alias("rides"), F.sum(morning).alias("morning"))
    return day.withColumn("share", numeric.ratio(F.col("morning") * 100, F.nullif(F.col("rides"), F.lit(0).cast("bigint"))))


def complete_weeks(days: DataFrame, by=("area",), day: str = "day") -> DataFrame:
    """Only days of weeks that have all seven days."""
    rows = days.withColumn("week", clock.monday_of(F.col(day)))
    size = F.count(F.lit(1)).over(Window.partitionBy(*by, "week"))
    return rows.withColumn("__n", size).where("__n = 7").drop("__n")


def weekly_effect(days: DataFrame, value: str = "share", by=("area",), day: str = "day") -> DataFrame:
    """Weekday mean minus weekend mean per complete week."""
    weekend = F.weekday(F.col(day)) >= 5
    return complete_weeks(days, by, day).groupBy(*by, "week").agg(
        (F.avg(F.when(~weekend, F.col(value))) - F.avg(F.when(weekend, F.col(value)))).alias("effect"))


def shift_hours(series: DataFrame, hours: int, name: str, cols: SeriesColumns = SERIES) -> DataFrame:
    """Value ``hours`` labels earlier in a gap-free series (whole days use short windows)."""
    if hours % 24 == 0:
        w = Window.partitionBy(cols.area, F.hour(cols.timestamp)).orderBy(cols.timestamp)
        return series.withColumn(name, F.lag(cols.value, hours // 24).over(w))
    w = Window.partitionBy(cols.area).orderBy(cols.timestamp)
    return series.withColumn(name, F.lag(cols.value, hours).over(w))


def weekly_autocorrelation(series: DataFrame, cols: SeriesColumns = SERIES) -> DataFrame:
    """Pearson r between a full week of hours and the same hours a week before."""
    rows = shift_hours(series, 168, "previous_week", cols).where(F.col("previous_week").isNotNull())
    week = rows.groupBy(cols.area, clock.monday_of(F.col(cols.timestamp)).alias("week"))
    return week.agg(F.count(F.lit(1)).alias("hours"), F.corr(F.col(cols.value).cast("double"), F.col("previous_week").cast("double")).alias("r")).where(
        "hours = 168").select(cols.area, "week", "r")


def paired_difference(daily: DataFrame, high: str, low: str, value: str = "median_duration", by: str = TRIPS.member) -> DataFrame:
    """Weekly mean of the day-by-day difference between two groups, full weeks only."""
    wide = daily.groupBy("day").pivot(by, [high, low]).agg(F.max(value)).dropna(subset=[high, low])
    return complete_weeks(wide, (), "day").groupBy("week").agg(F.avg(F.col(high) - F.col(low)).alias("effect"))


def hour_weekday_matrix(series: DataFrame, cols: SeriesColumns = SERIES) -> DataFrame:
    ts = F.col(cols.timestamp)
    rows = series.select(F.weekday(ts).alias("weekday"), F.hour(ts).alias("hour"), F.col(cols.value).alias("v"))
    wide = rows.groupBy("weekday").pivot("hour", list(range(24))).agg(F.avg("v"))
    return wide.select("weekday", *[F.col(str(h)).alias(f"h{h:02d}") for h in range(24)])


def day_type_pattern(series: DataFrame, cols: SeriesColumns = SERIES) -> DataFrame:
    weekend = F.weekday(cols.timestamp) >= 5
    v = F.col(cols.value)
    return series.groupBy(F.hour(cols.timestamp).alias("hour")).agg(
        F.avg(F.when(~weekend, v)).alias("working_day"), F.avg(F.when(weekend, v)).alias("weekend"))


def daily_totals(series: DataFrame, cols: SeriesColumns = SERIES) -> DataFrame:
    return series.groupBy(cols.area, clock.trunc("day", F.col(cols.timestamp)).alias("day")).agg(F.sum(cols.value).alias(cols.value))


def segment_errors(residuals: DataFrame, segments) -> DataFrame:
    """MAE, bias and size per value of each segment column, in one aggregation."""
    sets = [[F.col(s)] for s in segments]
    names = F.coalesce(*[F.when(F.grouping(s) == 0, F.lit(s)) for s in segments])
    values = F.coalesce(*[F.when(F.grouping(s) == 0, F.col(s).cast("string")) for s in segments])
    out = residuals.groupingSets(sets, *[F.col(s) for s in segments]).agg(
        names.alias("segment"), values.alias("level"),
        F.avg("absolute_error").alias("mae"), F.avg("residual").alias("bias"), F.count(F.lit(1)).alias("n"))
    return out.select("segment", "level", "mae", "bias", "n")


def worst_segments(errors: DataFrame) -> DataFrame:
    """Level with the highest MAE per segment; ties go to the smallest level."""
    pick = F.min(F.struct((-F.col("mae")).alias("m"), F.col("level"))).alias("x")
    return errors.groupBy("segment").agg(pick).select("segment", F.col("x.level").alias("level"), (-F.col("x.m")).alias("mae"))


def residual_summary(residuals: DataFrame) -> DataFrame:
    out = value_profile(residuals, [], "absolute_error", {"median_absolute_error": 0.5})
    bias = residuals.agg(F.avg("residual").alias("b")).scalar()
    return out.select(bias.alias("mean_bias"), "median_absolute_error", F.col("rows").alias("n"))


def regression_metrics(df: DataFrame, actual: str, predicted: str, by=()) -> DataFrame:
    """RMSE, MAE and R2 from additive sums."""
    y, e = F.col(actual).cast("double"), F.col(actual) - F.col(predicted)
    spread = F.var_pop(y) * F.count(y)
    return df.groupBy(*by).agg(
        F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
        (1 - F.try_divide(F.sum(e * e), spread)).alias("r2"), F.count(F.lit(1)).alias("n"))


def extremes(df: DataFrame, value: str, keep, tie: str, limit: int = 10) -> DataFrame:
    return df.select(*keep).orderBy(F.desc_nulls_last(value), tie).limit(limit)


def extreme_counts(df: DataFrame, value: str = TRIPS.duration) -> DataFrame:
    v = F.col(value)
    middle = value_profile(df, [], value, {"median_minutes": 0.5})
    over = df.agg(F.count_if(v > 1440).alias("over_24h"), F.count_if(v > 7 * 1440).alias("over_7days"))
    return middle.select("rows", over.select("over_24h").scalar().alias("over_24h"), over.select("over_7days").scalar().alias("over_7days"),
                         "median_minutes", F.col("maximum").alias("maximum_minutes"))


def equal_width_bins(df: DataFrame, value: str, low: Column, high: Column, n: int, log: bool = False) -> DataFrame:
    """Histogram counts; the top edge belongs to the last bin."""
    move = (lambda c: F.ln(c)) if log else (lambda c: c)
    bin_no = F.least(F.width_bucket(move(F.col(value)), move(low), move(high), F.lit(n)), F.lit(n).cast("bigint"))
    return df.where(F.col(value).isNotNull()).groupBy(bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def spatial_bins(df: DataFrame, lat: str, lng: str, cell: float) -> DataFrame:
    def index(c):
        return F.floor(F.round(F.col(c) / cell, 6)).cast("bigint")

    return df.groupBy(index(lat).alias("lat_bin"), index(lng).alias("lng_bin")).agg(F.count(F.lit(1)).alias("n"))


def hexagon_bins(df: DataFrame, lat: str, lng: str, box: tuple[float, float, float, float], across: int = 45) -> DataFrame:
    """Rows per hexagon of a honeycomb with ``across`` cells over the width of ``box`` (south, north, west, east).

    The centres of a honeycomb are two rectangular lattices, one shifted by half a cell both ways. A point belongs to
    the nearer of its two nearest centres, height counting three times as its cells are wider than high; ties go to
    the unshifted lattice. Rows with a null or infinite coordinate are left out.
    """
    south, north, west, east = (float(x) for x in box)
    wide, high = (east - west) / across, (north - south) / max(1, int(across / 3 ** 0.5))
    x, y = (F.col(lng) - west) / wide, (F.col(lat) - south) / high

    def centre(shift: float) -> tuple[Column, Column, Column]:
        cx, cy = F.floor(x - shift + 0.5) + shift, F.floor(y - shift + 0.5) + shift
        return cx, cy, (x - cx) * (x - cx) + 3 * (y - cy) * (y - cy)

    (ax, ay, a), (bx, by, b) = centre(0.0), centre(0.5)
    known = df.where(numeric.finite(F.col(lat)) & numeric.finite(F.col(lng)))
    first = F.round(a, 9) <= F.round(b, 9)
    cells = known.groupBy(F.when(first, ax).otherwise(bx).alias("__x"), F.when(first, ay).otherwise(by).alias("__y")).agg(F.count(F.lit(1)).alias("n"))
    return cells.select((F.col("__y") * high + south).alias("lat"), (F.col("__x") * wide + west).alias("lng"), "n")


def box_stats(df: DataFrame, by: str, value: str) -> DataFrame:
    """Quartiles and the most extreme values inside the 1.5-IQR fences."""
    marks = value_profile(df, [by], value, {"q1": 0.25, "median": 0.5, "q3": 0.75}).select(by, "q1", "median", "q3")
    spread = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.when(F.col(value).between(F.col("q1") - spread, F.col("q3") + spread), F.col(value))
    whisker = df.join(marks, by).groupBy(by).agg(F.min(inside).alias("whisker_low"), F.max(inside).alias("whisker_high"))
    return marks.join(whisker, by)


def autocorrelation(series: DataFrame, lags, cols: SeriesColumns = SERIES) -> DataFrame:
    """Pearson r with the shifted self, and the mean-centred ACF, per area and lag.

    A gap-free hourly label is its own position, so hour t meets hour t + k through an
    equi-join on the label: rows x lags come out, no ordering of the series is needed.
    """
    a, ts = cols.area, cols.timestamp
    x = series.select(a, ts, F.col(cols.value).cast("double").alias("x"))
    whole = x.groupBy(a).agg(F.avg("x").alias("m"), (F.var_pop("x") * F.count("x")).alias("ss"))
    lag = F.explode(F.array(*[F.lit(int(k)) for k in lags])).alias("lag")
    early = x.select(a, ts, F.col("x").alias("x0"), lag).withColumn(
        ts, F.col(ts) + F.make_dt_interval(F.lit(0), F.col("lag")))
    pairs = early.join(x, [a, ts]).join(whole, a)
    return pairs.groupBy(a, "lag").agg(
        F.corr("x0", "x").alias("r"),
        F.try_divide(F.sum((F.col("x0") - F.col("m")) * (F.col("x") - F.col("m"))), F.max("ss")).alias("acf"),
        F.count(F.lit(1)).alias("pairs"))
