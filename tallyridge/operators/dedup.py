"""Duplicate ids, proven copies and month alignment.

Nothing here ranks the rows of one id in a window: the surviving row is a ``min``
over an ordering struct, which combines on the map side however often an id repeats.
Rows without id bypass every id-keyed shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyridge.columns import CANONICAL_TRIP_COLUMNS, TRIPS, TripColumns
from tallyridge.functions import clock
from tallyridge.operators.clean import segment_normalised

CONTENT = (*CANONICAL_TRIP_COLUMNS, TRIPS.duration, TRIPS.area)


def first_by_key(df: DataFrame, key: str, order, columns) -> DataFrame:
    """Smallest row per key by ``order``, then by content; the key must not be null."""
    order = [o if isinstance(o, Column) else F.col(o) for o in order]
    packed = df.select(F.col(key).alias("__key"), F.struct(
        *[o.alias(f"o{i}") for i, o in enumerate(order)], F.struct(*columns).alias("row")).alias("__pick"))
    return packed.groupBy("__key").agg(F.min("__pick").alias("p")).select("p.row.*")


def keep_first(df: DataFrame, key: str, order, columns=None) -> DataFrame:
    """One row per non-null key; rows with a null key all stay."""
    columns = list(columns or df.columns)
    best = first_by_key(df.where(F.col(key).isNotNull()), key, order, columns)
    return df.where(F.col(key).isNull()).select(*columns).unionByName(best)


def dedup_first(df: DataFrame, cols: TripColumns = TRIPS, columns=None) -> DataFrame:
    """Earliest row per id; rows without id keep their exact multiplicity."""
    start = F.coalesce(clock.micros(F.col(cols.started_at)), F.lit(2**62))
    return keep_first(df, cols.ride_id, [start], columns)


def duplicate_ids(df: DataFrame, key: str = TRIPS.ride_id) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def duplicate_rows(df: DataFrame, key: str = TRIPS.ride_id) -> DataFrame:
    return df.join(duplicate_ids(df, key).select(key), key, "left_semi")


def conflicting_ids(df: DataFrame, content, key: str = TRIPS.ride_id) -> DataFrame:
    """Ids whose rows do not all carry the same content."""
    rows = df.where(F.col(key).isNotNull()).select(key, *[c for c in content if c != key]).distinct()
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("versions")).where("versions > 1")


def require_no_conflicts(df: DataFrame, content, key: str = TRIPS.ride_id) -> DataFrame:
    """Same id with different content stops the run."""
    bad = conflicting_ids(df, content, key).select(F.min(key).alias("k"), F.count(F.lit(1)).alias("n")).first()
    if bad.n:
        raise ValueError(f"{bad.n} ids have conflicting content, e.g. {bad.k}")
    return df


def time_alias_ids(df: DataFrame, cols: TripColumns = TRIPS) -> DataFrame:
    """Ids whose copies differ only in sub-second precision, with one whole-second version."""
    s, e = F.col(cols.started_at), F.col(cols.ended_at)
    s0, e0 = clock.trunc("second", s), clock.trunc("second", e)
    differs = lambda c: ~F.min(c).eqNullSafe(F.max(c))  # noqa: E731 - two distinct values <=> min differs from max
    return (
        df.where(F.col(cols.ride_id).isNotNull()).groupBy(cols.ride_id)
        .agg(F.count(F.lit(1)).alias("copies"), (differs(s) | differs(e)).alias("clock_differs"),
             (F.count(s0) > 0).alias("has_start"), (F.count(e0) > 0).alias("has_end"),
             (differs(s0) | differs(e0)).alias("second_differs"),
             F.count_if((s == s0) & (e == e0)).alias("whole"))
        .where("copies > 1 AND clock_differs AND NOT second_differs AND has_start AND has_end AND whole > 0")
        .select(cols.ride_id)
    )


def preferred_version(df: DataFrame, alias_ids: DataFrame, cols: TripColumns = TRIPS) -> DataFrame:
    """One row per id: sub-second version first (for alias ids), then valid, then by file.

    Rows without id are no part of the result; they never enter the id join.
    """
    marked, order = _ranked_versions(df, alias_ids, cols)
    return first_by_key(marked, cols.ride_id, order, df.columns)


def _ranked_versions(df: DataFrame, alias_ids: DataFrame, cols: TripColumns) -> tuple[DataFrame, list[Column]]:
    s, e = F.col(cols.started_at), F.col(cols.ended_at)
    keyed = df.where(F.col(cols.ride_id).isNotNull())
    marked = keyed.join(alias_ids.select(F.col(cols.ride_id), F.lit(True).alias("__alias")), cols.ride_id, "left")
    finer = F.coalesce(F.col("__alias"), F.lit(False)) & F.coalesce(
        (s != clock.trunc("second", s)) | (e != clock.trunc("second", e)), F.lit(False))
    return marked, [F.when(finer, 0).otherwise(1), F.when(F.col(cols.valid_demand), 0).otherwise(1), F.col(cols.file)]


def signed_counts(left: DataFrame, right: DataFrame, columns) -> DataFrame:
    """Per distinct content: copies on the left minus copies on the right."""
    tagged = left.select(*columns, F.lit(1).cast("bigint").alias("__d")).unionByName(
        right.select(*columns, F.lit(-1).cast("bigint").alias("__d")))
    return tagged.groupBy(*columns).agg(F.sum("__d").alias("surplus"))


def multiset_difference(left: DataFrame, right: DataFrame, columns) -> DataFrame:
    """One row: how many rows each side has that the other lacks."""
    d = F.col("surplus")
    return signed_counts(left, right, columns).agg(
        F.coalesce(F.sum(F.when(d > 0, d)), F.lit(0)).alias("only_left"),
        F.coalesce(F.sum(F.when(d < 0, -d)), F.lit(0)).alias("only_right"),
    ).withColumn("equal", (F.col("only_left") == 0) & (F.col("only_right") == 0))


def require_equivalent(left: DataFrame, right: DataFrame, columns) -> DataFrame:
    """Two representations of one source must hold the same rows with the same multiplicity."""
    if signed_counts(left, right, columns).where("surplus <> 0").take(1):
        raise ValueError("source representations are not equivalent")
    return left


def spill_rows(df: DataFrame, cols: TripColumns = TRIPS) -> DataFrame:
    """Rows whose start lies outside the month of their source."""
    month = F.date_format(cols.started_at, "yyyy-MM").alias("natural_month")
    return df.where(F.col(cols.started_at).isNotNull() & ~F.col(cols.valid_demand)).select("*", month)


def segment_containment(df: DataFrame, content=CONTENT, cols: TripColumns = TRIPS) -> DataFrame:
    """Off-month rows without id, per (file, natural month): are they contained, with
    multiplicity, in the rows that natural month already holds?

    All segments are compared at once through signed counts, instead of one multiset
    difference per segment.
    """
    content = [c for c in content if c != cols.ride_id]
    spills = spill_rows(df, cols).where(F.col(cols.ride_id).isNull())
    seg = spills.groupBy(cols.file, "natural_month", *content).agg(F.count(F.lit(1)).alias("need"))
    home = df.where(F.col(cols.valid_demand) & F.col(cols.ride_id).isNull()).groupBy(
        F.date_format(cols.started_at, "yyyy-MM").alias("natural_month"), *content).agg(F.count(F.lit(1)).alias("have"))
    keys = ["natural_month", *content]
    cond = None
    right = home.select(*[F.col(k).alias(f"__h_{k}") for k in keys], "have")
    for k in keys:
        piece = F.col(k).eqNullSafe(F.col(f"__h_{k}"))
        cond = piece if cond is None else cond & piece
    lack = F.greatest(F.col("need") - F.coalesce("have", F.lit(0).cast("bigint")), F.lit(0).cast("bigint"))
    return seg.join(right, cond, "left").groupBy(cols.file, "natural_month").agg(
        F.sum("need").alias("rows"), F.sum(lack).alias("unmatched_rows")).withColumn("proven_copy", F.col("unmatched_rows") == 0)


def accepted_spills(df: DataFrame, removed_versions: DataFrame, proven: DataFrame, cols: TripColumns = TRIPS) -> DataFrame:
    """Off-month rows that are neither a removed version of an id nor part of a proven copy."""
    spills = spill_rows(df, cols)
    with_id = spills.where(F.col(cols.ride_id).isNotNull()).join(
        removed_versions.select(cols.file, cols.ride_id), [cols.file, cols.ride_id], "left_anti")
    without = spills.where(F.col(cols.ride_id).isNull()).join(
        proven.select(cols.file, "natural_month"), [cols.file, "natural_month"], "left_anti")
    return with_id.unionByName(without, allowMissingColumns=False)


def align_months(df: DataFrame, cols: TripColumns = TRIPS, alias_precision: bool = True) -> DataFrame:
    """Surviving rows with the month they belong to, in one pass over all partitions.

    Ids keep their preferred version; off-month segments without id that are proven
    copies go; every other row moves to the month of its start when that month is
    present, else it stays flagged where it was. Validity is recomputed.
    """
    aliases = time_alias_ids(df, cols) if alias_precision else df.select(cols.ride_id).where("false")
    natural = F.date_format(cols.started_at, "yyyy-MM")
    proven = segment_containment(df, cols=cols).where("proven_copy").select(cols.file, "natural_month")
    # Only off-month rows without id can be such copies; all others skip this join.
    anonymous = df.where(F.col(cols.ride_id).isNull())
    off_month = F.col(cols.started_at).isNotNull() & ~F.col(cols.valid_demand)
    moved = anonymous.where(off_month).withColumn("natural_month", natural).join(
        proven, [cols.file, "natural_month"], "left_anti").drop("natural_month")
    rows = union_all(preferred_version(df, aliases, cols), anonymous.where(~off_month), moved.select(*df.columns))
    # One entry per calendar month of the sources.
    present = df.agg(F.collect_set("source_month")).scalar()
    target = F.when(F.array_contains(present, natural), natural).otherwise(F.col("source_month"))
    in_month = F.coalesce(natural == F.col("target_month"), F.lit(False))
    return (
        rows.withColumn("target_month", target)
        .withColumn(cols.valid_demand, in_month)
        .withColumn(cols.valid_duration, F.coalesce(F.col(cols.valid_demand) & (F.col(cols.duration) > 0), F.lit(False)))
        .select(*df.columns, "target_month")
    )


def removed_rows(df: DataFrame, cols: TripColumns = TRIPS, alias_precision: bool = True) -> DataFrame:
    """The rows that month alignment drops, found on their own: losing versions of repeated ids, and off-month copies
    without id that are proven."""
    repeated = duplicate_rows(df, cols.ride_id)
    aliases = time_alias_ids(repeated, cols) if alias_precision else df.select(cols.ride_id).where("false")
    marked, order = _ranked_versions(repeated, aliases, cols)
    place = F.row_number().over(Window.partitionBy(cols.ride_id).orderBy(*order, *df.columns))
    losing = marked.withColumn("__place", place).where("__place > 1").select(*df.columns)
    proven = segment_containment(df, cols=cols).where("proven_copy").select(cols.file, "natural_month")
    copies = spill_rows(df.where(F.col(cols.ride_id).isNull()), cols).join(proven, [cols.file, "natural_month"], "left_semi")
    return losing.unionByName(copies.select(*df.columns))


def inconsistent_fields(df: DataFrame, columns, key: str = TRIPS.ride_id) -> DataFrame:
    """Per column: how many repeated ids carry more than one value (null is a value)."""
    differs = [
        (~F.min(c).eqNullSafe(F.max(c)) | ((F.count(F.col(c)) > 0) & (F.count(F.col(c)) < F.count(F.lit(1))))).cast("int").alias(c)
        for c in columns]
    ids = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"), *differs).where("__n > 1")
    one = ids.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in columns])
    return one.unpivot([], list(columns), "column", "ids")


def proof_conflicts(df: DataFrame, cols: TripColumns = TRIPS, alias_precision: bool = True) -> DataFrame:
    """Ids that still disagree once serialisation and, where allowed, clock precision are neutralised."""
    repeated = duplicate_rows(df, cols.ride_id)
    aliases = time_alias_ids(repeated, cols) if alias_precision else df.select(cols.ride_id).where("false")
    return conflicting_ids(segment_normalised(repeated, aliases, cols), CONTENT, cols.ride_id)


def union_all(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def keep_first_row(df: DataFrame, content, row_id: str) -> DataFrame:
    """First source row of each distinct content and how often it occurs."""
    return df.groupBy(*content).agg(F.min(row_id).alias(row_id), F.count(F.lit(1)).alias("copies"))
