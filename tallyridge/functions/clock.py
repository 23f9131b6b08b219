"""Wall-clock helpers for one local zone (labels without offset)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "America/New_York"


def trunc(unit: str, c: Column) -> Column:
    """date_trunc that stays a wall-clock label."""
    return F.date_trunc(unit, c).cast("timestamp_ntz")


def micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def from_micros(c: Column) -> Column:
    return F.timestamp_micros(c).cast("timestamp_ntz")


def minutes_between(start: Column, end: Column) -> Column:
    """Wall-clock minutes with the fractional part kept."""
    return (micros(end) - micros(start)) / F.lit(60_000_000.0)


def physical_minutes(start: Column, end: Column, zone: str = ZONE) -> Column:
    """Elapsed minutes between two local labels, across clock changes."""
    a = F.to_utc_timestamp(start.cast("timestamp"), zone)
    b = F.to_utc_timestamp(end.cast("timestamp"), zone)
    return (F.unix_micros(b) - F.unix_micros(a)) / F.lit(60_000_000.0)


def monday_of(c: Column) -> Column:
    """Start of the Monday-based week, as a wall-clock label."""
    return trunc("week", c)


def autumn_repeat_label(c: Column) -> Column:
    """01:00-01:59 on the first Sunday of November: which hour is meant is unknown."""
    return (F.month(c) == 11) & (F.dayofmonth(c) <= 7) & (F.weekday(c) == 6) & (F.hour(c) == 1)


def clock_hours(c: Column, zone: str = ZONE) -> Column:
    """Physical hours behind one clock label: 0 in the spring gap, 2 when repeated, else 1."""
    ts = c.cast("timestamp")
    utc = F.to_utc_timestamp(ts, zone)
    back = F.from_utc_timestamp(utc, zone)
    later = F.from_utc_timestamp(utc + F.expr("INTERVAL 1 HOUR"), zone)
    return F.when(back != ts, 0).when(later == ts, 2).otherwise(1)


def season(c: Column) -> Column:
    m = F.month(c)
    return (
        F.when(m.isin(12, 1, 2), "winter").when(m.isin(3, 4, 5), "spring")
        .when(m.isin(6, 7, 8), "summer").otherwise("autumn")
    )
