"""Text cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted clock layouts of the trip sources, in order of preference.
TRIP_TIME_FORMATS = (
    "yyyy-M-d H:m:s[.SSSSSS]",
    "yyyy-M-d H:m",
    "M/d/yyyy H:m:s[.SSSSSS]",
    "M/d/yyyy H:m",
)

def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def default_unknown(c: Column, default: str = "unknown") -> Column:
    return F.coalesce(F.nullif(F.lower(F.trim(c)), F.lit("")), F.lit(default))


def parse_clock(c: Column, formats=TRIP_TIME_FORMATS) -> Column:
    """First format that fits wins; text that fits none becomes null."""
    text = F.trim(c)
    tries = [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*tries)


def map_values(c: Column, mapping: dict[str, str], default: str) -> Column:
    """Case-insensitive value map with a default for everything else."""
    key = F.lower(F.trim(c))
    out = None
    for source, target in mapping.items():
        out = F.when(key == source, target) if out is None else out.when(key == source, target)
    return out.otherwise(default)


def integer_suffix_stripped(c: Column, only_when: Column) -> Column:
    """Drop a trailing ``.0`` serialisation, but only where ``only_when`` holds."""
    text = F.trim(c)
    return F.nullif(F.when(only_when, F.regexp_replace(text, r"\.0+$", "")).otherwise(text), F.lit(""))


def trailing_zero_id(c: Column, known: Column) -> Column:
    """Equivalent id without trailing fractional zeros, where the place is known."""
    stripped = F.rtrim(F.rtrim(c, F.lit("0")), F.lit("."))
    return F.when(c.rlike(r"^[0-9]+\.[0-9]+$") & known, stripped).otherwise(c)
