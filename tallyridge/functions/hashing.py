"""Engine-neutral hashing: md5 text keys give reproducible pseudo-random choices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_key(*parts) -> Column:
    """md5 over the '|'-joined text of columns and literals."""
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in cols]))


def hash_mod(modulus: int | Column, *parts) -> Column:
    """First 32 bits of the md5 key, modulo ``modulus``."""
    head = F.conv(F.substring(md5_key(*parts), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, modulus if isinstance(modulus, Column) else F.lit(modulus))


def hash_bucket(key: Column, digits: int = 4) -> Column:
    """Leading hex digits of an md5 key: equal-sized, order-preserving buckets."""
    return F.substring(key, 1, digits)


def row_digest(columns) -> Column:
    """Content digest of a row; nulls stay distinguishable from empty text."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
