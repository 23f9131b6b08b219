"""Query registry: each entry pairs a Spark plan with an optional oracle statement."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyridge.plans.views import VIEW_SQL, Views

_PLANS: dict[str, Callable[[Views], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register ``fn(views) -> DataFrame`` under ``key`` with its equivalent SQL."""

    def register(fn):
        if key in _PLANS:
            raise ValueError(f"query {key} registered twice")
        _PLANS[key] = fn
        if sql is not None:
            _ORACLES[key] = sql
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round double columns so that two engines can be compared by value."""
    return df.select(*[
        (F.round(F.col(f"`{f.name}`"), digits) + F.lit(0.0)).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def _runner(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(fn(Views(spark, sf_dir)))

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {key: _runner(fn) for key, fn in _PLANS.items()}


def _needed(sql: str) -> list[str]:
    """View names a statement uses, dependencies first."""
    found: list[str] = []

    def visit(text: str) -> None:
        for name, body in VIEW_SQL.items():
            if name not in found and body is not text and re.search(rf"\b{name}\b", text):
                visit(body)
                if name not in found:
                    found.append(name)

    visit(sql)
    return found


def oracle_sql() -> dict[str, str]:
    out = {}
    for key, sql in _ORACLES.items():
        views = ", ".join(f"{name} AS ({VIEW_SQL[name]})" for name in _needed(sql))
        body = sql.strip()
        recursive = re.match(r"(?i)with\s+recursive\s", body)
        if views and recursive:
            out[key] = f"WITH RECURSIVE {views}, {body[recursive.end():].lstrip()}"
        elif views and re.match(r"(?i)with\s", body):
            out[key] = f"WITH {views}, {body[4:].lstrip()}"
        else:
            out[key] = f"WITH {views} {body}" if views else body
    return out
