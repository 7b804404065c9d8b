"""Where queries and their SQL twins are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without SQL it is checked by the tests only."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add


# Two engines round an exact half differently; a nudge far below the sixth decimal and
# far above the noise of a sum decides halves the same way in both.
HALF_UP = 1e-10


def r6(value: Column | str) -> Column:
    """Six decimals, the common ground of two engines' sums."""
    return F.round((F.col(value) if isinstance(value, str) else value) + F.lit(HALF_UP), 6)


def s6(expression: str, name: str) -> str:
    """The same in SQL; adding zero turns minus zero into zero."""
    return f"round(({expression}) + {HALF_UP}, 6) + 0.0 AS {name}"


def ts_text(ts: Column | str) -> Column:
    return F.date_format(F.col(ts) if isinstance(ts, str) else ts, "yyyy-MM-dd HH:mm:ss")


def s_ts(expression: str, name: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S') AS {name}"


def with_sql(*parts: str) -> str:
    """Common table expressions, then the final SELECT."""
    *ctes, final = parts
    return (f"WITH {', '.join(ctes)} " if ctes else "") + final


_DONE: dict[tuple, object] = {}


def once(name: str, make: Callable) -> Callable:
    """``make(spark, sf)``, once per session and folder, for what several queries share."""

    def made(spark: SparkSession, sf: str):
        key = (name, spark.sparkContext.applicationId, sf)
        if key not in _DONE:
            _DONE[key] = make(spark, sf)
        return _DONE[key]

    return made
