"""What the columns of a table are for.

These look at names and types at plan time; only :func:`detect_timestamp` may read
data, ten values of a column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airgrid import config
from airgrid.functions import values


class SchemaError(ValueError):
    """A table that cannot serve as a training table."""


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def feature_columns(
    df: DataFrame, target: str, pollutants: Sequence[str] = config.POLLUTANTS
) -> list[str]:
    """Numeric columns but the pollutants and the target, in column order."""
    return [c for c in numeric_columns(df) if c not in pollutants and c != target]


def detect_targets(
    columns: Sequence[str],
    pollutants: Sequence[str] = config.POLLUTANTS,
    fallback: Sequence[str] | None = None,
) -> list[str]:
    """Pollutants among the columns in their usual order; all of them if there is none.

    ``fallback`` replaces "all of them", for instance ``["PM25"]``.
    """
    found = [p for p in pollutants if p in set(columns)]
    return found or list(pollutants if fallback is None else fallback)


def detect_timestamp(df: DataFrame) -> str | None:
    """The first column named like a time, else the first whose values read as times."""
    for c in df.columns:
        if any(word in c.lower() for word in config.TIME_WORDS):
            return c
    reads = {r["column"]: r["reads"] for r in readable_columns(df).collect()}
    return next((c for c in df.columns if reads.get(c, True)), None)


def readable_columns(df: DataFrame, looked_at: int = 10) -> DataFrame:
    """(column, n, reads): whether the first values that are not NULL read as times.

    One job for all columns: each task passes on at most ``looked_at`` values of a column.
    Columns without values have no row.
    """
    texts = [F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(df.columns)]
    numbered = df.select(F.monotonically_increasing_id().alias("at"), *texts)
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"c{i}").alias("x")) for i in range(len(texts))])
    long = numbered.select("at", F.explode(cells).alias("cell")).select("at", "cell.*").where("x is not null")
    first = long.withColumn("turn", F.row_number().over(Window.partitionBy("i").orderBy("at"))).where(
        F.col("turn") <= looked_at
    )
    seen = first.groupBy("i").agg(
        F.count(F.lit(1)).alias("n"), (F.count(values.to_time(F.col("x"))) == F.count(F.lit(1))).alias("reads")
    )
    names = F.array(*[F.lit(c) for c in df.columns])
    return seen.select(names[F.col("i")].alias("column"), "n", "reads")


def detect_xy(
    df: DataFrame,
    ts: str | None = None,
    pollutants: Sequence[str] = config.POLLUTANTS,
    control: Sequence[str] = config.CONTROL_COLUMNS,
) -> tuple[list[str], list[str]]:
    """Features and targets: targets are the pollutants present, nothing is required."""
    y = [p for p in pollutants if p in df.columns]
    left_out = {*y, *control, *([ts] if ts else [])}
    return [c for c in numeric_columns(df) if c not in left_out], y


def detect_xy_strict(
    df: DataFrame,
    ts: str | None = None,
    pollutants: Sequence[str] = config.POLLUTANTS,
    base: Sequence[str] = config.BASE_FEATURES,
    control: Sequence[str] = config.CONTROL_COLUMNS,
) -> tuple[list[str], list[str], list[tuple[str, str]]]:
    """Features, targets, and features named after a target.

    All pollutants must be there and at least one feature. Known base features come
    first in their order, the others follow in column order.
    """
    missing = [p for p in pollutants if p not in df.columns]
    if missing:
        raise SchemaError(f"missing target columns: {', '.join(missing)}")
    free, y = detect_xy(df, ts, pollutants, control)
    x = [c for c in base if c in free] + [c for c in free if c not in base]
    if not x:
        raise SchemaError("no numeric feature columns")
    leaks = [c for c in x if c in y]
    if leaks:
        raise SchemaError(f"targets among the features: {', '.join(leaks)}")
    lags = [(c, p) for c in x for p in y if name_relation(c, [p]) == "prefijo"]
    return x, y, lags


def name_relation(name: str, targets: Sequence[str]) -> str:
    """Plan-time form of :func:`airgrid.functions.text.similarity` for column names."""
    upper = name.upper()
    for target in targets:
        base = target.upper()
        if upper == base:
            return "exacto"
        rest = upper.removeprefix(base)
        if rest != upper and (rest[0] in "_-." or rest[0].isdigit()):
            return "prefijo"
    return "silencio"


def column_roles(df: DataFrame, ts: str | None = None) -> DataFrame:
    """The lenient detection as a table (column, role), one row per column."""
    x, y = detect_xy(df, ts)
    rows = [
        (c, "time" if c == ts else "y" if c in y else "x" if c in x else "other")
        for c in df.columns
    ]
    return df.sparkSession.createDataFrame(rows, "column string, role string")
