"""Chronological splits and folds, as columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airgrid import config
from airgrid.operators import sequence


def train_rows(total: Column, ratio: float = config.TRAIN_RATIO) -> Column:
    return F.floor(total * F.lit(ratio))


def _numbered(df: DataFrame, keys: Sequence[str], ts: str, cell: sequence.Cell) -> DataFrame:
    """Rows with ``pos`` and ``n_rows``; a table that has them already is taken as it is."""
    if {"pos", "n_rows"} <= set(df.columns):
        return df
    return sequence.with_position(df, keys, ts, cell)


def chronological_split(
    df: DataFrame,
    keys: Sequence[str] = ("station",),
    ts: str = "ts",
    ratio: float = config.TRAIN_RATIO,
    inner_ratio: float | None = config.INNER_RATIO,
    cell: sequence.Cell = sequence.month_cell,
) -> DataFrame:
    """Add ``role``: the first rows of a series train, the rest test.

    With ``inner_ratio`` the training rows are cut again into ``fit`` and ``val``.
    Existing columns ``pos`` and ``n_rows`` are used and consumed.
    """
    numbered = _numbered(df, keys, ts, cell)
    cut = train_rows(F.col("n_rows"), ratio)
    if inner_ratio is None:
        role = F.when(F.col("pos") <= cut, "train").otherwise("test")
    else:
        inner = train_rows(cut, inner_ratio)
        role = (
            F.when(F.col("pos") <= inner, "fit")
            .when(F.col("pos") <= cut, "val")
            .otherwise("test")
        )
    return numbered.withColumn("role", role).drop("pos", "n_rows")


def fold_role(pos: Column, total: Column, fold: Column, folds: int) -> Column:
    """``train``, ``val`` or NULL: fold i trains on all rows before its test block."""
    size = F.floor(total / (folds + 1))
    start = total - (F.lit(folds + 1) - fold) * size
    return F.when(pos <= start, "train").when(pos <= start + size, "val")


def time_series_folds(
    df: DataFrame,
    keys: Sequence[str] = ("station",),
    ts: str = "ts",
    folds: int = config.FOLDS,
    cell: sequence.Cell = sequence.month_cell,
) -> DataFrame:
    """One row per row and fold it takes part in, with ``fold`` (from 1) and ``role``.

    Existing columns ``pos`` and ``n_rows`` are used and consumed.
    """
    numbered = _numbered(df, keys, ts, cell)
    copies = numbered.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(folds))))
    role = fold_role(F.col("pos"), F.col("n_rows"), F.col("fold"), folds)
    return copies.withColumn("role", role).filter("role is not null").drop("pos", "n_rows")


def split_ranges(split: DataFrame, keys: Sequence[str] = ("station",), ts: str = "ts") -> DataFrame:
    """Per series and role: rows, first and last time, share of the series.

    The window runs over the two or three result rows of a series.
    """
    parts = split.groupBy(*keys, "role").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")
    )
    whole = Window.partitionBy(*keys)
    return parts.withColumn("share", F.col("n_rows") / F.sum("n_rows").over(whole))


def stack_parts(*parts: DataFrame) -> DataFrame:
    """Training parts on top of each other."""
    stacked = parts[0]
    for other in parts[1:]:
        stacked = stacked.unionByName(other)
    return stacked


def stack_roles(split: DataFrame, *roles: str) -> DataFrame:
    """The parts of one split on top of each other: the split is computed and read once."""
    return split.filter(F.col("role").isin(*roles))
