"""Lag, difference, rolling, calendar, wind and interaction features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airgrid import config
from airgrid.functions import moments
from airgrid.operators import sequence

# Names of the weather columns derived features need.
TEMPERATURE, HUMIDITY, SPEED, DIRECTION, RAIN = config.WEATHER


def lag_columns(c: str, lags: Sequence[int], w: Window) -> dict[str, Column]:
    """The value so many kept rows earlier; "h" in the name counts rows."""
    return {f"{c}_lag_{k}h": F.lag(c, k).over(w) for k in lags}


def diff_columns(c: str, lags: Sequence[int], w: Window) -> dict[str, Column]:
    return {f"{c}_diff_{k}h": F.col(c) - F.lag(c, k).over(w) for k in lags}


def rolling_columns(
    c: str,
    means: Sequence[int],
    stds: Sequence[int],
    w: Window,
    exclude_current: bool = False,
) -> dict[str, Column]:
    """Mean (from one value) and sample deviation (from two) over the last n rows.

    The current row counts by default, as in the published model. A feature built
    from the target then holds the value to be predicted; ``exclude_current`` looks
    at the n rows before it instead.
    """
    shift = 1 if exclude_current else 0

    def frame(n: int) -> Window:
        return w.rowsBetween(-(n - 1) - shift, -shift)

    columns = {f"{c}_roll_mean_{n}h": F.avg(c).over(frame(n)) for n in means}
    columns.update({f"{c}_roll_std_{n}h": F.stddev_samp(c).over(frame(n)) for n in stds})
    return columns


def add_lags(
    df: DataFrame,
    column: str = config.TARGET,
    lags: Sequence[int] = config.TARGET_LAGS,
    keys: Sequence[str] = ("station",),
    ts: str = "ts",
    cell: sequence.Cell = sequence.month_cell,
    keep_position: bool = False,
) -> DataFrame:
    return sequence.over_rows(
        df, keys, ts, max(lags), lambda w: lag_columns(column, lags, w), cell,
        keep_position=keep_position,
    )


def add_diffs(
    df: DataFrame,
    columns: Sequence[str],
    lags: Sequence[int] = config.DIFF_LAGS,
    keys: Sequence[str] = ("station",),
    ts: str = "ts",
    cell: sequence.Cell = sequence.month_cell,
) -> DataFrame:
    def build(w):
        return {k: v for c in columns for k, v in diff_columns(c, lags, w).items()}

    return sequence.over_rows(df, keys, ts, max(lags), build, cell)


def add_rolling(
    df: DataFrame,
    columns: Sequence[str],
    means: Sequence[int] = config.MEAN_WINDOWS,
    stds: Sequence[int] = config.STD_WINDOWS,
    keys: Sequence[str] = ("station",),
    ts: str = "ts",
    exclude_current: bool = False,
    cell: sequence.Cell = sequence.month_cell,
) -> DataFrame:
    def build(w):
        return {
            k: v
            for c in columns
            for k, v in rolling_columns(c, means, stds, w, exclude_current).items()
        }

    return sequence.over_rows(df, keys, ts, max([*means, *stds]), build, cell)


def add_dataset_columns(
    df: DataFrame,
    target: str = config.TARGET,
    lags: Sequence[int] = config.TARGET_LAGS,
    keys: Sequence[str] = ("station",),
    ts: str = "ts",
    cell: sequence.Cell = sequence.month_cell,
) -> DataFrame:
    """What cleaning adds to the data set: target lags, hour and month on circles."""
    lagged = add_lags(df, target, lags, keys, ts, cell)
    return lagged.withColumns(moments.cyclic_columns(F.col(ts)))


def derived_columns(columns: Sequence[str], ts: Column | None) -> dict[str, Column]:
    """Row-wise derived features; one is left out if its inputs are not there."""

    def there(name: str) -> Column | None:
        return F.col(name) if name in columns else None

    derived = moments.interaction_columns(there(TEMPERATURE), there(HUMIDITY), there(SPEED))
    if SPEED in columns and DIRECTION in columns:
        derived.update(moments.wind_columns(F.col(SPEED), F.col(DIRECTION)))
    if ts is not None:
        derived.update(moments.weekday_columns(ts))
    return derived


def build_features(
    df: DataFrame,
    pollutants: Sequence[str] = config.POLLUTANTS,
    keys: Sequence[str] = ("station",),
    ts: str = "ts",
    exclude_current: bool = False,
    complete_only: bool = True,
    cell: sequence.Cell = sequence.month_cell,
) -> DataFrame:
    """Rolling and difference features per pollutant plus the row-wise ones.

    All window columns share one exchange and one sort. As the last step every row
    with a NULL in any column goes, so the first 24 rows of each series always do.
    """
    present = [c for c in pollutants if c in df.columns]

    def build(w):
        made: dict[str, Column] = {}
        for c in present:
            made.update(
                rolling_columns(c, config.MEAN_WINDOWS, config.STD_WINDOWS, w, exclude_current)
            )
            made.update(diff_columns(c, config.DIFF_LAGS, w))
        return made

    reach = max([*config.MEAN_WINDOWS, *config.STD_WINDOWS, *config.DIFF_LAGS])
    rolled = sequence.over_rows(df, keys, ts, reach, build, cell) if present else df
    full = rolled.withColumns(derived_columns(df.columns, F.col(ts)))
    return full.dropna("any") if complete_only else full
