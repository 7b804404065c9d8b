"""Casting and cleaning of single readings."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from airgrid import config


def null_nan(value: Column) -> Column:
    """NaN means missing: turn it into NULL before any comparison or average."""
    return F.nanvl(value, F.lit(None).cast("double"))


def to_number(text: Column) -> Column:
    """Text to double, NULL where it is no number.

    Spark's cast also reads Java suffixes such as ``1d``; those are no numbers here.
    """
    number = F.when(~text.rlike(r"[dDfF]\s*$"), text).try_cast("double")
    return null_nan(number)


def to_time(text: Column) -> Column:
    """Text to a zone-free timestamp, NULL where unreadable.

    ISO forms are read as they are; ``month/day/year`` and ``year/month/day``
    are rewritten first, so that no session time zone is involved.
    """
    trimmed = F.trim(text)
    iso = F.regexp_replace(trimmed, r"^(\d{4})/(\d{1,2})/(\d{1,2})", "$1-$2-$3")
    iso = F.regexp_replace(iso, r"^(\d{1,2})/(\d{1,2})/(\d{4})", "$3-$1-$2")
    return iso.try_cast("timestamp_ntz")


def epoch_to_time(seconds: Column) -> Column:
    """Unix seconds to a zone-free UTC timestamp."""
    return F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")) + F.make_dt_interval(
        secs=seconds.cast("decimal(18,6)")
    )


def hour_of(ts: Column) -> Column:
    """The full hour of a zone-free timestamp, without a detour over a time zone."""
    return F.make_timestamp_ntz(
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.lit(0), F.lit(0)
    )


def null_codes(value: Column, codes: Iterable[float] = config.SENSOR_CODES) -> Column:
    return F.when(~value.isin(*codes), value)


def null_out_of_range(value: Column, low: float, high: float) -> Column:
    return F.when(value.between(F.lit(low), F.lit(high)), value)


def clean_reading(
    variable: Column,
    value: Column,
    ranges: Mapping[str, tuple[float, float]] = config.VALID_RANGES,
    codes: Iterable[float] = config.SENSOR_CODES,
) -> Column:
    """Error codes and out-of-range values to NULL on long data.

    A variable without a range is only checked for codes.
    """
    coded = null_codes(null_nan(value), codes)
    cleaned = None
    for name, (low, high) in ranges.items():
        hit = variable == F.lit(name)
        checked = null_out_of_range(coded, low, high)
        cleaned = F.when(hit, checked) if cleaned is None else cleaned.when(hit, checked)
    return coded if cleaned is None else cleaned.otherwise(coded)
