"""Air-quality index, categories and label ladders."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from airgrid import config


def _per_pollutant(
    pollutant: str | Column,
    tables: Mapping[str, Any],
    build: Callable[[Any], Column],
    default: Column,
) -> Column:
    """The column built from the pollutant's table; a plain string is decided at plan time."""
    if isinstance(pollutant, str):
        return build(tables[pollutant]) if pollutant in tables else default
    chosen = None
    for name, table in tables.items():
        hit = pollutant == F.lit(name)
        chosen = F.when(hit, build(table)) if chosen is None else chosen.when(hit, build(table))
    return default if chosen is None else chosen.otherwise(default)


def ladder(value: Column, steps: Sequence[tuple[float | None, str]]) -> Column:
    """The label of the first bound that is not below the value."""
    label = None
    for bound, name in steps:
        if bound is None:
            return F.when(value.isNotNull(), F.lit(name)) if label is None else label.when(
                value.isNotNull(), F.lit(name)
            )
        hit = value <= F.lit(float(bound))
        label = F.when(hit, F.lit(name)) if label is None else label.when(hit, F.lit(name))
    return label


def air_index(
    pollutant: str | Column,
    value: Column,
    segments: Mapping[str, Sequence[tuple[float, float, int, int]]] = config.INDEX_SEGMENTS,
) -> Column:
    """Piecewise linear index on closed segments.

    Above the last segment it is 500. A value in a hole between two segments,
    or below zero, scores 0; :func:`air_index_continuous` has no holes.
    An unknown pollutant or a missing value has no index.
    """

    def score(parts: Sequence[tuple[float, float, int, int]]) -> Column:
        out = F.when(value.isNull(), F.lit(None).cast("double"))
        for c_lo, c_hi, i_lo, i_hi in parts:
            line = (value - c_lo) * float(i_hi - i_lo) / (c_hi - c_lo) + float(i_lo)
            out = out.when(value.between(c_lo, c_hi), line)
        out = out.when(value > parts[-1][1], F.lit(config.INDEX_CEILING))
        return out.otherwise(F.lit(0.0))

    return _per_pollutant(pollutant, segments, score, F.lit(None).cast("double"))


def _category(index: Column, part: int) -> Column:
    out = F.when(index.isNull(), F.lit(None).cast("string"))
    for row in config.INDEX_CATEGORIES:
        out = out.when(index.between(F.lit(float(row[0])), F.lit(float(row[1]))), F.lit(row[part]))
    return out.otherwise(F.lit(config.INDEX_CATEGORIES[-1][part]))


def air_category(index: Column) -> Column:
    """Category label; an index between two bands counts as the highest one."""
    return _category(index, 2)


def air_colour(index: Column) -> Column:
    return _category(index, 3)


def gauge_pointer(index: Column) -> Column:
    """Position 0-100 of the index on its scale."""
    inside = F.greatest(F.lit(0.0), F.least(F.lit(config.INDEX_CEILING), index))
    return F.coalesce(F.when(index.isNotNull(), inside) / F.lit(5.0), F.lit(0.0))


def air_index_continuous(
    pollutant: str | Column,
    value: Column,
    bounds: Mapping[str, Sequence[tuple[float, int]]] = config.CONTINUOUS_BOUNDS,
) -> Column:
    """Index that interpolates from one upper bound to the next; 500 above the last."""

    def score(steps: Sequence[tuple[float, int]]) -> Column:
        out = F.when(value.isNull(), F.lit(None).cast("double"))
        c_prev, i_prev = 0.0, 0
        for c_hi, i_hi in steps:
            slope = float(i_hi - i_prev) / (c_hi - c_prev)
            out = out.when(value <= c_hi, (value - c_prev) * slope + float(i_prev))
            c_prev, i_prev = c_hi, i_hi
        return out.otherwise(F.lit(config.INDEX_CEILING))

    return _per_pollutant(pollutant, bounds, score, F.lit(None).cast("double"))


def air_category_continuous(index: Column) -> Column:
    return ladder(index, config.CONTINUOUS_CATEGORIES)


def aqi_label(pollutant: str | Column, value: Column) -> Column:
    unknown = F.lit(config.AQI_UNKNOWN)
    return _per_pollutant(pollutant, config.AQI_LABELS, lambda s: ladder(value, s), unknown)


def aqi_icon(pollutant: str | Column, value: Column) -> Column:
    unknown = F.lit(config.ICON_UNKNOWN)
    return _per_pollutant(pollutant, config.AQI_ICONS, lambda s: ladder(value, s), unknown)


def pm25_quality(value: Column) -> Column:
    return ladder(value, config.PM25_QUALITY)


def unit_of(pollutant: str | Column) -> Column:
    return _per_pollutant(pollutant, config.UNITS, F.lit, F.lit(config.DEFAULT_UNIT))


def r2_level(r2: Column) -> Column:
    return (
        F.when(r2 >= config.R2_GOOD, F.lit("Bueno"))
        .when(r2 >= config.R2_ACCEPTABLE, F.lit("Aceptable"))
        .when(r2.isNotNull(), F.lit("Mejorable"))
    )


def r2_band(r2: Column) -> Column:
    """The highest of the marks 0.5, 0.7 and 0.9 the score reaches, else 0."""
    return (
        F.when(r2 >= config.R2_EXCELLENT, F.lit(config.R2_EXCELLENT))
        .when(r2 >= config.R2_GOOD, F.lit(config.R2_GOOD))
        .when(r2 >= config.R2_ACCEPTABLE, F.lit(config.R2_ACCEPTABLE))
        .when(r2.isNotNull(), F.lit(0.0))
    )


def overfit(r2_train: Column, r2_test: Column, gap: float = config.OVERFIT_GAP) -> Column:
    return (r2_train - r2_test) > F.lit(gap)


def clip_non_negative(value: Column) -> Column:
    return F.when(value.isNotNull(), F.greatest(F.lit(0.0), value))
