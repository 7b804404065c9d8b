"""Readings from wide to long and back to one row per station and time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airgrid import config
from airgrid.functions import values
from airgrid.functions.labels import air_index
from airgrid.session import stored

TASK_NAMES = 8192


def drop_unit_rows(
    df: DataFrame, column: str, pattern: str = config.UNIT_ROW_PATTERN
) -> DataFrame:
    """Drop rows whose time cell names a unit. The pattern also hits ``01-Aug-2020``."""
    text = F.col(column).cast("string")
    return df.filter(F.coalesce(~text.rlike(f"(?i){pattern}"), F.lit(True)))


def unpivot_stations(
    df: DataFrame,
    ids: Sequence[str],
    stations: Sequence[str],
    name: str = "station",
    value: str = "raw",
) -> DataFrame:
    """One row per station column; station names trimmed and in upper case."""
    quoted = [F.col(f"`{c}`") for c in stations]
    long = df.unpivot([F.col(c) for c in ids], quoted, name, value)
    return long.withColumn(name, F.upper(F.trim(name)))


def _substrings(text: Column, sizes: Sequence[int]) -> Column:
    """All distinct substrings of the given lengths."""
    length = F.length(text)
    fitting = F.filter(F.array(*[F.lit(n) for n in sizes]).cast("array<int>"), lambda size: size <= length)
    pieces = F.transform(
        fitting,
        lambda size: F.transform(
            F.sequence(F.lit(1), length - size + 1),
            lambda start: F.substring(text, start, size),
        ),
    )
    return F.array_distinct(F.flatten(pieces))


def match_station(
    searches: DataFrame, headers: DataFrame, search: str, header: str, position: str
) -> DataFrame:
    """For each searched name the header that equals it, else the first containing it.

    ``headers`` lists station columns with their position, ``searches`` the names
    looked for. ``kind`` is ``exact``, ``partial`` or ``missing``. To contain a name
    is to have it among the substrings of a header; names are short, so the
    substrings as long as some searched name are listed, reduced to the first header
    each, and joined by equality. The distinct headers are dealt evenly, some
    ``TASK_NAMES`` to a task, so that no task lists the substrings of more.
    """
    wanted = stored(searches.select(search).distinct().withColumn("__s", F.upper(F.trim(search))), "wanted")
    sizes = [r["size"] for r in wanted.select(F.length("__s").alias("size")).distinct().dropna().collect()]
    names = (
        headers.select(F.trim(header).alias("__header"), F.col(position).alias("__at"))
        .withColumn("__s", F.upper("__header"))
        .filter(F.col("__s") != "")
    )
    first = F.min_by("__header", "__at")
    exact = stored(names.groupBy("__s").agg(first.alias("__header"), F.min("__at").alias("__at")), "names")
    partial = (
        exact.repartition(1 + exact.count() // TASK_NAMES)
        .withColumn("__s", F.explode(_substrings(F.col("__s"), sorted(sizes))))
        .groupBy("__s")
        .agg(first.alias("__partial"))
    )
    exact = exact.select("__s", F.col("__header").alias("__exact"))
    both = wanted.join(exact, "__s", "left").join(partial, "__s", "left")
    return both.select(
        search,
        F.coalesce("__exact", "__partial").alias("matched"),
        F.when(F.col("__exact").isNotNull(), "exact")
        .when(F.col("__partial").isNotNull(), "partial")
        .otherwise("missing")
        .alias("kind"),
    )


def align(
    readings: DataFrame,
    variables: Sequence[str],
    keys: Sequence[str] = ("station",),
    ts: str = "ts",
    value: str = "value",
    variable: str = "variable",
    arrival: str = "arrival",
    how: str = "first",
) -> DataFrame:
    """One row per station and time, one column per variable (a full outer alignment).

    Conditional aggregates with map-side combine: one shuffle, whatever the number
    of variables, and no hot task for a station or hour with many readings.
    Of several readings at one time ``first`` keeps the one that arrived first,
    ``mean`` averages them.
    """
    columns = []
    for name in variables:
        hit = F.col(variable) == F.lit(name)
        if how == "first":
            picked = F.min_by(F.col(value), F.when(hit, F.col(arrival)))
        elif how == "mean":
            picked = F.avg(F.when(hit, F.col(value)))
        else:
            raise ValueError(f"unknown rule {how!r}")
        columns.append(picked.alias(name))
    known = readings.filter(F.col(variable).isin(list(variables)))
    return known.groupBy(*keys, ts).agg(*columns)


def align_hourly(readings: DataFrame, variables: Sequence[str], ts: str = "ts", **kw) -> DataFrame:
    """:func:`align` on the full hour: at most one row per station and hour."""
    hourly = readings.withColumn(ts, values.hour_of(F.col(ts)))
    return align(hourly, variables, ts=ts, **kw)


def first_per_hour(
    readings: DataFrame, key: str, ts: str = "ts", value: str = "value", arrival: str = "arrival"
) -> DataFrame:
    """One series: the first value to arrive in each hour."""
    return readings.groupBy(key, values.hour_of(F.col(ts)).alias(ts)).agg(
        F.min_by(value, arrival).alias(value)
    )


def index_by_range(
    df: DataFrame, pollutant: str, value: str, out: str = "air_index"
) -> DataFrame:
    """The closed-segment index by a range join with the segment table.

    Same result as :func:`airgrid.functions.labels.air_index`, which is the faster
    form; this one takes the segments as data. The table has a fixed 36 rows, so it
    is broadcast.
    """
    rows = ", ".join(
        f"('{name}', {c_lo}D, {c_hi}D, {i_lo}D, {i_hi}D)"
        for name, parts in config.INDEX_SEGMENTS.items()
        for c_lo, c_hi, i_lo, i_hi in parts
    )
    table = df.sparkSession.sql(
        f"SELECT * FROM VALUES {rows} AS segments(__p, c_lo, c_hi, i_lo, i_hi)"
    )
    tops = {name: parts[-1][1] for name, parts in config.INDEX_SEGMENTS.items()}
    top = F.create_map(*[F.lit(x) for pair in tops.items() for x in pair])
    hit = (F.col(pollutant) == F.col("__p")) & F.col(value).between(F.col("c_lo"), F.col("c_hi"))
    joined = df.join(F.broadcast(table), hit, "left")
    bound = F.try_element_at(top, F.col(pollutant))
    line = F.col("i_lo") + (F.col(value) - F.col("c_lo")) * (F.col("i_hi") - F.col("i_lo")) / (
        F.col("c_hi") - F.col("c_lo")
    )
    index = (
        F.when(bound.isNull() | F.col(value).isNull(), F.lit(None).cast("double"))
        .when(F.col("c_lo").isNotNull(), line)
        .when(F.col(value) > bound, F.lit(config.INDEX_CEILING))
        .otherwise(F.lit(0.0))
    )
    return joined.select(*df.columns, index.alias(out))


def global_index(df: DataFrame, columns: dict[str, str], index=air_index) -> DataFrame:
    """Add ``air_index``, the highest index over several columns.

    ``columns`` maps a column to the pollutant whose table applies.
    """
    scores = [index(pollutant, F.col(column)) for column, pollutant in columns.items()]
    highest = scores[0] if len(scores) == 1 else F.greatest(*scores)
    return df.withColumn("air_index", highest)
