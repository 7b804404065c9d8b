"""Completeness, row rules with their audit, gaps, profiles and checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airgrid import config
from airgrid.functions import moments, values
from airgrid.operators import sequence

BEFORE_ALL = "0001-01-01 00:00:00"


def any_known(columns: Sequence[str]) -> Column:
    return F.coalesce(*[F.col(c) for c in columns]).isNotNull()


# -- files and completeness ------------------------------------------------------------


def file_status(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Per expected variable: ``Cargado`` and its file, or ``No encontrado`` and a dash."""
    joined = expected.select("variable").join(
        found.select("variable", F.col("file").alias("__file")), "variable", "left"
    )
    return joined.select(
        "variable",
        F.when(F.col("__file").isNotNull(), "Cargado").otherwise("No encontrado").alias("status"),
        F.coalesce("__file", F.lit("—")).alias("file"),
    )


def unrecognised_files(files: DataFrame, recognised: DataFrame) -> DataFrame:
    return files.join(recognised.select("path"), "path", "left_anti")


def columns_per_file(readings: DataFrame) -> DataFrame:
    """Per variable the number of its stations and their names in order."""
    pairs = readings.select("variable", "station").distinct()
    return pairs.groupBy("variable").agg(
        F.count(F.lit(1)).alias("n_stations"),
        F.array_join(F.sort_array(F.collect_list("station")), ", ").alias("stations"),
    )


def list_stations(*tables: DataFrame, column: str = "station") -> DataFrame:
    """Distinct names over all tables, in upper case."""
    names = [t.select(F.upper(F.trim(F.col(column))).alias(column)) for t in tables]
    union = names[0]
    for other in names[1:]:
        union = union.unionByName(other)
    return union.filter(~F.col(column).isin(*config.NOT_STATIONS)).distinct()


def station_variables(readings: DataFrame, among: Sequence[str] | None = None) -> DataFrame:
    """Per station the variables with at least one value.

    With ``among`` only those are looked for, so that a set holds no more names than that.
    """
    variable = F.col("variable")
    wanted = variable if among is None else F.when(variable.isin(*among), variable)
    known = readings.filter(F.col("value").isNotNull())
    return known.groupBy("station").agg(F.collect_set(wanted).alias("present"))


def completeness(
    readings: DataFrame,
    expected: Sequence[str] = config.VARIABLES,
    max_missing: int = config.MAX_MISSING_VARIABLES,
) -> DataFrame:
    """Per station the expected variables that are present and missing, in expected order."""
    wanted = F.array(*[F.lit(v) for v in expected])
    return station_variables(readings, expected).select(
        "station",
        F.array_intersect(wanted, "present").alias("present"),
        F.array_except(wanted, "present").alias("missing"),
    ).select(
        "station",
        "present",
        "missing",
        F.size("present").cast("bigint").alias("n_present"),
        (F.size("missing") <= max_missing).alias("eligible"),
    )


def series_coverage(readings: DataFrame) -> DataFrame:
    """Per series the values present, and the first and last day of its rows."""
    return readings.groupBy("station", "variable").agg(
        F.count("value").alias("n_values"),
        F.min(F.col("ts").cast("date")).alias("first_date"),
        F.max(F.col("ts").cast("date")).alias("last_date"),
    )


def min_rows_guard(df: DataFrame, keys: Sequence[str], minimum: int) -> DataFrame:
    """Row count per key and whether it suffices; a status, not an exception."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "status", F.when(F.col("n_rows") >= minimum, "ok").otherwise("too_few")
    )


# -- value and row rules ---------------------------------------------------------------


def clean_values(
    readings: DataFrame,
    ranges: Mapping[str, tuple[float, float]] = config.VALID_RANGES,
    codes: Sequence[float] = config.SENSOR_CODES,
    out: str = "clean_value",
) -> DataFrame:
    cleaned = values.clean_reading(F.col("variable"), F.col("value"), ranges, codes)
    return readings.withColumn(out, cleaned)


def anomaly_count(cleaned: DataFrame, raw: str = "value", clean: str = "clean_value") -> DataFrame:
    """Per variable the readings that cleaning set to NULL."""
    nulled = F.col(raw).isNotNull() & F.col(clean).isNull()
    return cleaned.groupBy("variable").agg(F.count_if(nulled).alias("n_nulled"))


def in_period(ts: Column, start: str, end: str) -> Column:
    """Both ends count, and the end is the midnight that starts its day."""
    low = F.to_timestamp_ntz(F.lit(start))
    high = F.to_timestamp_ntz(F.lit(end))
    return (ts >= low) & (ts <= high)


def exclude_period(
    df: DataFrame,
    ts: str = "ts",
    start: str = config.EXCLUDED_START,
    end: str = config.EXCLUDED_END,
) -> DataFrame:
    return df.filter(~in_period(F.col(ts), start, end))


def exclude_years(
    df: DataFrame, ts: str = "ts", years: Sequence[int] = config.EXCLUDED_YEARS
) -> DataFrame:
    """Each run of years is one range of times, which the scan can use."""
    kept = F.col(ts).isNotNull()
    wanted = sorted(set(years))
    for first in (y for y in wanted if y - 1 not in wanted):
        after = first + 1
        while after in wanted:
            after += 1
        low, high = (F.to_timestamp_ntz(F.lit(f"{y:04d}-01-01 00:00:00")) for y in (first, after))
        kept &= (F.col(ts) < low) | (F.col(ts) >= high)
    return df.filter(kept)


def require_target(df: DataFrame, target: str) -> DataFrame:
    return df.filter(F.col(target).isNotNull())


def require_any(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows with a value in one of the columns; a rule for two columns or more."""
    present = [c for c in columns if c in df.columns]
    return df.filter(any_known(present)) if len(present) >= 2 else df


def require_all(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.dropna("any", subset=list(columns) if columns else None)


def null_total(df: DataFrame, columns: Sequence[str]) -> Column:
    """Aggregate: the NULL cells over the columns."""
    return F.sum(sum((F.col(c).isNull().cast("bigint") for c in columns), F.lit(0)))


def last_days(
    df: DataFrame, keys: Sequence[str], days: int = config.PLOT_DAYS, ts: str = "ts"
) -> DataFrame:
    """Rows no older than ``days`` before the key's last time."""
    ends = df.groupBy(*keys).agg(F.max(ts).alias("__end"))
    joined = sequence.join_per_key(df, ends, keys, ts)
    start = F.col("__end") - F.make_dt_interval(F.lit(days))
    return joined.filter(F.col(ts) >= start).drop("__end")


# -- gaps ------------------------------------------------------------------------------


def _silence(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    columns: Sequence[str],
    alive: Column | None,
    cell: sequence.Cell,
) -> DataFrame:
    """Mark silent rows and name each silent run by the last reporting time before it."""
    living = F.lit(True) if alive is None else alive
    flagged = df.withColumn("__silent", living & ~any_known(columns)).withColumn(
        "__active", living & any_known(columns)
    )
    named = sequence.with_known(
        flagged, keys, ts, last={"__since": F.when(F.col("__active"), F.col(ts))}, cell=cell
    )
    start = F.to_timestamp_ntz(F.lit(BEFORE_ALL))
    return named.withColumn("__run", F.coalesce("__since", start)).drop("__active", "__since")


def _runs(silence: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    return (
        silence.filter("__silent")
        .groupBy(*keys, "__run")
        .agg(
            F.min(ts).alias("first_ts"),
            F.max(ts).alias("last_ts"),
            F.count(F.lit(1)).alias("n_rows"),
        )
        .withColumn("hours", moments.hours_between(F.col("first_ts"), F.col("last_ts")))
    )


def gap_blocks(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = ("station",),
    ts: str = "ts",
    longer_than: float | None = None,
    cell: sequence.Cell = sequence.month_cell,
) -> DataFrame:
    """Runs of rows in which no column has a value, with their length in hours.

    The length is the last minus the first time of the silent rows. Rows of one run
    share the last reporting time before them, so a run is a plain group: no running
    block number over the whole series is needed.
    """
    runs = _runs(_silence(df, keys, ts, columns, None, cell), keys, ts).drop("__run")
    return runs if longer_than is None else runs.filter(F.col("hours") > longer_than)


def flag_gap_rows(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = ("station",),
    ts: str = "ts",
    hours: float = config.GAP_HOURS,
    alive: Column | None = None,
    out: str = "in_gap",
    cell: sequence.Cell = sequence.month_cell,
) -> DataFrame:
    """Mark the rows of silent runs of strictly more than ``hours``.

    Rows that are not ``alive`` neither end a run nor belong to one.
    """
    silence = _silence(df, keys, ts, columns, alive, cell)
    long_runs = (
        _runs(silence, keys, ts).filter(F.col("hours") > hours).select(*keys, "__run")
    ).withColumn("__long", F.lit(True))
    joined = silence.join(long_runs, [*keys, "__run"], "left")
    flag = F.col("__silent") & F.coalesce("__long", F.lit(False))
    return joined.select(*df.columns, flag.alias(out))


def drop_long_gaps(df: DataFrame, columns: Sequence[str], **kw) -> DataFrame:
    return flag_gap_rows(df, columns, out="__gap", **kw).filter("not __gap").drop("__gap")


# -- the rules in sequence, with audit --------------------------------------------------

PERIOD, TARGET, ANY, GAP, KEPT = "period", "target", "any", "gap", "kept"
DEFAULT_RULES = (PERIOD, TARGET, ANY, GAP)


def tag_removals(
    df: DataFrame,
    target: str = config.TARGET,
    pollutants: Sequence[str] = config.POLLUTANTS,
    rules: Sequence[str] = DEFAULT_RULES,
    keys: Sequence[str] = ("station",),
    ts: str = "ts",
    period: tuple[str, str] = (config.EXCLUDED_START, config.EXCLUDED_END),
    gap_hours: float = config.GAP_HOURS,
    cell: sequence.Cell = sequence.month_cell,
) -> DataFrame:
    """Add ``removed_by``: the first rule that drops the row, NULL if it stays.

    The default order applies ``target`` before ``gap``; as the target is itself a
    pollutant, no silent row is then left for ``gap``. Put ``gap`` first to find gaps.
    """
    present = [c for c in pollutants if c in df.columns]
    tagged = df.withColumn("removed_by", F.lit(None).cast("string"))
    for rule in rules:
        alive = F.col("removed_by").isNull()
        if rule == PERIOD:
            drop = in_period(F.col(ts), *period)
        elif rule == TARGET:
            drop = F.col(target).isNull()
        elif rule == ANY:
            drop = ~any_known(present) if len(present) >= 2 else F.lit(False)
        elif rule == GAP:
            tagged = flag_gap_rows(
                tagged, present, keys, ts, gap_hours, alive, "__gap", cell
            )
            drop = F.col("__gap")
        else:
            raise ValueError(f"unknown rule {rule!r}")
        tagged = tagged.withColumn(
            "removed_by", F.coalesce("removed_by", F.when(drop, F.lit(rule)))
        ).drop("__gap")
    return tagged


def removal_audit(
    tagged: DataFrame, rules: Sequence[str] = DEFAULT_RULES, keys: Sequence[str] = ()
) -> DataFrame:
    """Rows removed per rule, and kept, with their share of all rows in percent.

    One aggregation over the tags; rules that removed nothing are listed with 0.
    """
    stages = list(rules) + [KEPT]
    stage = F.coalesce("removed_by", F.lit(KEPT))
    counts = tagged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__all"),
        *[F.count_if(stage == F.lit(name)).alias(f"__{name}") for name in stages],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("step"), F.lit(name).alias("stage"), F.col(f"__{name}").alias("n_rows")
            )
            for i, name in enumerate(stages, 1)
        ]
    )
    long = counts.select(*keys, "__all", F.inline(rows))
    return long.withColumn(
        "pct", F.coalesce(F.try_divide(F.col("n_rows") * 100.0, F.col("__all")), F.lit(0.0))
    ).drop("__all")


# -- profile and checks ----------------------------------------------------------------


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: values, percent NULL (one decimal), mean, min and max (three).

    All columns in one aggregation; the single result row is unfolded afterwards.
    """
    aggregates = [F.count(F.lit(1)).alias("__n")]
    for c in columns:
        value = F.col(c).cast("double")
        aggregates += [
            F.count(c).alias(f"{c}__n"),
            F.avg(value).alias(f"{c}__mean"),
            F.min(value).alias(f"{c}__min"),
            F.max(value).alias(f"{c}__max"),
        ]
    rows = [
        F.struct(
            F.lit(c).alias("variable"),
            F.col(f"{c}__n").alias("n_valid"),
            F.round(
                F.try_divide((F.col("__n") - F.col(f"{c}__n")) * 100.0, F.col("__n")), 1
            ).alias("pct_null"),
            F.round(f"{c}__mean", 3).alias("mean"),
            F.round(f"{c}__min", 3).alias("min"),
            F.round(f"{c}__max", 3).alias("max"),
        )
        for c in columns
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def dataset_summary(df: DataFrame, keys: Sequence[str] = ("station",), ts: str = "ts") -> DataFrame:
    """Per station: rows, first and last time, whole days between them."""
    summary = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
    )
    hours = moments.hours_between(F.col("first_ts"), F.col("last_ts"))
    return summary.withColumn("n_days", F.floor(hours / 24.0))


def duplicate_times(df: DataFrame, keys: Sequence[str] = ("station",), ts: str = "ts") -> DataFrame:
    """Rows beyond the first per key and time.

    Counted per (key, time) first, so that no task collects a key's distinct times.
    """
    per_time = df.groupBy(*keys, ts).agg(F.count(F.lit(1)).alias("__n"))
    return per_time.groupBy(*keys).agg(F.sum(F.col("__n") - 1).alias("n_duplicates"))


def unsorted_times(
    df: DataFrame, keys: Sequence[str], ts: str = "ts", arrival: str = "arrival"
) -> DataFrame:
    """Rows whose time is before that of the row that arrived just before."""
    previous = sequence.with_known(
        df.select(*keys, ts, arrival),
        keys,
        arrival,
        last={"__previous": F.col(ts)},
        cell=sequence.id_cell,
        include_current=False,
    )
    return previous.groupBy(*keys).agg(
        F.count_if(F.col("__previous") > F.col(ts)).alias("n_unsorted")
    )


def validate_dataset(
    df: DataFrame,
    target: str,
    pollutants: Sequence[str],
    keys: Sequence[str] = ("station",),
    ts: str = "ts",
    arrival: str = "arrival",
) -> DataFrame:
    """Violations of the four rules a finished data set keeps."""
    present = [c for c in pollutants if c in df.columns]
    rows = df.agg(
        F.count_if(F.col(target).isNull()).alias("target_null"),
        F.count_if(~any_known(present)).alias("no_pollutant"),
    ).select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(n).alias("rule"), F.col(n).alias("n_violations"))
                    for n in ("target_null", "no_pollutant")
                ]
            )
        )
    )
    doubled = duplicate_times(df, keys, ts).agg(
        F.lit("duplicate_time").alias("rule"),
        F.coalesce(F.sum("n_duplicates"), F.lit(0)).alias("n_violations"),
    )
    unsorted = unsorted_times(df, keys, ts, arrival).agg(
        F.lit("unsorted").alias("rule"),
        F.coalesce(F.sum("n_unsorted"), F.lit(0)).alias("n_violations"),
    )
    return rows.unionByName(doubled).unionByName(unsorted)
