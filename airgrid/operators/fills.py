"""Filling missing values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airgrid.operators import sequence
from airgrid.session import stored

VALUE_BINS = 4096


def forward_fill(df, columns, keys=("station",), ts="ts", cell=sequence.month_cell) -> DataFrame:
    """Replace NULL by the last known value, however far back."""
    filled = sequence.with_known(
        df, keys, ts, last={f"__{c}": F.col(c) for c in columns}, cell=cell
    )
    return _replace(filled, df.columns, {c: F.col(f"__{c}") for c in columns})


def backward_fill(df, columns, keys=("station",), ts="ts", cell=sequence.month_cell) -> DataFrame:
    """Replace NULL by the next known value."""
    filled = sequence.with_known(
        df, keys, ts, following={f"__{c}": F.col(c) for c in columns}, cell=cell
    )
    return _replace(filled, df.columns, {c: F.col(f"__{c}") for c in columns})


def impute_temporal(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = ("station",),
    ts: str = "ts",
    default: float | None = 0.0,
    cell: sequence.Cell = sequence.month_cell,
) -> DataFrame:
    """Last known value, else the next one, else ``default``.

    Both directions share one exchange. After them only a column that is NULL in the
    whole series is still open, so there is no column mean to fall back to. With
    ``default=None`` such a column stays NULL.
    """
    filled = sequence.with_known(
        df,
        keys,
        ts,
        last={f"__b_{c}": F.col(c) for c in columns},
        following={f"__f_{c}": F.col(c) for c in columns},
        cell=cell,
    )
    options = {}
    for c in columns:
        found = [F.col(f"__b_{c}"), F.col(f"__f_{c}")]
        options[c] = F.coalesce(*found, *([] if default is None else [F.lit(default)]))
    return _replace(filled, df.columns, options)


def _replace(df: DataFrame, order: Sequence[str], new: dict[str, Column]) -> DataFrame:
    return df.select(*[new[c].alias(c) if c in new else F.col(c) for c in order])


def fill_with_means(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = ("station",),
    ts: str = "ts",
    train: Column | None = None,
) -> DataFrame:
    """NULL becomes the column mean over the (training) rows, 0 where there is none."""
    source = df if train is None else df.filter(train)
    means = source.groupBy(*keys).agg(*[F.avg(c).alias(f"__{c}") for c in columns])
    joined = sequence.join_per_key(df, means, keys, ts)
    return _replace(
        joined,
        df.columns,
        {c: F.coalesce(F.col(c), F.col(f"__{c}"), F.lit(0.0)) for c in columns},
    )


def _coarse_bin(value: Column) -> Column:
    """A number that never falls as the value grows, 16 steps an octave, whatever the range."""
    return F.signum(value) * F.floor(16 * F.log2(1 + F.abs(value) * 2.0**30))


def _rank_bins(rows: DataFrame, group: Sequence[str], ranks: DataFrame | None) -> DataFrame:
    """(group, which, lo, hi, rank): per middle rank the extremes of the bin that holds it, and its rank there.

    ``rows`` has (group, which, __bin, __v); without ``ranks`` (group, which, rank) both middle ranks of
    each group are looked for. Only one row per bin reaches the windows.
    """
    group = list(group)
    keys = group if ranks is None else [*group, "which"]
    bins = rows.groupBy(*keys, "__bin").agg(
        F.count(F.lit(1)).alias("__n"), F.min("__v").alias("lo"), F.max("__v").alias("hi")
    )
    along = Window.partitionBy(*keys).orderBy("__bin")
    upto = F.sum("__n").over(along.rowsBetween(Window.unboundedPreceding, 0))
    counted = bins.withColumn("__upto", upto)
    if ranks is None:
        total = F.sum("__n").over(Window.partitionBy(*keys))
        middle = F.array(F.floor((total + 1) / 2), F.ceil((total + 1) / 2))
        counted = counted.withColumn("__ranks", middle).select("*", F.posexplode("__ranks").alias("which", "rank"))
    else:
        counted = counted.join(ranks, keys)
    holds = (F.col("__upto") >= F.col("rank")) & (F.col("__upto") - F.col("__n") < F.col("rank"))
    return counted.where(holds).select(
        *group, "which", "lo", "hi", (F.col("rank") - F.col("__upto") + F.col("__n")).alias("rank")
    )


def _inside(values_: DataFrame, found: DataFrame, group: Sequence[str]) -> DataFrame:
    """The values between the extremes of an open rank, once for each of them, in fine bins."""
    open_ = found.where("lo < hi").groupBy(*group).agg(
        F.collect_list(F.struct("which", "lo", "hi")).alias("__open")  # two at most
    )
    joined = sequence.join_per_key(values_, open_, group, "__v").where("__open is not null")
    spread = joined.select("*", F.explode("__open").alias("__o"))
    if "which" in values_.columns:  # a value is there once for each rank already
        spread = spread.where(F.col("which") == F.col("__o.which"))
    within = spread.where(F.col("__v").between(F.col("__o.lo"), F.col("__o.hi")))
    share = (F.col("__v") - F.col("__o.lo")) / (F.col("__o.hi") - F.col("__o.lo"))
    return within.select(*group, F.col("__o.which").alias("which"), "__v", F.floor(share * VALUE_BINS).alias("__bin"))


def exact_medians(df: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Exact median per key and column, as columns ``<name>``; NULL and NaN do not count.

    Selection by counting: values are counted in bins of like magnitude, only the bins that hold
    the middle ranks are looked into again, in ``VALUE_BINS`` bins between their own least and
    greatest value, and so on until a bin holds one value. No values are sorted or collected;
    a window sees one row per bin. An extreme value has a bin of its own and makes no other
    bin wider. The values inside the first bins are written, later rounds read only them.
    """
    keys, columns = list(keys), list(columns)
    doubles = [F.col(c).cast("double").alias(c) for c in columns]
    long = df.select(*keys, *doubles).unpivot([F.col(k) for k in keys], columns, "__name", "__v")
    long = long.where("__v is not null and not isnan(__v)")
    group = [*keys, "__name"]
    found = stored(_rank_bins(long.withColumn("__bin", _coarse_bin(F.col("__v"))), group, None), "median_ranks")
    left = long
    while found.where("lo < hi").limit(1).count():
        rows = stored(_inside(left, found, group), "median_values")
        finer = _rank_bins(rows, group, found.where("lo < hi").select(*group, "which", "rank"))
        found = stored(found.where("lo = hi").unionByName(finer), "median_ranks")
        left = rows
    middle = found.groupBy(*group).agg((F.sum("lo") / F.lit(2.0)).alias("__m"))
    return middle.groupBy(*keys).agg(*[F.max(F.when(F.col("__name") == c, F.col("__m"))).alias(c) for c in columns])


def fill_with_medians(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("station",), ts: str = "ts"
) -> DataFrame:
    """NULL becomes the exact column median."""
    medians = exact_medians(df, columns, keys)
    for c in columns:
        medians = medians.withColumnRenamed(c, f"__{c}")
    joined = sequence.join_per_key(df, medians, keys, ts)
    return _replace(
        joined, df.columns, {c: F.coalesce(F.col(c), F.col(f"__{c}")) for c in columns}
    )
