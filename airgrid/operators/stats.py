"""Scaling, correlation, importance tables, climatology, last known values."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airgrid import config
from airgrid.functions.labels import air_category, air_index, gauge_pointer
from airgrid.operators import sequence
from airgrid.session import stored
from airgrid.tasks import in_tasks


def unfold(df: DataFrame, rows: list[Column], keys: Sequence[str] = ()) -> DataFrame:
    """A wide aggregate to one row per struct."""
    return df.select(*keys, F.inline(F.array(*rows)))


# -- per feature -----------------------------------------------------------------------


def feature_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Min, max and mean per feature."""
    wide = df.agg(
        *[
            f(F.col(c).cast("double")).alias(f"{c}__{name}")
            for c in columns
            for name, f in (("min", F.min), ("max", F.max), ("mean", F.avg))
        ]
    )
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            *[F.col(f"{c}__{name}").alias(name) for name in ("min", "max", "mean")],
        )
        for c in columns
    ]
    return unfold(wide, rows)


def scaler_stats(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """Mean and population deviation per feature, as ``mu_<name>`` and ``sd_<name>``.

    A deviation of 0 becomes 1, so that a constant feature scales to 0.
    """
    wide = df.groupBy(*keys).agg(
        *[F.avg(c).alias(f"mu_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"sd_{c}") for c in columns],
    )
    return wide.withColumns(
        {f"sd_{c}": F.when(F.col(f"sd_{c}") == 0, 1.0).otherwise(F.col(f"sd_{c}")) for c in columns}
    )


def standardise(c: str) -> Column:
    """Needs the columns of :func:`scaler_stats`."""
    return (F.col(c) - F.col(f"mu_{c}")) / F.col(f"sd_{c}")


def unstandardise(value: Column, c: str) -> Column:
    return value * F.col(f"sd_{c}") + F.col(f"mu_{c}")


def top_variance(df: DataFrame, columns: Sequence[str], n: int = 20) -> DataFrame:
    """The columns with the largest sample deviation, ranked."""
    wide = df.agg(*[F.stddev_samp(F.col(c).cast("double")).alias(c) for c in columns])
    spread = F.array(
        *[F.struct((-F.col(c)).alias("__minus"), F.lit(c).alias("column")) for c in columns]
    )
    known = F.filter(spread, lambda s: s["__minus"].isNotNull())
    ranked = wide.select(F.posexplode(F.slice(F.array_sort(known), 1, n)).alias("__at", "__s"))
    return ranked.select(
        F.col("__s.column").alias("column"),
        (-F.col("__s.__minus")).alias("std"),
        (F.col("__at") + 1).alias("rank"),
    )


# -- correlation -----------------------------------------------------------------------


def pearson(a: str, b: str) -> Column:
    """Aggregate: correlation over the rows that have both values.

    NULL where a column does not vary on them; the built-in ``corr`` stops with a
    division by zero there.
    """
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    spread = F.sqrt(F.var_pop(F.when(y.isNotNull(), x)) * F.var_pop(F.when(x.isNotNull(), y)))
    return F.try_divide(F.covar_pop(x, y), spread)


class CoMoments:
    """Counts, means and centred products of all pairs of columns, over rows that have both.

    Entry (i, j) of ``mean`` and ``square`` is about column i on the rows that have i and j.
    """

    def __init__(self, k: int) -> None:
        self.n, self.mean, self.square, self.product = (np.zeros((k, k)) for _ in range(4))

    def add(self, x: np.ndarray) -> None:
        """Take in rows; NaN is missing."""
        there = ~np.isnan(x)
        known = there.any(axis=0)
        centre = np.zeros(x.shape[1])
        centre[known] = np.nanmedian(x[:, known], axis=0)  # so that a constant column leaves exact zeros
        d, m = np.where(there, x - centre, 0.0), there.astype(float)
        n = m.T @ m
        with np.errstate(divide="ignore", invalid="ignore"):
            shift = np.where(n > 0, (d.T @ m) / n, 0.0)
        square, product = (d * d).T @ m - n * shift**2, d.T @ d - n * shift * shift.T
        self.merge(n, centre[:, None] + shift, square, product)

    def merge(self, n: np.ndarray, mean: np.ndarray, square: np.ndarray, product: np.ndarray) -> None:
        total = self.n + n
        with np.errstate(divide="ignore", invalid="ignore"):
            share = np.where(total > 0, n / total, 0.0)
        off = np.where(self.n > 0, mean - self.mean, 0.0)
        weight = self.n * share
        self.square += square + weight * off**2
        self.product += product + weight * off * off.T
        self.mean = np.where(self.n > 0, self.mean + share * off, mean)
        self.n = total


def pair_correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(i, j, n, r) of all pairs i < j of column numbers, in one scan whatever their number.

    Every task sends one row per pair; these are merged exactly by the pair's overall means.
    """
    columns = list(columns)
    k = len(columns)
    values = F.array(*[F.col(f"`{c}`").cast("double") for c in columns])
    one, two = np.triu_indices(k, 1)

    def rows(batches) -> Iterator[pa.RecordBatch]:
        sums = CoMoments(k)
        for batch in batches:
            if batch.num_rows:
                flat = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(float)
                sums.add(flat.reshape(-1, k))
        seen = np.flatnonzero(sums.n[one, two] > 0)
        i, j = one[seen], two[seen]
        fields = (sums.n[i, j], sums.mean[i, j], sums.mean[j, i], sums.square[i, j], sums.square[j, i], sums.product[i, j])
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), *[pa.array(f) for f in fields]], PAIR_FIELDS
        )

    kinds = "i int, j int, " + ", ".join(f"{f} double" for f in PAIR_FIELDS[2:])
    parts = stored(in_tasks(df.select(values.alias("x")), rows, kinds), "co_moments")
    whole = parts.groupBy("i", "j").agg(
        F.sum("n").alias("all"),
        (F.sum(F.col("n") * F.col("mx")) / F.sum("n")).alias("ax"),
        (F.sum(F.col("n") * F.col("my")) / F.sum("n")).alias("ay"),
    )
    dx, dy = F.col("mx") - F.col("ax"), F.col("my") - F.col("ay")
    # Means of a constant column may differ from it in the last digit only.
    dx, dy = (F.when(F.abs(d) <= F.abs(F.col(m)) * 1e-15, 0.0).otherwise(d) for d, m in ((dx, "ax"), (dy, "ay")))
    met = parts.join(whole, ["i", "j"]).groupBy("i", "j").agg(
        F.max("all").cast("bigint").alias("n"),
        F.sum(F.col("sx") + F.col("n") * dx * dx).alias("sx"),
        F.sum(F.col("sy") + F.col("n") * dy * dy).alias("sy"),
        F.sum(F.col("sp") + F.col("n") * dx * dy).alias("sp"),
    )
    spread = F.sqrt(F.greatest("sx", F.lit(0.0))) * F.sqrt(F.greatest("sy", F.lit(0.0)))
    return met.select("i", "j", "n", F.try_divide("sp", spread).alias("r"))


PAIR_FIELDS = ["i", "j", "n", "mx", "my", "sx", "sy", "sp"]


def pearson_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise-complete correlation of every pair, lower triangle; NULL without common rows or spread."""
    columns = list(columns)
    if len(columns) < 2:
        raise ValueError("a correlation matrix needs two columns or more")
    found = pair_correlations(df, columns)
    numbers = df.sparkSession.createDataFrame(list(combinations(range(len(columns)), 2)), "i int, j int")
    names = F.array(*[F.lit(c) for c in columns])
    return numbers.join(found, ["i", "j"], "left").select(
        names[F.col("i")].alias("col_a"), names[F.col("j")].alias("col_b"), "r"
    )


def top_variance_with_target(df: DataFrame, columns: Sequence[str], target: str, n: int = 20) -> DataFrame:
    """The columns with the largest deviation, ranked, with their correlation with the target."""
    columns = [c for c in columns if c != target]
    ranked = top_variance(df, columns, n)
    names = F.array(*[F.lit(c) for c in columns])
    with_target = pair_correlations(df, [target, *columns]).where("i = 0")
    return ranked.join(with_target.select(names[F.col("j") - 1].alias("column"), "r"), "column", "left")


def pearson_listwise(df: DataFrame, columns: Sequence[str], minimum: int = 10) -> DataFrame:
    """Correlation over rows complete in all columns; NULL below ``minimum`` rows."""
    complete = df.dropna("any", subset=list(columns))
    pairs = list(combinations(columns, 2))
    wide = complete.agg(
        F.count(F.lit(1)).alias("__n"),
        *[pearson(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)],
    )
    enough = F.col("__n") >= minimum
    rows = [
        F.struct(
            F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.when(enough, F.col(f"r{i}")).alias("r")
        )
        for i, (a, b) in enumerate(pairs)
    ]
    return unfold(wide, rows)


# -- importance tables -----------------------------------------------------------------


def importance_ranking(importance: DataFrame, n: int = 25) -> DataFrame:
    """The top of the importance table; the feature name breaks ties."""
    return importance.orderBy(F.desc("importance"), "feature").limit(n)


def importance_share(importance: DataFrame, n: int = 10, rest: str = "Otros") -> DataFrame:
    """Positive importances: the first ``n`` and one bucket with the sum of the rest.

    The table has one row per model feature, so it is folded into one sorted array.
    """
    ordered = importance.filter("importance > 0").agg(
        F.array_sort(
            F.collect_list(F.struct((-F.col("importance")).alias("__minus"), F.col("feature")))
        ).alias("__all")
    )
    listed = ordered.select(F.posexplode("__all").alias("__at", "__s")).select(
        F.when(F.col("__at") < n, F.col("__s.feature")).alias("feature"),
        (-F.col("__s.__minus")).alias("importance"),
    )
    grouped = listed.groupBy("feature").agg(
        F.sum("importance").alias("importance"), F.count(F.lit(1)).alias("__n")
    )
    total = grouped.agg(F.array_agg(F.struct("feature", "importance", "__n")).alias("__all"))
    whole = F.aggregate("__all", F.lit(0.0), lambda acc, s: acc + s["importance"])
    return total.select(whole.alias("__whole"), F.inline("__all")).select(
        F.coalesce("feature", F.concat(F.lit(f"{rest} ("), F.col("__n"), F.lit(")"))).alias(
            "feature"
        ),
        "importance",
        (F.col("importance") / F.col("__whole")).alias("share"),
    )


# -- climatology -----------------------------------------------------------------------


def climatology_wide(
    df: DataFrame, features: Sequence[str], keys: Sequence[str] = ("station",), ts: str = "ts"
) -> DataFrame:
    """Mean of each feature per key, hour of day and month: at most 288 rows per key."""
    return df.groupBy(*keys, F.hour(ts).alias("hour"), F.month(ts).alias("month")).agg(
        *[F.avg(c).alias(c) for c in features]
    )


def climatology(
    df: DataFrame, features: Sequence[str], keys: Sequence[str] = ("station",), ts: str = "ts"
) -> DataFrame:
    """The same, long: (key, feature, hour, month, mean); groups without a value are left out."""
    wide = climatology_wide(df, features, keys, ts)
    long = wide.unpivot(
        [F.col(k) for k in (*keys, "hour", "month")], [F.col(c) for c in features], "feature", "mean"
    )
    return long.filter("mean is not null")


def lookup_climatology(
    df: DataFrame,
    wide: DataFrame,
    features: Sequence[str],
    keys: Sequence[str] = ("station",),
    ts: str = "ts",
    prefix: str = "clim_",
) -> DataFrame:
    """Add the climatological mean of each feature at the row's hour and month.

    The table grows with the stations, so it is written first and Spark broadcasts it
    only where its size allows; beyond that each group of a hot station is spread over
    several tasks by the day of its rows.
    """
    found = [f"{prefix}{c}" for c in features]
    table = wide.select(
        *keys, F.col("hour").alias("__hour"), F.col("month").alias("__month"),
        *[F.col(c).alias(name) for c, name in zip(features, found)],
    )
    slotted = df.withColumns({"__hour": F.hour(ts), "__month": F.month(ts)})
    joined = sequence.join_per_key(slotted, table, [*keys, "__hour", "__month"], ts)
    return joined.select(*df.columns, *found)


def lookup_lagged(
    df: DataFrame,
    wide: DataFrame,
    base: str,
    lags: Sequence[int],
    keys: Sequence[str] = ("station",),
    ts: str = "ts",
    fallback: Column | None = None,
) -> DataFrame:
    """Add ``<base>_lag_<k>h``: the mean of ``base`` at the hour and month of ts - k hours.

    All lags are read from one map per station of at most 288 means, so there is one
    join whatever the number of lags. ``fallback`` (0 by default) serves where the
    climatology has no entry.
    """
    slot = F.col("month") * 100 + F.col("hour")
    maps = wide.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct(slot, F.col(base)))).alias("__means")
    )
    joined = sequence.join_per_key(df, maps, keys, ts)
    default = F.lit(0.0) if fallback is None else fallback
    found = {}
    for k in lags:
        past = F.col(ts) - F.make_dt_interval(hours=F.lit(k))
        mean = F.try_element_at("__means", F.month(past) * 100 + F.hour(past))
        found[f"{base}_lag_{k}h"] = F.coalesce(mean, default)
    return joined.withColumns(found).drop("__means")


def lookup_lags(
    df: DataFrame,
    wide: DataFrame,
    lags: Sequence[tuple[str, str, int]],
    keys: Sequence[str] = ("station",),
    ts: str = "ts",
    prefix: str = "lag_",
) -> DataFrame:
    """Add ``<prefix><name>`` for each (name, base, hours): the mean of the base at the hour and month
    of ts - hours, NULL where the climatology has none.

    All bases and lags are read from one map per station of at most 288 entries: one join.
    """
    bases = sorted({base for _, base, _ in lags})
    slot = F.col("month") * 100 + F.col("hour")
    maps = wide.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct(slot, F.struct(*bases)))).alias("__means")
    )
    joined = sequence.join_per_key(df, maps, keys, ts)
    found = {}
    for name, base, hours in lags:
        past = F.col(ts) - F.make_dt_interval(hours=F.lit(hours))
        entry = F.try_element_at("__means", F.month(past) * 100 + F.hour(past))
        found[f"{prefix}{name}"] = entry[base]
    return joined.withColumns(found).drop("__means")


def last_known(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("station",), ts: str = "ts"
) -> DataFrame:
    """Per key: last time and month, each column in the last row and its last known value."""
    return df.groupBy(*keys).agg(
        F.max(ts).alias("last_ts"),
        F.month(F.max(ts)).alias("last_month"),
        *[F.max_by(c, ts).alias(f"row_{c}") for c in columns],
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(ts))).alias(f"known_{c}") for c in columns],
    )


# -- index tables ----------------------------------------------------------------------


def geo_mean(df: DataFrame, place: Sequence[str], value: str, pollutant: str) -> DataFrame:
    """Mean per place with its index and category."""
    means = df.groupBy(*place).agg(F.avg(value).alias("mean"))
    indexed = means.withColumn("air_index", air_index(pollutant, F.col("mean")))
    return indexed.withColumn("category", air_category(F.col("air_index")))


def coordinate_columns(columns: Sequence[str]) -> tuple[str, str] | None:
    """The first columns named like a latitude and a longitude, in any case."""
    found = [next((c for c in columns if c.lower() in names), None) for names in (config.LATITUDES, config.LONGITUDES)]
    return tuple(found) if all(found) else None


def geo_mean_by_name(df: DataFrame, value: str, pollutant: str) -> DataFrame:
    """``geo_mean`` by the coordinates found among the columns; without them no rows."""
    place = coordinate_columns(df.columns)
    if place is None:
        return geo_mean(df.limit(0).withColumns({"lat": F.lit(None).cast("double"), "lon": F.lit(None).cast("double")}), ("lat", "lon"), value, pollutant)
    return geo_mean(df, place, value, pollutant)


def mean_index_gauge(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Per column its mean, index, category and pointer position."""
    wide = df.agg(*[F.avg(c).alias(c) for c in columns])
    rows = [
        F.struct(
            F.lit(c).alias("variable"),
            F.col(c).alias("mean"),
            air_index(pollutant, F.col(c)).alias("air_index"),
        )
        for c, pollutant in columns.items()
    ]
    return unfold(wide, rows).select(
        "*",
        air_category(F.col("air_index")).alias("category"),
        gauge_pointer(F.col("air_index")).alias("pointer"),
    )


def sample_rows(df: DataFrame, ids: Sequence[str], n: int = config.SAMPLE_ROWS) -> DataFrame:
    """Up to ``n`` rows by the hash of their id: the same rows for any partitioning."""
    return df.orderBy(F.xxhash64(*ids, F.lit(config.SEED)), *ids).limit(n)
