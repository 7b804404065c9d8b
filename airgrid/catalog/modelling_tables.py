"""Queries over features, splits, scores and index tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from airgrid import config
from airgrid.catalog import views as v
from airgrid.catalog.registry import query, r6, s6, s_ts, ts_text, with_sql
from airgrid.functions import labels, moments
from airgrid.operators import align as al
from airgrid.operators import features as fe
from airgrid.operators import fills, metrics, splits, stats
from airgrid.operators import sequence as sq
from airgrid.plans import scoring
from airgrid.session import stored

USER = ("user_id",)
OVER = "OVER (PARTITION BY user_id ORDER BY ts)"

# -- windows ---------------------------------------------------------------------------


@query(
    "lag_features",
    with_sql(
        v.SERIES,
        "SELECT user_id, " + s_ts("ts", "ts") + ", "
        + ", ".join(f"lag(value, {k}) {OVER} AS value_lag_{k}h" for k in config.TARGET_LAGS)
        + " FROM series",
    ),
)
def lag_features(spark, sf):
    lagged = fe.add_lags(stored(v.series(spark, sf)), "value", keys=USER)
    return lagged.drop("value").withColumn("ts", ts_text("ts"))


@query(
    "diff_features",
    with_sql(
        v.SERIES,
        "SELECT user_id, " + s_ts("ts", "ts") + ", "
        + ", ".join(
            s6(f"value - lag(value, {k}) {OVER}", f"value_diff_{k}h") for k in config.DIFF_LAGS
        )
        + " FROM series",
    ),
)
def diff_features(spark, sf):
    diffs = fe.add_diffs(stored(v.series(spark, sf)), ["value"], keys=USER)
    return diffs.select(
        "user_id",
        ts_text("ts").alias("ts"),
        *[r6(f"value_diff_{k}h").alias(f"value_diff_{k}h") for k in config.DIFF_LAGS],
    )


def _frame(n: int, shift: int = 0) -> str:
    return (
        f"OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN {n - 1 + shift} PRECEDING AND "
        + (f"{shift} PRECEDING)" if shift else "CURRENT ROW)")
    )


_ROLLING = ", ".join(
    [s6(f"avg(value) {_frame(n)}", f"value_roll_mean_{n}h") for n in config.MEAN_WINDOWS]
    + [s6(f"stddev_samp(value) {_frame(n)}", f"value_roll_std_{n}h") for n in config.STD_WINDOWS]
)


@query(
    "rolling_features",
    with_sql(v.SERIES, "SELECT user_id, " + s_ts("ts", "ts") + f", {_ROLLING} FROM series"),
)
def rolling_features(spark, sf):
    rolled = fe.add_rolling(stored(v.series(spark, sf)), ["value"], keys=USER)
    made = [c for c in rolled.columns if "_roll_" in c]
    return rolled.select("user_id", ts_text("ts").alias("ts"), *[r6(c).alias(c) for c in made])


@query(
    "rolling_past",
    with_sql(
        v.USER_HOURLY,
        "SELECT user_id, " + s_ts("ts", "ts") + ", "
        + s6(f'avg("view") {_frame(6, 1)}', "view_roll_mean_6h") + ", "
        + s6(f'stddev_samp("view") {_frame(24, 1)}', "view_roll_std_24h")
        + " FROM user_hourly",
    ),
)
def rolling_past(spark, sf):
    """Rolling features without the current row, on a sparse column."""
    rolled = fe.add_rolling(
        stored(v.user_hourly(spark, sf)), ["view"], (6,), (24,), USER, exclude_current=True
    )
    made = ["view_roll_mean_6h", "view_roll_std_24h"]
    return rolled.select("user_id", ts_text("ts").alias("ts"), *[r6(c).alias(c) for c in made])


_WEATHER_SQL = (
    "value % 35 AS Temperatura, (value * 3) % 100 AS Humedad, value % 12 AS Viento_Velocidad, "
    "(value * 7) % 360 AS Viento_Direccion"
)


def _with_weather(df):
    value = F.col("value")
    return df.withColumns(
        {
            "Temperatura": value % 35,
            "Humedad": (value * 3) % 100,
            "Viento_Velocidad": value % 12,
            "Viento_Direccion": (value * 7) % 360,
        }
    )


_DAY = "(isodow(ts) - 1)"
_WEEKDAY_SQL = (
    f"CAST({_DAY} AS INTEGER) AS dia_semana, "
    + s6(f"sin(2 * pi() * {_DAY} / 7)", "dia_semana_sin")
    + ", "
    + s6(f"cos(2 * pi() * {_DAY} / 7)", "dia_semana_cos")
    + f", CAST({_DAY} >= 5 AS INTEGER) AS es_finde"
)
_WIND_SQL = ", ".join(
    [
        s6("Temperatura * Humedad", "temp_hum"),
        s6("Temperatura * Viento_Velocidad", "temp_wind"),
        s6("Viento_Velocidad * cos(radians(Viento_Direccion))", "wind_u"),
        s6("Viento_Velocidad * sin(radians(Viento_Direccion))", "wind_v"),
    ]
)


@query(
    "build_features",
    with_sql(
        v.SERIES,
        f"weather AS (SELECT *, {_WEATHER_SQL} FROM series)",
        "built AS (SELECT user_id, " + s_ts("ts", "ts") + ", value, "
        + ", ".join(
            s6(c, c)
            for c in ("Temperatura", "Humedad", "Viento_Velocidad", "Viento_Direccion")
        )
        + f", {_ROLLING}, "
        + ", ".join(
            s6(f"value - lag(value, {k}) {OVER}", f"value_diff_{k}h") for k in config.DIFF_LAGS
        )
        + f", {_WIND_SQL}, {_WEEKDAY_SQL} FROM weather)",
        "SELECT * FROM built WHERE value_diff_24h IS NOT NULL",
    ),
)
def build_features(spark, sf):
    """All features of the model, complete rows only."""
    built = fe.build_features(_with_weather(stored(v.series(spark, sf))), ["value"], USER)
    rounded = [
        r6(c).alias(c) if t == "double" and c != "value" else F.col(c)
        for c, t in built.dtypes
        if c != "ts"
    ]
    return built.select(*rounded, ts_text("ts").alias("ts"))


@query(
    "impute_temporal",
    with_sql(
        v.USER_HOURLY,
        "SELECT user_id, " + s_ts("ts", "ts") + ", "
        + ", ".join(
            f"coalesce(last_value(\"{c}\" IGNORE NULLS) OVER b, "
            f"first_value(\"{c}\" IGNORE NULLS) OVER f, 0.0) AS \"{c}\""
            for c in v.VARIABLES
        )
        + " FROM user_hourly WINDOW b AS (PARTITION BY user_id ORDER BY ts "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
        "f AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)",
    ),
)
def impute_temporal(spark, sf):
    filled = fills.impute_temporal(stored(v.user_hourly(spark, sf)), v.VARIABLES, USER)
    return filled.withColumn("ts", ts_text("ts"))


@query(
    "directional_fills",
    with_sql(
        v.USER_HOURLY,
        "SELECT user_id, " + s_ts("ts", "ts") + ", "
        'last_value("view" IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts '
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS \"view\", "
        "first_value(click IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts "
        "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS click FROM user_hourly",
    ),
)
def directional_fills(spark, sf):
    """One column filled forwards, another backwards."""
    wide = stored(v.user_hourly(spark, sf)).select("user_id", "ts", "view", "click")
    filled = fills.backward_fill(fills.forward_fill(wide, ["view"], USER), ["click"], USER)
    return filled.withColumn("ts", ts_text("ts"))


@query(
    "column_fills",
    with_sql(
        v.READINGS,
        v.HOURLY,
        "SELECT station, " + s_ts("ts", "ts") + ", "
        + s6('coalesce("view", avg("view") OVER (PARTITION BY station), 0)', "view_mean") + ", "
        + s6("coalesce(click, m)", "click_median")
        + " FROM hourly JOIN (SELECT station, quantile_cont(click, 0.5) AS m FROM hourly "
        "GROUP BY station) USING (station)",
    ),
)
def column_fills(spark, sf):
    """Missing targets by the column mean and by the exact median."""
    hourly = stored(v.hourly(spark, sf)).select(
        "station", "ts", F.col("view").alias("view_mean"), F.col("click").alias("click_median")
    )
    filled = fills.fill_with_medians(fills.fill_with_means(hourly, ["view_mean"]), ["click_median"])
    return filled.select(
        "station", ts_text("ts").alias("ts"), r6("view_mean").alias("view_mean"),
        r6("click_median").alias("click_median"),
    )


# -- splits ----------------------------------------------------------------------------

_POS = (
    "pos AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS pos, "
    "count(*) OVER (PARTITION BY user_id) AS n FROM series)"
)
_ROLE = (
    "roles AS (SELECT *, CASE WHEN pos <= floor(floor(n * 0.8::DOUBLE) * 0.8::DOUBLE) THEN 'fit' "
    "WHEN pos <= floor(n * 0.8::DOUBLE) THEN 'val' ELSE 'test' END AS role FROM pos)"
)
_FOLD = (
    "sized AS (SELECT *, n // 6 AS size FROM pos), "
    "spread AS (SELECT *, n - (6 - fold) * size AS start FROM sized, "
    "(SELECT CAST(unnest([1, 2, 3, 4, 5]) AS INTEGER) AS fold)), "
    "folds AS (SELECT *, CASE WHEN pos <= start THEN 'train' ELSE 'val' END AS role FROM spread "
    "WHERE pos <= start + size)"
)


@query(
    "split_ranges",
    with_sql(
        v.SERIES,
        _POS,
        _ROLE,
        "SELECT user_id, role, count(*) AS n_rows, " + s_ts("min(ts)", "first_ts") + ", "
        + s_ts("max(ts)", "last_ts") + ", " + s6("count(*)::DOUBLE / any_value(n)", "share")
        + " FROM roles GROUP BY 1, 2",
    ),
)
def split_ranges(spark, sf):
    """Training, validation and test stretch of each series."""
    ranges = splits.split_ranges(splits.chronological_split(stored(v.series(spark, sf)), USER), USER)
    return ranges.select(
        "user_id", "role", "n_rows", ts_text("first_ts").alias("first_ts"),
        ts_text("last_ts").alias("last_ts"), r6("share").alias("share"),
    )


@query(
    "time_series_folds",
    with_sql(
        v.SERIES,
        _POS,
        _FOLD,
        "SELECT user_id, fold, count(*) FILTER (role = 'train') AS n_train, "
        "count(*) FILTER (role = 'val') AS n_val, "
        + s_ts("min(ts) FILTER (role = 'val')", "val_first_ts")
        + " FROM folds GROUP BY 1, 2",
    ),
)
def time_series_folds(spark, sf):
    folds = splits.time_series_folds(stored(v.series(spark, sf)), USER)
    is_val = F.col("role") == "val"
    return folds.groupBy("user_id", "fold").agg(
        F.count_if(F.col("role") == "train").alias("n_train"),
        F.count_if(is_val).alias("n_val"),
        ts_text(F.min(F.when(is_val, F.col("ts")))).alias("val_first_ts"),
    )


@query(
    "stack_parts",
    with_sql(v.SERIES, _POS, _ROLE,
             "SELECT user_id, count(*) AS n_rows FROM roles WHERE role <> 'test' GROUP BY 1"),
)
def stack_parts(spark, sf):
    """The fit part on top of the validation part."""
    split = splits.chronological_split(stored(v.series(spark, sf)), USER)
    stacked = splits.stack_roles(split, "fit", "val")
    return stacked.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_rows"))


# -- scores of the persistence forecast -------------------------------------------------


def _persistence(spark, sf):
    lagged = fe.add_lags(stored(v.series(spark, sf)), "value", (1,), USER, keep_position=True)
    return lagged.select(
        "user_id", "ts", "pos", "n_rows", F.col("value").alias("y"), F.col("value_lag_1h").alias("yhat")
    )


_FORECAST = f"forecast AS (SELECT *, lag(value) {OVER} AS yhat FROM {{source}})"
_SCORES = (
    "count(*) AS n, CASE WHEN count(*) > 1 THEN avg(abs(value - yhat)) END AS mae, "
    "CASE WHEN count(*) > 1 THEN sqrt(avg((value - yhat) ** 2)) END AS rmse, "
    "CASE WHEN count(*) < 2 THEN NULL WHEN var_pop(value) > 0 "
    "THEN 1 - avg((value - yhat) ** 2) / var_pop(value) "
    "WHEN avg((value - yhat) ** 2) = 0 THEN 1 ELSE 0 END AS r2"
)


@query(
    "regression_metrics",
    with_sql(
        v.SERIES,
        "predicted AS (SELECT *, lag(value) " + OVER + " AS yhat FROM series)",
        _POS.replace("FROM series", "FROM predicted"),
        "roles AS (SELECT *, CASE WHEN pos <= floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END "
        "AS role FROM pos)",
        f"scores AS (SELECT user_id, role, {_SCORES} FROM roles WHERE yhat IS NOT NULL GROUP BY 1, 2)",
        "SELECT user_id, role, n, " + s6("mae", "mae") + ", " + s6("rmse", "rmse") + ", "
        + s6("r2", "r2") + ", round(100 * r2, 2) + 0.0 AS r2_pct, "
        "max(r2) FILTER (role = 'train') OVER (PARTITION BY user_id) - max(r2) FILTER (role = 'test') "
        "OVER (PARTITION BY user_id) > 0.15 AS overfit FROM scores",
    ),
)
def regression_metrics(spark, sf):
    """Scores per series on its training and test part, with the overfit flag."""
    split = splits.chronological_split(_persistence(spark, sf), USER, inner_ratio=None)
    scores = metrics.regression_metrics(split, ("user_id", "role"))
    gaps = scores.groupBy("user_id").agg(
        labels.overfit(
            F.max(F.when(F.col("role") == "train", F.col("r2"))),
            F.max(F.when(F.col("role") == "test", F.col("r2"))),
        ).alias("overfit")
    )
    return scores.join(gaps, "user_id").select(
        "user_id", "role", "n", *[r6(m).alias(m) for m in ("mae", "rmse", "r2")],
        F.round(F.col("r2") * 100, 2).alias("r2_pct"), "overfit",
    )


def _fold_metrics(spark, sf):
    folds = splits.time_series_folds(_persistence(spark, sf), USER).filter("role = 'val'")
    scores = metrics.regression_metrics(folds, ("user_id", "fold"))
    return scores.withColumnRenamed("user_id", "target")


_FOLD_SCORES = (
    f"fold_scores AS (SELECT user_id AS target, fold, {_SCORES} FROM folds WHERE role = 'val' "
    "AND yhat IS NOT NULL GROUP BY 1, 2)"
)
_PREDICTED_FOLDS = (
    "predicted AS (SELECT *, lag(value) " + OVER + " AS yhat FROM series)",
    _POS.replace("FROM series", "FROM predicted"),
    _FOLD,
    _FOLD_SCORES,
)


@query(
    "fold_summary",
    with_sql(
        v.SERIES,
        *_PREDICTED_FOLDS,
        "SELECT target, "
        + ", ".join(
            s6(f"{f}({m})", f"{m}_{n}")
            for m in ("mae", "rmse", "r2")
            for f, n in (("avg", "mean"), ("stddev_samp", "std"))
        )
        + ", CASE WHEN avg(r2) >= 0.7 THEN 'Bueno' WHEN avg(r2) >= 0.5 THEN 'Aceptable' "
        "ELSE 'Mejorable' END AS level, CASE WHEN avg(r2) >= 0.9 THEN 0.9::DOUBLE "
        "WHEN avg(r2) >= 0.7 THEN 0.7 WHEN avg(r2) >= 0.5 THEN 0.5 ELSE 0 END AS band "
        "FROM fold_scores GROUP BY target",
    ),
)
def fold_summary(spark, sf):
    summary = metrics.r2_ranking(metrics.fold_summary(_fold_metrics(spark, sf)))
    return summary.select(
        *[r6(c).alias(c) if t == "double" and c != "band" else c for c, t in summary.dtypes]
    )


@query(
    "fold_mean_r2",
    with_sql(v.SERIES, *_PREDICTED_FOLDS,
             "SELECT fold, " + s6("avg(r2)", "r2_mean") + " FROM fold_scores GROUP BY fold"),
)
def fold_mean_r2(spark, sf):
    means = metrics.fold_mean_r2(_fold_metrics(spark, sf))
    return means.select("fold", r6("r2_mean").alias("r2_mean"))


@query(
    "part_mean_r2",
    with_sql(
        v.SERIES,
        "predicted AS (SELECT *, lag(value) " + OVER + " AS yhat FROM series)",
        _POS.replace("FROM series", "FROM predicted"),
        "roles AS (SELECT *, CASE WHEN pos <= floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END "
        "AS part FROM pos)",
        f"scores AS (SELECT user_id, part, {_SCORES} FROM roles WHERE yhat IS NOT NULL GROUP BY 1, 2)",
        "SELECT part, " + s6("avg(r2)", "r2_mean") + ", count(r2) AS n_targets FROM scores GROUP BY part",
    ),
)
def part_mean_r2(spark, sf):
    """Mean score over all series on the training and on the test part."""
    split = splits.chronological_split(_persistence(spark, sf), USER, inner_ratio=None)
    scores = metrics.regression_metrics(split, ("user_id", "role"))
    means = metrics.part_mean_r2(scores.withColumnRenamed("role", "part"))
    return means.select("part", r6("r2_mean").alias("r2_mean"), "n_targets")


ROUNDS = tuple(range(1, 11))


def _curves(spark, sf):
    """Learning curves by stand-in: round k scores the forecast of k + 1 rows ago."""
    lagged = fe.add_lags(stored(v.series(spark, sf)), "value", ROUNDS, USER, keep_position=True)
    folds = splits.time_series_folds(lagged, USER)
    wide = folds.groupBy(
        (F.col("user_id") % 3).alias("target"), "fold", F.col("role").alias("split")
    ).agg(
        *[F.avg(F.abs(F.col("value") - F.col(f"value_lag_{k}h"))).alias(str(k - 1)) for k in ROUNDS]
    )
    long = wide.unpivot(
        ["target", "fold", "split"], [F.col(f"`{k - 1}`") for k in ROUNDS], "iter", "score"
    )
    return long.withColumn("iter", F.col("iter").cast("int"))


_CURVES = (
    "lagged AS (SELECT *, "
    + ", ".join(f"lag(value, {k}) {OVER} AS p{k - 1}" for k in ROUNDS)
    + " FROM series)",
    _POS.replace("FROM series", "FROM lagged"),
    _FOLD,
    "curves AS ("
    + " UNION ALL ".join(
        f"SELECT user_id % 3 AS target, fold, role AS split, {k - 1} AS iter, "
        f"avg(abs(value - p{k - 1})) AS score FROM folds GROUP BY 1, 2, 3"
        for k in ROUNDS
    )
    + ")",
    "curve_means AS (SELECT target, split, iter, avg(score) AS mean, stddev_pop(score) AS std "
    "FROM curves GROUP BY 1, 2, 3)",
)


@query(
    "curve_summary",
    with_sql(
        v.SERIES,
        *_CURVES,
        "SELECT target, split, iter, " + s6("mean", "mean") + ", " + s6("std", "std")
        + " FROM curve_means",
    ),
)
def curve_summary(spark, sf):
    summary = metrics.curve_summary(_curves(spark, sf))
    return summary.select(
        "target", "split", "iter", r6("mean").alias("mean"), r6("std").alias("std")
    )


@query(
    "best_rounds",
    with_sql(
        v.SERIES,
        *_CURVES,
        "best AS (SELECT target, arg_min(iter, mean) AS best_iter, min(mean) AS best_score "
        "FROM curve_means WHERE split = 'val' GROUP BY 1)",
        "final AS (SELECT CAST(floor(quantile_cont((best_iter + 1) * 20, 0.5)) AS BIGINT) AS b FROM best)",
        "SELECT target, best_iter, " + s6("best_score", "best_score")
        + ", b AS best_rounds, least(b + 40, 200) AS final_rounds FROM best, final",
    ),
)
def best_rounds(spark, sf):
    """Best round per target and the round count of the final fit."""
    found = metrics.best_and_final_rounds(stored(_curves(spark, sf)), 200)
    return found.withColumn("best_score", r6("best_score"))


# -- statistics ------------------------------------------------------------------------


@query(
    "feature_stats",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, min({c}) AS min, max({c}) AS max, " + s6(f"avg({c})", "mean")
        + " FROM lineitem"
        for c in v.MEASURES
    ),
)
def feature_stats(spark, sf):
    table = stats.feature_stats(v.measures(spark, sf), v.MEASURES)
    return table.withColumn("mean", r6("mean"))


@query(
    "scaler",
    "WITH s AS (SELECT l_returnflag, "
    + ", ".join(f"avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}" for c in v.MEASURES)
    + " FROM lineitem GROUP BY 1) SELECT l_orderkey, l_linenumber, "
    + ", ".join(
        s6(f"({c} - mu_{c}) / CASE WHEN sd_{c} = 0 THEN 1 ELSE sd_{c} END", f"z_{c}")
        for c in v.MEASURES
    )
    + ", " + s6("l_quantity", "back") + " FROM lineitem JOIN s USING (l_returnflag)",
)
def scaler(spark, sf):
    """Standard scores per group, and one column scaled back."""
    lines = v.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", *v.MEASURES
    )
    facts = stats.scaler_stats(lines, v.MEASURES, ("l_returnflag",))
    joined = sq.join_per_key(lines, facts, ("l_returnflag",), "l_orderkey")
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        *[r6(stats.standardise(c)).alias(f"z_{c}") for c in v.MEASURES],
        r6(stats.unstandardise(stats.standardise("l_quantity"), "l_quantity")).alias("back"),
    )


def _pairs_sql(source: str, columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, " + s6(f'corr("{a}", "{b}")', "r") + f" FROM {source}"
        for i, a in enumerate(columns)
        for b in columns[i + 1 :]
    )


@query(
    "pearson_matrix",
    with_sql(
        v.READINGS, v.HOURLY,
        _pairs_sql("hourly", v.VARIABLES) + " UNION ALL " + _pairs_sql("lineitem", v.MEASURES),
    ),
)
def pearson_matrix(spark, sf):
    sparse = stats.pearson_matrix(v.hourly(spark, sf), v.VARIABLES)
    dense = stats.pearson_matrix(v.measures(spark, sf), v.MEASURES)
    return sparse.unionByName(dense).withColumn("r", r6("r"))


@query(
    "pearson_listwise",
    with_sql(
        v.READINGS, v.HOURLY,
        'complete AS (SELECT * FROM hourly WHERE "view" IS NOT NULL AND click IS NOT NULL '
        "AND error IS NOT NULL)",
        _pairs_sql("complete", ("view", "click", "error")),
    ),
)
def pearson_listwise(spark, sf):
    table = stats.pearson_listwise(v.hourly(spark, sf), ("view", "click", "error"))
    return table.withColumn("r", r6("r"))


_NUMERIC = ("l_partkey", "l_suppkey", "l_linenumber", *v.MEASURES)


@query(
    "top_variance",
    'SELECT "column", ' + s6("s", "std") + ", CAST(row_number() OVER (ORDER BY s DESC) AS INTEGER) "
    "AS rank FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", stddev_samp({c}) AS s FROM lineitem" for c in _NUMERIC
    ) + ") QUALIFY rank <= 5",
)
def top_variance(spark, sf):
    table = stats.top_variance(v.measures(spark, sf), _NUMERIC, 5)
    return table.withColumn("std", r6("std"))


def _importance(spark, sf):
    """Correlation with the price as a stand-in for importance."""
    others = [c for c in _NUMERIC if c != "l_extendedprice"]
    wide = v.measures(spark, sf).agg(*[F.corr(c, "l_extendedprice").alias(c) for c in others])
    return wide.unpivot([], others, "feature", "importance")


_IMPORTANCE = (
    "importance AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, corr({c}, l_extendedprice) AS importance FROM lineitem"
        for c in _NUMERIC
        if c != "l_extendedprice"
    )
    + ")"
)


@query(
    "importance_ranking",
    with_sql(_IMPORTANCE, "SELECT feature, " + s6("importance", "importance") + " FROM importance "
             "ORDER BY importance.importance DESC LIMIT 4"),
)
def importance_ranking(spark, sf):
    ranked = stats.importance_ranking(_importance(spark, sf), 4)
    return ranked.withColumn("importance", r6("importance"))


@query(
    "importance_share",
    with_sql(
        _IMPORTANCE,
        "ranked AS (SELECT *, row_number() OVER (ORDER BY importance DESC) AS rn FROM importance "
        "WHERE importance > 0)",
        "grouped AS (SELECT CASE WHEN rn <= 1 THEN feature END AS f, sum(importance) AS s, "
        "count(*) AS n FROM ranked GROUP BY 1)",
        "SELECT coalesce(f, 'Otros (' || n || ')') AS feature, " + s6("s", "importance") + ", "
        + s6("s / sum(s) OVER ()", "share") + " FROM grouped",
    ),
)
def importance_share(spark, sf):
    share = stats.importance_share(_importance(spark, sf), 1)
    return share.select("feature", r6("importance").alias("importance"), r6("share").alias("share"))


@query(
    "last_known",
    with_sql(
        v.USER_HOURLY,
        "SELECT user_id, " + s_ts("max(ts)", "last_ts") + ", CAST(month(max(ts)) AS INTEGER) AS last_month, "
        + ", ".join(
            f'arg_max_null("{c}", ts) AS row_{c}, arg_max("{c}", ts) AS known_{c}' for c in v.VARIABLES
        )
        + " FROM user_hourly GROUP BY user_id",
    ),
)
def last_known(spark, sf):
    table = stats.last_known(v.user_hourly(spark, sf), v.VARIABLES, USER)
    return table.withColumn("last_ts", ts_text("last_ts"))


# -- climatology and scenarios ---------------------------------------------------------


@query(
    "climatology",
    with_sql(
        v.READINGS, v.HOURLY,
        "long AS (" + " UNION ALL ".join(
            f"SELECT CAST(station AS VARCHAR) AS key, ts, '{c}' AS feature, \"{c}\" AS x FROM hourly"
            for c in v.VARIABLES
        ) + " UNION ALL SELECT o_orderpriority, o_orderdate, 'o_totalprice', o_totalprice FROM orders)",
        "SELECT key, feature, CAST(hour(ts) AS INTEGER) AS hour, CAST(month(ts) AS INTEGER) AS month, "
        + s6("avg(x)", "mean") + " FROM long GROUP BY ALL HAVING avg(x) IS NOT NULL",
    ),
)
def climatology(spark, sf):
    """Means by hour and month: hourly readings, and order values over all months."""
    hourly = v.hourly(spark, sf).withColumn("key", F.col("station").cast("string"))
    orders = v.table(spark, sf, "orders").withColumn("key", F.col("o_orderpriority"))
    by_hour = stats.climatology(hourly, v.VARIABLES, ("key",))
    by_month = stats.climatology(orders, ("o_totalprice",), ("key",), "o_orderdate")
    return by_hour.unionByName(by_month).withColumn("mean", r6("mean"))


@query(
    "climatology_lookup",
    with_sql(
        v.READINGS, v.HOURLY,
        'clim AS (SELECT station, hour(ts) AS h, month(ts) AS m, avg("view") AS "view", '
        "avg(error) AS error FROM hourly GROUP BY 1, 2, 3)",
        "SELECT arrival AS event_id, " + s6('clim."view"', "clim_view") + ", "
        + s6("clim.error", "clim_error")
        + " FROM readings r LEFT JOIN clim ON clim.station = r.station AND h = hour(r.ts + INTERVAL 5 HOUR) "
        "AND m = month(r.ts + INTERVAL 5 HOUR)",
    ),
)
def climatology_lookup(spark, sf):
    """The usual values five hours after each reading; none where the month is unknown."""
    wide = stats.climatology_wide(v.hourly(spark, sf), ("view", "error"))
    later = v.readings(spark, sf).withColumn("ts", F.expr("ts + interval 5 hours"))
    found = stats.lookup_climatology(later, wide, ("view", "error"))
    return found.select(
        F.col("arrival").alias("event_id"),
        r6("clim_view").alias("clim_view"),
        r6("clim_error").alias("clim_error"),
    )


@query(
    "lagged_lookup",
    with_sql(
        v.READINGS, v.HOURLY,
        'clim AS (SELECT station, hour(ts) AS h, month(ts) AS m, avg("view") AS x FROM hourly '
        "GROUP BY 1, 2, 3)",
        "SELECT arrival AS event_id, " + ", ".join(
            s6(f"coalesce(c{k}.x, 0)", f"view_lag_{k}h") for k in (1, 24)
        ) + " FROM readings r " + " ".join(
            f"LEFT JOIN clim c{k} ON c{k}.station = r.station AND c{k}.h = hour(r.ts - INTERVAL {k} HOUR) "
            f"AND c{k}.m = month(r.ts - INTERVAL {k} HOUR)"
            for k in (1, 24)
        ),
    ),
)
def lagged_lookup(spark, sf):
    """The usual value 1 and 24 hours before each reading, else 0."""
    wide = stats.climatology_wide(v.hourly(spark, sf), ("view",))
    found = stats.lookup_lagged(v.readings(spark, sf), wide, "view", (1, 24))
    return found.select(
        F.col("arrival").alias("event_id"),
        *[r6(f"view_lag_{k}h").alias(f"view_lag_{k}h") for k in (1, 24)],
    )


def _scenarios(spark, sf):
    readings = v.readings(spark, sf).withColumnRenamed("arrival", "event_id")
    return _with_weather(readings).withColumn("Precipitacion", F.col("value") % 5).drop(
        "value", "variable"
    )


_SCENARIOS = (
    "scenarios AS (SELECT arrival AS event_id, station, ts, " + _WEATHER_SQL
    + ", value % 5 AS Precipitacion FROM readings)"
)
SCENARIO_FEATURES = (
    *config.WEATHER, "hora_sin", "mes_cos", "temp_hum", "wind_u", "es_finde",
    "signup", "purchase", "error", "unknown",
)


@query(
    "assemble_scenarios",
    with_sql(
        v.READINGS, v.HOURLY, _SCENARIOS,
        "clim AS (SELECT station, hour(ts) AS h, month(ts) AS m, avg(signup) AS signup, "
        "avg(purchase) AS purchase FROM hourly GROUP BY 1, 2, 3)",
        "means AS (SELECT station, avg(signup) AS signup, avg(purchase) AS purchase, "
        "avg(error) AS error FROM hourly GROUP BY 1)",
        "SELECT event_id, " + ", ".join(s6(c, c) for c in config.WEATHER) + ", "
        + s6("sin(2 * pi() * hour(ts) / 24)", "hora_sin") + ", "
        + s6("cos(2 * pi() * month(ts) / 12)", "mes_cos") + ", "
        + s6("Temperatura * Humedad", "temp_hum") + ", "
        + s6("Viento_Velocidad * cos(radians(Viento_Direccion))", "wind_u") + ", "
        "CASE WHEN isodow(ts) >= 6 THEN 1.0::DOUBLE ELSE 0 END AS es_finde, "
        + s6("coalesce(c.signup, m.signup, 0)", "signup") + ", "
        + s6("coalesce(c.purchase, m.purchase, 0)", "purchase") + ", "
        + s6("coalesce(m.error, 0)", "error") + ", 0.0::DOUBLE AS unknown, "
        "CAST(c.signup IS NOT NULL AS INTEGER) + CAST(c.purchase IS NOT NULL AS INTEGER) AS n_lookup, "
        "14 - 5 - 2 - CAST(c.signup IS NOT NULL AS INTEGER) - CAST(c.purchase IS NOT NULL AS INTEGER) "
        "AS n_mean FROM scenarios s JOIN means m USING (station) LEFT JOIN clim c "
        "ON c.station = s.station AND c.h = hour(s.ts) AND c.m = month(s.ts)",
    ),
)
def assemble_scenarios(spark, sf):
    """Feature rows from weather, clock, climatology and means."""
    hourly = stored(v.hourly(spark, sf))
    wide = stats.climatology_wide(hourly, ("signup", "purchase"))
    means = hourly.groupBy("station").agg(
        *[F.avg(c).alias(c) for c in ("signup", "purchase", "error")]
    )
    rows = scoring.assemble_scenarios(
        _scenarios(spark, sf), SCENARIO_FEATURES, wide, means, spread="event_id"
    )
    return rows.select(
        "event_id", *[r6(c).alias(c) for c in SCENARIO_FEATURES], "n_lookup", "n_mean"
    )


@query(
    "assemble_last_known",
    with_sql(
        v.READINGS, v.HOURLY, _SCENARIOS,
        "last AS (SELECT station, arg_max_null(signup, ts) AS signup, arg_max(purchase, ts) AS purchase, "
        "month(max(ts)) AS m, avg(error) AS error FROM hourly GROUP BY 1)",
        "SELECT event_id, " + s6("Temperatura", "Temperatura") + ", "
        + s6("cos(2 * pi() * m / 12)", "mes_cos") + ", "
        + s6("coalesce(signup, 0)", "signup") + ", "
        + s6("coalesce(purchase, 0)", "purchase_lag_1h") + ", " + s6("coalesce(error, 0)", "error")
        + ", 0.0::DOUBLE AS unknown FROM scenarios JOIN last USING (station)",
    ),
)
def assemble_last_known(spark, sf):
    """Feature rows that carry the last row, or the last known lags, forward."""
    hourly = stored(v.hourly(spark, sf)).withColumnRenamed("purchase", "purchase_lag_1h")
    last = stats.last_known(hourly, ("signup", "purchase_lag_1h"))
    means = hourly.groupBy("station").agg(F.avg("error").alias("error"))
    scenarios = _scenarios(spark, sf)
    by_row = scoring.assemble_last_known(
        scenarios, ("Temperatura", "mes_cos", "signup", "unknown"), last, spread="event_id"
    )
    by_lag = scoring.assemble_last_known(
        scenarios, ("purchase_lag_1h", "error"), last, means, spread="event_id", source="known"
    )
    joined = by_row.select("event_id", "Temperatura", "mes_cos", "signup", "unknown").join(
        by_lag.select("event_id", "purchase_lag_1h", "error"), "event_id"
    )
    return joined.select(
        "event_id",
        *[
            r6(c).alias(c)
            for c in ("Temperatura", "mes_cos", "signup", "unknown", "purchase_lag_1h", "error")
        ],
    )


@query(
    "json_scenarios",
    "WITH means AS (SELECT user_id, avg(value) AS z FROM events GROUP BY 1) "
    "SELECT event_id, CAST(regexp_extract(props, '\"k\": *([0-9.]+)', 1) AS DOUBLE) AS k, "
    + s6("z", "z") + " FROM events JOIN means USING (user_id)",
)
def json_scenarios(spark, sf):
    """Features out of JSON; the key that is never there becomes the mean."""
    events = v.table(spark, sf, "events").select("event_id", "user_id", "value", "props")
    means = events.groupBy("user_id").agg(F.avg("value").alias("z"), F.avg("value").alias("k"))
    rows = scoring.scenario_from_json(events, "props", ("k", "z"), means, USER, "event_id")
    return rows.select("event_id", "k", r6("z").alias("z"))


@query(
    "extrapolation",
    with_sql(
        v.SERIES, _POS,
        "roles AS (SELECT *, pos <= floor(n * 0.8::DOUBLE) AS train FROM pos)",
        "ends AS (SELECT user_id, max(ts) AS last FROM roles WHERE train GROUP BY 1)",
        "SELECT user_id, " + s_ts("ts", "ts") + ", " + s6("epoch(ts - last) / 3600", "hours_past")
        + ", epoch(ts - last) / 3600 > 48 AS extrapolated FROM roles JOIN ends USING (user_id) "
        "WHERE NOT train",
    ),
)
def extrapolation(spark, sf):
    """How far test rows lie past the training rows."""
    split = splits.chronological_split(stored(v.series(spark, sf)), USER, inner_ratio=None)
    ends = split.filter("role = 'train'").groupBy("user_id").agg(F.max("ts").alias("last_train_ts"))
    rows = scoring.extrapolation(split.filter("role = 'test'"), ends, USER)
    return rows.select(
        "user_id", ts_text("ts").alias("ts"), r6("hours_past").alias("hours_past"), "extrapolated"
    )


# -- clock, wind, index ----------------------------------------------------------------


@query(
    "cyclic_features",
    "SELECT event_id, " + ", ".join(
        [
            s6("sin(2 * pi() * hour(ts) / 24)", "hora_sin"),
            s6("cos(2 * pi() * hour(ts) / 24)", "hora_cos"),
            s6("sin(2 * pi() * month(ts) / 12)", "mes_sin"),
            s6("cos(2 * pi() * month(ts) / 12)", "mes_cos"),
            s6("sin(2 * pi() * (hour(ts) + minute(ts) / 60.0::DOUBLE) / 24)", "minute_sin"),
            s6("cos(2 * pi() * (hour(ts) + minute(ts) / 60.0::DOUBLE) / 24)", "minute_cos"),
        ]
    ) + f", {_WEEKDAY_SQL} FROM events",
)
def cyclic_features(spark, sf):
    ts = F.col("ts")
    fine = moments.cyclic_columns(ts, minutes=True)
    columns = {
        **moments.cyclic_columns(ts),
        "minute_sin": fine["hora_sin"],
        "minute_cos": fine["hora_cos"],
        **moments.weekday_columns(ts),
    }
    exact = ("dia_semana", "es_finde")
    return v.table(spark, sf, "events").select(
        "event_id", *[(c if n in exact else r6(c)).alias(n) for n, c in columns.items()]
    )


@query(
    "wind_features",
    "WITH w AS (SELECT l_orderkey, l_linenumber, l_quantity AS Viento_Velocidad, "
    "l_extendedprice % 360 AS Viento_Direccion, l_tax * 100 AS Temperatura, "
    f"l_discount * 100 AS Humedad FROM lineitem) SELECT l_orderkey, l_linenumber, {_WIND_SQL} FROM w",
)
def wind_features(spark, sf):
    named = v.measures(spark, sf).select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").alias("Viento_Velocidad"),
        (F.col("l_extendedprice") % 360).alias("Viento_Direccion"),
        (F.col("l_tax") * 100).alias("Temperatura"),
        (F.col("l_discount") * 100).alias("Humedad"),
    )
    derived = fe.derived_columns(named.columns, None)
    return named.select(
        "l_orderkey", "l_linenumber", *[r6(c).alias(n) for n, c in derived.items()]
    )


# The pollutant each event type stands for; the last has no index table.
POLLUTANT_OF = {"view": "PM25", "click": "PM10", "purchase": "O3", "signup": "CO", "error": "NO"}
_NAMED = (
    "named AS (SELECT event_id, value, CASE event_type "
    + " ".join(f"WHEN '{k}' THEN '{p}'" for k, p in POLLUTANT_OF.items())
    + " END AS pollutant FROM events)"
)
_SEGMENTS = (
    "seg(pollutant, c_lo, c_hi, i_lo, i_hi) AS (VALUES "
    + ", ".join(
        f"('{p}', {c_lo}::DOUBLE, {c_hi}::DOUBLE, {i_lo}, {i_hi})"
        for p, parts in config.INDEX_SEGMENTS.items()
        for c_lo, c_hi, i_lo, i_hi in parts
    )
    + ")"
)


def _index_sql(value: str, pollutant: str) -> str:
    return (
        f"(SELECT CASE WHEN {value} IS NULL OR count(*) = 0 THEN NULL "
        f"WHEN {value} > max(c_hi) THEN 500.0 ELSE coalesce(max(CASE WHEN {value} BETWEEN c_lo AND c_hi "
        f"THEN i_lo + ({value} - c_lo) * (i_hi - i_lo) / (c_hi - c_lo) END), 0.0) END "
        f"FROM seg WHERE seg.pollutant = {pollutant})"
    )


def _category_sql(index: str) -> str:
    return (
        f"CASE WHEN {index} IS NULL THEN NULL "
        + " ".join(
            f"WHEN {index} BETWEEN {lo} AND {hi} THEN '{name}'"
            for lo, hi, name, _ in config.INDEX_CATEGORIES
        )
        + " ELSE 'Emergencia' END"
    )


def _pollutants(spark, sf):
    pairs = F.create_map(*[F.lit(x) for pair in POLLUTANT_OF.items() for x in pair])
    return v.table(spark, sf, "events").select(
        "event_id", "value", pairs[F.col("event_type")].alias("pollutant")
    )


_INDEXED = f"indexed AS (SELECT *, {_index_sql('named.value', 'named.pollutant')} AS i FROM named)"


@query(
    "air_index_category",
    with_sql(
        _NAMED, _SEGMENTS, _INDEXED,
        "SELECT event_id, " + s6("i", "air_index") + f", {_category_sql('i')} AS category, "
        + s6("CASE WHEN i IS NULL THEN 0 ELSE greatest(0, least(500, i)) / 5 END", "pointer")
        + " FROM indexed",
    ),
)
def air_index_category(spark, sf):
    index = F.col("air_index")
    indexed = _pollutants(spark, sf).withColumn(
        "air_index", labels.air_index(F.col("pollutant"), F.col("value"))
    )
    return indexed.select(
        "event_id",
        r6(index).alias("air_index"),
        labels.air_category(index).alias("category"),
        r6(labels.gauge_pointer(index)).alias("pointer"),
    )


@query(
    "breakpoint_join",
    with_sql(_NAMED, _SEGMENTS, _INDEXED, "SELECT event_id, " + s6("i", "air_index") + " FROM indexed"),
)
def breakpoint_join(spark, sf):
    """The same index by a range join with the segment table."""
    indexed = al.index_by_range(_pollutants(spark, sf), "pollutant", "value")
    return indexed.select("event_id", r6("air_index").alias("air_index"))


def _continuous_sql(value: str, pollutant: str) -> str:
    arms = []
    for name, steps in config.CONTINUOUS_BOUNDS.items():
        inner, c_prev, i_prev = "", 0.0, 0
        for c_hi, i_hi in steps:
            inner += (
                f" WHEN {value} <= {c_hi} THEN {i_prev} + ({value} - {c_prev}::DOUBLE) "
                f"* {i_hi - i_prev} / ({c_hi}::DOUBLE - {c_prev}::DOUBLE)"
            )
            c_prev, i_prev = c_hi, i_hi
        arms.append(f"WHEN '{name}' THEN CASE{inner} ELSE 500.0 END")
    return f"CASE {pollutant} {' '.join(arms)} END"


@query(
    "air_index_continuous",
    with_sql(
        _NAMED,
        f"indexed AS (SELECT *, {_continuous_sql('value', 'pollutant')} AS i FROM named)",
        "SELECT event_id, " + s6("i", "air_index") + ", CASE WHEN i <= 50 THEN '🟢 Deseable' "
        "WHEN i <= 100 THEN '🟡 Aceptable' WHEN i <= 150 THEN '🟠 Precaución' "
        "WHEN i <= 200 THEN '🔴 Alerta' WHEN i <= 300 THEN '🟣 Alarma' "
        "WHEN i > 300 THEN '🟤 Emergencia' END AS category FROM indexed",
    ),
)
def air_index_continuous(spark, sf):
    index = F.col("air_index")
    indexed = _pollutants(spark, sf).withColumn(
        "air_index", labels.air_index_continuous(F.col("pollutant"), F.col("value"))
    )
    return indexed.select(
        "event_id", r6(index).alias("air_index"),
        labels.air_category_continuous(index).alias("category"),
    )


def _ladder_sql(value: str, pollutant: str, table, unknown: str) -> str:
    arms = []
    for name, steps in table.items():
        inner = " ".join(
            f"WHEN {value} <= {bound} THEN '{label}'" for bound, label in steps if bound is not None
        )
        arms.append(f"WHEN '{name}' THEN CASE {inner} ELSE '{steps[-1][1]}' END")
    return f"CASE {pollutant} {' '.join(arms)} ELSE '{unknown}' END"


@query(
    "aqi_labels",
    with_sql(
        _NAMED,
        "SELECT event_id, "
        + _ladder_sql("value", "pollutant", config.AQI_LABELS, config.AQI_UNKNOWN)
        + " AS label, "
        + _ladder_sql("value", "pollutant", config.AQI_ICONS, config.ICON_UNKNOWN)
        + " AS icon, CASE WHEN value <= 12 THEN '🟢 Buena' WHEN value <= 35 THEN '🟡 Moderada' "
        "WHEN value <= 55 THEN '🟠 Insalubre GS' WHEN value <= 150 THEN '🔴 Insalubre' "
        "ELSE '🟣 Muy insalubre' END AS quality, "
        "CASE WHEN pollutant = 'CO' THEN 'mg/m³' ELSE 'µg/m³' END AS unit FROM named",
    ),
)
def aqi_labels(spark, sf):
    pollutant, value = F.col("pollutant"), F.col("value")
    return _pollutants(spark, sf).select(
        "event_id",
        labels.aqi_label(pollutant, value).alias("label"),
        labels.aqi_icon(pollutant, value).alias("icon"),
        labels.pm25_quality(value).alias("quality"),
        labels.unit_of(pollutant).alias("unit"),
    )


COLUMN_POLLUTANTS = {"view": "PM25", "click": "PM10", "purchase": "O3"}


@query(
    "global_index",
    with_sql(
        v.USER_HOURLY, _SEGMENTS,
        "scored AS (SELECT user_id, ts, greatest("
        + ", ".join(_index_sql(f'u."{c}"', f"'{p}'") for c, p in COLUMN_POLLUTANTS.items())
        + ") AS i FROM user_hourly u)",
        "SELECT user_id, " + s_ts("ts", "ts") + ", " + s6("i", "air_index")
        + f", {_category_sql('i')} AS category FROM scored",
    ),
)
def global_index(spark, sf):
    """The worst index of each hour."""
    indexed = al.global_index(v.user_hourly(spark, sf), COLUMN_POLLUTANTS)
    return indexed.select(
        "user_id", ts_text("ts").alias("ts"), r6("air_index").alias("air_index"),
        labels.air_category(F.col("air_index")).alias("category"),
    )


@query(
    "mean_index_gauge",
    with_sql(
        v.READINGS, v.HOURLY, _SEGMENTS,
        "means AS (" + " UNION ALL ".join(
            f"SELECT '{c}' AS variable, '{p}' AS pollutant, avg(\"{c}\") AS mean FROM hourly"
            for c, p in COLUMN_POLLUTANTS.items()
        ) + ")",
        f"indexed AS (SELECT *, {_index_sql('means.mean', 'means.pollutant')} AS i FROM means)",
        "SELECT variable, " + s6("mean", "mean") + ", " + s6("i", "air_index")
        + f", {_category_sql('i')} AS category, " + s6("greatest(0, least(500, i)) / 5", "pointer")
        + " FROM indexed",
    ),
)
def mean_index_gauge(spark, sf):
    gauge = stats.mean_index_gauge(v.hourly(spark, sf), COLUMN_POLLUTANTS)
    return gauge.select(
        "variable", "category", *[r6(c).alias(c) for c in ("mean", "air_index", "pointer")]
    )


@query(
    "geo_mean",
    with_sql(
        _SEGMENTS,
        "accounts AS (SELECT s_nationkey AS k, s_acctbal AS x FROM supplier UNION ALL "
        "SELECT c_nationkey, c_acctbal FROM customer)",
        "means AS (SELECT n_name, avg(x) / 20 AS mean FROM accounts JOIN nation ON n_nationkey = k GROUP BY 1)",
        f"indexed AS (SELECT *, {_index_sql('means.mean', chr(39) + 'PM25' + chr(39))} AS i FROM means)",
        "SELECT n_name, " + s6("mean", "mean") + ", " + s6("i", "air_index")
        + f", {_category_sql('i')} AS category FROM indexed",
    ),
)
def geo_mean(spark, sf):
    """Mean account balance per nation, on the index scale."""

    def part(table, prefix):
        return v.table(spark, sf, table).select(
            F.col(f"{prefix}_nationkey").alias("n_nationkey"),
            (F.col(f"{prefix}_acctbal") / 20).alias("x"),
        )

    accounts = part("supplier", "s").unionByName(part("customer", "c"))
    places = accounts.join(v.table(spark, sf, "nation"), "n_nationkey")
    means = stats.geo_mean(places, ("n_name",), "x", "PM25")
    return means.select(
        "n_name", "category", r6("mean").alias("mean"), r6("air_index").alias("air_index")
    )


@query(
    "clip_predictions",
    "SELECT l_orderkey, l_linenumber, greatest(0.0, l_quantity - 25) AS clipped FROM lineitem",
)
def clip_predictions(spark, sf):
    return v.measures(spark, sf).select(
        "l_orderkey", "l_linenumber",
        labels.clip_non_negative(F.col("l_quantity") - 25).alias("clipped"),
    )
