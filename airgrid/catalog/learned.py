"""Queries that fit a model on the given tables.

The booster's settings are the defaults, but for the number of rounds: ``ROUNDS`` bounds what
one machine spends on them (each round is a handful of Spark jobs). Scores have no SQL twin;
which rows are fitted, folded, explained and scored has, in the ``_rows`` queries.

Queries of one session share what they fit.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from airgrid import config
from airgrid.catalog import views as v
from airgrid.catalog.modelling_tables import _SCENARIOS as SCENARIOS_SQL
from airgrid.catalog.modelling_tables import USER, _scenarios, _with_weather
from airgrid.catalog.registry import once, query, r6, s6, s_ts, ts_text, with_sql
from airgrid.functions import moments
from airgrid.models import boosted, importance, shap
from airgrid.operators import features as fe
from airgrid.operators import fills, metrics, quality, schema, splits, stats
from airgrid.plans import scoring
from airgrid.session import stored

ROUNDS = 100
PARAMS = boosted.BoostParams(rounds=ROUNDS)
TARGET = "value"
IDS = ("user_id", "ts")


def _features(spark, sf):
    return stored(fe.build_features(_with_weather(stored(v.series(spark, sf))), [TARGET], USER))


def _columns(df):
    return [c for c in schema.numeric_columns(df) if c not in (TARGET, "user_id")]


def _fit(spark, sf):
    """A model on the fit rows, and all rows with vector, label and role."""
    full = _features(spark, sf)
    columns = _columns(full)
    split = splits.chronological_split(full, USER)
    rows = stored(
        boosted.assemble(split, columns, TARGET).select("user_id", "ts", "role", boosted.VECTOR, boosted.LABEL), "fitted"
    )
    model = boosted.fit_boosted(rows.filter("role = 'fit'"), rows.filter("role = 'val'"), PARAMS)
    return model, rows, columns


_fitted = once("fitted", _fit)


def _wide(spark, sf):
    """All event types of a station's hours, gaps filled, with the features of each of them."""
    hourly = fills.impute_temporal(v.hourly(spark, sf), v.VARIABLES)
    timed = _with_weather(hourly.withColumn(TARGET, F.col("view"))).drop(TARGET)
    return stored(fe.build_features(stored(timed), v.VARIABLES))


@query("select_features")
def select_features(spark, sf):
    """Forest importance of the features of all event types; the forty best are selected."""
    full = _wide(spark, sf)
    split = splits.chronological_split(full, inner_ratio=None).filter("role = 'train'")
    columns = [c for c in schema.numeric_columns(full) if c not in ("view", "station")]
    _, table = boosted.select_features(stored(split), columns, "view")
    return table


@query("train_boosted")
def train_boosted(spark, sf):
    """Scores of a boosted model on its fit, validation and test rows."""
    fitted, rows, _ = _fitted(spark, sf)
    predicted = boosted.predict(fitted.model, rows)
    return metrics.regression_metrics(predicted, ("role",), boosted.LABEL, boosted.PREDICTION)


BUILT = (
    "built AS (SELECT *, row_number() OVER w AS k, lag(value, 24) OVER w AS before FROM series "
    "WINDOW w AS (PARTITION BY user_id ORDER BY ts)), "
    "complete AS (SELECT user_id, ts, value, row_number() OVER w AS pos, count(*) OVER (PARTITION BY user_id) AS n "
    "FROM built WHERE value IS NOT NULL AND before IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts)), "
    "part AS (SELECT *, CASE WHEN pos <= floor(floor(n * 0.8::DOUBLE) * 0.8::DOUBLE) THEN 'fit' "
    "WHEN pos <= floor(n * 0.8::DOUBLE) THEN 'val' ELSE 'test' END AS role FROM complete)"
)


@query(
    "train_boosted_rows",
    with_sql(v.SERIES, BUILT, "SELECT role, count(*) AS n, true AS better_than_mean FROM part GROUP BY role"),
)
def train_boosted_rows(spark, sf):
    """Rows the model was fitted, stopped and tested on, and whether it beats their mean."""
    fitted, rows, _ = _fitted(spark, sf)
    scores = metrics.regression_metrics(boosted.predict(fitted.model, rows), ("role",), boosted.LABEL, boosted.PREDICTION)
    return scores.select("role", "n", (F.col("r2") > 0).alias("better_than_mean"))


def _validate(spark, sf):
    full = _hours(spark, sf)
    columns = [c for c in schema.numeric_columns(full) if c not in (*v.VARIABLES, "station")]
    features = {t: columns for t in v.VARIABLES}
    return boosted.cross_validate(full, (*v.VARIABLES, "refund"), features, params=PARAMS)


def _hours(spark, sf):
    """Stations' hours as they are, with clock and weather features."""
    weather = _with_weather(v.hourly(spark, sf).withColumn(TARGET, F.coalesce(*v.VARIABLES))).drop(TARGET)
    timed = weather.withColumns(fe.derived_columns(weather.columns, F.col("ts"))).withColumns(
        moments.cyclic_columns(F.col("ts"))
    )
    return stored(timed)


_validated = once("validated", _validate)


@query("cross_validate")
def cross_validate(spark, sf):
    """Scores per event type and chronological fold; a type that is no column has its rows, too."""
    return _validated(spark, sf).folds


def _fold_sql(keys: str, folds: int, source: str) -> str:
    """Rows of each validation block: n // (folds + 1) of every series."""
    types = ", ".join(f"('{t}')" for t in v.VARIABLES)
    counted = " UNION ALL ".join(
        f"SELECT '{t}' AS target, {keys}, count(\"{t}\") AS n FROM {source} GROUP BY {keys}" for t in v.VARIABLES
    )
    return (
        f"counted AS ({counted}), blocks AS (SELECT target, sum(n) AS total, sum(n // {folds + 1}) AS n FROM counted "
        f"GROUP BY target), names AS (SELECT * FROM (VALUES {types}) AS t(target))"
    )


@query(
    "cross_validate_rows",
    with_sql(
        v.READINGS, v.HOURLY, _fold_sql("station", 5, "hourly"),
        "SELECT target, CAST(fold AS INTEGER) AS fold, CASE WHEN total < 100 THEN 0 ELSE n END::BIGINT AS n, "
        "CASE WHEN total < 100 THEN 'too_few_rows' ELSE 'ok' END AS status FROM blocks, "
        "(SELECT unnest(range(1, 6)) AS fold) UNION ALL "
        "SELECT 'refund', CAST(unnest(range(1, 6)) AS INTEGER), 0::BIGINT, 'absent'",
    ),
)
def cross_validate_rows(spark, sf):
    """Validation rows and status of every fold."""
    return _validated(spark, sf).folds.select("target", "fold", "n", "status")


def _several(spark, sf):
    full = _hours(spark, sf)
    columns = [c for c in schema.numeric_columns(full) if c not in (*v.VARIABLES, "station")]
    split = splits.chronological_split(full, inner_ratio=None)
    train = stored(split.filter("role = 'train'"))
    return boosted.fit_multi_target(train, columns, v.VARIABLES, params=PARAMS)


_multi = once("multi", _several)


@query("multi_target")
def multi_target(spark, sf):
    """One model per event type on the same rows; missing targets become means."""
    result = _multi(spark, sf)
    return result.cross_validated.folds.withColumn("final_rounds", F.lit(result.rounds))


@query(
    "multi_target_rows",
    with_sql(
        v.READINGS, v.HOURLY,
        "placed AS (SELECT *, row_number() OVER (PARTITION BY station ORDER BY ts) AS pos, "
        "count(*) OVER (PARTITION BY station) AS m FROM hourly), "
        "train AS (SELECT * FROM placed WHERE pos <= floor(m * 0.8::DOUBLE))",
        _fold_sql("station", 5, "train"),
        "SELECT target, CAST(fold AS INTEGER) AS fold, n::BIGINT AS n, 'ok' AS status, true AS fitted FROM blocks, "
        "(SELECT unnest(range(1, 6)) AS fold)",
    ),
)
def multi_target_rows(spark, sf):
    """Validation rows and status of every fold, and whether the final model is as long as all others."""
    result = _multi(spark, sf)
    whole = [t for t, m in result.models.items() if m.rounds == result.rounds]
    folds = result.cross_validated.folds.select("target", "fold", "n", "status")
    return folds.withColumn("fitted", F.col("target").isin(whole))


@query("learning_curve")
def learning_curve(spark, sf):
    """Error after each boosting round on fit and validation rows."""
    fitted, _, _ = _fitted(spark, sf)
    rows = [
        (TARGET, split, i, score)
        for split, curve in (("train", fitted.train_curve), ("val", fitted.val_curve))
        for i, score in enumerate(curve)
    ]
    return spark.createDataFrame(rows, "target string, split string, iter int, score double")


@query("permutation_importance")
def permutation_importance(spark, sf):
    """Drop in R2 per shuffled feature on the test rows, eight times each."""
    fitted, rows, columns = _fitted(spark, sf)
    test = rows.filter("role = 'test'")
    return importance.permutation_importance(fitted.model, test, columns, IDS)


@query("permutation_importance_mse")
def permutation_importance_mse(spark, sf):
    """Rise in squared error per shuffled feature on all test rows, four times each."""
    fitted, rows, columns = _fitted(spark, sf)
    test = rows.filter("role = 'test'")
    return importance.permutation_importance(fitted.model, test, columns, IDS, repeats=4, score="mse")


def _explain(spark, sf):
    fitted, rows, columns = _fitted(spark, sf)
    return stored(shap.tree_shap(fitted.model, rows.filter("role = 'test'"), columns, IDS), "explained")


_explained = once("explained", _explain)


@query("tree_shap")
def tree_shap(spark, sf):
    """What each feature adds to the prediction of each test row."""
    return _explained(spark, sf).select(
        "user_id", ts_text("ts").alias("ts"), "feature", "phi", "base"
    )


@query(
    "tree_shap_rows",
    with_sql(
        v.SERIES, BUILT,
        "SELECT user_id, " + s_ts("ts", "ts") + ", 24::BIGINT AS n_features, true AS adds_up FROM part WHERE role = 'test'",
    ),
)
def tree_shap_rows(spark, sf):
    """The explained rows, and whether base and values add up to the prediction."""
    fitted, rows, _ = _fitted(spark, sf)
    sums = _explained(spark, sf).groupBy(*IDS).agg(
        F.count(F.lit(1)).alias("n_features"), (F.first("base") + F.sum("phi")).alias("total")
    )
    predicted = boosted.predict(fitted.model, rows.filter("role = 'test'")).select(*IDS, boosted.PREDICTION)
    near = F.abs(F.col("total") - F.col(boosted.PREDICTION)) < 1e-6
    return predicted.join(sums, list(IDS)).select(
        "user_id", ts_text("ts").alias("ts"), "n_features", near.alias("adds_up")
    )


@query("shap_global")
def shap_global(spark, sf):
    """Mean absolute contribution per feature."""
    return shap.shap_global(_explained(spark, sf))


@query("first_prediction")
def first_prediction(spark, sf):
    """The contributions for the first row alone."""
    values = shap.first_explained(_explained(spark, sf), IDS)
    return values.select("feature", "phi", "base")


def _recent(spark, sf):
    fitted, rows, _ = _fitted(spark, sf)
    predicted = boosted.predict(fitted.model, rows.filter("role = 'test'"))
    return quality.last_days(predicted, USER, config.PLOT_DAYS)


@query("real_vs_predicted")
def real_vs_predicted(spark, sf):
    """Observed and predicted values of each series' last seven test days."""
    return _recent(spark, sf).select(
        "user_id", ts_text("ts").alias("ts"), F.col("label").alias("real"), "prediction"
    )


@query(
    "real_vs_predicted_rows",
    with_sql(
        v.SERIES, BUILT,
        "SELECT user_id, " + s_ts("ts", "ts") + ", value AS real, true AS predicted FROM "
        "(SELECT *, max(ts) OVER (PARTITION BY user_id) AS last FROM part WHERE role = 'test') "
        "WHERE ts >= last - INTERVAL 7 DAY",
    ),
)
def real_vs_predicted_rows(spark, sf):
    """The same rows, and whether each has a prediction."""
    return _recent(spark, sf).select(
        "user_id", ts_text("ts").alias("ts"), F.col("label").alias("real"),
        F.col("prediction").isNotNull().alias("predicted"),
    )


SCENARIO_COLUMNS = (*config.WEATHER, "hora_sin", "hora_cos", "es_finde", "click", "error")


@query("score_scenarios")
def score_scenarios(spark, sf):
    """Predictions, index and category for weather scenarios, one per event."""
    hourly = stored(v.hourly(spark, sf).filter(F.col("view").isNotNull()))
    weather = _with_weather(hourly.withColumn("value", F.col("view"))).withColumn(
        "Precipitacion", F.col("view") % 5
    )
    ts = F.col("ts")
    timed = weather.withColumns({**moments.cyclic_columns(ts), **moments.weekday_columns(ts)})
    lookups = ("click", "error")
    climatology = stats.climatology_wide(hourly, lookups)
    means = hourly.groupBy("station").agg(*[F.avg(c).alias(c) for c in lookups])
    training = timed.fillna(0.0, list(lookups))
    rows = boosted.assemble(training, SCENARIO_COLUMNS, "view")
    split = stored(splits.chronological_split(rows.select("station", "ts", boosted.VECTOR, boosted.LABEL)))
    fitted = boosted.fit_boosted(split.filter("role = 'fit'"), split.filter("role = 'val'"), PARAMS)
    assembled = scoring.assemble_scenarios(
        _scenarios(spark, sf), SCENARIO_COLUMNS, climatology, means, spread="event_id"
    )
    vectors = boosted.assemble(assembled.withColumn("__y", F.lit(0.0)), SCENARIO_COLUMNS, "__y")
    scored = scoring.with_index(boosted.predict(fitted.model, vectors), "PM25")
    return scored.select(
        "event_id", "station", r6("prediction").alias("prediction"),
        r6("air_index").alias("air_index"), "category", "n_lookup",
    )


LAGS = ("purchase_lag_1h", "purchase_lag_24h", "signup_lag_24h")
MULTI_COLUMNS = (*config.WEATHER, "hora_sin", "hora_cos", "mes_sin", "mes_cos", "es_finde", "error", *LAGS)
MULTI = {"PM25": "view", "CO": "click"}


def _multi_scoring(spark, sf):
    """Models of two pollutants on weather, clock and lags, through the scoring job."""
    hourly = stored(v.hourly(spark, sf))
    filled = fills.impute_temporal(hourly, ("purchase", "signup", "error"))
    lagged = fe.add_lags(fe.add_lags(filled, "purchase", (1, 24)), "signup", (24,))
    weather = _with_weather(lagged.withColumn(TARGET, F.coalesce(*v.VARIABLES))).withColumn(
        "Precipitacion", F.col(TARGET) % 5
    )
    ts = F.col("ts")
    timed = weather.withColumns({**moments.cyclic_columns(ts), **moments.weekday_columns(ts)})
    split = stored(splits.chronological_split(timed))
    fitted = boosted.fit_together(split, MULTI_COLUMNS, tuple(MULTI.values()), ("station", "ts"), PARAMS)
    trained = split.where("role <> 'test'")
    bases = ("purchase", "signup", "error")
    scored = scoring.score_scenarios(
        _scenarios(spark, sf),
        {p: fitted[t].model for p, t in MULTI.items()},
        MULTI_COLUMNS,
        stats.climatology_wide(hourly, bases),
        hourly.groupBy("station").agg(*[F.avg(c).alias(c) for c in bases]),
        trained.groupBy("station").agg(F.max("ts").alias("last_train_ts")),
        spread="event_id",
    )
    return stored(scored, "score_multi")


_scored = once("score_multi", _multi_scoring)


@query("score_multi")
def score_multi(spark, sf):
    """Predictions, indexes, icons and units of two pollutants and the global index, one row per event."""
    scored = _scored(spark, sf)
    own = [c for p in MULTI for c in (f"pred_{p}", f"index_{p}", f"category_{p}", f"icon_{p}", f"unit_{p}")]
    return scored.select("event_id", *own, "air_index", "category", "n_lookup", "n_mean", "hours_past", "extrapolated")


def _lag_sql(name: str) -> str:
    base, hours = name.split("_lag_")
    return (
        f"LEFT JOIN clim {name} ON {name}.station = s.station AND {name}.h = hour(s.ts - INTERVAL {hours[:-1]} HOUR) "
        f"AND {name}.m = month(s.ts - INTERVAL {hours[:-1]} HOUR)"
    )


@query(
    "score_multi_rows",
    with_sql(
        v.READINGS, v.HOURLY, SCENARIOS_SQL,
        "clim AS (SELECT station, hour(ts) AS h, month(ts) AS m, avg(purchase) AS purchase, avg(signup) AS signup, "
        "avg(error) AS error FROM hourly GROUP BY 1, 2, 3)",
        "means AS (SELECT station, avg(purchase) AS purchase, avg(signup) AS signup, avg(error) AS error "
        "FROM hourly GROUP BY 1)",
        "placed AS (SELECT station, ts, row_number() OVER (PARTITION BY station ORDER BY ts) AS pos, "
        "count(*) OVER (PARTITION BY station) AS m FROM hourly)",
        "ends AS (SELECT station, max(ts) AS last FROM placed WHERE pos <= floor(m * 0.8::DOUBLE) GROUP BY 1)",
        "SELECT event_id, "
        + ", ".join(s6(f"coalesce({n}.{n.split('_')[0]}, m.{n.split('_')[0]}, 0)", n) for n in LAGS) + ", "
        + s6("coalesce(c.error, m.error, 0)", "error") + ", CAST("
        + " + ".join([f"CAST({n}.{n.split('_')[0]} IS NOT NULL AS INTEGER)" for n in LAGS] + ["CAST(c.error IS NOT NULL AS INTEGER)"])
        + " AS INTEGER) AS n_lookup, " + s6("epoch(s.ts - ends.last) / 3600", "hours_past")
        + ", epoch(s.ts - ends.last) / 3600 > 48 AS extrapolated, true AS highest, true AS labelled FROM scenarios s "
        "JOIN means m USING (station) JOIN ends USING (station) "
        "LEFT JOIN clim c ON c.station = s.station AND c.h = hour(s.ts) AND c.m = month(s.ts) "
        + " ".join(map(_lag_sql, LAGS)),
    ),
)
def score_multi_rows(spark, sf):
    """The looked-up features, what was looked up, how far past the training data; whether the
    global index is the highest one and every row has its labels."""
    scored = _scored(spark, sf)
    highest = F.col("air_index") == F.greatest(*[F.col(f"index_{p}") for p in MULTI])
    labelled = F.lit(True)
    for p in MULTI:
        labelled &= F.col(f"icon_{p}").isNotNull() & F.col(f"unit_{p}").isNotNull() & (F.col(f"category_{p}") != "N/D")
    return scored.select(
        "event_id", *[r6(c).alias(c) for c in (*LAGS, "error")], F.col("n_lookup").cast("int").alias("n_lookup"),
        r6("hours_past").alias("hours_past"), "extrapolated", highest.alias("highest"), labelled.alias("labelled"),
    )
