"""Feature rows for scenarios, and their predictions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airgrid import config
from airgrid.functions import labels, moments
from airgrid.functions.text import lag_parts
from airgrid.models.trees import TreeModel, predict_all
from airgrid.operators import sequence, stats
from airgrid.operators.features import DIRECTION, HUMIDITY, SPEED, TEMPERATURE


def _given(ts: Column, features: Sequence[str], month: Column | None = None) -> dict[str, Column]:
    """What a scenario itself tells: weather, clock, and what follows from them."""
    given = {name: F.col(name) for name in config.WEATHER}
    given.update(moments.cyclic_columns(ts))
    if month is not None:
        sine, cosine = moments.on_circle(month.cast("double"), 12)
        given.update({"mes_sin": sine, "mes_cos": cosine})
    given.update(
        moments.interaction_columns(F.col(TEMPERATURE), F.col(HUMIDITY), F.col(SPEED))
    )
    given.update(moments.wind_columns(F.col(SPEED), F.col(DIRECTION)))
    given.update(moments.weekday_columns(ts))
    return {name: column.cast("double") for name, column in given.items() if name in features}


def lag_features(features: Sequence[str], bases: Sequence[str]) -> list[tuple[str, str, int]]:
    """(name, base, hours) of the features named as lags of one of the bases."""
    parts = [(c, lag_parts(c)) for c in features]
    return [(c, *found) for c, found in parts if found and found[0] in bases]


CLOCK = ("hora_sin", "hora_cos", "mes_sin", "mes_cos")


def assemble_scenarios(
    scenarios: DataFrame,
    features: Sequence[str],
    climatology: DataFrame,
    means: DataFrame,
    keys: Sequence[str] = ("station",),
    ts: str = "ts",
    spread: str = "scenario_id",
    resolve_lags: bool = False,
) -> DataFrame:
    """The feature row of each scenario, with how much of it was looked up.

    Each feature comes from the first source that has it: weather, clock, derived,
    climatology at the hour and month, training mean, 0. ``climatology`` is the wide
    table, ``means`` has one column per feature and one row per key. ``n_lookup``
    counts all features the climatology knows at that hour and month, also those
    taken from the scenario; ``n_mean`` is what is left, never below 0.

    With ``resolve_lags`` a feature named like ``X_lag_24h`` is the climatology of X at the
    hour and month of 24 hours before, else the training mean of X; those found count as looked up.
    """
    lags = lag_features(features, climatology.columns) if resolve_lags else []
    lagged = {name: base for name, base, _ in lags}
    known = [c for c in features if c in climatology.columns and c not in lagged]
    averaged = [c for c in dict.fromkeys([*features, *lagged.values()]) if c in means.columns]
    found = stats.lookup_climatology(scenarios, climatology, known, keys, ts, "clim_")
    if lags:
        found = stats.lookup_lags(found, climatology, lags, keys, ts, "clim_")
    facts = means.select(*keys, *[F.col(c).alias(f"mean_{c}") for c in averaged])
    found = sequence.join_per_key(found, facts, keys, spread)
    given = _given(F.col(ts), features)
    row = {}
    for c in features:
        if c in given:
            row[c] = given[c]
            continue
        sources = [F.col(f"clim_{c}")] if c in known or c in lagged else []
        mean_of = lagged.get(c, c)
        sources += [F.col(f"mean_{mean_of}")] if mean_of in averaged else []
        row[c] = F.coalesce(*sources, F.lit(0.0))
    looked_up = sum((F.col(f"clim_{c}").isNotNull().cast("int") for c in [*known, *lagged]), F.lit(0))
    left_over = (
        len(features) - len(config.WEATHER) - len([c for c in features if c in CLOCK]) - looked_up
    )
    kept = [c for c in scenarios.columns if c not in row]
    return found.select(
        *kept,
        *[column.alias(c) for c, column in row.items()],
        looked_up.alias("n_lookup"),
        F.greatest(left_over, F.lit(0)).alias("n_mean"),
    )


def assemble_last_known(
    scenarios: DataFrame,
    features: Sequence[str],
    last: DataFrame,
    means: DataFrame | None = None,
    keys: Sequence[str] = ("station",),
    ts: str = "ts",
    spread: str = "scenario_id",
    source: str = "row",
) -> DataFrame:
    """Feature rows that carry the last known state forward.

    ``last`` is :func:`airgrid.operators.stats.last_known`. With ``source='row'``
    every feature the scenario does not give is taken from the last row; with
    ``source='known'`` only lags are, as their last known value, and the others are
    training means. What is still open is 0. The month is that of the last row.
    """
    facts = last
    averaged = []
    if means is not None:
        averaged = [c for c in features if c in means.columns]
        renamed = means.select(*keys, *[F.col(c).alias(f"mean_{c}") for c in averaged])
        facts = facts.join(renamed, list(keys), "left")
    joined = sequence.join_per_key(scenarios, facts, keys, spread)
    given = _given(F.col(ts), (*config.WEATHER, *CLOCK), F.col("last_month"))
    row = {}
    for c in features:
        if c in given:
            row[c] = given[c]
            continue
        sources = []
        if f"{source}_{c}" in last.columns and (source == "row" or "_lag_" in c.lower()):
            sources.append(F.col(f"{source}_{c}"))
        if c in averaged:
            sources.append(F.col(f"mean_{c}"))
        row[c] = F.coalesce(*sources, F.lit(0.0))
    kept = [c for c in scenarios.columns if c not in row]
    return joined.select(*kept, *[column.alias(c) for c, column in row.items()])


def scenario_from_json(
    df: DataFrame,
    text: str,
    features: Sequence[str],
    means: DataFrame,
    keys: Sequence[str] = ("station",),
    spread: str = "scenario_id",
) -> DataFrame:
    """Features read from a JSON object; an absent key becomes the training mean."""
    parsed = df.withColumn("__given", F.from_json(text, "map<string,double>"))
    facts = means.select(*keys, *[F.col(c).alias(f"__{c}") for c in features])
    joined = sequence.join_per_key(parsed, facts, keys, spread)
    kept = [c for c in df.columns if c not in features]
    return joined.select(
        *kept,
        *[
            F.coalesce(F.try_element_at("__given", F.lit(c)), F.col(f"__{c}")).alias(c)
            for c in features
        ],
    )


def extrapolation(
    df: DataFrame,
    ends: DataFrame,
    keys: Sequence[str] = ("station",),
    ts: str = "ts",
    warn_hours: float = config.EXTRAPOLATION_WARN_HOURS,
    spread: str | None = None,
) -> DataFrame:
    """Add the hours past the last training time, and whether they are too many.

    ``ends`` has (keys, last_train_ts).
    """
    joined = sequence.join_per_key(df, ends, keys, spread or ts)
    hours = moments.hours_between(F.col("last_train_ts"), F.col(ts))
    return joined.withColumn("hours_past", hours).withColumn(
        "extrapolated", F.col("hours_past") > warn_hours
    ).drop("last_train_ts")


def with_index(df: DataFrame, pollutant: str, prediction: str = "prediction") -> DataFrame:
    """Add index, category and colour of a predicted concentration."""
    return df.withColumn("air_index", labels.air_index(pollutant, F.col(prediction))).withColumns(
        {
            "category": F.coalesce(labels.air_category(F.col("air_index")), F.lit("N/D")),
            "colour": F.coalesce(labels.air_colour(F.col("air_index")), F.lit("#64748B")),
        }
    )


def score_scenarios(
    scenarios: DataFrame,
    models: Mapping[str, TreeModel],
    features: Sequence[str],
    climatology: DataFrame,
    means: DataFrame,
    ends: DataFrame | None = None,
    keys: Sequence[str] = ("station",),
    ts: str = "ts",
    spread: str = "scenario_id",
    continuous: bool = False,
) -> DataFrame:
    """The scoring job: every scenario through the models of all pollutants, in one pass over the rows.

    ``models`` go by pollutant and share ``features``. Per pollutant p the result has ``pred_p``,
    ``index_p``, ``category_p``, ``icon_p`` and ``unit_p``; then ``air_index`` and ``category`` of the
    highest index, ``n_lookup`` and ``n_mean``, and with ``ends`` (keys, last_train_ts) ``hours_past`` and
    ``extrapolated``. Predictions below 0 count as 0 in the index. ``continuous`` takes the index
    without holes.
    """
    rows = assemble_scenarios(scenarios, features, climatology, means, keys, ts, spread, resolve_lags=True)
    x = F.array(*[F.col(f"`{c}`").cast("double") for c in features])
    out = predict_all(rows, models, x)
    index = labels.air_index_continuous if continuous else labels.air_index
    category = labels.air_category_continuous if continuous else labels.air_category
    for p in models:
        value = labels.clip_non_negative(F.col(f"pred_{p}"))
        out = out.withColumn(f"index_{p}", index(p, value)).withColumns(
            {
                f"category_{p}": F.coalesce(category(F.col(f"index_{p}")), F.lit("N/D")),
                f"icon_{p}": labels.aqi_icon(p, value),
                f"unit_{p}": labels.unit_of(p),
            }
        )
    highest = F.greatest(*[F.col(f"index_{p}") for p in models]) if len(models) > 1 else F.col(f"index_{next(iter(models))}")
    out = out.withColumn("air_index", highest).withColumn(
        "category", F.coalesce(category(F.col("air_index")), F.lit("N/D"))
    )
    return out if ends is None else extrapolation(out, ends, keys, ts, spread=spread)
