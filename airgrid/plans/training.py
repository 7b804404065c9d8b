"""Data set to trained model with everything scoring needs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airgrid import config
from airgrid.functions import text
from airgrid.models import boosted, importance
from airgrid.operators import features as fe
from airgrid.operators import metrics, quality, schema, splits, stats
from airgrid.session import stored
from airgrid.sources import files


@dataclass(frozen=True)
class Trained:
    """A model and its side tables."""

    model: boosted.Boosted
    features: list[str]
    target: str
    selection: DataFrame
    scores: DataFrame
    predictions: DataFrame
    scaler: DataFrame
    climatology: DataFrame
    means: DataFrame
    ends: DataFrame
    cross_validated: boosted.CrossValidated | None
    importance: DataFrame | None


def prepare(
    df: DataFrame,
    target: str,
    pollutants: Sequence[str] = config.POLLUTANTS,
    keys: Sequence[str] = ("station",),
    ts: str = "ts",
    exclude: bool = True,
    engineer: bool = True,
    exclude_current: bool = False,
) -> DataFrame:
    """Drop excluded years and rows without target, then add the features."""
    kept = quality.exclude_years(df, ts) if exclude else df
    kept = quality.require_target(kept, target)
    if not engineer:
        return kept
    return fe.build_features(kept, pollutants, keys, ts, exclude_current)


def train(
    df: DataFrame,
    target: str = config.TARGET,
    pollutants: Sequence[str] = config.POLLUTANTS,
    keys: Sequence[str] = ("station",),
    ts: str = "ts",
    exclude: bool = True,
    engineer: bool = True,
    exclude_current: bool = False,
    top: int = config.TOP_FEATURES,
    folds: int = config.FOLDS,
    params: boosted.BoostParams = boosted.BoostParams(),
    repeats: int = 8,
    sample: int | None = None,
    validate: bool = True,
) -> Trained:
    """Features, selection, cross-validation, final fit, scores, importance.

    One model learns from all stations; splits are chronological within each.
    Selection sees training rows only. Candidates are all numeric columns but the
    target, so other pollutants can serve as features; cross-validation covers the
    target and the pollutants the selection kept, each without other pollutants.
    Climatology and last times come from training rows, feature means from all rows.
    """
    full = stored(
        prepare(df, target, pollutants, keys, ts, exclude, engineer, exclude_current)
    )
    candidates = [c for c in schema.numeric_columns(full) if c not in (target, *keys)]
    split = stored(splits.chronological_split(full, keys, ts))
    chosen, selection = boosted.select_features(
        split.filter("role <> 'test'"), candidates, target, top
    )
    clean = quality.require_all(
        full.select(*keys, ts, target, *chosen), [*chosen, target]
    )
    validated = None
    if validate:
        kept = [p for p in pollutants if p in clean.columns]
        x = [c for c in chosen if c not in pollutants]
        validated = boosted.cross_validate(
            clean, kept, {p: x for p in kept}, keys, ts, folds, params
        )
    again = stored(splits.chronological_split(clean, keys, ts))
    rows = boosted.assemble(again, chosen, target)
    fit, val = rows.filter("role = 'fit'"), rows.filter("role = 'val'")
    model = boosted.fit_boosted(fit, val, params)
    predicted = boosted.predict(model.model, rows).drop(boosted.VECTOR)
    part = F.when(F.col("role") == "test", "test").otherwise("train")
    scores = metrics.regression_metrics(
        predicted.withColumn("part", part), ("part",), boosted.LABEL, boosted.PREDICTION
    )
    ranked = None
    if repeats:
        ranked = importance.permutation_importance(
            model.model, rows.filter("role = 'test'"), chosen, [*keys, ts], repeats, sample
        )
    trained_rows = again.filter("role <> 'test'")
    return Trained(
        model=model,
        features=chosen,
        target=target,
        selection=selection,
        scores=scores,
        predictions=predicted,
        scaler=stats.scaler_stats(fit, chosen),
        climatology=stats.climatology_wide(trained_rows, chosen, keys, ts),
        means=clean.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in chosen]),
        ends=trained_rows.groupBy(*keys).agg(F.max(ts).alias("last_train_ts")),
        cross_validated=validated,
        importance=ranked,
    )


def read_training_csv(spark: SparkSession, path: str, station: str | None = None) -> DataFrame:
    """An annotated file as a training table: (station, ts, numbers).

    The time column is found by name or content; every other column becomes a number, NULL where
    it cannot be read. Without a column ``station`` all rows belong to ``station`` or, by default, to
    the one the file's name tells.
    """
    raw = files.scan_annotated_csv(spark, path)
    time = schema.detect_timestamp(raw)
    if time is None:
        raise ValueError(f"no time column in {path}")
    typed = files.typed_columns(raw, time).withColumnRenamed(time, "ts")
    if "station" not in typed.columns:
        name = F.lit(station) if station is not None else text.station_from_file(F.lit(path))
        typed = typed.withColumn("station", name)
    return typed.select("station", "ts", *[c for c in typed.columns if c not in ("station", "ts")])


def train_csv(spark: SparkSession, path: str, target: str = config.TARGET, station: str | None = None, **settings) -> Trained:
    """The whole way from an annotated file to a trained model; ``settings`` are those of ``train``."""
    return train(stored(read_training_csv(spark, path, station)), target, **settings)
