"""Boosted trees: fitting with a validation stretch, curves, cross-validation."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airgrid import config
from airgrid.models import trees
from airgrid.models.trees import TRAIN, VALIDATE, BoostParams, TreeModel
from airgrid.operators import metrics, schema, sequence, splits
from airgrid.tasks import in_tasks

VECTOR, LABEL, PREDICTION = "features", "label", "prediction"


@dataclass(frozen=True)
class Boosted:
    """A model, its number of trees, and the errors of all rounds that were grown."""

    model: TreeModel
    rounds: int
    train_curve: list[float] = field(default_factory=list)
    val_curve: list[float] = field(default_factory=list)


def assemble(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Add the feature vector and the label; rows must be complete."""
    vectors = VectorAssembler(inputCols=list(features), outputCol=VECTOR, handleInvalid="error")
    return vectors.transform(df).withColumn(LABEL, F.col(target).cast("double"))


def rmse_curve(model: TreeModel, df: DataFrame) -> list[float]:
    """Root mean squared error after each round, in one pass."""

    def rows(batches) -> Iterator[pa.RecordBatch]:
        sums, n = np.zeros(len(model.trees)), 0
        for batch in batches:
            x, y = np.asfortranarray(trees._matrix(batch.column(0))), batch.column(1).to_numpy(zero_copy_only=False)
            margin = np.full(len(y), model.base)
            n += len(y)
            for t, tree in enumerate(model.trees):
                if len(y):
                    margin += tree.value[tree.leaves(x, tree.threshold)]
                    sums[t] += ((y - margin) ** 2).sum()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(sums))), pa.array(sums), pa.array(np.full(len(sums), n))], ["round", "squares", "n"]
        )

    partial = in_tasks(df.select(vector_to_array(VECTOR), LABEL), rows, "round bigint, squares double, n bigint")
    total = partial.groupBy("round").agg((F.sum("squares") / F.sum("n")).alias("mse")).orderBy("round")
    return [math.sqrt(r["mse"]) for r in total.collect()]


def best_round(curve: Sequence[float], patience: int) -> int:
    """Rounds to keep: the best one before ``patience`` rounds bring nothing better."""
    best = 0
    for i, score in enumerate(curve):
        if score < curve[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def _draw(df: DataFrame) -> Column:
    """A hash of the whole row, by which trees draw their rows."""
    plain = [vector_to_array(c) if kind == "vector" else F.col(f"`{c}`") for c, kind in df.dtypes]
    return F.xxhash64(*plain)


def fit_boosted(fit: DataFrame, val: DataFrame | None = None, params: BoostParams = BoostParams()) -> Boosted:
    """Grow on one part and stop ``params.patience`` rounds after the best on the other.

    Without validation rows all rounds are grown. Each tree is grown once: the model
    keeps the first ones, up to the best round.
    """
    parts = [(fit, TRAIN)] + ([(val, VALIDATE)] if val is not None else [])
    rows = None
    for df, part in parts:
        own = df.select(
            vector_to_array(VECTOR).alias("x"),
            F.array(F.col(LABEL)).alias("y"),
            F.array(F.lit(part).cast("tinyint")).alias("parts"),
            _draw(df).alias("draw"),
        )
        rows = own if rows is None else rows.unionByName(own)
    first = fit.select(VECTOR).first()
    if first is None:
        raise ValueError("no rows to fit")
    (grown,), _ = trees.grow(rows, [0], len(first[0]), params)
    kept = grown.best + 1 if grown.n_val else len(grown.trees)
    model = TreeModel(grown.base, grown.trees[:kept])
    return Boosted(model, model.rounds, grown.curves["train"], grown.curves["val"])


def fit_together(
    split: DataFrame, features: Sequence[str], targets: Sequence[str], ids: Sequence[str], params: BoostParams = BoostParams()
) -> dict[str, Boosted]:
    """A model per target, grown in lockstep from the rows of role ``fit``, stopped by those of role ``val``.

    Rows that lack a feature play no part, rows that lack a target none in its model. A target
    without rows has a model that predicts 0.
    """
    complete = split.dropna("any", subset=list(features)).where("role in ('fit', 'val')")
    part = F.when(F.col("role") == "fit", TRAIN).otherwise(VALIDATE)
    rows = complete.select(
        F.array(*[F.col(c).cast("double") for c in features]).alias("x"),
        F.array(*[F.coalesce(F.col(t).cast("double"), F.lit(0.0)) for t in targets]).alias("y"),
        F.array(*[F.when(F.col(t).isNotNull(), part).otherwise(0).cast("tinyint") for t in targets]).alias("parts"),
        F.xxhash64(*ids).alias("draw"),
    )
    grown, _ = trees.grow(rows, list(range(len(targets))), len(features), params)
    out = {}
    for t, m in zip(targets, grown, strict=True):
        kept = m.trees[: m.best + 1] if m.n_val else m.trees
        out[t] = Boosted(TreeModel(m.base, kept), len(kept), m.curves["train"], m.curves["val"])
    return out


def predict(model, df: DataFrame) -> DataFrame:
    return model.transform(df)


def select_features(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    n: int = config.TOP_FEATURES,
    min_rows: int = 50,
    trees: int = 80,
    depth: int = 6,
    leaf_rows: int = 20,
) -> tuple[list[str], DataFrame]:
    """The ``n`` most important features in column order, and the importance table.

    ``status`` tells how they came about: ``ranked`` by a forest; ``all_kept`` where there are no
    more than ``n``, ``too_few_rows`` where fewer than ``min_rows`` are complete: then all are kept,
    no forest is grown and the importance is NULL.
    """
    features = list(features)
    schema_text = "feature string, importance double, position int, selected boolean, status string"
    complete = df.dropna("any", subset=[*features, target])
    few = len(complete.limit(min_rows).take(min_rows)) < min_rows
    if len(features) <= n or few:
        status = "all_kept" if len(features) <= n else "too_few_rows"
        rows = [(c, None, i, True, status) for i, c in enumerate(features)]
        return features, df.sparkSession.createDataFrame(rows, schema_text)
    forest = RandomForestRegressor(
        featuresCol=VECTOR,
        labelCol=LABEL,
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=leaf_rows,
        seed=config.SEED,
    )
    model = forest.fit(assemble(complete, features, target))
    importance = [float(x) for x in model.featureImportances.toArray()]
    ranked = sorted(range(len(features)), key=lambda i: (-importance[i], i))
    chosen = set(ranked[:n])
    rows = [(c, importance[i], i, i in chosen, "ranked") for i, c in enumerate(features)]
    return (
        [c for i, c in enumerate(features) if i in chosen],
        df.sparkSession.createDataFrame(rows, schema_text),
    )


# -- cross-validation ------------------------------------------------------------------


@dataclass(frozen=True)
class CrossValidated:
    """Small tables: (target, fold, n, mae, rmse, r2, rounds, status) and (target, fold, split, iter, score)."""

    folds: DataFrame
    curves: DataFrame


FOLD_TABLE = "target string, fold int, n bigint, mae double, rmse double, r2 double, rounds int, status string"
CURVE_TABLE = "target string, fold int, split string, iter int, score double"
ABSENT, TOO_FEW, OK = "absent", "too_few_rows", "ok"


def folded_rows(
    df: DataFrame, features: Mapping[str, Sequence[str]], keys: Sequence[str], ts: str, folds: int, whole: Sequence[str] = ()
) -> tuple[DataFrame, list[str]]:
    """One row per row of ``df`` for the folds of all targets, and the union of the features.

    (x, y, parts, draw, n_<target>): ``parts`` has the part a row plays in each (target, fold), target by
    target. Rows of a target that lack it or one of its features play none; they are not
    counted when its folds are laid. ``whole`` names columns that must be there for all targets.
    """
    columns = sorted({c for own in features.values() for c in own})
    needed = {t: [*own, t] for t, own in features.items()}
    complete = {}
    for i, (t, own) in enumerate(needed.items()):
        flag = F.lit(True)
        for c in [*own, *whole]:
            flag &= F.col(c).isNotNull()
        complete[f"t{i}"] = flag
    placed = sequence.with_positions(df, keys, ts, complete)
    parts = []
    for i in range(len(needed)):
        for fold in range(1, folds + 1):
            role = splits.fold_role(F.col(f"pos_t{i}"), F.col(f"n_t{i}"), F.lit(fold), folds)
            part = F.when(role == "train", TRAIN).when(role == "val", VALIDATE).otherwise(0)
            parts.append(F.when(F.col(f"pos_t{i}").isNotNull(), part).otherwise(0).cast("tinyint"))
    rows = placed.select(
        F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns]).alias("x"),
        F.array(*[F.coalesce(F.col(t).cast("double"), F.lit(0.0)) for t in needed]).alias("y"),
        F.array(*parts).alias("parts"),
        F.xxhash64(*keys, ts).alias("draw"),
        *[F.col(f"pos_t{i}").isNotNull().alias(f"has_t{i}") for i in range(len(needed))],
    )
    return rows, columns


def _validated(
    df: DataFrame, present: Mapping[str, Sequence[str]], absent: Sequence[str], keys: Sequence[str], ts: str,
    folds: int, params: BoostParams, min_rows: int, min_train: int, min_val: int, step: int = 1,
) -> CrossValidated:
    """All folds of all targets from one table, grown in lockstep; a row for each of them."""
    spark = df.sparkSession
    fold_rows = [(t, f, 0, None, None, None, 0, ABSENT) for t in absent for f in range(1, folds + 1)]
    curve_rows = []
    if present:
        rows, columns = folded_rows(df, present, keys, ts, folds)
        names = list(present)
        counts = rows.agg(*[F.count_if(f"has_t{i}").alias(f"t{i}") for i in range(len(names))]).first()
        few = {t for i, t in enumerate(names) if counts[f"t{i}"] < min_rows}
        place = {c: i for i, c in enumerate(columns)}
        models = [(t, f) for t in names for f in range(1, folds + 1)]
        targets = [names.index(t) for t, _ in models]
        allowed = [[place[c] for c in present[t]] for t, _ in models]
        silenced = [t in few for t, _ in models]
        kept = F.transform(
            "parts", lambda p, i: F.when(F.array(*[F.lit(s) for s in silenced])[i], F.lit(0).cast("tinyint")).otherwise(p)
        )
        rows = rows.withColumn("parts", kept) if few else rows
        grown, coded = trees.grow(rows, targets, len(columns), params, min_train, allowed)
        best = [m.best + 1 if m.n_val else len(m.trees) for m in grown]
        scores = trees.scored(coded, grown, [min(b, len(m.trees)) for b, m in zip(best, grown, strict=True)])
        nothing = {"n": 0, "mae": None, "rmse": None, "r2": None}
        for (t, f), m, b in zip(models, grown, best, strict=True):
            enough = t not in few and m.n_train >= min_train
            s = scores.get(m.number, nothing) if enough else nothing
            status = OK if enough and s["n"] >= min_val else TOO_FEW
            fold_rows.append((t, f, s["n"], s["mae"], s["rmse"], s["r2"], min(b, len(m.trees)) if enough else 0, status))
            for split, curve in m.curves.items():
                if enough and (split == "train" or s["n"] >= min_val):
                    curve_rows += [(t, f, split, i, x) for i, x in enumerate(curve[step - 1 :: step])]
    return CrossValidated(spark.createDataFrame(fold_rows, FOLD_TABLE), spark.createDataFrame(curve_rows, CURVE_TABLE))


def cross_validate(
    df: DataFrame,
    targets: Sequence[str] = config.POLLUTANTS,
    features: Mapping[str, Sequence[str]] | None = None,
    keys: Sequence[str] = ("station",),
    ts: str = "ts",
    folds: int = config.FOLDS,
    params: BoostParams = BoostParams(),
) -> CrossValidated:
    """Chronological folds of every target, grown in lockstep from one table.

    Features default to all numeric columns that are no pollutant. A target that is no column is
    ``absent``; one with fewer than ``20 * folds`` complete rows has ``too_few_rows`` and is not
    fitted: both have their rows in the table. Scaling is skipped inside the folds: a tree
    splits the same rows apart whatever the linear scale of a column.
    """
    present = {
        t: list(features[t]) if features else schema.feature_columns(df, t, targets) for t in targets if t in df.columns
    }
    absent = [t for t in targets if t not in df.columns]
    return _validated(df, present, absent, keys, ts, folds, params, folds * 20, 2, 2)


# -- several targets -------------------------------------------------------------------


@dataclass(frozen=True)
class MultiTarget:
    models: dict[str, TreeModel]
    rounds: int
    cross_validated: CrossValidated


def fit_multi_target(
    train: DataFrame,
    features: Sequence[str],
    targets: Sequence[str],
    keys: Sequence[str] = ("station",),
    ts: str = "ts",
    folds: int = config.FOLDS,
    batch: int = config.CURVE_BATCH,
    params: BoostParams = BoostParams(),
    min_train: int = 10,
    min_val: int = 2,
) -> MultiTarget:
    """One model per target, the number of rounds shared.

    Each fold fits each target on its non-null rows (at least ``min_train``, and
    ``min_val`` to be scored) for all rounds and reads the curve every ``batch`` rounds. The
    median over targets of the best batch, plus two batches, is the final number of rounds.
    The final models are fitted on all training rows, missing targets replaced by the
    target's mean. With fewer than ``50 * folds`` rows no model is fitted, and every fold's
    status says so.
    """
    features, targets = list(features), list(targets)
    present = {t: features for t in targets}
    spark = train.sparkSession
    if len(train.select(ts).take(folds * 50)) < folds * 50:
        none = [(t, f, 0, None, None, None, 0, TOO_FEW) for t in targets for f in range(1, folds + 1)]
        return MultiTarget({}, 0, CrossValidated(spark.createDataFrame(none, FOLD_TABLE), spark.createDataFrame([], CURVE_TABLE)))
    patient = replace(params, patience=params.rounds + 1)
    validated = _validated(train, present, [], keys, ts, folds, patient, 0, min_train, min_val, batch)
    best = metrics.best_rounds(metrics.curve_summary(validated.curves))
    final = metrics.final_rounds(best, params.rounds, batch).first()
    rounds = int(final["final_rounds"])

    means = train.agg(*[F.avg(t).alias(t) for t in targets]).first()
    complete = train.dropna("any", subset=features)
    filled = complete.select(
        F.array(*[F.col(c).cast("double") for c in features]).alias("x"),
        F.array(*[F.coalesce(F.col(t), F.lit(means[t]), F.lit(0.0)).cast("double") for t in targets]).alias("y"),
        F.array(*[F.lit(TRAIN).cast("tinyint") for _ in targets]).alias("parts"),
        F.xxhash64(*keys, ts).alias("draw"),
    )
    grown, _ = trees.grow(filled, list(range(len(targets))), len(features), replace(params, rounds=rounds), 1)
    models = {t: TreeModel(m.base, m.trees) for t, m in zip(targets, grown, strict=True)}
    return MultiTarget(models, rounds, validated)
