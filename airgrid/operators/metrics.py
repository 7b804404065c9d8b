"""Scores of predictions and summaries over folds and curves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airgrid import config
from airgrid.functions.labels import r2_band, r2_level


def regression_metrics(
    df: DataFrame, keys: Sequence[str] = (), y: str = "y", yhat: str = "yhat"
) -> DataFrame:
    """Rows, MAE, RMSE and R2 per group; rows without target or prediction are skipped.

    Below two rows all scores are NULL. A constant target scores 1 if it is met
    exactly and 0 otherwise.
    """
    error = F.col(y) - F.col(yhat)
    known = df.filter(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    sums = known.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(error)).alias("__mae"),
        F.avg(error * error).alias("__mse"),
        F.var_pop(y).alias("__var"),
    )
    enough = F.col("n") >= 2
    r2 = F.when(F.col("__var") > 0, F.lit(1.0) - F.col("__mse") / F.col("__var")).otherwise(
        F.when(F.col("__mse") == 0, 1.0).otherwise(0.0)
    )
    return sums.select(
        *keys,
        "n",
        F.when(enough, F.col("__mae")).alias("mae"),
        F.when(enough, F.sqrt("__mse")).alias("rmse"),
        F.when(enough, r2).alias("r2"),
    )


def fold_summary(fold_metrics: DataFrame, by: str = "target") -> DataFrame:
    """Mean and sample deviation over folds with the level of the mean R2."""
    summary = fold_metrics.groupBy(by).agg(
        *[F.avg(m).alias(f"{m}_mean") for m in ("mae", "rmse", "r2")],
        *[F.stddev_samp(m).alias(f"{m}_std") for m in ("mae", "rmse", "r2")],
    )
    return summary.withColumns(
        {"level": r2_level(F.col("r2_mean")), "band": r2_band(F.col("r2_mean"))}
    )


def r2_ranking(summary: DataFrame, by: str = "target") -> DataFrame:
    """Targets from the lowest to the highest mean R2."""
    return summary.orderBy("r2_mean", by)


def fold_mean_r2(fold_metrics: DataFrame) -> DataFrame:
    """Mean R2 over targets per fold; missing scores do not count."""
    return fold_metrics.groupBy("fold").agg(F.avg("r2").alias("r2_mean"))


def part_mean_r2(scores: DataFrame, part: str = "part") -> DataFrame:
    """Mean R2 over targets per part of the data (train, test), and how many targets have one."""
    return scores.groupBy(part).agg(F.avg("r2").alias("r2_mean"), F.count("r2").alias("n_targets"))


def curve_summary(curves: DataFrame, keys: Sequence[str] = ("target",)) -> DataFrame:
    """Mean and population deviation over folds, per round, up to the shortest curve.

    ``curves`` has (keys, fold, split, iter, score) with rounds counted from 0.
    """
    by_round = curves.groupBy(*keys, "split", "iter").agg(
        F.avg("score").alias("mean"), F.stddev_pop("score").alias("std"), F.count_distinct("fold").alias("__folds")
    )
    # A round that fewer folds have than the first one is past the end of the shortest curve.
    whole = Window.partitionBy(*keys)
    ends = F.min(F.when(F.col("__folds") < F.col("__all"), F.col("iter"))).over(whole)
    counted = by_round.withColumn("__all", F.max("__folds").over(Window.partitionBy(*keys, "split")))
    cut = counted.withColumn("__end", ends).where(F.col("__end").isNull() | (F.col("iter") < F.col("__end")))
    return cut.select(*keys, "split", "iter", "mean", "std")


def best_rounds(
    summary: DataFrame,
    keys: Sequence[str] = ("target",),
    split: str = "val",
    highest: bool = False,
) -> DataFrame:
    """Per key the round with the lowest (or highest) mean score; the first of equals."""
    score = F.col("mean") if not highest else -F.col("mean")
    scored = summary.filter((F.col("split") == split) & F.col("mean").isNotNull())
    best = scored.groupBy(*keys).agg(
        F.min(F.struct(score.alias("s"), F.col("iter"), F.col("mean"))).alias("__b")
    )
    return best.select(
        *keys, F.col("__b.iter").alias("best_iter"), F.col("__b.mean").alias("best_score")
    )


def final_rounds(
    best: DataFrame, max_rounds: int, batch: int = config.CURVE_BATCH
) -> DataFrame:
    """The round count for the final fit: median over targets plus two batches, capped.

    ``best`` has one row per target, with rounds in batches counted from 0.
    """
    rounds = (F.col("best_iter") + 1) * batch
    middle = F.floor(F.percentile(rounds, 0.5)).cast("bigint")
    return best.agg(F.coalesce(middle, F.lit(max_rounds)).alias("best_rounds")).withColumn(
        "final_rounds", F.least(F.col("best_rounds") + 2 * batch, F.lit(max_rounds))
    )


def best_and_final_rounds(
    curves: DataFrame, max_rounds: int, key: str = "target", split: str = "val", batch: int = config.CURVE_BATCH
) -> DataFrame:
    """(key, best_iter, best_score, best_rounds, final_rounds) from the curves in one pass.

    The rows of all keys are one small group: a key has one row here, and the curves are summed
    by (key, iter) before. The median over keys is carried beside the rows it is made of.
    """
    best = best_rounds(curve_summary(curves, (key,)), (key,), split)
    rows = F.collect_list(F.struct(F.col(key), "best_iter", "best_score"))
    whole = best.agg(rows.alias("rows"), F.percentile((F.col("best_iter") + 1) * batch, 0.5).alias("middle"))
    rounds = F.floor("middle").cast("bigint")
    return whole.select(F.inline("rows"), rounds.alias("best_rounds")).withColumn(
        "final_rounds", F.least(F.col("best_rounds") + 2 * batch, F.lit(max_rounds)).cast("bigint")
    )
