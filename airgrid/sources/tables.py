"""Results out: data sets, metadata, result tables, models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airgrid import config
from airgrid.models.trees import TreeModel
from airgrid.operators import quality

TIME_FORMAT = "yyyy-MM-dd HH:mm"


def dataset_metadata(
    df: DataFrame, target: str = config.TARGET, keys: Sequence[str] = ("station",), ts: str = "ts"
) -> DataFrame:
    """Per station what the data set holds; the writer adds when it was made."""
    columns = [c for c in df.columns if c not in (*keys, ts)]
    return quality.dataset_summary(df, keys, ts).drop("n_days").withColumns(
        {
            "target": F.lit(target),
            "n_columns": F.lit(len(columns)),
            "columns": F.lit(",".join(columns)),
        }
    )


def write_dataset(
    df: DataFrame,
    path: str,
    target: str = config.TARGET,
    key: str = "station",
    ts: str = "ts",
    kind: str = "parquet",
) -> None:
    """The data set by station below ``path/data``, its metadata in ``path/metadata``.

    Rows are laid out by station and time over many files: a station with many rows
    is split, and no file is written by a single task for all stations.
    """
    laid_out = df.repartitionByRange(key, ts).sortWithinPartitions(key, ts)
    writer = laid_out.write.mode("overwrite").partitionBy(key)
    if kind == "csv":
        writer.option("header", True).option("timestampNTZFormat", TIME_FORMAT).csv(f"{path}/data")
    elif kind == "parquet":
        writer.parquet(f"{path}/data")
    else:
        raise ValueError(f"unknown kind {kind!r}")
    metadata = dataset_metadata(df, target, (key,), ts).withColumn(
        "generated_at", F.date_format(F.current_timestamp(), TIME_FORMAT)
    )
    metadata.write.mode("overwrite").parquet(f"{path}/metadata")


def write_results(path: str, tables: Mapping[str, DataFrame], kinds: Sequence[str] = ("csv",)) -> None:
    """Named result tables, each below ``path/<name>.<kind>``."""
    for name, table in tables.items():
        for kind in kinds:
            writer = table.write.mode("overwrite")
            if kind == "csv":
                writer.option("header", True).csv(f"{path}/{name}.csv")
            else:
                writer.format(kind).save(f"{path}/{name}.{kind}")


def save_model(model: TreeModel, path: str, tables: Mapping[str, DataFrame]) -> None:
    """The fitted model, a row per node, with the tables scoring needs beside it."""
    spark = next(iter(tables.values())).sparkSession if tables else SparkSession.active()
    model.save(spark, f"{path}/model")
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")


def load_model(spark: SparkSession, path: str, names: Sequence[str]) -> tuple[TreeModel, dict[str, DataFrame]]:
    model = TreeModel.load(spark, f"{path}/model")
    return model, {name: spark.read.parquet(f"{path}/{name}") for name in names}


def preview(df: DataFrame, order: Sequence[str] = ("station", "ts"), n: int = 100) -> DataFrame:
    """The first rows, times as text."""
    head = df.orderBy(*order).limit(n)
    return head.select(
        *[
            F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if t.startswith("timestamp") else F.col(c)
            for c, t in head.dtypes
        ]
    )
