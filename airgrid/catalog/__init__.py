"""The registered queries and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airgrid.catalog import cleaning, file_tables, learned, modelling_tables, views  # noqa: F401
from airgrid.catalog.registry import QUERIES, SQL, r6
from airgrid.functions import labels
from airgrid.operators import align, features, quality

__all__ = ["QUERIES", "SQL", "flagship"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings to clean hours with lags, rolling features, index and category."""
    cleaned = quality.clean_values(views.readings(spark, sf_dir), cleaning.RANGES)
    hours = align.align_hourly(
        cleaned.select("station", "variable", "ts", F.col("clean_value").alias("value"), "arrival"),
        views.VARIABLES,
    )

    rolled = features.add_rolling(features.add_lags(hours, "view"), ["view"])
    indexed = align.global_index(rolled, modelling_tables.COLUMN_POLLUTANTS)
    return indexed.select(
        "station",
        "ts",
        *[r6(c).alias(c) for c in rolled.columns if c not in ("station", "ts")],
        r6("air_index").alias("air_index"),
        labels.air_category(F.col("air_index")).alias("category"),
    ).orderBy("station", "ts")
