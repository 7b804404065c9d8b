"""The given tables seen as sensor data, for Spark and as SQL.

``events`` plays the readings: its type is the variable, its user the series. Queries
whose operators read an aligned view more than once store it first, so that the raw
table is scanned and aligned once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airgrid.operators import align as al

VARIABLES = ("view", "click", "purchase", "signup", "error")
MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long readings: (station, variable, ts, value, arrival)."""
    return table(spark, sf_dir, "events").select(
        (F.col("user_id") % 10).alias("station"),
        F.col("event_type").alias("variable"),
        "ts",
        "value",
        F.col("event_id").alias("arrival"),
    )


READINGS = (
    "readings AS (SELECT user_id % 10 AS station, event_type AS variable, ts, value, "
    "event_id AS arrival FROM events)"
)


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per station and hour, one column per variable, hourly means."""
    return al.align_hourly(readings(spark, sf_dir), VARIABLES, how="mean")


_HOURLY_COLUMNS = ", ".join(
    f"avg(value) FILTER (variable = '{v}') AS \"{v}\"" for v in VARIABLES
)
HOURLY = (
    f"hourly AS (SELECT station, date_trunc('hour', ts) AS ts, {_HOURLY_COLUMNS} "
    "FROM readings GROUP BY 1, 2)"
)


def user_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same per user: many short, sparse series."""
    per_user = table(spark, sf_dir, "events").select(
        "user_id",
        F.col("event_type").alias("variable"),
        "ts",
        "value",
        F.col("event_id").alias("arrival"),
    )
    return al.align_hourly(per_user, VARIABLES, keys=("user_id",))


_USER_COLUMNS = ", ".join(
    f"arg_min(value, event_id) FILTER (event_type = '{v}') AS \"{v}\"" for v in VARIABLES
)
USER_HOURLY = (
    f"user_hourly AS (SELECT user_id, date_trunc('hour', ts) AS ts, {_USER_COLUMNS} "
    "FROM events GROUP BY 1, 2)"
)


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series per user: the first value of each hour, (user_id, ts, value)."""
    return al.first_per_hour(table(spark, sf_dir, "events"), "user_id", arrival="event_id")


SERIES = (
    "series AS (SELECT user_id, date_trunc('hour', ts) AS ts, arg_min(value, event_id) AS value "
    "FROM events GROUP BY 1, 2)"
)


def measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense numeric columns with the line's key."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *MEASURES, "l_shipdate"
    )
