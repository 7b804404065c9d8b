"""Sensor files: finding them, reading them, turning them into readings."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airgrid import config
from airgrid.functions import text, values
from airgrid.operators import align, schema

SEPARATORS = (",", ";", "\t")

# -- listing ---------------------------------------------------------------------------


def list_files(
    spark: SparkSession,
    folder: str,
    extensions: Sequence[str] = config.FILE_EXTENSIONS,
    recursive: bool = False,
) -> DataFrame:
    """Files of the folder: (path, name, length). File contents are not read."""
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", recursive)
        .load(folder)
        .select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length")
    )
    return listing.filter(F.lower("name").rlike(rf"\.({'|'.join(extensions)})$"))


def list_csv(spark: SparkSession, folder: str) -> DataFrame:
    """All ``.csv`` paths below the folder, sorted."""
    return list_files(spark, folder, ("csv",), recursive=True).select("path").orderBy("path")


def file_listing(files: DataFrame) -> DataFrame:
    """Name and size in kilobytes, by lower-case name."""
    return files.select("name", (F.col("length") / 1024).alias("size_kb")).orderBy(F.lower("name"))


def _accepted(spark: SparkSession) -> DataFrame:
    rows = [
        (variable, name, rank)
        for variable, names in config.FILE_NAMES.items()
        for rank, name in enumerate(names)
    ]
    return spark.createDataFrame(rows, "variable string, accepted string, rank int")


def recognise_files(files: DataFrame) -> DataFrame:
    """(variable, path, file): per variable the first file, by path, with an accepted stem.

    Case and punctuation do not matter. The table of accepted names has a fixed size,
    so it is broadcast.
    """
    accepted = _accepted(files.sparkSession).select(
        "variable", text.normalised_stem(F.col("accepted")).alias("stem")
    ).distinct()
    named = files.withColumn("stem", text.normalised_stem(F.col("name")))
    return (
        named.join(F.broadcast(accepted), "stem")
        .groupBy("variable")
        .agg(F.min("path").alias("path"), F.min_by("name", "path").alias("file"))
    )


def recognise_exact(files: DataFrame) -> DataFrame:
    """(variable, path, file): per variable the first of its exact names that exists."""
    accepted = _accepted(files.sparkSession)
    return (
        files.join(F.broadcast(accepted), files["name"] == accepted["accepted"])
        .groupBy("variable")
        .agg(F.min_by("path", "rank").alias("path"), F.min_by("name", "rank").alias("file"))
    )


# -- reading ---------------------------------------------------------------------------


def first_line(spark: SparkSession, path: str) -> str:
    row = spark.read.text(path).limit(1).first()
    return "" if row is None else row[0]


def sniff_separator(line: str) -> str:
    """The first of comma, semicolon and tab that yields more than one column."""
    for separator in SEPARATORS:
        if len(next(csv.reader([line], delimiter=separator), [])) > 1:
            return separator
    raise ValueError("no separator gives more than one column")


def scan_delimited(spark: SparkSession, path: str) -> DataFrame:
    """A delimited file as text columns."""
    separator = sniff_separator(first_line(spark, path))
    return spark.read.csv(
        path, sep=separator, header=True, inferSchema=False, ignoreLeadingWhiteSpace=False
    )


#: A line up to a comment sign outside quotes. A quote opens only where a field begins.
_FIELD = r'(?:"(?:[^"]++|"")*+"?+)?+[^,#]*+'
UNCOMMENTED = f"^{_FIELD}(?:,{_FIELD})*+"
NO_NULL = "\u0001"


def _without_comments(lines: DataFrame) -> DataFrame:
    """(at, value): a ``#`` outside quotes cuts the rest of its line; lines empty then are skipped.

    ``at`` grows along the file.
    """
    cut = F.regexp_extract("value", UNCOMMENTED, 0)
    numbered = lines.select(F.monotonically_increasing_id().alias("at"), cut.alias("value"))
    return numbered.filter(F.trim("value") != "")


def _header(spark: SparkSession, path: str) -> tuple[int, list[str]]:
    """Where the first line that is no comment stands, and its fields."""
    first = _without_comments(spark.read.text(path)).agg(F.min("at").alias("at"), F.min_by("value", "at").alias("v")).first()
    return (-1, []) if first["at"] is None else (first["at"], [c.strip() for c in next(csv.reader([first["v"]]))])


def probe_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of an annotated file, from its first line that is no comment."""
    return _header(spark, path)[1]


def annotated_rows(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The rows of a comma-separated file with comments, as text columns, and the rejected lines.

    Only the first line is the header; a later line that repeats it is a row. A ``#`` inside quotes
    is part of its field. Short rows are filled with NULL; lines with more fields than the header are
    rejected: (at, line, n_fields), in the order of ``at``. A field does not go over a line's end.
    """
    at, columns = _header(spark, path)
    if not columns:
        raise ValueError(f"no header in {path}")
    lines = _without_comments(spark.read.text(path)).where(F.col("at") != at)
    # One extra column tells rows of too many fields from the others.
    schema = ", ".join(f"`c{i}` string" for i in range(len(columns) + 1))
    options = {"nullValue": NO_NULL, "emptyValue": "", "maxCharsPerColumn": "-1", "escape": '"'}
    parsed = lines.select("at", "value", F.from_csv("value", schema, options).alias("r"))
    last = F.col(f"r.c{len(columns)}")
    accepted = parsed.where(last.isNull()).select(
        *[F.nullif(F.col(f"r.c{i}"), F.lit("")).alias(c) for i, c in enumerate(columns)]
    )
    fields = F.regexp_count(F.regexp_replace("value", r'"(?:[^"]++|"")*+"', ""), F.lit(",")) + 1
    rejected = parsed.where(last.isNotNull()).select("at", F.col("value").alias("line"), fields.alias("n_fields"))
    return accepted, rejected


def scan_annotated_csv(spark: SparkSession, path: str) -> DataFrame:
    """The accepted rows of ``annotated_rows``."""
    return annotated_rows(spark, path)[0]


SUMMARY = (
    "path string, ok boolean, message string, n_rows bigint, n_columns int, time_column string, "
    "pollutants array<string>, targets array<string>"
)


def summarise_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Per annotated file its rows, columns, time column and pollutants, or why it cannot be read.

    ``targets`` are the pollutants found, or all where none is. The files are few; each is a
    query of its own, so that an unreadable one does not stop the others.
    """
    rows = []
    for path in paths:
        try:
            df = scan_annotated_csv(spark, path)
            found = [c for c in config.POLLUTANTS if c in df.columns]
            time = schema.detect_timestamp(df) or "No detectado"
            rows.append((path, True, None, df.count(), len(df.columns), time, found, schema.detect_targets(df.columns)))
        except Exception as error:  # whatever the reader says becomes the row's message
            message = str(error).splitlines()[0] if str(error) else type(error).__name__
            rows.append((path, False, message, None, None, None, [], list(config.POLLUTANTS)))
    return spark.createDataFrame(rows, SUMMARY)


def typed_columns(df: DataFrame, ts: str, texts: Sequence[str] = ("station",)) -> DataFrame:
    """Text columns as a model takes them: ``ts`` a time, all others but ``texts`` numbers; rows
    without a time go."""
    columns = [
        values.to_time(F.col(f"`{c}`")).alias(c) if c == ts
        else F.col(f"`{c}`") if c in texts or kind != "string"
        else values.to_number(F.col(f"`{c}`")).alias(c)
        for c, kind in df.dtypes
    ]
    return df.select(*columns).where(F.col(f"`{ts}`").isNotNull())


# -- readings --------------------------------------------------------------------------


def wide_to_readings(wide: DataFrame, variable: str) -> DataFrame:
    """One variable's wide text table to (station, variable, ts, value, arrival).

    The first column is the time. Unit rows and unreadable times go, numbers that
    cannot be read are NULL.
    """
    time, *stations = wide.columns
    stations = [c for c in stations if c.strip().upper() not in config.NOT_STATIONS and c.strip()]
    rows = wide.withColumn("arrival", F.monotonically_increasing_id()).withColumn(
        "__time", F.col(f"`{time}`").cast("string")
    )
    timed = align.drop_unit_rows(rows, "__time").withColumn(
        "ts", values.to_time(F.col("__time"))
    ).filter("ts is not null")
    long = align.unpivot_stations(timed, ["ts", "arrival"], stations)
    return long.select(
        "station",
        F.lit(variable).alias("variable"),
        "ts",
        values.to_number(F.col("raw")).alias("value"),
        "arrival",
    )


def read_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Readings of all recognised files of a folder.

    There is at most one file per expected variable, so the driver holds at most
    eleven paths; each file is read once, for all its stations. Files of a kind that
    cannot be read here (spreadsheets) are left out, to be converted beforehand.
    """
    found = recognise_files(list_files(spark, folder, ("csv",))).collect()
    if not found:
        raise ValueError(f"no recognised file in {folder}")
    parts = [
        wide_to_readings(scan_delimited(spark, row["path"]), row["variable"])
        for row in sorted(found, key=lambda row: row["variable"])
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union

