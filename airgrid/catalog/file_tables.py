"""Queries over files: the given events are written as sensor files, then found and read again.

What is written is what a station network delivers: one wide file per variable, an annotated
table of one station's hours, and the library's own outputs. All of it is derived from the whole
``events`` table, once per session, below the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airgrid import config
from airgrid.catalog import views as v
from airgrid.catalog.learned import BUILT, _fitted
from airgrid.catalog.registry import once, query, r6, s6, s_ts, ts_text, with_sql
from airgrid.models import boosted
from airgrid.operators import quality, schema
from airgrid.session import shared_path, stored
from airgrid.sources import files, tables

#: The event type that plays each variable, and its file.
PLAYED = {"view": ("PM25", "pm2.5.CSV"), "click": ("O3", "O3.csv"), "purchase": ("CO", "co.csv"), "error": ("Humedad", "HUM.csv")}
OTHERS = ("notas.csv", "signup.csv")
STATIONS = tuple(str(i) for i in range(10))


def _one_file(df: DataFrame, path: str, **options) -> None:
    """A small table as one file of a chosen name."""
    spark = df.sparkSession
    folder = shared_path(spark, "part")
    writer = df.coalesce(1).write.options(**options)
    writer.text(folder) if df.columns == ["value"] else writer.csv(folder)
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    system = path_of(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path_of(path).getParent())
    part = system.globStatus(path_of(f"{folder}/part-*"))[0].getPath()
    if not system.rename(part, path_of(path)):
        raise OSError(f"could not write {path}")


def _write_folder(spark: SparkSession, sf: str) -> str:
    """One wide file per variable: time, then a column per station; and two that are no variables."""
    folder = shared_path(spark, "raw")
    hourly = stored(v.hourly(spark, sf))
    for kind, (_, name) in PLAYED.items():
        wide = hourly.groupBy(ts_text("ts").alias("Fecha")).pivot("station", [int(s) for s in STATIONS]).agg(F.max(kind))
        titled = wide.select("Fecha", *[F.col(s).alias(f" Centro {s} ") for s in STATIONS])
        _one_file(titled, f"{folder}/{name}", header=True, sep=";")
    for name in OTHERS:
        _one_file(hourly.groupBy("station").agg(F.count("signup").alias("n")), f"{folder}/{name}", header=True)
    return folder


_folder = once("folder", _write_folder)


def _values(rows, names: str) -> str:
    return f"SELECT * FROM (VALUES {', '.join(map(str, rows))}) AS t({names})"


@query(
    "read_folder",
    with_sql(
        v.READINGS, v.HOURLY,
        " UNION ALL ".join(
            f"SELECT 'CENTRO ' || station AS station, '{variable}' AS variable, " + s_ts("ts", "ts") + ", "
            + s6(f'"{kind}"', "value") + f' FROM hourly WHERE "{kind}" IS NOT NULL'
            for kind, (variable, _) in PLAYED.items()
        ),
    ),
)
def read_folder(spark, sf):
    """All readings of the recognised files, values as written."""
    found = files.read_folder(spark, _folder(spark, sf)).where("value is not null")
    return found.select(F.upper(F.trim("station")).alias("station"), "variable", ts_text("ts").alias("ts"), r6("value").alias("value"))


@query("recognise_files", _values([(n, f) for n, f in PLAYED.values()], "variable, file"))
def recognise_files(spark, sf):
    """Variable and file of every recognised name, whatever its case and punctuation."""
    return files.recognise_files(files.list_files(spark, _folder(spark, sf))).select("variable", "file")


@query("recognise_exact", _values([("O3", "O3.csv")], "variable, file"))
def recognise_exact(spark, sf):
    """Variable and file of every name written exactly as expected."""
    return files.recognise_exact(files.list_files(spark, _folder(spark, sf))).select("variable", "file")


@query("unrecognised_files", f"SELECT unnest({list(OTHERS)}) AS name")
def unrecognised_files(spark, sf):
    """Files that are no variable's."""
    listed = files.list_files(spark, _folder(spark, sf))
    return quality.unrecognised_files(listed, files.recognise_files(listed)).select("name")


@query("file_listing", f"SELECT unnest({sorted([*OTHERS, *[n for _, n in PLAYED.values()]])}) AS name, true AS has_size")
def file_listing(spark, sf):
    """Names of all files, and whether a size was found."""
    listed = files.file_listing(files.list_files(spark, _folder(spark, sf)))
    return listed.select("name", (F.col("size_kb") > 0).alias("has_size"))


@query("list_csv", f"SELECT unnest({sorted([*OTHERS, *[n for _, n in PLAYED.values()]])}) AS name")
def list_csv(spark, sf):
    """All CSV files below the folder's parent, found recursively, of this folder."""
    folder = _folder(spark, sf)
    paths = files.list_csv(spark, folder)
    return paths.select(F.element_at(F.split("path", "/"), -1).alias("name"))


# -- annotated files ---------------------------------------------------------------------


def _write_annotated(spark: SparkSession, sf: str) -> str:
    """Hours with comments, quoted signs, a repeated header and rows that are too long."""
    path = f"{shared_path(spark, 'annotated')}/norte.csv"
    hourly = v.hourly(spark, sf)
    value = F.coalesce(F.col("view").cast("string"), F.lit(""))
    note = F.concat(F.lit('"station #'), F.col("station").cast("string"), F.lit(', ""north"""'))
    row = F.concat_ws(",", ts_text("ts"), F.col("station").cast("string"), note, value)
    line = F.when(F.hour("ts") == 5, F.concat(row, F.lit(",1,2"))).when(F.hour("ts") == 7, F.concat(row, F.lit(" # checked"))).otherwise(row)
    rows = hourly.select(F.concat(ts_text("ts"), F.col("station").cast("string")).alias("at"), line.alias("value"))
    head = spark.createDataFrame([(" 0", "# hours"), (" 1", "Fecha,station,note,PM25"), ("9", "Fecha,station,note,PM25"), ("9", "#")], "at string, value string")
    ordered = rows.unionByName(head).repartition(1).sortWithinPartitions("at").select("value")
    _one_file(ordered, path)
    return path


_annotated = once("annotated", _write_annotated)


@query(
    "scan_annotated",
    with_sql(
        v.READINGS, v.HOURLY,
        "SELECT " + s_ts("ts", "Fecha") + ", station::VARCHAR AS station, 'station #' || station || ', \"north\"' AS note, "
        + s6('"view"', "PM25") + " FROM hourly WHERE hour(ts) <> 5 "
        "UNION ALL SELECT 'Fecha', 'station', 'note', NULL",
    ),
)
def scan_annotated(spark, sf):
    """The accepted rows of an annotated file; a repeated header line is a row."""
    rows = files.scan_annotated_csv(spark, _annotated(spark, sf))
    return rows.select("Fecha", "station", "note", r6(F.trim("PM25").try_cast("double")).alias("PM25"))


@query(
    "rejected_lines",
    with_sql(v.READINGS, v.HOURLY, "SELECT " + s_ts("ts", "ts") + ", station::VARCHAR AS station, 6 AS n_fields FROM hourly WHERE hour(ts) = 5"),
)
def rejected_lines(spark, sf):
    """Lines with more fields than the header."""
    lines = files.annotated_rows(spark, _annotated(spark, sf))[1]
    part = F.split("line", ",")
    return lines.select(F.get(part, F.lit(0)).alias("ts"), F.get(part, F.lit(1)).alias("station"), "n_fields")


@query("probe_header", "SELECT unnest(['Fecha', 'station', 'note', 'PM25']) AS name")
def probe_header(spark, sf):
    """Column names of the annotated file."""
    return spark.createDataFrame([(c,) for c in files.probe_header(spark, _annotated(spark, sf))], "name string")


@query(
    "file_summary",
    with_sql(
        v.READINGS, v.HOURLY,
        "SELECT true AS ok, count(*) + 1 AS n_rows, 4 AS n_columns, 'Fecha' AS time_column, 'PM25' AS pollutants FROM hourly "
        "WHERE hour(ts) <> 5 UNION ALL SELECT false, NULL, NULL, NULL, ''",
    ),
)
def file_summary(spark, sf):
    """Rows, columns, time column and pollutants per file; a missing file has its row."""
    path = _annotated(spark, sf)
    found = files.summarise_files(spark, [path, f"{path}.missing"])
    return found.select("ok", "n_rows", "n_columns", "time_column", F.array_join("pollutants", ",").alias("pollutants"))


# -- outputs -------------------------------------------------------------------------------


def _write_outputs(spark: SparkSession, sf: str) -> str:
    path = shared_path(spark, "outputs")
    hourly = stored(v.hourly(spark, sf))
    tables.write_dataset(hourly, f"{path}/dataset", target="view")
    tables.write_results(f"{path}/results", {"coverage": hourly.groupBy("station").agg(F.count("view").alias("n"))}, ("csv", "parquet"))
    return path


_outputs = once("outputs", _write_outputs)


@query(
    "write_dataset",
    with_sql(
        v.READINGS, v.HOURLY,
        "SELECT station, " + s_ts("ts", "ts") + ", " + ", ".join(s6(f'"{c}"', f'"{c}"') for c in v.VARIABLES) + " FROM hourly",
    ),
)
def write_dataset(spark, sf):
    """The data set as written by station and read again."""
    back = spark.read.parquet(f"{_outputs(spark, sf)}/dataset/data")
    return back.select(F.col("station").cast("bigint").alias("station"), ts_text("ts").alias("ts"), *[r6(c).alias(c) for c in v.VARIABLES])


@query(
    "written_metadata",
    with_sql(
        v.READINGS, v.HOURLY,
        "SELECT station, count(*) AS n_rows, 'view' AS target, 5 AS n_columns, 'view,click,purchase,signup,error' AS columns "
        "FROM hourly GROUP BY station",
    ),
)
def written_metadata(spark, sf):
    """What the data set's metadata say of each station."""
    back = spark.read.parquet(f"{_outputs(spark, sf)}/dataset/metadata")
    return back.select(F.col("station").cast("bigint").alias("station"), "n_rows", "target", "n_columns", "columns")


@query(
    "write_results",
    with_sql(v.READINGS, v.HOURLY, "SELECT station, count(\"view\") AS n, 2::BIGINT AS kinds FROM hourly GROUP BY station"),
)
def write_results(spark, sf):
    """A result table as written in two kinds and read again."""
    path = f"{_outputs(spark, sf)}/results/coverage"
    text = spark.read.csv(f"{path}.csv", header=True).select(*[F.col(c).cast("bigint").alias(c) for c in ("station", "n")])
    both = text.unionByName(spark.read.parquet(f"{path}.parquet").select(*[F.col(c).cast("bigint").alias(c) for c in ("station", "n")]))
    return both.groupBy("station", "n").agg(F.count(F.lit(1)).alias("kinds"))


@query("model_round_trip", with_sql(v.SERIES, BUILT, "SELECT role, count(*) AS n, true AS same FROM part GROUP BY role"))
def model_round_trip(spark, sf):
    """Rows whose prediction by the saved and loaded model is that of the fitted one."""
    fitted, rows, _ = _fitted(spark, sf)
    path = shared_path(spark, "saved")
    tables.save_model(fitted.model, path, {"roles": rows.groupBy("role").count()})
    loaded, side = tables.load_model(spark, path, ["roles"])
    twice = boosted.predict(loaded, boosted.predict(fitted.model, rows).withColumnRenamed("prediction", "first"))
    compared = twice.groupBy("role").agg(F.count(F.lit(1)).alias("n"), F.min(F.col("first") == F.col("prediction")).alias("same"))
    return compared.join(side["roles"].select("role"), "role")


# -- what columns are for --------------------------------------------------------------------


def _titled(spark, sf) -> DataFrame:
    """The hours with names of a training table."""
    hourly = v.hourly(spark, sf)
    return hourly.select(
        F.col("ts").alias("Timestamp"), F.col("view").alias("PM25"), F.col("click").alias("CO"),
        F.col("purchase").alias("Temperatura"), F.col("signup").alias("PM25_lag_1h"), F.col("error").alias("CONTROL"),
        F.col("station").cast("string").alias("Parroquia"),
    )


@query("numeric_columns", "SELECT unnest(['PM25', 'CO', 'Temperatura', 'PM25_lag_1h', 'CONTROL']) AS name")
def numeric_columns(spark, sf):
    """Columns that hold numbers."""
    return spark.createDataFrame([(c,) for c in schema.numeric_columns(_titled(spark, sf))], "name string")


@query("resolve_features", "SELECT unnest(['Temperatura', 'PM25_lag_1h', 'CONTROL']) AS name")
def resolve_features(spark, sf):
    """Numeric columns that are no pollutant."""
    return spark.createDataFrame([(c,) for c in schema.feature_columns(_titled(spark, sf), "PM25")], "name string")


@query(
    "detect_roles",
    _values(
        [("Timestamp", "time"), ("PM25", "y"), ("CO", "y"), ("Temperatura", "x"), ("PM25_lag_1h", "x"), ("CONTROL", "x")], "name, role"
    ),
)
def detect_roles(spark, sf):
    """Time column, targets and features, found by name and content."""
    df = _titled(spark, sf)
    time = schema.detect_timestamp(df)
    x, y = schema.detect_xy(df, time)
    targets = schema.detect_targets(df.columns)
    rows = [(time, "time"), *[(c, "y") for c in y if c in targets], *[(c, "x") for c in x]]
    return spark.createDataFrame(rows, "name string, role string")


@query(
    "first_values",
    with_sql(
        v.READINGS, v.HOURLY,
        "SELECT 'Timestamp' AS \"column\", least(count(*), 10) AS n, true AS reads FROM hourly UNION ALL "
        "SELECT 'Parroquia', least(count(*), 10), false FROM hourly",
    ),
)
def first_values(spark, sf):
    """Whether the first values of a column read as times, for all columns in one job."""
    df = _titled(spark, sf).select("Timestamp", F.concat(F.lit("Centro "), "Parroquia").alias("Parroquia"))
    return schema.readable_columns(df)


@query(
    "detect_strict",
    _values([("x", "Temperatura"), ("x", "PM25_lag_1h"), ("x", "CONTROL"), *[("y", p) for p in config.POLLUTANTS]], "role, name"),
)
def detect_strict(spark, sf):
    """Features and targets where every pollutant must be there."""
    df = _titled(spark, sf).withColumns({p: F.col("CO") for p in config.POLLUTANTS if p not in ("PM25", "CO")})
    x, y, _ = schema.detect_xy_strict(df, "Timestamp")
    return spark.createDataFrame([("x", c) for c in x] + [("y", c) for c in y], "role string, name string")
