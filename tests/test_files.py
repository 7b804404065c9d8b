"""Files in, tables out, and what columns are for."""

import datetime as dt
import math
import random

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from airgrid import config
from airgrid.models import boosted
from airgrid.operators import quality, schema, stats
from airgrid.plans import training
from airgrid.sources import files, tables


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "pm2.5.CSV").write_text(
        "fecha;Centro ;El Camal\nug/m3;x;y\n2020-01-01 00:00;1.5;2\n2020-01-01 01:00;NaN;12,5\n"
        "malo;1;1\n2020-01-01 02:00;-999;7\n", encoding="utf-8"
    )
    (tmp_path / "HUM.csv").write_text("Date,CENTRO\n2020-01-01 00:00,55\n", encoding="utf-8")
    (tmp_path / "temperatura.csv").write_text("t\tCentro\n2020/1/1 0:00\t11\n", encoding="utf-8")
    (tmp_path / "notas.csv").write_text("a,b\n1,2\n", encoding="utf-8")
    (tmp_path / "CO.xlsx").write_bytes(b"x" * 2048)
    (tmp_path / "leeme.txt").write_text("x")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "PM25.csv").write_text("a,b\n1,2\n", encoding="utf-8")
    return tmp_path


def test_recognition(spark, folder):
    found = files.list_files(spark, str(folder))
    named = {r["variable"]: r["file"] for r in files.recognise_files(found).collect()}
    assert named == {
        "PM25": "pm2.5.CSV", "Humedad": "HUM.csv", "Temperatura": "temperatura.csv", "CO": "CO.xlsx"
    }
    exact = {r["variable"] for r in files.recognise_exact(found).collect()}
    assert exact == {"CO"}
    lost = quality.unrecognised_files(found, files.recognise_files(found))
    assert [r["name"] for r in lost.collect()] == ["notas.csv"]
    expected = spark.createDataFrame([(v,) for v in config.FILE_NAMES], "variable string")
    status = {r["variable"]: r["status"] for r in quality.file_status(expected, files.recognise_files(found)).collect()}
    assert status["CO"] == "Cargado" and status["O3"] == "No encontrado" and len(status) == 11


def test_listings(spark, folder):
    sizes = files.file_listing(files.list_files(spark, str(folder))).collect()
    assert [r["name"] for r in sizes] == ["CO.xlsx", "HUM.csv", "notas.csv", "pm2.5.CSV", "temperatura.csv"]
    assert sizes[0]["size_kb"] == 2.0
    paths = [r["path"] for r in files.list_csv(spark, str(folder)).collect()]
    assert len(paths) == 5 and paths == sorted(paths) and any("/sub/" in p for p in paths)


def test_readings_of_a_folder(spark, folder):
    readings = files.read_folder(spark, str(folder))
    rows = {(r["station"], r["variable"], r["ts"].hour): r["value"] for r in readings.collect()}
    assert rows == {
        ("CENTRO", "PM25", 0): 1.5, ("EL CAMAL", "PM25", 0): 2.0,
        ("CENTRO", "PM25", 1): None, ("EL CAMAL", "PM25", 1): None,
        ("CENTRO", "PM25", 2): -999.0, ("EL CAMAL", "PM25", 2): 7.0,
        ("CENTRO", "Humedad", 0): 55.0, ("CENTRO", "Temperatura", 0): 11.0,
    }
    assert sorted(r["station"] for r in quality.list_stations(readings).collect()) == ["CENTRO", "EL CAMAL"]


def test_separators():
    assert files.sniff_separator("a;b") == ";" and files.sniff_separator("a\tb") == "\t"
    assert files.sniff_separator('"x;y",b') == ","
    with pytest.raises(ValueError):
        files.sniff_separator("solo")


def test_annotated_csv(spark, tmp_path):
    path = tmp_path / "belisario.csv"
    path.write_text(
        "# hecho hoy\n#\nTimestamp,PM25,Humedad\n2020-01-01 00:00,1.5,50 # nota\n"
        "2020-01-01 01:00,2.5\n2020-01-01 02:00,1,2,3\n\n2020-01-01 03:00,,60\n", encoding="utf-8"
    )
    assert files.probe_header(spark, str(path)) == ["Timestamp", "PM25", "Humedad"]
    df = files.scan_annotated_csv(spark, str(path))
    rows = [tuple(x.strip() if x else x for x in r) for r in df.collect()]
    assert rows == [
        ("2020-01-01 00:00", "1.5", "50"), ("2020-01-01 01:00", "2.5", None), ("2020-01-01 03:00", None, "60")
    ]
    assert schema.detect_timestamp(df) == "Timestamp"


def test_annotated_csv_with_quotes(spark, tmp_path):
    path = tmp_path / "a.csv"
    lines = [
        "# made today, with \"quotes\"", "ts,note,x", '2020-01-01 00:00,"a#b",1 # cut', "ts,note,x", 'a"b#c,d,2',
        '2020-01-01 01:00,"say ""#1"", please",3', '"x#y,z', "1,2,3,4", 'p,"q,r",5,6,7', "q,,", "#", "  # only a comment",
    ]
    path.write_text("\n".join(lines), encoding="utf-8")
    rows, rejected = files.annotated_rows(spark, str(path))
    assert [tuple(r) for r in rows.collect()] == [
        ("2020-01-01 00:00", "a#b", "1 "), ("ts", "note", "x"), ('a"b', None, None),
        ("2020-01-01 01:00", 'say "#1", please', "3"), ("x#y,z", None, None), ("q", None, None),
    ]
    assert [(r["line"], r["n_fields"]) for r in rejected.orderBy("at").collect()] == [("1,2,3,4", 4), ('p,"q,r",5,6,7', 5)]
    typed = files.typed_columns(rows, "ts", ()).collect()
    assert [(r["ts"], r["x"]) for r in typed] == [(dt.datetime(2020, 1, 1, 0), 1.0), (dt.datetime(2020, 1, 1, 1), 3.0)]


def test_dataset_round_trip(spark, tmp_path):
    start = dt.datetime(2020, 1, 1)
    rows = [(s, start + dt.timedelta(hours=i), float(i), None) for s in ("a", "b") for i in range(30)]
    df = spark.createDataFrame(rows, "station string, ts timestamp_ntz, PM25 double, O3 double")
    tables.write_dataset(df, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out" / "data"))
    assert sorted(map(str, back.select(*df.columns).collect())) == sorted(map(str, df.collect()))
    meta = spark.read.parquet(str(tmp_path / "out" / "metadata")).orderBy("station").collect()
    assert (meta[0]["n_rows"], meta[0]["columns"], meta[0]["n_columns"]) == (30, "PM25,O3", 2)
    tables.write_dataset(df, str(tmp_path / "csv"), kind="csv")
    text = spark.read.csv(str(tmp_path / "csv" / "data"), header=True)
    assert text.filter("station = 'a'").agg(F.max("ts")).first()[0] == "2020-01-02 05:00"
    tables.write_results(str(tmp_path / "res"), {"m": df.select("station", "PM25")}, ("csv", "parquet"))
    assert spark.read.parquet(str(tmp_path / "res" / "m.parquet")).count() == 60
    assert tables.preview(df, n=3).collect()[0]["ts"] == "2020-01-01 00:00:00"


def test_model_round_trip(spark, tmp_path):
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(
        spark.range(60).select(F.col("id").cast("double").alias("x"), (F.col("id") % 9).cast("double").alias("label"))
    )
    model = boosted.fit_boosted(df, None, boosted.BoostParams(rounds=2, depth=2)).model
    tables.save_model(model, str(tmp_path / "m"), {"means": df.select("x").agg(F.avg("x").alias("x"))})
    loaded, side = tables.load_model(spark, str(tmp_path / "m"), ["means"])
    both = [[r["prediction"] for r in m.transform(df).orderBy("x").collect()] for m in (model, loaded)]
    assert both[0] == both[1] and len(set(both[0])) > 1 and side["means"].first()["x"] == 29.5


# -- schema ----------------------------------------------------------------------------


def header(spark, names, types=None):
    types = types or {}
    return spark.createDataFrame([], ", ".join(f"`{n}` {types.get(n, 'double')}" for n in names))


def test_schema_detection(spark):
    names = ["Timestamp", *config.POLLUTANTS, "hora_cos", "PM25_lag_1h", "Temperatura", "nota", "CONTROL"]
    df = header(spark, names, {"Timestamp": "timestamp_ntz", "nota": "string"})
    x, y = schema.detect_xy(df, "Timestamp")
    assert y == list(config.POLLUTANTS) and x == ["hora_cos", "PM25_lag_1h", "Temperatura", "CONTROL"]
    x, y, lags = schema.detect_xy_strict(df, "Timestamp")
    assert x == ["Temperatura", "hora_cos", "PM25_lag_1h", "CONTROL"] and lags == [("PM25_lag_1h", "PM25")]
    assert schema.feature_columns(df, "PM25") == ["hora_cos", "PM25_lag_1h", "Temperatura", "CONTROL"]
    roles = {r["column"]: r["role"] for r in schema.column_roles(df, "Timestamp").collect()}
    assert roles["Timestamp"] == "time" and roles["nota"] == "other" and roles["CO"] == "y"
    with pytest.raises(schema.SchemaError):
        schema.detect_xy_strict(header(spark, ["PM25", "Temperatura"]))
    with pytest.raises(schema.SchemaError):
        schema.detect_xy_strict(header(spark, list(config.POLLUTANTS)))
    assert schema.detect_targets(["CO", "PM25"]) == ["PM25", "CO"]
    assert schema.detect_targets(["x"]) == list(config.POLLUTANTS)
    assert schema.detect_targets(["x"], fallback=["PM25"]) == ["PM25"]


@pytest.mark.parametrize(
    "name, relation",
    [("PM25_lag_1h", "prefijo"), ("hora_cos", "silencio"), ("pm25", "exacto"), ("CONTROL", "silencio"),
     ("NO23", "prefijo"), ("SO2.x", "prefijo")],
)
def test_name_relation(name, relation):
    assert schema.name_relation(name, config.POLLUTANTS) == relation


def test_timestamp_by_content(spark):
    df = spark.createDataFrame([("x", "2020-01-01 10:00"), ("y", None)], "a string, b string")
    assert schema.detect_timestamp(df) == "b"
    assert schema.detect_timestamp(df.select("a")) is None


def test_timestamp_by_content_takes_one_job(spark):
    rows = [(None if i < 500 else f"2020-01-0{i % 9 + 1}", str(i), "x" if i == 3 else "2020-01-01", None) for i in range(1000)]
    df = spark.createDataFrame(rows, "late string, number string, nearly string, empty string").repartition(6)
    found = {r["column"]: (r["n"], r["reads"]) for r in schema.readable_columns(df).collect()}
    assert found["late"] == (10, True) and "empty" not in found and found["number"][0] == 10
    assert schema.detect_timestamp(df) == "late"

    def jobs(frame, group):
        spark.sparkContext.setJobGroup(group, "")
        try:
            schema.detect_timestamp(frame)
            return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        finally:
            spark.sparkContext.setJobGroup("", "")

    wide = df.select("nearly", *[F.col("number").alias(f"n{i}") for i in range(30)])
    assert jobs(wide, "wide") <= 5 and jobs(df.select("nearly"), "narrow") <= 5  # however many columns


def test_coordinates_by_name(spark):
    df = spark.createDataFrame([(1.0, 2.0, 10.0), (1.0, 2.0, 20.0), (3.0, 4.0, 8.0)], "Latitud double, LNG double, PM25 double")
    got = {(r["Latitud"], r["LNG"]): r["mean"] for r in stats.geo_mean_by_name(df, "PM25", "PM25").collect()}
    assert got == {(1.0, 2.0): 15.0, (3.0, 4.0): 8.0}
    assert stats.geo_mean_by_name(df.drop("LNG"), "PM25", "PM25").collect() == []


def test_from_annotated_file_to_model(spark, tmp_path):
    rng = random.Random(4)
    lines = ["# station file", "Fecha,PM25,O3,Temperatura,nota"]
    for i in range(420):
        at = dt.datetime(2022, 1, 1) + dt.timedelta(hours=i)
        warm = 15 + 8 * math.sin(i / 24 * 2 * math.pi)
        lines.append(f'{at:%Y-%m-%d %H:%M},{20 + warm + rng.random():.3f},{rng.randint(5, 50)},{warm:.2f},"a#{i}" # x')
    lines.insert(50, "malo,1,2,3,4")
    path = tmp_path / "el_camal.csv"
    path.write_text("\n".join(lines), encoding="utf-8")
    table = training.read_training_csv(spark, str(path))
    assert table.columns == ["station", "ts", "PM25", "O3", "Temperatura", "nota"] and table.count() == 420
    assert table.first()["station"] == "El Camal" and dict(table.dtypes)["PM25"] == "double"
    quick = boosted.BoostParams(rounds=6, depth=3, rate=0.5)
    settings = {"top": 10, "folds": 2, "params": quick, "repeats": 1, "pollutants": ("PM25", "O3")}
    out = training.train(table.drop("nota"), "PM25", **settings)
    assert {r["part"] for r in out.scores.collect()} == {"train", "test"}
    summary = files.summarise_files(spark, [str(path), str(tmp_path / "missing.csv")]).collect()
    assert (summary[0]["ok"], summary[0]["n_rows"], summary[0]["time_column"]) == (True, 421, "Fecha")
    assert summary[0]["pollutants"] == ["PM25", "O3"] and summary[0]["n_columns"] == 5
    assert not summary[1]["ok"] and summary[1]["message"] and len(summary[1]["targets"]) == 6
