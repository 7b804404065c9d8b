"""Index, categories, ladders, clock features and scores."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from airgrid import config
from airgrid.functions import labels, moments
from airgrid.operators import align, metrics, stats


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x double").select(column(F.col("x")).alias("y")).first()["y"]


INDEX_CASES = [
    ("PM25", 0.0, 0.0), ("PM25", 12.0, 50.0), ("PM25", 12.05, 0.0), ("PM25", 12.1, 51.0),
    ("PM25", 37.4, 100.0), ("PM25", 500.4, 500.0), ("PM25", 501.0, 500.0), ("PM25", -1.0, 0.0),
    ("PM10", 54.5, 0.0), ("CO", 15.5, 201.0), ("SO2", 1004.0, 500.0), ("NO2", 26.5, 25.0),
    ("NO", 5.0, None), ("PM25", None, None),
]


@pytest.fixture(scope="module")
def cases(spark):
    return spark.createDataFrame(
        [(i, p, c) for i, (p, c, _) in enumerate(INDEX_CASES)], "i int, p string, c double"
    )


@pytest.mark.parametrize("form", ["chain", "join"])
def test_index_with_its_holes(cases, form):
    if form == "chain":
        got = cases.withColumn("air_index", labels.air_index(F.col("p"), F.col("c")))
    else:
        got = align.index_by_range(cases, "p", "c")
    rows = got.orderBy("i").collect()
    assert len(rows) == len(INDEX_CASES)
    for row, (_, _, wanted) in zip(rows, INDEX_CASES):
        assert row["air_index"] == (pytest.approx(wanted) if wanted is not None else None)


def test_index_by_name_equals_index_by_column(cases):
    got = cases.filter("p = 'PM25'").select(
        labels.air_index("PM25", F.col("c")).alias("a"), labels.air_index(F.col("p"), F.col("c")).alias("b")
    )
    assert all(r["a"] == r["b"] for r in got.collect())


def test_index_rises_inside_segments_and_stays_on_its_scale(spark):
    for pollutant, parts in config.INDEX_SEGMENTS.items():
        for c_lo, c_hi, _, _ in parts:
            points = [c_lo + (c_hi - c_lo) * k / 10 for k in range(10)] + [c_hi]
            df = spark.createDataFrame([(x,) for x in points], "x double").coalesce(1)
            got = [r["y"] for r in df.select(labels.air_index(pollutant, F.col("x")).alias("y")).collect()]
            assert got == sorted(got) and 0 <= got[0] and got[-1] <= 500


@pytest.mark.parametrize(
    "index, label",
    [(0.0, "Deseable"), (50.0, "Deseable"), (50.5, "Emergencia"), (51.0, "Aceptable"),
     (300.0, "Alarma"), (500.0, "Emergencia"), (None, None)],
)
def test_category(spark, index, label):
    assert one(spark, index, labels.air_category) == label


def test_continuous_index(spark):
    for value, wanted in ((0.0, 0.0), (15.0, 50.0), (20.0, 75.0), (50.0, 200.0), (50.1, 500.0), (-3.0, -10.0)):
        got = one(spark, value, lambda x: labels.air_index_continuous("PM25", x))
        assert got == pytest.approx(wanted)
    assert one(spark, 200.5, labels.air_category_continuous) == "🟣 Alarma"
    assert one(spark, 301.0, labels.air_category_continuous) == "🟤 Emergencia"


def test_ladders(spark):
    assert one(spark, 12.0, lambda x: labels.aqi_label("PM25", x)) == "🟢 Buena"
    assert one(spark, 1e9, lambda x: labels.aqi_label("CO", x)) == "🔴 Insalubre"
    assert one(spark, 1.0, lambda x: labels.aqi_label("NO", x)) == config.AQI_UNKNOWN
    assert one(spark, 355.0, lambda x: labels.aqi_icon("PM10", x)) == "🟣"
    assert one(spark, 56.0, labels.pm25_quality) == "🔴 Insalubre"
    assert one(spark, 0.7, labels.r2_level) == "Bueno"
    assert one(spark, 0.49, labels.r2_level) == "Mejorable"
    assert one(spark, 700.0, labels.gauge_pointer) == 100.0
    assert one(spark, -4.0, labels.clip_non_negative) == 0.0


def test_clock_and_wind(spark):
    saturday = dt.datetime(2024, 3, 9, 6, 30)
    df = spark.createDataFrame([(saturday, 2.0, 90.0)], "ts timestamp_ntz, v double, d double")
    row = df.select(
        *[c.alias(n) for n, c in moments.cyclic_columns(F.col("ts")).items()],
        moments.cyclic_columns(F.col("ts"), minutes=True)["hora_sin"].alias("fine"),
        *[c.alias(n) for n, c in moments.weekday_columns(F.col("ts")).items()],
        *[c.alias(n) for n, c in moments.wind_columns(F.col("v"), F.col("d")).items()],
    ).first()
    assert row["hora_sin"] == pytest.approx(1.0)
    assert row["fine"] == pytest.approx(math.sin(2 * math.pi * 6.5 / 24))
    assert row["mes_sin"] == pytest.approx(1.0)
    assert (row["dia_semana"], row["es_finde"]) == (5, 1)
    assert row["wind_u"] == pytest.approx(0.0, abs=1e-12) and row["wind_v"] == pytest.approx(2.0)


def test_hours_between_counts_fractions(spark):
    pair = (dt.datetime(2024, 1, 31, 23, 30), dt.datetime(2024, 2, 2, 0, 0, 0, 500000))
    df = spark.createDataFrame([pair], "a timestamp_ntz, b timestamp_ntz")
    got = df.select(moments.hours_between(F.col("a"), F.col("b")).alias("h")).first()["h"]
    assert got == pytest.approx((pair[1] - pair[0]).total_seconds() / 3600)


def test_regression_metrics(spark):
    rows = [("perfect", 1.0, 1.0), ("perfect", 2.0, 2.0), ("flat", 3.0, 1.0), ("flat", 3.0, 5.0),
            ("met", 3.0, 3.0), ("met", 3.0, 3.0), ("single", 1.0, 2.0), ("gap", None, 1.0),
            ("gap", 1.0, None), ("gap", 1.0, 2.0), ("gap", 2.0, 2.0)]
    df = spark.createDataFrame(rows, "k string, y double, yhat double")
    got = {r["k"]: r for r in metrics.regression_metrics(df, ("k",)).collect()}
    assert got["perfect"]["r2"] == 1.0 and got["perfect"]["mae"] == 0.0
    assert got["flat"]["r2"] == 0.0 and got["flat"]["rmse"] == 2.0
    assert got["met"]["r2"] == 1.0
    assert got["single"]["n"] == 1 and got["single"]["r2"] is None and got["single"]["mae"] is None
    assert got["gap"]["n"] == 2 and got["gap"]["r2"] == pytest.approx(1 - 1 / 0.5)


def test_curves_are_cut_to_the_shortest(spark):
    curves = [("t", f, s, i, float(abs(i - 2) + f)) for f, n in ((1, 6), (2, 4))
              for s in ("train", "val") for i in range(n)]
    df = spark.createDataFrame(curves, "target string, fold int, split string, iter int, score double")
    summary = metrics.curve_summary(df)
    assert summary.agg(F.max("iter")).first()[0] == 3
    best = metrics.best_rounds(summary)
    assert best.first()["best_iter"] == 2
    assert metrics.best_rounds(summary, highest=True).first()["best_iter"] == 0
    final = metrics.final_rounds(best, 80).first()
    assert (final["best_rounds"], final["final_rounds"]) == (60, 80)


def test_importance_share(spark):
    rows = [(f"f{i:02d}", 12.0 - i) for i in range(12)] + [("bad", -1.0)]
    df = spark.createDataFrame(rows, "feature string, importance double")
    got = {r["feature"]: r for r in stats.importance_share(df).collect()}
    assert len(got) == 11 and got["Otros (2)"]["importance"] == 3.0
    assert sum(r["share"] for r in got.values()) == pytest.approx(1.0)
    assert [r["feature"] for r in stats.importance_ranking(df, 2).collect()] == ["f00", "f01"]


def test_scaler_and_back(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    facts = stats.scaler_stats(df, ["a", "b"])
    row = facts.first()
    assert (row["mu_a"], row["sd_a"], row["sd_b"]) == (2.0, 1.0, 1.0)
    scaled = df.join(facts.hint("broadcast")).select(
        stats.standardise("a").alias("z"), stats.unstandardise(stats.standardise("a"), "a").alias("a")
    )
    assert [tuple(r) for r in scaled.collect()] == [(-1.0, 1.0), (1.0, 3.0)]


def test_columns_with_holes_and_a_constant_are_correlated(spark):
    df = spark.range(50).select(
        *[(F.col("id") * (i + 1) % 7).cast("double").alias(f"c{i}") for i in range(7)],
        F.when(F.col("id") % 3 > 0, F.col("id").cast("double")).alias("holes"),
    )
    got = stats.pearson_matrix(df, df.columns).collect()
    assert len(got) == 8 * 7 // 2
    wanted = df.toPandas().corr()
    for row in got:
        r = wanted.loc[row["col_a"], row["col_b"]]
        assert row["r"] is None if math.isnan(r) else row["r"] == pytest.approx(r)
    assert sum(r["r"] is None for r in got) == 7  # c6 is constant


def test_sample_does_not_depend_on_partitioning(spark):
    a = stats.sample_rows(spark.range(1000).repartition(7), ["id"], 50).collect()
    b = stats.sample_rows(spark.range(1000).coalesce(1), ["id"], 50).collect()
    assert a == b and len(a) == 50
