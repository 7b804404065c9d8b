"""Values, rows, completeness and audit on literal frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from airgrid import config
from airgrid.functions import text, values
from airgrid.operators import align, quality
from airgrid.plans.cleaning import clean_readings

HOUR = dt.timedelta(hours=1)


def column(df, name):
    return [r[name] for r in df.collect()]


def test_ranges_include_both_ends(spark):
    rows = [("PM25", x) for x in (0.0, 400.0, -0.1, 400.1, -999.0, float("nan"), None)]
    rows += [("otra", 1e6), ("otra", -9999.0), ("Temperatura", -10.0)]
    df = spark.createDataFrame(rows, "variable string, value double")
    cleaned = quality.clean_values(df)
    assert column(cleaned, "clean_value") == [0.0, 400.0] + [None] * 5 + [1e6, None, -10.0]
    counts = {r["variable"]: r["n_nulled"] for r in quality.anomaly_count(cleaned).collect()}
    assert counts["PM25"] == 4  # NaN counts as nulled, it was no NULL before


def test_casts(spark):
    texts = ["1.5", " 2 ", "12,5", "NaN", "1d", "", None, "-3e2"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = column(df.select(values.to_number(F.col("t")).alias("x")), "x")
    assert got == [1.5, 2.0, None, None, None, None, None, -300.0]
    times = ["2004-01-01 00:00", "2004/1/2 3:04", "12/31/2019 23:00", "ayer", "2020-13-01", None]
    df = spark.createDataFrame([(t,) for t in times], "t string")
    got = column(df.select(values.to_time(F.col("t")).alias("x")), "x")
    assert got == [
        dt.datetime(2004, 1, 1), dt.datetime(2004, 1, 2, 3, 4), dt.datetime(2019, 12, 31, 23),
        None, None, None,
    ]
    df = spark.createDataFrame([(1704067200.5,)], "s double")
    assert column(df.select(values.epoch_to_time(F.col("s")).alias("x")), "x") == [
        dt.datetime(2024, 1, 1, 0, 0, 0, 500000)
    ]


def test_times_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([("2024-03-10 02:30",)], "t string")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = df.select(values.to_time(F.col("t")).alias("x")).select(
            values.hour_of(F.col("x")).alias("h")
        ).first()
        assert row["h"] == dt.datetime(2024, 3, 10, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_period_ends_at_midnight_of_the_last_day(spark):
    start = dt.datetime(2021, 12, 30, 22)
    df = spark.createDataFrame([(start + i * HOUR,) for i in range(60)], "ts timestamp_ntz")
    kept = sorted(column(quality.exclude_period(df), "ts"))
    last_day = [t for t in kept if t.date() == dt.date(2021, 12, 31)]
    assert len(last_day) == 23 and last_day[0].hour == 1
    assert all(t.year == 2022 for t in column(quality.exclude_years(df), "ts"))


def test_unit_rows(spark):
    rows = ["ug/m3", "°C", "Unidad", "2020-08-01", "01-Aug-2020", None, "50 %"]
    df = spark.createDataFrame([(r,) for r in rows], "Fecha string")
    assert column(align.drop_unit_rows(df, "Fecha"), "Fecha") == ["2020-08-01", None]


def test_require_any_needs_two_columns(spark):
    df = spark.createDataFrame([(None, None), (1.0, None)], "PM25 double, O3 double")
    assert quality.require_any(df, ["PM25", "O3"]).count() == 1
    assert quality.require_any(df, ["PM25", "CO"]).count() == 2


def test_match_station(spark):
    headers = spark.createDataFrame(
        [(" El Camal ", 0), ("CAMAL", 1), ("Los Chillos", 2)], "name string, at int"
    )
    searches = spark.createDataFrame([("camal ",), ("chillo",), ("norte",)], "search string")
    got = {
        r["search"]: (r["matched"], r["kind"])
        for r in align.match_station(searches, headers, "search", "name", "at").collect()
    }
    assert got == {
        "camal ": ("CAMAL", "exact"),
        "chillo": ("Los Chillos", "partial"),
        "norte": (None, "missing"),
    }


def test_match_station_lists_searched_lengths_only(spark):
    """Of a header's substrings those of a searched length, the blank one included where it is searched."""
    df = spark.createDataFrame([("ABAB",), ("",)], "name string")
    listed = [sorted(r["s"]) for r in df.select(align._substrings(F.col("name"), [0, 2, 9]).alias("s")).collect()]
    assert listed == [["", "AB", "BA"], [""]]
    headers = spark.createDataFrame(
        [("Norte 1", 3), ("norte 1", 1), ("Sur", None), ("Centro", 2), (None, 0), (" ", 4)], "name string, at int"
    )
    searches = spark.createDataFrame([("NORTE 1",), ("te",), ("r",), (" ",), ("sur",), (None,)], "search string")
    few = align.TASK_NAMES
    try:
        align.TASK_NAMES = 1
        got = align.match_station(searches, headers, "search", "name", "at").collect()
    finally:
        align.TASK_NAMES = few
    assert {r["search"]: (r["matched"], r["kind"]) for r in got} == {
        "NORTE 1": ("norte 1", "exact"), "te": ("norte 1", "partial"), "r": ("norte 1", "partial"),
        " ": ("norte 1", "partial"), "sur": (None, "missing"), None: (None, "missing"),
    }


def test_alignment_is_outer_and_keeps_the_first_arrival(spark):
    t = dt.datetime(2020, 5, 1)
    rows = [
        ("s", "PM25", t, 9.0, 5), ("s", "PM25", t, 1.0, 2), ("s", "O3", t + HOUR, 3.0, 1),
        ("s", "CO", t + 2 * HOUR, 4.0, 9),
    ]
    df = spark.createDataFrame(
        rows, "station string, variable string, ts timestamp_ntz, value double, arrival bigint"
    )
    got = align.align(df, ["PM25", "O3"]).orderBy("ts").collect()
    assert [(r["ts"], r["PM25"], r["O3"]) for r in got] == [(t, 1.0, None), (t + HOUR, None, 3.0)]
    chained = (
        df.filter("variable = 'PM25'").groupBy("station", "ts").agg(F.min_by("value", "arrival").alias("PM25"))
        .join(
            df.filter("variable = 'O3'").select("station", "ts", F.col("value").alias("O3")),
            ["station", "ts"], "full",
        )
    )
    assert sorted(map(str, chained.collect())) == sorted(map(str, got))


def silent_rows(n):
    """One reporting hour, ``n`` silent ones, one reporting hour."""
    t = dt.datetime(2020, 1, 1)
    values_ = [1.0] + [None] * n + [2.0]
    return [("s", t + i * HOUR, v, v) for i, v in enumerate(values_)]


@pytest.mark.parametrize("n, dropped", [(25, 0), (26, 26)])
def test_gap_must_be_longer_than_24_hours(spark, n, dropped):
    df = spark.createDataFrame(
        silent_rows(n), "station string, ts timestamp_ntz, PM25 double, O3 double"
    )
    assert quality.drop_long_gaps(df, ["PM25", "O3"]).count() == n + 2 - dropped


def test_rule_order_decides_who_removes_a_silent_row(spark):
    df = spark.createDataFrame(
        silent_rows(30), "station string, ts timestamp_ntz, PM25 double, O3 double"
    )
    period = ("2019-01-01", "2019-01-02")

    def audit(rules):
        tagged = quality.tag_removals(df, rules=rules, period=period)
        return {r["stage"]: r["n_rows"] for r in quality.removal_audit(tagged, rules).collect()}

    assert audit(quality.DEFAULT_RULES) == {
        "period": 0, "target": 30, "any": 0, "gap": 0, "kept": 2
    }
    assert audit((quality.GAP, quality.TARGET)) == {"gap": 30, "target": 0, "kept": 2}


def test_audit_adds_up(spark):
    df = spark.createDataFrame(
        silent_rows(30), "station string, ts timestamp_ntz, PM25 double, O3 double"
    )
    audit = quality.removal_audit(quality.tag_removals(df)).collect()
    assert sum(r["n_rows"] for r in audit) == 32
    assert sum(r["pct"] for r in audit) == pytest.approx(100)


def test_completeness(spark):
    rows = [("A", v, 1.0) for v in config.VARIABLES[:-1]]
    rows += [("B", "PM25", 1.0), ("B", "O3", None), ("A", "ruido", 5.0)]
    df = spark.createDataFrame(rows, "station string, variable string, value double")
    got = {r["station"]: r for r in quality.completeness(df).collect()}
    assert got["A"]["eligible"] and got["A"]["missing"] == ["Precipitacion"]
    assert got["A"]["present"] == list(config.VARIABLES[:-1])
    assert not got["B"]["eligible"] and got["B"]["n_present"] == 1


def test_names(spark):
    df = spark.createDataFrame(
        [(" Año 1/x.PKL",), ("...",), ("",), (None,), ("a-b.c",)], "n string"
    )
    got = df.select(
        text.safe_model_name(F.col("n"), "m").alias("m"),
        text.safe_dataset_name(F.col("n"), "d").alias("d"),
    ).collect()
    assert [r["m"] for r in got] == ["Año_1_x", "m", "m", "m", "a-b.c"]
    assert [r["d"] for r in got] == ["Año_1_x_PKL", "d", "d", "d", "a-b_c"]
    files = spark.createDataFrame([("/x/belisario_norte.v2.csv",)], "f string")
    assert files.select(text.station_from_file(F.col("f")).alias("s")).first()["s"] == "Belisario Norte.V2"
    names = spark.createDataFrame([("PM25_lag_24h",), ("hora_cos",)], "f string")
    got = names.select(text.lag_base(F.col("f")).alias("b"), text.lag_hours(F.col("f")).alias("h")).collect()
    assert [tuple(r) for r in got] == [("PM25", 24), (None, None)]


def test_clean_readings(spark):
    t = dt.datetime(2019, 12, 30)
    rows, arrival = [], 0
    for i in range(24 * 6):
        for variable in config.VARIABLES:
            value = 20.0 + i % 7
            if variable == "PM25" and i % 50 == 3:
                value = -999.0
            rows.append(("CENTRO", variable, t + i * HOUR, value, arrival))
            arrival += 1
    df = spark.createDataFrame(
        rows, "station string, variable string, ts timestamp_ntz, value double, arrival bigint"
    )
    out = clean_readings(df)
    audit = {r["stage"]: r["n_rows"] for r in out.audit.collect()}
    assert audit == {"period": 96, "target": 1, "any": 0, "gap": 0, "kept": 47}
    assert out.dataset.count() == 47
    assert out.dataset.filter("PM25 is null").count() == 0
    assert {"PM25_lag_24h", "hora_sin", "mes_cos"} <= set(out.dataset.columns)
    assert out.dataset.filter("PM25_lag_24h is not null").count() == 23
    anomalies = {r["variable"]: r["n_nulled"] for r in out.anomalies.collect()}
    assert anomalies["PM25"] == 3
    assert out.completeness.first()["eligible"]
    exact = clean_readings(df, exclude=False, exact_times=True)
    assert exact.dataset.count() == 24 * 6 - 3
