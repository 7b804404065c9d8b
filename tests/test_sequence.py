"""Ordered operators against pandas, cut small so that many cells and blocks meet."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from airgrid.operators import features, fills, quality, sequence, splits, stats
from airgrid.session import broadcast_bytes, stored

START = dt.datetime(2019, 11, 3)


@pytest.fixture(scope="module")
def rows():
    """Three series; ``hot`` holds most rows, with holes of days and months."""
    random.seed(7)
    out = []
    for station, hours in (("hot", 4000), ("a", 90), ("b", 1)):
        at = START
        for _ in range(hours):
            at += dt.timedelta(hours=random.choice([1, 1, 1, 1, 2, 30]))
            value = None if random.random() < 0.3 else round(random.uniform(0, 50), 2)
            out.append((station, at, value))
    return out


@pytest.fixture(scope="module")
def frame(spark, rows):
    shuffled = random.Random(1).sample(rows, len(rows))
    return spark.createDataFrame(shuffled, "station string, ts timestamp_ntz, value double")


@pytest.fixture(scope="module")
def expected(rows):
    return pd.DataFrame(rows, columns=["station", "ts", "value"]).sort_values(["station", "ts"])


def collected(df):
    pdf = df.orderBy("station", "ts").toPandas()
    pdf["ts"] = pd.to_datetime(pdf["ts"])
    return pdf.reset_index(drop=True)


def same(left, right):
    pd.testing.assert_series_equal(
        left.reset_index(drop=True).astype(float),
        right.reset_index(drop=True).astype(float),
        check_names=False,
        rtol=1e-9,
        atol=1e-9,
    )


def test_positions(frame, expected):
    got = collected(sequence.with_position(frame, ["station"], "ts"))
    same(got["pos"], expected.groupby("station").cumcount() + 1)
    same(got["n_rows"], expected.groupby("station")["ts"].transform("size"))


@pytest.mark.parametrize("block_rows", [24, 100, sequence.BLOCK_ROWS])
def test_row_windows(frame, expected, block_rows):
    def build(w):
        return {
            **features.lag_columns("value", (1, 24), w),
            **features.rolling_columns("value", (3, 24), (6, 24), w),
            **features.diff_columns("value", (12,), w),
        }

    got = collected(
        sequence.over_rows(frame, ["station"], "ts", 24, build, block_rows=block_rows)
    )
    assert len(got) == len(expected)
    series = expected.groupby("station")["value"]
    same(got["value_lag_1h"], series.shift(1))
    same(got["value_lag_24h"], series.shift(24))
    same(got["value_diff_12h"], series.diff(12))
    for n in (3, 24):
        same(got[f"value_roll_mean_{n}h"], series.transform(lambda s: s.rolling(n, 1).mean()))
    for n in (6, 24):
        same(got[f"value_roll_std_{n}h"], series.transform(lambda s: s.rolling(n, 2).std()))


def test_rolling_without_current_row(frame, expected):
    got = collected(features.add_rolling(frame, ["value"], (24,), (6,), exclude_current=True))
    series = expected.groupby("station")["value"]
    same(
        got["value_roll_mean_24h"],
        series.transform(lambda s: s.shift(1).rolling(24, 1).mean()),
    )


def test_reach_must_fit_a_block(frame):
    with pytest.raises(ValueError):
        sequence.over_rows(frame, ["station"], "ts", 25, lambda w: {}, block_rows=24)


def test_fills(frame, expected):
    series = expected.groupby("station")["value"]
    same(collected(fills.forward_fill(frame, ["value"]))["value"], series.ffill())
    same(collected(fills.backward_fill(frame, ["value"]))["value"], series.bfill())
    both = series.transform(lambda s: s.ffill().bfill()).fillna(0.0)
    same(collected(fills.impute_temporal(frame, ["value"]))["value"], both)


def test_exact_median(frame, expected):
    got = fills.exact_medians(frame, ["value"], ["station"]).toPandas().set_index("station")
    for station, median in expected.groupby("station")["value"].median().dropna().items():
        assert got.loc[station, "value"] == pytest.approx(median, abs=0)


def test_median_of_equal_values(spark):
    df = spark.createDataFrame([("a", 2.0)] * 5 + [("b", 1.0), ("b", 4.0)], "station string, x double")
    got = {r["station"]: r["x"] for r in fills.exact_medians(df, ["x"], ["station"]).collect()}
    assert got == {"a": 2.0, "b": 2.5}


def brute_gaps(expected, hours):
    out = []
    for station, part in expected.groupby("station"):
        silent = part["value"].isna()
        block = (silent != silent.shift()).cumsum()
        for _, run in part[silent].groupby(block[silent]):
            span = (run["ts"].max() - run["ts"].min()).total_seconds() / 3600
            if span > hours:
                out.append((station, run["ts"].min(), run["ts"].max(), span, len(run)))
    return sorted(out)


def test_gaps(frame, expected):
    for hours in (-1, 24):
        got = quality.gap_blocks(frame, ["value"], longer_than=hours).select(
            "station", "first_ts", "last_ts", "hours", "n_rows"
        )
        assert sorted(tuple(r) for r in got.collect()) == brute_gaps(expected, hours)
    kept = quality.drop_long_gaps(frame, ["value"]).count()
    assert kept == len(expected) - sum(g[4] for g in brute_gaps(expected, 24))


def test_split_and_folds(frame, expected):
    got = collected(splits.chronological_split(frame))
    for station, part in got.groupby("station"):
        n = len(part)
        cut = int(n * 0.8)
        inner = int(cut * 0.8)
        assert list(part["role"]) == ["fit"] * inner + ["val"] * (cut - inner) + ["test"] * (n - cut)

    folds = splits.time_series_folds(frame).toPandas()
    for station, part in expected.groupby("station"):
        n = len(part)
        size = n // 6
        times = list(part["ts"])
        for fold in range(1, 6):
            start = n - (6 - fold) * size
            mine = folds[(folds["station"] == station) & (folds["fold"] == fold)]
            train = mine[mine["role"] == "train"]["ts"]
            val = mine[mine["role"] == "val"]["ts"]
            assert sorted(train) == times[:start]
            assert sorted(val) == times[start : start + size]


def test_results_do_not_depend_on_partitioning(spark, frame):
    wanted = None
    for partitions in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        got = collected(features.add_lags(frame.repartition(int(partitions)), "value"))
        wanted = got if wanted is None else wanted
        pd.testing.assert_frame_equal(got, wanted)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_no_window_is_partitioned_by_the_station_over_rows(frame):
    """Windows by station alone only ever run over one row per cell."""
    plan = features.add_lags(frame, "value")._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.split("\n"):
        if "Window [" in line and "lag(" in line:
            assert "__block" in line


def test_join_per_key_keeps_all_rows(spark, frame):
    facts = spark.createDataFrame([("hot", 1), ("a", 2)], "station string, fact int")
    joined = sequence.join_per_key(frame, facts, ["station"], "ts")
    assert joined.count() == frame.count()
    assert joined.filter("station = 'b' and fact is null").count() == 1
    assert joined.filter("station = 'hot' and fact = 1").count() == 4000


@pytest.mark.parametrize("threshold, most, broadcast", [("10MB", 1 << 18, 1), ("10MB", 2, 0), ("100b", 1 << 18, 0), ("-1", 1 << 18, 0)])
def test_join_per_key_broadcasts_no_copies(spark, frame, monkeypatch, threshold, most, broadcast):
    """Facts are broadcast as they are, few of them and only below the threshold; salted copies never."""
    monkeypatch.setattr(sequence, "SENT_ROWS", most)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        facts = spark.createDataFrame([("hot", 1), ("a", 2), ("c", 3)], "station string, fact int")
        joined = sequence.join_per_key(stored(frame), facts, ["station"], "ts")
        assert joined.columns == [*frame.columns, "fact"]
        got = {(r["station"], r["ts"]): r["fact"] for r in joined.collect()}
        plan = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == {(r["station"], r["ts"]): {"hot": 1, "a": 2}.get(r["station"]) for r in frame.collect()}
    assert plan.count("BroadcastHashJoin") == broadcast and plan.count("Generate") == 1 - broadcast


def test_threshold_in_bytes(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for text, number in (("256k", 256 << 10), ("10MB", 10 << 20), ("10485760b", 10 << 20), ("7", 7), ("-1", -1), ("1g", 1 << 30)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
            assert broadcast_bytes(spark) == number
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_unsorted_times_match_arrival_order(spark):
    rows = [("s", 70000 * i, START + dt.timedelta(hours=h)) for i, h in enumerate([0, 3, 1, 2, 2, 9, 8])]
    df = spark.createDataFrame(rows, "station string, arrival bigint, ts timestamp_ntz")
    assert quality.unsorted_times(df, ["station"]).first()["n_unsorted"] == 2


def test_cells_of_ids_are_bounded(spark):
    df = spark.range(300000).withColumn("cell", sequence.id_cell("id"))
    assert df.groupBy("cell").count().agg(F.max("count")).first()[0] == sequence.CELL_IDS


def test_median_with_outliers(spark):
    """Extreme values make no bin wider: few values are looked into again, and the result is exact."""
    rng = np.random.default_rng(11)
    x = np.concatenate([rng.normal(50, 3, 4001), [1e300, -1e300, 1e-300, 0.0, -0.0, float("nan")]])
    cases = {"a": x, "b": x[1:], "c": np.array([7.0]), "d": np.array([1.0, 2.0]), "e": np.repeat([3.0, 1e9], 500),
             "f": 1e15 + rng.integers(0, 5, 999), "g": -np.exp(rng.uniform(-600, 600, 1000))}
    rows = [(k, float(v), float(-v)) for k, values in cases.items() for v in values]
    df = spark.createDataFrame(rows, "k string, x double, y double").repartition(5)
    got = {r["k"]: r for r in fills.exact_medians(df, ["x", "y"], ["k"]).collect()}
    for k, values in cases.items():
        assert got[k]["x"] == np.nanmedian(values) and got[k]["y"] == np.nanmedian(-values)
    long = df.where("k = 'a' and not isnan(x)").select("k", F.lit("x").alias("__name"), F.col("x").alias("__v"))
    group = ["k", "__name"]
    ranks = fills._rank_bins(long.withColumn("__bin", fills._coarse_bin(F.col("__v"))), group, None)
    inside = fills._inside(long, stored(ranks), group)
    n = inside.where("which = 0").count()
    assert 0 < n < 4001 / 3  # of the values around the middle only
    largest = inside.where("which = 0").groupBy("__bin").count().agg(F.max("count")).first()[0]
    assert largest <= 10


def test_correlations_in_one_scan(spark):
    """Forty columns with gaps, a constant one, far from zero: as pairwise by hand, and the table is read once."""
    rng = np.random.default_rng(12)
    x = rng.normal(0, 1, (600, 40)).cumsum(axis=1) + 1e6
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 7], x[300:, 9] = 0.1, np.nan
    x[:300, 11] = np.nan  # no rows in common with column 9
    frame = pd.DataFrame(x, columns=[f"c{i}" for i in range(40)])
    df = spark.createDataFrame(frame.astype(object).where(frame.notna(), None), ", ".join(f"c{i} double" for i in range(40)))
    df = df.repartition(7)
    want = frame.corr()
    got = stats.pearson_matrix(df, list(frame.columns)).collect()
    assert len(got) == 40 * 39 // 2
    for r in got:
        expected = want.loc[r["col_a"], r["col_b"]]
        if "c7" in (r["col_a"], r["col_b"]) or {r["col_a"], r["col_b"]} == {"c9", "c11"}:
            assert r["r"] is None
        else:
            assert r["r"] == pytest.approx(expected, abs=1e-9)
    top = stats.top_variance_with_target(df, list(frame.columns), "c0", 5).orderBy("rank").collect()
    order = frame.drop(columns="c0").std().sort_values(ascending=False).index[:5].tolist()
    assert [r["column"] for r in top] == order
    assert all(r["r"] == pytest.approx(want.loc["c0", r["column"]], abs=1e-9) for r in top)


def test_rows_of_a_window_are_exchanged_once(spark, frame):
    """The aligned table is read once for the windows, and only the exchange by block moves its rows."""
    table = stored(frame)
    plan = features.add_lags(table, "value")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "__block" in plan
    assert plan.count("BroadcastHashJoin") == 1


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_row_windows_beyond_a_broadcast(spark, frame, expected, threshold):
    """The same rows, positions and values whether the plan of the blocks is sent or joined."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        build = lambda w: features.lag_columns("value", (24,), w)
        got = collected(
            sequence.over_rows(frame, ["station"], "ts", 24, build, block_rows=700, keep_position=True)
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    series = expected.groupby("station")["value"]
    same(got["value_lag_24h"], series.shift(24))
    same(got["pos"], expected.groupby("station").cumcount() + 1)
    same(got["n_rows"], expected.groupby("station")["ts"].transform("size"))


def test_blocks_are_bounded(spark, frame):
    """No block holds more than its rows, the rows looked back at, and two cells; one cell is in few blocks."""
    celled = frame.withColumn("__cell", sequence.month_cell("ts"))
    blocks = sequence.cell_blocks(celled, ["station"], 24, 1000)
    assert blocks.agg(F.max(F.size("__blocks"))).first()[0] <= 2
    rows = celled.join(blocks, ["station", "__cell"]).select("station", F.explode("__blocks").alias("b"))
    largest = rows.groupBy("station", "b").count().agg(F.max("count")).first()[0]
    assert largest <= 1000 + 24 + 2 * 744


def test_stacked_roles_are_read_once(spark, frame):
    split = splits.chronological_split(stored(frame))
    both = splits.stack_roles(split, "fit", "val")
    assert both.count() == split.filter("role <> 'test'").count()
    plan = both._jdf.queryExecution().executedPlan().toString()
    once = split._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == once.count("FileScan")


def test_climatology_lookup_keeps_rows_of_a_hot_station(spark, frame, expected):
    wide = stats.climatology_wide(frame, ["value"])
    got = stats.lookup_climatology(frame, wide, ["value"]).toPandas()
    assert len(got) == len(expected)
    slots = [expected["station"], expected["ts"].dt.hour, expected["ts"].dt.month]
    wanted = expected.assign(mean=expected.groupby(slots)["value"].transform("mean"))
    got["ts"] = pd.to_datetime(got["ts"])
    merged = got.merge(wanted, on=["station", "ts"])
    same(merged["clim_value"], merged["mean"])
