"""Models: fitting, importance, SHAP, the training and scoring jobs."""

import dataclasses
import datetime as dt
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from airgrid import config
from airgrid.models import boosted, importance, shap, trees
from airgrid.operators import features, metrics, splits, stats
from airgrid.plans import scoring, training
from airgrid.session import stored

QUICK = boosted.BoostParams(rounds=4, depth=3, rate=0.5)


@pytest.fixture(scope="module")
def table(spark):
    random.seed(3)
    rows = []
    for station in ("a", "b"):
        for i in range(400):
            x = [random.uniform(-1, 1) for _ in range(3)]
            y = 10 + 4 * x[0] + 2 * (x[1] > 0) + random.gauss(0, 0.05)
            at = dt.datetime(2022, 1, 1) + dt.timedelta(hours=i)
            rows.append((station, at, *x, y, None if i % 3 else y / 2))
    return spark.createDataFrame(
        rows, "station string, ts timestamp_ntz, x0 double, x1 double, x2 double, PM25 double, CO double"
    )


@pytest.fixture(scope="module")
def fitted(table):
    rows = boosted.assemble(splits.chronological_split(table), ["x0", "x1", "x2"], "PM25").persist()
    model = boosted.fit_boosted(rows.filter("role = 'fit'"), rows.filter("role = 'val'"), QUICK)
    return model, rows


def test_best_round_waits():
    assert boosted.best_round([3.0, 2.0, 2.5, 2.4, 1.0], patience=5) == 5
    assert boosted.best_round([3.0, 2.0, 2.5, 2.4, 1.0], patience=2) == 2
    assert boosted.best_round([1.0, 2.0], patience=50) == 1


def test_curves_and_rounds(fitted):
    model, rows = fitted
    assert len(model.val_curve) == len(model.train_curve) == QUICK.rounds
    assert model.model.rounds == model.rounds
    again = boosted.rmse_curve(model.model, rows.filter("role = 'val'"))
    assert again == pytest.approx(model.val_curve[: model.rounds])
    assert model.train_curve == sorted(model.train_curve, reverse=True)


def test_a_stop_keeps_the_first_trees(fitted):
    """Patience ends the growing, and the model is the first trees of a longer one."""
    _, rows = fitted
    fit = rows.filter("role = 'fit'")
    # Validation labels that no tree can follow: the error soon rises.
    val = rows.filter("role = 'val'").withColumn("label", 20 - F.col("label"))
    impatient = boosted.BoostParams(rounds=40, depth=3, rate=0.5, patience=2)
    stopped = boosted.fit_boosted(fit, val, impatient)
    assert len(stopped.val_curve) == stopped.rounds + 2 < 40
    assert stopped.val_curve[stopped.rounds - 1] == min(stopped.val_curve)
    longer = boosted.fit_boosted(fit, val, dataclasses.replace(impatient, patience=50, rounds=stopped.rounds + 1))
    for one, two in zip(stopped.model.trees, longer.model.trees):
        assert all(np.array_equal(getattr(one, f), getattr(two, f)) for f in trees.FIELDS)
    assert boosted.BoostParams().rounds == 2000 and boosted.BoostParams().patience == 50


def plain_tree(x, y, margin, depth, params):
    """A tree by the definition, from all distinct cuts."""
    g = margin - y
    soft = lambda s: np.sign(s) * max(abs(s) - params.l1, 0)
    score = lambda s, n: soft(s) ** 2 / (n + params.l2)
    out = np.zeros(len(y))

    def split(rows, level):
        best = (1e-12, None)
        if level < depth:
            for f in range(x.shape[1]):
                for cut in np.unique(x[rows, f])[:-1]:
                    left = rows[x[rows, f] <= cut]
                    right = rows[x[rows, f] > cut]
                    gain = 0.5 * (score(g[left].sum(), len(left)) + score(g[right].sum(), len(right)) - score(g[rows].sum(), len(rows)))
                    if gain > best[0] + 1e-9:
                        best = (gain, (left, right))
        if best[1] is None:
            out[rows] = -params.rate * soft(g[rows].sum()) / (len(rows) + params.l2)
        else:
            for part in best[1]:
                split(part, level + 1)

    split(np.arange(len(y)), 0)
    return out


def test_trees_equal_the_definition(spark):
    """Few distinct values, so that codes are exact; many tasks and one give the same trees."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 12, (500, 3)).astype(float)
    y = 3 * x[:, 0] + (x[:, 1] > 5) * 7 + rng.normal(0, 0.1, 500)
    params = boosted.BoostParams(rounds=4, depth=3, rate=0.3, subsample=1.0, columns=1.0)
    df = spark.createDataFrame([(i, *map(float, a), float(b)) for i, (a, b) in enumerate(zip(x, y))], "id int, a double, b double, c double, y double")
    rows = boosted.assemble(df.repartition(5), ["a", "b", "c"], "y")
    model = boosted.fit_boosted(rows, None, params).model
    margin = np.full(500, y.mean())
    for _ in range(4):
        margin += plain_tree(x, y, margin, 3, params)
    assert model.predict(x) == pytest.approx(margin, abs=1e-9)
    spread_out = trees.TASK_ROWS
    try:
        trees.TASK_ROWS = 100
        again = boosted.fit_boosted(rows, None, params).model
    finally:
        trees.TASK_ROWS = spread_out
    assert again.predict(x) == pytest.approx(margin, abs=1e-9)


def test_coded_rows_are_read_by_the_block(spark):
    """A level reads a record per block, not one per row, and blocks of any length give the same trees."""
    rng = np.random.default_rng(7)
    rows = [([float(v) for v in rng.integers(0, 9, 3)], [float(rng.normal())], [1 + i % 2], i * 7919) for i in range(300)]
    df = spark.createDataFrame(rows, "x array<double>, y array<double>, parts array<tinyint>, draw bigint").coalesce(1)
    (whole,), coded = trees.grow(df, [0], 3, QUICK)
    assert coded.count() == 1
    most = trees.BLOCK_ROWS
    try:
        trees.BLOCK_ROWS = 70
        (cut,), coded = trees.grow(df, [0], 3, QUICK)
    finally:
        trees.BLOCK_ROWS = most
    assert sorted(r["n"] for r in coded.select("n").collect()) == [20, 70, 70, 70, 70]
    assert cut.curves["val"] == pytest.approx(whole.curves["val"]) and len(whole.curves["val"]) == QUICK.rounds


def test_columns_and_rows_walk_to_the_same_leaves():
    rng = np.random.default_rng(8)
    nodes, ends = [trees._new_node()], [0]
    while len(nodes) < 61:
        at = ends.pop(rng.integers(len(ends)))
        nodes[at].update(feature=int(rng.integers(4)), threshold=float(rng.normal()), left=len(nodes), right=len(nodes) + 1)
        ends += [len(nodes), len(nodes) + 1]
        nodes += [trees._new_node(), trees._new_node()]
    tree, x = trees.grown_tree(nodes), rng.normal(size=(400, 4))
    x[rng.random(x.shape) < 0.1] = np.nan
    by_column, most = tree.leaves(x, tree.threshold), trees.COLUMN_NODES
    try:
        trees.COLUMN_NODES = 0
        by_row = tree.leaves(x, tree.threshold)
    finally:
        trees.COLUMN_NODES = most
    assert np.array_equal(by_column, by_row) and set(by_row) <= set(ends) and len(set(by_row)) > 5


def test_regularised_leaves_and_saved_models(spark, fitted, tmp_path):
    model, rows = fitted
    strict = boosted.BoostParams(rounds=2, depth=3, rate=0.5, gamma=1e9)
    flat = boosted.fit_boosted(rows.filter("role = 'fit'"), None, strict)
    assert all(len(t.left) == 1 for t in flat.model.trees)
    model.model.save(spark, str(tmp_path / "m"))
    back = trees.TreeModel.load(spark, str(tmp_path / "m"))
    x = np.random.default_rng(1).uniform(-1, 1, (50, 3))
    assert np.array_equal(back.predict(x), model.model.predict(x))
    predicted = boosted.predict(model.model, rows)
    assert dict(predicted.dtypes) == {**dict(rows.dtypes), "prediction": "double"}


def test_shap_adds_up_to_the_prediction(fitted):
    model, rows = fitted
    test = rows.filter("role = 'test'")
    values = shap.tree_shap(model.model, test, ["x0", "x1", "x2"], ["station", "ts"])
    sums = values.groupBy("station", "ts").agg((F.sum("phi") + F.first("base")).alias("total"))
    both = boosted.predict(model.model, test).join(sums, ["station", "ts"])
    gaps = both.select(F.max(F.abs(F.col("prediction") - F.col("total"))), F.count("*")).first()
    assert gaps[1] == test.count() and gaps[0] < 1e-9
    ranked = [r["feature"] for r in shap.shap_global(values).orderBy(F.desc("mean_abs")).collect()]
    assert ranked[0] == "x0"
    first = shap.first_explained(values, ["station", "ts"]).collect()
    assert len(first) == 3 and {r["station"] for r in first} == {"a"}


def expected(tree, x, known, node=0):
    """Expectation of a tree with some features known, by walking it."""
    if tree.left[node] < 0:
        return tree.value[node]
    f = tree.feature[node]
    if f in known:
        return expected(tree, x, known, tree.left[node] if x[f] <= tree.threshold[node] else tree.right[node])
    share = tree.count[tree.left[node]] / tree.count[node]
    return share * expected(tree, x, known, tree.left[node]) + (1 - share) * expected(tree, x, known, tree.right[node])


def by_definition(tree, x, d):
    """Shapley values by summing over all coalitions."""
    out = np.zeros(d)
    for i in range(d):
        others = [j for j in range(d) if j != i]
        for size in range(d):
            for coalition in itertools.combinations(others, size):
                weight = math.factorial(size) * math.factorial(d - size - 1) / math.factorial(d)
                out[i] += weight * (expected(tree, x, {*coalition, i}) - expected(tree, x, set(coalition)))
    return out


def random_tree(rng, features, depth, repeat=True):
    nodes = [{"feature": -1, "cut": -1, "threshold": 0.0, "left": -1, "right": -1, "value": 0.0, "count": 1000.0}]

    def grow(at, level, free):
        if level == depth or (level > 1 and rng.random() < 0.2) or not free:
            nodes[at]["value"] = rng.uniform(-5, 5)
            return
        f = rng.choice(free)
        share = rng.uniform(0.1, 0.9)
        nodes[at].update(feature=f, threshold=rng.uniform(-1, 1), left=len(nodes), right=len(nodes) + 1)
        for s in (share, 1 - share):
            nodes.append({**nodes[0], "feature": -1, "left": -1, "right": -1, "count": nodes[at]["count"] * s})
        left, right = nodes[at]["left"], nodes[at]["right"]
        free = free if repeat else [x for x in free if x != f]
        grow(left, level + 1, free)
        grow(right, level + 1, free)

    grow(0, 0, list(range(features)))
    return trees.grown_tree(nodes)


def test_shap_equals_the_definition():
    """Trees that repeat features on a path, rows on all sides."""
    rng = random.Random(7)
    for _ in range(6):
        tree = random_tree(rng, 4, 5)
        points = np.random.default_rng(2).uniform(-1.2, 1.2, (15, 4))
        got = shap.explained([tree], points)
        assert shap.expected_value(tree) == pytest.approx(expected(tree, None, set()))
        for x, phi in zip(points, got):
            assert phi == pytest.approx(by_definition(tree, x, 4))


def test_shap_of_deep_trees(spark):
    """A path of 20 features: values add up, and equal the definition on the features a row meets."""
    nodes = []
    for i in range(20):  # a chain: each inner node has a leaf on its left
        nodes.append({"feature": i, "cut": 0, "threshold": 0.0, "left": 2 * i + 1, "right": 2 * i + 2, "value": 0.0, "count": 2.0 ** (21 - i)})
        nodes.append({"feature": -1, "cut": -1, "threshold": 0.0, "left": -1, "right": -1, "value": float(i % 3), "count": 2.0 ** (20 - i)})
    nodes.append({**nodes[1], "value": 50.0, "count": 2.0})
    chain = trees.grown_tree(nodes)
    x = np.random.default_rng(3).choice([-1.0, 1.0], (40, 20), p=[0.05, 0.95])
    phi = shap.explained([chain], x)
    value = chain.value[chain.leaves(x, chain.threshold)]
    assert phi.sum(axis=1) + shap.expected_value(chain) == pytest.approx(value)
    ten = trees.grown_tree([*nodes[:18], {**nodes[1], "value": 50.0, "count": nodes[18]["count"]}])
    for row, got in zip(x[:4, :9], shap.explained([ten], x[:4])):
        assert got[:9] == pytest.approx(by_definition(ten, row, 9))
    # In groups of bounded bytes the sums are the same.
    model = trees.TreeModel(1.0, [chain, ten, chain])
    assert [len(g) for g in shap.tree_groups(model.trees, chain.nbytes)] == [1, 1, 1]
    rows = spark.createDataFrame([(i, Vectors.dense(r)) for i, r in enumerate(x.tolist())], ["id", "features"])
    names = [f"f{i}" for i in range(20)]
    one, many = (
        {(r["id"], r["feature"]): r["phi"] for r in shap.tree_shap(model, rows, names, ["id"], limit).collect()}
        for limit in (shap.GROUP_BYTES, chain.nbytes)
    )
    assert len(one) == 800 and one == pytest.approx(many)


@pytest.mark.parametrize("score", ["r2", "mse"])
def test_permutation_importance(fitted, score):
    model, rows = fitted
    test = rows.filter("role = 'test'")
    table = importance.permutation_importance(model.model, test, ["x0", "x1", "x2"], ["station", "ts"], 3, score=score)
    got = {r["feature"]: r for r in table.collect()}
    assert got["x0"]["importance"] > got["x1"]["importance"] > got["x2"]["importance"] - 1e-9
    assert abs(got["x2"]["importance"]) < 0.05 and got["x0"]["std"] > 0
    # By hand: the rows in the order of their hashes, each feature shuffled as told.
    marked = test.withColumn("mark", F.xxhash64("station", "ts", F.lit(config.SEED))).orderBy("mark").collect()
    x, y = np.array([r["features"].toArray() for r in marked]), np.array([r["label"] for r in marked])
    mse = lambda x: float(((y - model.model.predict(x)) ** 2).mean())
    for f, name in enumerate(["x0", "x1", "x2"]):
        worse = []
        for repeat in range(3):
            other = x.copy()
            other[:, f] = x[importance.shuffled(len(x), 0, f, repeat, config.SEED), f]
            worse.append((mse(other) - mse(x)) / (y.var() if score == "r2" else 1))
        assert got[name]["importance"] == pytest.approx(np.mean(worse)) and got[name]["std"] == pytest.approx(np.std(worse))


def test_permutation_importance_moves_rows_once(fitted):
    """One exchange of the rows, no explode, and blocks that add up."""
    model, rows = fitted
    test = stored(rows.filter("role = 'test'").select("station", "ts", "features", "label"))
    errors = importance.permutation_errors(model.model, test, ["station", "ts"], 160, 2, 1, block_rows=30)
    plan = errors._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan and plan.count("Exchange hashpartitioning") == 2
    got = {(r["feature"], r["repeat"]): r["squares"] for r in errors.collect()}
    plain = test.collect()
    y = np.array([r["label"] for r in plain])
    own = ((y - model.model.predict(np.array([r["features"].toArray() for r in plain]))) ** 2).sum()
    assert got[(-1, 0)] == pytest.approx(own) and len(got) == 1 + 3 * 2


def test_permutation_importance_scores_once(fitted):
    """What comes back reads written sums: no block is scored a second time for the rows as they are."""
    model, rows = fitted
    test = rows.filter("role = 'test'")
    table = importance.permutation_importance(model.model, test, ["x0", "x1", "x2"], ["station", "ts"], 2)
    assert "MapInArrow" not in table._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("thresholds", [5, 400])
def test_codes_compare_as_values(thresholds):
    """Rows end in the same leaves by codes as by values: at a threshold, beside it, at NaN, in trees of any size."""
    rng = np.random.default_rng(thresholds)
    limits = rng.normal(size=thresholds).round(2)
    leaf = dict(feature=-1, cut=-1, threshold=0.0, left=-1, right=-1, value=0.0, count=1.0)

    def chain(n):  # every inner node has a leaf on its left
        nodes = []
        for i in range(n):
            nodes += [{**leaf, "feature": i % 2, "threshold": rng.choice(limits), "left": 2 * i + 1, "right": 2 * i + 2},
                      {**leaf, "value": rng.normal()}]
        return trees.grown_tree([*nodes, {**leaf, "value": rng.normal()}])

    model = trees.TreeModel(1.5, [chain(3), chain(30), chain(100), chain(0)])
    x = np.concatenate([rng.choice(limits, (300, 3)), rng.normal(size=(100, 3)), np.full((1, 3), np.nan), np.zeros((1, 3))])
    codes, cuts = importance.coded(model, x)
    assert codes.dtype == (np.uint8 if thresholds == 5 else codes.dtype) and codes.shape == (3, 402)
    for tree, cut in zip(model.trees, cuts, strict=True):
        assert np.array_equal(tree.leaves(codes.T, cut), tree.leaves(x, tree.threshold))
    y = rng.normal(size=402)
    got = {(f, r): e for f, r, e in importance.variant_errors(model, x, y, 4, 3, 9)}
    assert set(got) == {(-1, 0), *itertools.product(range(3), range(3))}
    for (f, r), e in got.items():
        other = x.copy()
        if f >= 0:
            other[:, f] = x[importance.shuffled(402, 4, f, r, 9), f]
        assert e == pytest.approx(((y - model.predict(other)) ** 2).sum())


def test_select_features(table):
    with_label = table.withColumn("extra", F.col("x0") * 0 + 1.0)
    chosen, listing = boosted.select_features(with_label, ["x2", "x1", "extra", "x0"], "PM25", n=2, trees=5)
    assert chosen == ["x1", "x0"]
    assert listing.filter("selected and status = 'ranked'").count() == 2
    chosen, listing = boosted.select_features(table, ["x2", "x1"], "PM25", n=2)
    assert chosen == ["x2", "x1"] and listing.filter("importance is null and status = 'all_kept'").count() == 2
    chosen, listing = boosted.select_features(table.limit(20), ["x2", "x1", "x0"], "PM25", n=2)
    assert chosen == ["x2", "x1", "x0"] and listing.filter("status = 'too_few_rows'").count() == 3


def test_cross_validation(table):
    with_few = table.withColumn("SO2", F.when(F.col("ts") < "2022-01-01 10:00:00", F.col("x0")))
    result = boosted.cross_validate(with_few.drop("CO"), ("PM25", "CO", "SO2"), folds=2, params=QUICK)
    rows = {(r["target"], r["fold"]): r for r in result.folds.collect()}
    assert set(rows) == {(t, f) for t in ("PM25", "CO", "SO2") for f in (1, 2)}  # never an absent row
    assert all(rows["PM25", f]["n"] == 2 * 133 and rows["PM25", f]["r2"] > 0.5 for f in (1, 2))
    assert {r["status"] for (t, _), r in rows.items() if t == "CO"} == {"absent"}
    assert {r["status"] for (t, _), r in rows.items() if t == "SO2"} == {"too_few_rows"}
    assert result.curves.count() == 2 * 2 * QUICK.rounds


def test_folds_grown_together_equal_folds_grown_alone(table):
    """Each fold's model is the one its rows alone give, whatever grows beside it."""
    plain = dataclasses.replace(QUICK, subsample=1.0, columns=1.0, bins=256)
    coarse = table.withColumns({c: F.round(c, 1) for c in ("x0", "x1", "x2")})
    both = boosted.cross_validate(coarse, ("PM25", "CO"), folds=2, params=plain).folds.collect()
    x = ["x0", "x1", "x2"]
    for r in both:
        own = coarse.dropna(subset=[r["target"]])
        part = splits.time_series_folds(boosted.assemble(own, x, r["target"]), ("station",), "ts", 2).filter(F.col("fold") == r["fold"])
        alone = boosted.fit_boosted(part.filter("role = 'train'"), part.filter("role = 'val'"), plain)
        assert r["rounds"] == alone.rounds and r["rmse"] == pytest.approx(min(alone.val_curve))


def test_multi_target(table):
    result = boosted.fit_multi_target(table, ["x0", "x1"], ["PM25", "CO"], folds=2, batch=2, params=QUICK)
    assert set(result.models) == {"PM25", "CO"} and 1 <= result.rounds <= QUICK.rounds
    assert all(m.rounds == result.rounds for m in result.models.values())
    few = boosted.fit_multi_target(table.limit(50), ["x0"], ["PM25"], folds=2, params=QUICK)
    assert few.models == {} and [r["status"] for r in few.cross_validated.folds.collect()] == ["too_few_rows"] * 2


@pytest.fixture(scope="module")
def dataset(spark):
    random.seed(5)
    rows = []
    for station in ("a", "b"):
        pm = 20.0
        for i in range(260):
            at = dt.datetime(2022, 6, 1) + dt.timedelta(hours=i)
            pm = max(1.0, pm + random.gauss(0, 3) + 3 * math.sin(i / 4))
            rows.append(
                (station, at, pm, random.uniform(0, 40), random.uniform(5, 25), random.uniform(30, 90),
                 random.uniform(0, 8), random.uniform(0, 360), random.uniform(0, 3))
            )
    columns = "PM25 double, O3 double, " + ", ".join(f"{c} double" for c in config.WEATHER)
    df = spark.createDataFrame(rows, f"station string, ts timestamp_ntz, {columns}")
    return features.add_dataset_columns(df)


def test_features_drop_incomplete_rows(dataset):
    full = training.prepare(dataset, "PM25")
    assert full.count() == 2 * (260 - 24)
    assert {"O3_roll_std_24h", "PM25_diff_24h", "wind_u", "temp_hum", "es_finde"} <= set(full.columns)
    assert training.prepare(dataset, "PM25", engineer=False).count() == 520


def test_train_and_score(spark, dataset):
    out = training.train(dataset, top=12, folds=2, params=QUICK, repeats=2)
    assert len(out.features) == 12
    scores = {r["part"]: r for r in out.scores.collect()}
    assert set(scores) == {"train", "test"} and scores["train"]["r2"] > 0.5
    assert out.importance.count() == 12
    assert out.cross_validated.folds.filter("target = 'PM25'").count() in (0, 2)
    ends = {r["station"]: r["last_train_ts"] for r in out.ends.collect()}
    first_test = out.predictions.filter("role = 'test'").groupBy("station").agg(F.min("ts").alias("t"))
    assert all(r["t"] > ends[r["station"]] for r in first_test.collect())

    after = ends["a"]
    rows = [(k, "a", after + dt.timedelta(hours=h), 20.0, 50.0, 2.0, 90.0, 0.0) for k, h in enumerate((47, 48, 49))]
    weather = ", ".join(f"{c} double" for c in config.WEATHER)
    scenarios = spark.createDataFrame(rows, f"scenario_id bigint, station string, ts timestamp_ntz, {weather}")
    assembled = scoring.assemble_scenarios(scenarios, out.features, out.climatology, out.means)
    vectors = boosted.assemble(assembled.withColumn("y", F.lit(0.0)), out.features, "y")
    scored = scoring.with_index(boosted.predict(out.model.model, vectors), "PM25")
    flagged = scoring.extrapolation(scored, out.ends, spread="scenario_id").orderBy("scenario_id").collect()
    assert [r["extrapolated"] for r in flagged] == [False, False, True]
    assert [r["hours_past"] for r in flagged] == [47.0, 48.0, 49.0]
    assert all(r["category"] for r in flagged)


def test_scenario_sources(spark):
    t = dt.datetime(2022, 3, 5, 10)
    history = spark.createDataFrame(
        [("a", t, 4.0), ("a", t - dt.timedelta(days=1), 6.0), ("a", t + dt.timedelta(hours=3), 20.0)],
        "station string, ts timestamp_ntz, O3 double",
    )
    wide = stats.climatology_wide(history, ["O3"])
    means = history.groupBy("station").agg(F.avg("O3").alias("O3"))
    weather = ", ".join(f"{c} double" for c in config.WEATHER)
    rows = [(1, "a", t, 20.0, 50.0, 2.0, 0.0, 0.0), (2, "a", t + dt.timedelta(hours=1), 1.0, 2.0, 3.0, 4.0, 5.0),
            (3, "new", t, 1.0, 1.0, 1.0, 1.0, 1.0)]
    scenarios = spark.createDataFrame(rows, f"scenario_id bigint, station string, ts timestamp_ntz, {weather}")
    names = ("Temperatura", "wind_u", "es_finde", "O3", "otro")
    got = scoring.assemble_scenarios(scenarios, names, wide, means).orderBy("scenario_id").collect()
    assert [r["O3"] for r in got] == [5.0, 10.0, 0.0]
    assert [r["n_lookup"] for r in got] == [1, 0, 0] and [r["n_mean"] for r in got] == [0, 0, 0]
    assert got[0]["wind_u"] == 2.0 and got[0]["es_finde"] == 1.0 and got[0]["otro"] == 0.0

    lagged = stats.lookup_lagged(scenarios, wide, "O3", (1, 24), ).orderBy("scenario_id").collect()
    assert [(r["O3_lag_1h"], r["O3_lag_24h"]) for r in lagged] == [(0.0, 5.0), (5.0, 0.0), (0.0, 0.0)]

    from_text = spark.createDataFrame([(1, "a", '{"O3": 3}'), (2, "a", "{}")], "scenario_id bigint, station string, j string")
    got = scoring.scenario_from_json(from_text, "j", ["O3"], means).orderBy("scenario_id").collect()
    assert [r["O3"] for r in got] == [3.0, 10.0]


def test_lags_in_scenarios(spark):
    """A lag is the base's climatology that many hours before, else the base's mean, else 0."""
    t = dt.datetime(2022, 3, 5, 10)
    history = spark.createDataFrame(
        [("a", t, 4.0, 1.0), ("a", t - dt.timedelta(hours=1), 6.0, 3.0)], "station string, ts timestamp_ntz, O3 double, CO double"
    )
    wide = stats.climatology_wide(history, ["O3", "CO"])
    means = history.groupBy("station").agg(F.avg("O3").alias("O3"), F.avg("CO").alias("CO"))
    weather = ", ".join(f"{c} double" for c in config.WEATHER)
    rows = [(1, "a", t, 20.0, 50.0, 2.0, 0.0, 0.0), (2, "b", t, 20.0, 50.0, 2.0, 0.0, 0.0)]
    scenarios = spark.createDataFrame(rows, f"scenario_id bigint, station string, ts timestamp_ntz, {weather}")
    names = ("Temperatura", "O3_lag_1h", "CO_lag_24h", "CO_lag_0h", "X_lag_1h")
    assert scoring.lag_features(names, wide.columns) == [("O3_lag_1h", "O3", 1), ("CO_lag_24h", "CO", 24), ("CO_lag_0h", "CO", 0)]
    flat = {"PM25": trees.TreeModel(30.0), "CO": trees.TreeModel(-2.0)}
    ends = spark.createDataFrame([("a", t - dt.timedelta(hours=50))], "station string, last_train_ts timestamp_ntz")
    a, b = scoring.score_scenarios(scenarios, flat, names, wide, means, ends).orderBy("scenario_id").collect()
    assert (a["O3_lag_1h"], a["CO_lag_24h"], a["CO_lag_0h"], a["X_lag_1h"]) == (6.0, 1.0, 1.0, 0.0)  # same hour, a day before
    assert (b["O3_lag_1h"], b["CO_lag_24h"], b["n_lookup"]) == (0.0, 0.0, 0) and a["n_lookup"] == 3
    assert (a["pred_PM25"], a["pred_CO"], a["index_CO"], a["air_index"]) == (30.0, -2.0, 0.0, a["index_PM25"])
    assert a["extrapolated"] and a["hours_past"] == 50.0 and b["hours_past"] is None
    smooth = scoring.score_scenarios(scenarios, flat, names, wide, means, continuous=True).first()
    assert smooth["category"] != a["category"] and smooth["unit_CO"] == "mg/m³"


def test_models_grown_together(table):
    split = splits.chronological_split(table)
    both = boosted.fit_together(split, ["x0", "x1", "x2"], ["PM25", "CO"], ["station", "ts"], QUICK)
    assert both["PM25"].rounds <= QUICK.rounds and len(both["CO"].val_curve) == QUICK.rounds
    assert both["PM25"].val_curve[-1] < both["PM25"].val_curve[0]


def test_best_rounds_read_the_curves_once(spark):
    rows = [(t, f, s, i, abs(i - b) + f / 10) for t, b in (("a", 2), ("b", 4), ("c", 9)) for f in (1, 2) for s in ("train", "val")
            for i in range(10 if f == 1 else 8)]
    curves = stored(spark.createDataFrame(rows, boosted.CURVE_TABLE))
    found = metrics.best_and_final_rounds(curves, 300)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and plan.count("FileScan") == 1
    got = {r["target"]: (r["best_iter"], r["best_rounds"], r["final_rounds"]) for r in found.collect()}
    assert got == {"a": (2, 100, 140), "b": (4, 100, 140), "c": (7, 100, 140)}  # the shortest curve ends at 7
