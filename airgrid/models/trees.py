"""Boosted regression trees, grown level by level, many models in lockstep.

Feature values are coded once by quantile cuts and the coded rows are written, a record for a
block of rows: the bytes of a column of codes, targets or margins lie together, so that reading a
row costs a few bytes copied and not a value converted. Each level of
a round is one Spark job for all models still growing: tasks sum gradients and rows per
(model, node, feature, code), the sums meet by (model, node), and one best split per node
comes back. The driver holds trees and splits, never rows; what a task sends grows with
models x nodes x features x codes, not with its rows.

A model is a target with its own training and validation rows, so the folds of all targets
are grown from one table: ``parts`` has a number per model, 1 for training, 2 for validation.
Margins, one per model, are written every ``STORE_EVERY`` rounds; trees since then are applied
inside the task. A lost executor repeats a level's task at most.

The loss is the squared error. Splits and leaves are regularised by ``l1``, ``l2`` and
``gamma`` as usual for second-order boosting with a constant second derivative. Growing stops
``patience`` rounds after a model's best validation error, and its first trees up to the best
are kept: no tree is grown twice.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airgrid import config
from airgrid.session import stored
from airgrid.tasks import in_tasks

STORE_EVERY = 10
TASK_ROWS = 1 << 15  # at least, where the table is read by every level's tasks
BLOCK_ROWS, BLOCK_BYTES = 1 << 15, 1 << 22  # of one record at most
FEW_BLOCKS = {"maxRecordsPerFile": 2}  # small files: a task takes as many as it can hold at once
TASK_NODES = 64  # nodes whose sums meet in one task
TRAIN, VALIDATE = 1, 2
NODE_SLOTS = 1 << 16
COLUMN_NODES = 128  # of a tree whose every inner node is compared with every row


@dataclass(frozen=True)
class BoostParams:
    """Booster settings."""

    rounds: int = 2000
    depth: int = 5
    rate: float = 0.05
    subsample: float = 0.8
    columns: float = 0.8
    l1: float = 0.5
    l2: float = 2.0
    gamma: float = 0.0
    min_rows: float = 1.0
    patience: int = config.PATIENCE
    bins: int = 64
    seed: int = config.SEED


@dataclass
class Tree:
    """Nodes as arrays; a leaf has no children (-1) and carries its value, rate included.

    Children come after their parent.

    ``x <= threshold`` goes left, and so does ``code <= cut``. ``count`` is the number of
    training rows the tree was grown from.
    """

    feature: np.ndarray
    cut: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    count: np.ndarray

    @property
    def nbytes(self) -> int:
        return sum(getattr(self, name).nbytes for name in FIELDS)

    def leaves(self, x: np.ndarray, limits: np.ndarray) -> np.ndarray:
        """The node each row of ``x`` ends in; ``limits`` are cuts or thresholds.

        Small trees compare whole columns, inner node by inner node: fastest where ``x`` lies
        in memory by columns.
        """
        if len(self.left) <= COLUMN_NODES:
            return self._ends(x.T, limits.tolist()).astype(np.int64)
        node = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        while True:
            inner = self.left[node] >= 0
            if not inner.any():
                return node
            below = x[rows, np.maximum(self.feature[node], 0)] <= limits[node]
            node = np.where(inner, np.where(below, self.left[node], self.right[node]), node)

    def _ends(self, columns: np.ndarray, limits: list) -> np.ndarray:
        """The last node of every row, from the last node up: a parent takes one of its children's.

        Bits instead of branches: a comparison is a mask of no bits or all, and right ^ ((left ^ right) & mask)
        is one of both.
        """
        ends: list = [np.uint8(i) for i in range(len(self.left))]
        feature, left, right = self.feature.tolist(), self.left.tolist(), self.right.tolist()
        for i in range(len(left) - 1, -1, -1):  # children come after their parent
            if left[i] >= 0:
                mask = np.negative((columns[feature[i]] <= limits[i]).view(np.uint8))
                one, other = ends[left[i]], ends[right[i]]
                mask &= one ^ other
                mask ^= other
                ends[i] = mask
                ends[left[i]] = ends[right[i]] = None
        return np.full(columns.shape[1], ends[0], np.uint8) if left[0] < 0 else ends[0]


FIELDS = ("feature", "cut", "threshold", "left", "right", "value", "count")


def grown_tree(nodes: list[dict]) -> Tree:
    """The arrays of a list of nodes."""
    kinds = (np.int64, np.int64, np.float64, np.int64, np.int64, np.float64, np.float64)
    return Tree(*[np.array([n[name] for n in nodes], kind) for name, kind in zip(FIELDS, kinds, strict=True)])


@dataclass
class TreeModel:
    """A constant and trees; predictions are their sum."""

    base: float
    trees: list[Tree] = field(default_factory=list)

    @property
    def rounds(self) -> int:
        return len(self.trees)

    def predict(self, x: np.ndarray) -> np.ndarray:
        x = np.asfortranarray(x)
        out = np.full(len(x), self.base)
        for tree in self.trees:
            out += tree.value[tree.leaves(x, tree.threshold)]
        return out

    def transform(self, df: DataFrame, vector: str = "features", prediction: str = "prediction") -> DataFrame:
        """``df`` with the prediction for the vector column."""
        model = self

        def rows(batches) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _matrix(batch.column(batch.num_columns - 1))
                columns = batch.columns[:-1] + [pa.array(model.predict(x))]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], prediction])

        whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row")
        packed = df.select(whole, vector_to_array(vector).alias("__x"))
        # Vectors cannot cross to Arrow as they are, so they travel as arrays and come back.
        vectors = [c for c, kind in df.dtypes if kind == "vector"]
        fields = [vector_to_array(f"__row.{c}").alias(c) if c in vectors else F.col(f"__row.`{c}`").alias(c) for c in df.columns]
        flat = packed.select(*fields, "__x")
        schema = ", ".join([f"`{c}` {kind}" for c, kind in flat.dtypes if c != "__x"] + [f"`{prediction}` double"])
        out = in_tasks(flat, rows, schema)
        return out.withColumns({c: _vector(F.col(c)) for c in vectors}) if vectors else out

    def save(self, spark: SparkSession, path: str) -> None:
        """One row per node below ``path``; the constant is tree -1."""
        rows = [(-1, 0, -1, -1, 0.0, -1, -1, self.base, 0.0)]
        for t, tree in enumerate(self.trees):
            for i in range(len(tree.left)):
                rows.append((t, i, *[getattr(tree, name)[i].item() for name in FIELDS]))
        spark.createDataFrame(rows, _NODE_TABLE).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> TreeModel:
        nodes = spark.read.parquet(path).orderBy("tree", "node").toPandas()
        trees = [grown_tree(part.to_dict("records")) for t, part in nodes.groupby("tree") if t >= 0]
        return TreeModel(float(nodes.loc[nodes["tree"] == -1, "value"].iloc[0]), trees)


def predict_all(df: DataFrame, models: Mapping[str, TreeModel], x: Column, prefix: str = "pred_") -> DataFrame:
    """``df`` with the prediction of every model for the array ``x``, in one pass."""
    names = [f"{prefix}{name}" for name in models]

    def rows(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _matrix(batch.column(batch.num_columns - 1))
            found = [pa.array(m.predict(values) if len(values) else np.zeros(0)) for m in models.values()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *found], [*batch.schema.names[:-1], *names])

    kinds = [f"`{c}` {kind}" for c, kind in df.dtypes] + [f"`{n}` double" for n in names]
    return in_tasks(df.select("*", x.alias("__x")), rows, ", ".join(kinds))


_NODE_TABLE = (
    "tree int, node int, feature bigint, cut bigint, threshold double, left bigint, right bigint, "
    "value double, count double"
)


def _vector(values: Column) -> Column:
    from pyspark.ml.functions import array_to_vector

    return array_to_vector(values)


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(n, -1) if n else flat.reshape(0, 0)


CODED = "n int, codes binary, y binary, parts binary, draw binary, margins binary"


def _blocks(batches) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(codes, y, parts, draw, margins) of every record of a coded table; a line for each column."""
    kinds = (np.uint8, np.float64, np.int8, np.int64, np.float64)
    for batch in batches:
        for i, n in enumerate(batch.column(0).to_pylist()):
            codes, y, parts, draw, margins = (
                np.frombuffer(batch.column(1 + k)[i].as_buffer(), kind) for k, kind in enumerate(kinds)
            )
            yield codes.reshape(-1, n), y.reshape(-1, n), parts.reshape(-1, n), draw, margins.reshape(-1, n)


def _record(n: int, *columns: np.ndarray) -> pa.RecordBatch:
    """One record of a coded table."""
    packed = [pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in columns]
    return pa.RecordBatch.from_arrays(
        [pa.array([n], pa.int32()), *packed], ["n", "codes", "y", "parts", "draw", "margins"]
    )


# -- coded rows ------------------------------------------------------------------------


def quantile_cuts(rows: DataFrame, n_features: int, bins: int) -> tuple[list[np.ndarray], int]:
    """Per feature the distinct quantiles of the array column ``x``, and the rows, in one pass."""
    shares = [i / bins for i in range(1, bins)]
    wide = rows.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.percentile_approx(F.get("x", F.lit(i)), shares, 50 * bins).alias(f"c{i}") for i in range(n_features)],
    ).first()
    return [np.unique(np.array(wide[f"c{i}"] or [], float)) for i in range(n_features)], wide["n"]


def _in_blocks(batches, most: int) -> Iterator[pa.Table]:
    """The same rows in tables of ``most`` rows, the last one shorter."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        while n >= most:
            table = pa.Table.from_batches(held)
            yield table.slice(0, most).combine_chunks()
            held = table.slice(most).to_batches()
            n -= most
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def coded_rows(rows: DataFrame, cuts: list[np.ndarray], models: int, n_rows: int, targets: int) -> DataFrame:
    """Blocks of (codes, y, parts, draw, margins) of rows (x, y, parts, draw), written; margins start at 0."""
    width = len(cuts) + 8 * targets + models + 8 + 8 * models
    most = max(1, min(BLOCK_ROWS, BLOCK_BYTES // width))

    def code(batches) -> Iterator[pa.RecordBatch]:
        for block in _in_blocks(batches, most):
            n = block.num_rows
            x, y, parts = (_matrix(block.column(i).chunk(0)) for i in range(3))
            draw = block.column(3).to_numpy()
            codes = np.empty((len(cuts), n), np.uint8)
            for j, cut in enumerate(cuts):
                codes[j] = np.searchsorted(cut, x[:, j], side="left")
            yield _record(n, codes, y.T, parts.T.astype(np.int8), draw, np.zeros((models, n)))

    coded = in_tasks(rows.select("x", "y", "parts", "draw"), code, CODED)
    return stored(coded.coalesce(1 + n_rows // TASK_ROWS), "coded_rows", FEW_BLOCKS)


# -- growing ---------------------------------------------------------------------------


def _soft(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def leaf_value(g: float, n: float, params: BoostParams) -> float:
    return float(-params.rate * _soft(np.float64(g), params.l1) / (n + params.l2)) if n + params.l2 > 0 else 0.0


def best_split(sums: np.ndarray, params: BoostParams) -> tuple[int, int, float, float, float]:
    """(feature, cut, gain, left gradient, left rows) of sums (gradient or rows, feature, code).

    The gain is 0 where no split is worth it; the first of equal ones counts.
    """
    g, n = np.cumsum(sums[0], axis=1), np.cumsum(sums[1], axis=1)
    all_g, all_n = g[:, -1:], n[:, -1:]

    def score(g, n):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(n + params.l2 > 0, _soft(g, params.l1) ** 2 / (n + params.l2), 0.0)

    gain = 0.5 * (score(g, n) + score(all_g - g, all_n - n) - score(all_g, all_n)) - params.gamma
    allowed = (n >= max(params.min_rows, 1)) & (all_n - n >= max(params.min_rows, 1))
    gain = np.where(allowed, gain, 0.0)
    feature, cut = np.unravel_index(np.argmax(gain), gain.shape)
    return int(feature), int(cut), float(gain[feature, cut]), float(g[feature, cut]), float(n[feature, cut])


def _spread(x: np.ndarray) -> np.ndarray:
    """A mixing of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def drawn(draw: np.ndarray, model: int, turn: int, share: float, seed: int) -> np.ndarray:
    """Which rows a tree is grown from: a hash of row, model and round below the share."""
    if share >= 1:
        return np.ones(len(draw), bool)
    key = np.uint64((seed * 1_000_003 + model * 100_003 + turn + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    return (_spread(draw.view(np.uint64) ^ key) >> np.uint64(11)).astype(float) / 2**53 < share


@dataclass
class Growing:
    """One model while it grows."""

    target: int
    number: int
    base: float = 0.0
    trees: list[Tree] = field(default_factory=list)
    since_store: int = 0  # the trees that the written margins hold
    curves: dict[str, list[float]] = field(default_factory=lambda: {"train": [], "val": []})
    best: int = 0
    n_train: int = 0
    n_val: int = 0
    active: bool = True
    nodes: list[dict] = field(default_factory=list)
    open: list[int] = field(default_factory=list)  # nodes of the current level

    def begin(self) -> None:
        self.nodes = [_new_node()]
        self.open = [0]


def _new_node(value: float = 0.0, count: float = 0.0) -> dict:
    return {"feature": -1, "cut": -1, "threshold": 0.0, "left": -1, "right": -1, "value": value, "count": count}


def _level_sums(plan: list[dict], bins: int, params: BoostParams, errors: bool) -> Callable:
    """The task side of a level: sums by (model, open node), and errors where asked for."""

    def rows(batches) -> Iterator[pa.RecordBatch]:
        sums = {p["number"]: np.zeros((len(p["open"]), 2, len(p["features"]), bins)) for p in plan}
        wrong = {p["number"]: np.zeros(6) for p in plan}
        for codes, y, parts, draw, margins in _blocks(batches):
            for p in plan:
                m = p["number"]
                part = parts[m]
                mine = np.flatnonzero(part > 0 if errors else part == TRAIN)
                if not errors and len(mine):
                    mine = mine[drawn(draw[mine], m, p["turn"], params.subsample, params.seed)]
                if not len(mine):
                    continue
                own = codes.take(mine, axis=1)
                margin = margins[m, mine] + p["base"]
                for tree in p["new"]:
                    margin += tree.value[tree.leaves(own.T, tree.cut)]
                g = margin - y[p["target"], mine]
                if errors:
                    for k, which in enumerate((TRAIN, VALIDATE)):
                        e = g[part[mine] == which]
                        wrong[m][3 * k : 3 * k + 3] += len(e), e.sum(), (e * e).sum()
                    used = np.flatnonzero(part[mine] == TRAIN)
                    used = used[drawn(draw[mine[used]], m, p["turn"], params.subsample, params.seed)]
                    own, g = own.take(used, axis=1), g[used]
                if not p["open"] or not len(g):
                    continue
                slot = p["slot"][p["tree"].leaves(own.T, p["tree"].cut)]
                inside = np.flatnonzero(slot >= 0)
                whole = len(inside) == len(slot)
                slot, g = (slot, g) if whole else (slot[inside], g[inside])
                start, size = slot * bins, len(p["open"]) * bins
                for j, feature in enumerate(p["features"]):
                    at = start + (own[feature] if whole else own[feature].take(inside))
                    sums[m][:, 0, j] += np.bincount(at, g, size).reshape(-1, bins)
                    sums[m][:, 1, j] += np.bincount(at, minlength=size).reshape(-1, bins)
        keys, packed = [], []
        for p in plan:
            m = p["number"]
            if errors and wrong[m].any():
                keys.append(-1 - m)
                packed.append(wrong[m].tobytes())
            for s in range(len(p["open"])):
                if sums[m][s, 1].any():
                    keys.append(m * NODE_SLOTS + s)
                    packed.append(sums[m][s].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(packed, pa.binary())], ["key", "sums"])

    return rows


def _splits(widths: dict[int, int], bins: int, params: BoostParams) -> Callable:
    """The meeting side of a level: sums of one key added up, and its best split or its errors."""

    def rows(batches) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for key, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                values = np.frombuffer(packed.as_buffer(), np.float64)
                totals[key] = totals[key] + values if key in totals else values
        out = []
        for key, values in totals.items():
            if key < 0:
                out.append((key, values.tolist()))
                continue
            sums = values.reshape(2, widths[key // NODE_SLOTS], bins)
            feature, cut, gain, g, n = best_split(sums, params)
            out.append((key, [feature, cut, gain, g, n, sums[0, 0].sum(), sums[1, 0].sum()]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in out], pa.int64()), pa.array([v for _, v in out], pa.list_(pa.float64()))],
            ["key", "found"],
        )

    return rows


def _one_level(rows: DataFrame, models: list[Growing], columns: dict[int, np.ndarray], bins: int,
               params: BoostParams, errors: bool, one_task: bool) -> dict[int, list[float]]:
    """One Spark job: the best split of every open node, by key; errors under -1 - model."""
    plan = []
    for m in models:
        slot = np.full(max(len(m.nodes), 1), -1)
        slot[m.open] = np.arange(len(m.open))
        plan.append(
            {
                "number": m.number, "target": m.target, "turn": len(m.trees), "base": m.base,
                "new": m.trees[m.since_store :], "tree": grown_tree(m.nodes or [_new_node()]),
                "slot": slot, "open": m.open, "features": columns[m.number],
            }
        )
    widths, n_open = {m.number: len(columns[m.number]) for m in models}, sum(len(m.open) for m in models)
    sums, splits = _level_sums(plan, bins, params, errors), _splits(widths, bins, params)
    found = "key bigint, found array<double>"
    if one_task:  # its sums are whole
        met = in_tasks(rows, lambda batches: splits(sums(batches)), found)
    else:
        partial = in_tasks(rows, sums, "key bigint, sums binary")
        met = in_tasks(partial.repartition(1 + n_open // TASK_NODES, "key"), splits, found)
    return {row["key"]: row["found"] for row in met.collect()}  # a row per open node


def _apply(m: Growing, found: dict[int, list[float]], cuts: list[np.ndarray], columns: np.ndarray, params: BoostParams) -> None:
    """Split the open nodes as found; their children are open next."""
    opened = []
    for s, at in enumerate(m.open):
        node = m.nodes[at]
        if (split := found.get(m.number * NODE_SLOTS + s)) is None:
            continue
        feature, cut, gain, g, n, all_g, all_n = split
        if at == 0:
            node.update(value=leaf_value(all_g, all_n, params), count=all_n)
        feature = int(columns[int(feature)])
        if gain <= 1e-12 or int(cut) >= len(cuts[feature]):
            continue
        node.update(
            feature=feature, cut=int(cut), threshold=float(cuts[feature][int(cut)]), left=len(m.nodes), right=len(m.nodes) + 1
        )
        for child_g, child_n in ((g, n), (all_g - g, all_n - n)):
            opened.append(len(m.nodes))
            m.nodes.append(_new_node(leaf_value(child_g, child_n, params), child_n))
    m.open = opened


def _with_margins(rows: DataFrame, models: list[Growing]) -> DataFrame:
    """The rows with the margins of all trees so far, written."""
    new = {m.number: m.trees[m.since_store :] for m in models}

    def add(batches) -> Iterator[pa.RecordBatch]:
        for codes, y, parts, draw, margins in _blocks(batches):
            margins = margins.copy()
            for number, trees in new.items():
                for tree in trees:
                    margins[number] += tree.value[tree.leaves(codes.T, tree.cut)]
            yield _record(len(draw), codes, y, parts, draw, margins)

    out = stored(in_tasks(rows, add, CODED), "margins", FEW_BLOCKS)
    for m in models:
        m.since_store = len(m.trees)
    return out


def _judge(m: Growing, sums: list[float] | None, params: BoostParams) -> None:
    """Write down the errors of the trees so far and decide whether to go on."""
    n, _, squares, n_val, _, squares_val = sums or [0.0] * 6
    m.n_train, m.n_val = int(n), int(n_val)
    m.curves["train"].append(math.sqrt(squares / n) if n else math.nan)
    if n_val:
        m.curves["val"].append(math.sqrt(squares_val / n_val))
        curve = m.curves["val"]
        if curve[-1] < curve[m.best]:
            m.best = len(curve) - 1
        if len(curve) - 1 - m.best >= params.patience:
            m.active = False
    if len(m.trees) >= params.rounds:
        m.active = False


def grow(
    rows: DataFrame, targets: Sequence[int], n_features: int, params: BoostParams = BoostParams(),
    min_train: int = 2, allowed: Sequence[Sequence[int]] | None = None,
) -> tuple[list[Growing], DataFrame | None]:
    """Grow a model for each entry of ``targets`` from rows (x, y, parts, draw).

    ``x`` and ``y`` are arrays of features and targets, ``parts`` a number per model, ``draw`` a
    hash of the row. ``allowed`` are the features a model may use, by default all. Models of fewer than ``min_train`` training rows get no trees. Curves hold
    one error per round; ``best`` counts rounds from 0. The coded rows come back for ``scored``.
    """
    if params.bins > 256:
        raise ValueError("codes are single bytes")
    cuts, n_rows = quantile_cuts(rows.select("x"), n_features, params.bins)
    models = [Growing(target, number) for number, target in enumerate(targets)]
    if not models:
        return [], None
    coded = whole = coded_rows(rows, cuts, len(models), n_rows, max(targets) + 1)
    one_task = coded.rdd.getNumPartitions() == 1
    own = [np.array(a) for a in allowed] if allowed else [np.arange(n_features)] * len(models)
    every = {m.number: np.arange(n_features) for m in models}
    first = _one_level(coded, models, every, params.bins, params, True, one_task)
    for m in models:
        n, g, _, n_val, _, _ = first.get(-1 - m.number, [0.0] * 6)
        m.n_train, m.n_val = int(n), int(n_val)
        m.base = -g / n if n else 0.0
        m.active = m.n_train >= min_train and params.rounds > 0
    growing = [m for m in models if m.active]
    while growing:
        turn = len(growing[0].trees)
        columns = {}
        for m in growing:
            m.begin()
            order = np.random.default_rng([params.seed, m.number, turn]).permutation(own[m.number])
            columns[m.number] = np.sort(order[: max(1, math.ceil(params.columns * len(order)))])
        for level in range(params.depth):
            splitting = [m for m in growing if m.open]
            errors = level == 0 and turn > 0
            if not splitting:
                break
            found = _one_level(coded, splitting, columns, params.bins, params, errors, one_task)
            for m in splitting:
                if errors:
                    _judge(m, found.get(-1 - m.number), params)
                _apply(m, found, cuts, columns[m.number], params)
            if errors:
                growing = [m for m in growing if m.active]
        for m in growing:
            m.trees.append(grown_tree(m.nodes))
        if growing and len(growing[0].trees) - growing[0].since_store >= STORE_EVERY:
            coded = _with_margins(coded, growing)
        if growing and len(growing[0].trees) >= params.rounds:
            for m in growing:
                m.open, m.nodes = [], []
            found = _one_level(coded, growing, columns, params.bins, params, True, one_task)
            for m in growing:
                _judge(m, found.get(-1 - m.number), params)
            growing = []
    for m in models:
        m.nodes, m.open = [], []
    return models, whole


def scored(coded: DataFrame, models: list[Growing], kept: Sequence[int]) -> dict[int, dict]:
    """Per model n, mae, rmse and r2 on its validation rows, by its first ``kept`` trees.

    One pass; a task sends one row per model. Below two rows the scores are None.
    """
    plan = [(m.number, m.target, m.base, m.trees[:n]) for m, n in zip(models, kept, strict=True)]

    def rows(batches) -> Iterator[pa.RecordBatch]:
        sums = {number: np.zeros(5) for number, *_ in plan}
        for codes, y, parts, _, _ in _blocks(batches):
            for number, target, base, trees in plan:
                mine = np.flatnonzero(parts[number] == VALIDATE)
                if not len(mine):
                    continue
                own = codes.take(mine, axis=1)
                margin = np.full(len(mine), base)
                for tree in trees:
                    margin += tree.value[tree.leaves(own.T, tree.cut)]
                actual = y[target, mine]
                e, centred = actual - margin, actual - base
                sums[number] += len(mine), np.abs(e).sum(), (e * e).sum(), centred.sum(), (centred * centred).sum()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int64()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))],
            ["number", "sums"],
        )

    partial = in_tasks(coded, rows, "number bigint, sums array<double>")
    added = partial.groupBy("number").agg(F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(5)]).alias("sums"))
    out = {}
    for row in added.collect():  # a row per model
        n, off, squares, total, total_squares = row["sums"]
        spread = total_squares - total * total / n if n else 0.0
        enough = n >= 2
        r2 = (1 - squares / spread if spread > 0 else float(squares == 0)) if enough else None
        out[row["number"]] = {
            "n": int(n), "mae": off / n if enough else None, "rmse": math.sqrt(squares / n) if enough else None, "r2": r2,
        }
    return out
