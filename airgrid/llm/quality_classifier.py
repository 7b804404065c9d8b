"""Quality classifier: regularised quadratic discriminant over document statistics.

Every text becomes a short vector of transformed counts. Each class is a normal density
with a shrunken covariance, kept as its Cholesky factor; the score is the logistic of the
difference of the two log-densities (Mahalanobis distance plus determinant) and the log
prior, which is the share of label 1 among all training rows. Learning holds at most
``labelled.MOST_ROWS`` vectors of each class on the driver; scoring is one pass over the texts
without a shuffle.

Defined results. NULL text counts as empty; an empty text gets the score of its (all zero)
counts. Repeated rows get equal scores. Without labels of both classes the score is the
share of label 1 (0.5 without any). Rows with NULL id are scored, with held_out false.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgrid.llm import arrays
from airgrid.llm.labelled import MOST_ROWS, label_totals, remainder, training_rows
from airgrid.llm.shipping import in_tasks
from airgrid.llm.text import table

FOLDS, HELD_OUT, DECIDE = 4, 2, 0.7
SHRINK = 0.1  # towards the variances of both classes together
PRIOR_FLOOR = 0.02
LITTLE = 60  # bytes of text at which its evidence counts half

_CLASSES = {
    "upper": (range(0x41, 0x5B),),
    "lower": (range(0x61, 0x7B), range(0x80, 0x100)),
    "digit": (range(0x30, 0x3A),),
    "stop": (b".",),
    "comma": (b",",),
    "shout": (b"!?",),
    "symbol": (b"#*$%&|<>",),
    "other": (b"\"'()/:;=@[]^_`{}~+-\\",),
    "newline": (b"\n",),
}


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of transformed statistics per text."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    starts, ends, first = arrays.find_words(data, offsets, arrays.SPACES)
    n_words = np.diff(first)
    share = lambda part, whole: np.log((part + 0.5) / (whole + 10.0))
    columns = []
    for groups in _CLASSES.values():
        member = np.zeros(256, bool)
        member[[b for g in groups for b in g]] = True
        columns.append(share(arrays.per_text(member[data], offsets), sizes))
    (symbols,) = arrays.word_symbols(data, starts, ends)
    owner = np.repeat(np.arange(n), n_words)
    distinct = np.bincount(
        owner[np.unique(arrays.mix(symbols ^ arrays.spread(owner, 3)), return_index=True)[1]], minlength=n
    )
    again = np.zeros(len(symbols), bool)
    if len(symbols):
        again[1:] = (symbols[1:] == symbols[:-1]) & (owner[1:] == owner[:-1])
    marked = np.zeros(256, bool)
    marked[list(b"#*$%&|<>!")] = True
    columns += [
        share(n_words - distinct, n_words),
        share(arrays.per_text(again, first), n_words),
        share(arrays.per_text(marked[data[ends - 1]], first) if len(ends) else np.zeros(n), n_words),
        np.log1p(arrays.per_text((ends - starts).astype(np.int64), first) / np.maximum(n_words, 1)),
        np.log1p(n_words),
    ]
    return np.column_stack(columns)


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors and log-determinants of both classes."""

    means: tuple
    factors: tuple
    dets: tuple
    prior: float

    def score(self, x: np.ndarray, trust: np.ndarray) -> np.ndarray:
        """``trust`` (0 to 1) weighs the evidence of each text against the prior."""
        if not self.means:
            return np.full(len(x), self.prior)
        logs = [
            -0.5 * (((x - m) @ f.T) ** 2).sum(axis=1) - 0.5 * d
            for m, f, d in zip(self.means, self.factors, self.dets, strict=True)
        ]
        gap = trust * (logs[1] - logs[0]) + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(gap, -50, 50)))


def fit(
    x: np.ndarray, y: np.ndarray, shrink: float = SHRINK, totals: tuple[int, int] | None = None
) -> Discriminant:
    """Class densities; a class covariance is shrunken to the common variances.

    ``totals`` are the rows of each label where ``x`` and ``y`` are a sample of them.
    """
    totals = totals or ((y == 0).sum(), (y == 1).sum())
    share = float(totals[1] / sum(totals)) if sum(totals) else 0.5
    if len(y) == 0 or y.min() == y.max() or min((y == 0).sum(), (y == 1).sum()) < 3:
        return Discriminant((), (), (), share)
    weight = np.where(y == 1, share / (y == 1).sum(), (1 - share) / (y == 0).sum())
    common = np.diag(weight @ (x - weight @ x) ** 2 + 1e-3)
    means, factors, dets = [], [], []
    for k in (0, 1):
        own = x[y == k]
        rate = min(1.0, shrink + x.shape[1] / len(own))
        factor = np.linalg.cholesky((1 - rate) * np.cov(own.T, bias=True) + rate * common)
        means.append(own.mean(axis=0))
        factors.append(np.linalg.inv(factor))
        dets.append(2 * np.log(np.diag(factor)).sum())
    prior = float(np.clip(share, PRIOR_FLOOR, 1 - PRIOR_FLOOR))
    return Discriminant(tuple(means), tuple(factors), tuple(dets), prior)


def learn(docs: DataFrame, labels: DataFrame, folds=FOLDS, held_out=HELD_OUT, most=MOST_ROWS) -> Discriminant:
    """The discriminant of a bounded sample of labelled rows outside the held-out fold; the prior is of all of them."""

    def vectors(batches) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in arrays.pieces(batches):
            x = statistics(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [rows.column("label").combine_chunks(), pa.array(list(x), pa.list_(pa.float64()))], ["label", "x"]
            )

    sample = training_rows(docs, labels, "quality", folds, held_out, most)
    got = in_tasks(sample, vectors, "label int, x array<double>").collect()
    got = sorted(got, key=lambda r: (r["label"], r["x"]))  # sums in one order on every run
    x = np.array([r["x"] for r in got], float) if got else np.zeros((0, 1))
    totals = label_totals(docs, labels, "quality", folds, held_out)
    return fit(x, np.array([r["label"] for r in got], int), totals=totals)


def score_quality(docs: DataFrame, model: Discriminant) -> DataFrame:
    """(doc_id, score) for every row of ``docs``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scored(batches) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in arrays.pieces(batches):
            sizes = np.diff(offsets)
            score = model.score(statistics(data, offsets), sizes / (sizes + LITTLE))
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays(rows.column("doc_id").chunks), pa.array(score)], ["doc_id", "score"]
            )

    return in_tasks(docs.select("doc_id", "text"), scored, f"doc_id {kind}, score double")


def op6_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    docs = table(spark, sf_dir, "documents")
    scored = score_quality(docs, learn(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= DECIDE).cast("int").alias("predicted"),
    )
