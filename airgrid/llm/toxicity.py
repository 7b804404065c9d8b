"""Toxicity: a subsequence string-kernel support vector machine with Nystroem landmarks.

The kernel of two words sums, over all triples of characters that occur in both in order
within ``SPAN`` characters, the decay to the power of both spans. A gap or an inserted
character only costs decay, so a broken-up or inflected insult stays close to the plain one.
Words with single characters in a row count as one word. A sentence is as toxic as its most toxic word, a text as its most toxic
sentence.

Learning. From a bounded sample of labelled texts, landmarks are drawn: words that stand out
in toxic texts, and ordinary words. The Nystroem map (kernel to the landmarks times the
inverse root of the landmark kernel) gives features for a linear squared-hinge machine.
Which word of a toxic text is to blame is not labelled; it is found by turns of fitting and
picking the highest word of each toxic text, and others that many different toxic texts hold,
against the words of clean texts. A logistic
curve over the texts' highest values gives the score; there the sample's texts weigh as much
as their label does among all training rows. As kernel, map and machine are linear
in the triples, the model folds into one weight per triple (32,768 numbers), and scoring is one
pass of table lookups without a shuffle.

Defined results. NULL text counts as empty; a text without words gets the score of the
lowest evidence. Repeated rows get equal scores. Without labels of both kinds the score is 0.
NULL ids are scored and are not held out. Other columns are no input.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgrid.llm import arrays
from airgrid.llm.labelled import label_totals, remainder, training_rows
from airgrid.llm.shipping import give_back, in_tasks
from airgrid.llm.text import table

FOLDS, HELD_OUT, DECIDE = 3, 1, 0.7
SPAN, DECAY = 5, 0.8  # characters of a triple from first to last, and the decay per character
SAMPLE = 1_500  # texts of each label to learn from, whole
LANDMARKS, ORDINARY, NEGATIVES = 320, 160, 15_000
RANK = 256  # features kept of the Nystroem map
TURNS, COST = 4, 10.0
# A word may be to blame beside a higher one if it stands in this share of the toxic texts, and if to find
# it in no clean text has a chance of at most exp(-SURE).
COMMON, SURE = 0.05, 7.0
STEMS = (3, 4, 5, 6, 7)
PIECE = 1 << 20  # bytes of text scored at once, as every byte takes some ten numbers

# Codes of 5 bits: 0 for bytes that can only be gaps, 1-26 letters, 27-30 accented letters by
# their last byte, 31 the start of a word.
START = 31
CODES = np.zeros(256, np.uint8)
CODES[0x61:0x7B] = np.arange(1, 27)
CODES[0x41:0x5B] = np.arange(1, 27)
CODES[0x80:0xC0] = 27 + np.arange(64) % 4

_OFFSETS = [(i, j) for j in range(2, SPAN) for i in range(1, j)]


def norms(letters: np.ndarray) -> np.ndarray:
    """Root of a word's kernel with itself where no triple repeats, by its length."""
    own = np.zeros(len(letters))
    for _, j in _OFFSETS:
        own += np.maximum(letters - j, 0) * DECAY ** (2 * (j + 1))
    return np.sqrt(np.maximum(own, 1e-9))


def with_starts(codes: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The start mark before the letters of every word."""
    at = np.flatnonzero(np.diff(word, prepend=-1))
    return np.insert(codes, at, START), np.insert(word, at, word[at])


def char_words(data: np.ndarray, offsets: np.ndarray):
    """Codes of the letters, the word of each, and the words' texts.

    Bytes that are no letters (inserted marks, digits) are dropped, which leaves a gap of
    nothing; words of one letter in a row are one word.
    """
    starts, ends, first = arrays.find_words(data, offsets, arrays.SPACES)
    codes = CODES[data]
    inside = np.zeros(len(data) + 1, np.int32)
    np.add.at(inside, starts, 1)
    np.cumsum(inside, out=inside)
    word = inside[:-1] - 1
    keep = np.flatnonzero(codes > 0)
    keep = keep[word[keep] >= 0] if len(keep) else keep
    owner = word[keep]
    letters = np.bincount(owner, minlength=len(starts))
    new = np.ones(len(starts), bool)
    if len(starts) > 1:
        new[1:] = ~((letters[1:] == 1) & (letters[:-1] == 1))
        inner = first[1:-1]
        new[inner[inner < len(starts)]] = True
    joined = np.cumsum(new) - 1
    text_of = np.repeat(np.arange(len(offsets) - 1), np.diff(first))[new]
    return (*with_starts(codes[keep], joined[owner] if len(owner) else owner), text_of)


def triple_sums(codes: np.ndarray, word: np.ndarray, n_words: int, weights: np.ndarray) -> np.ndarray:
    """Per word, the sum of ``weights`` over its triples, times their decay.

    ``weights`` has one value per triple, or one row of values.
    """
    wide = weights.ndim == 2
    out = np.zeros((n_words, weights.shape[1]) if wide else n_words, weights.dtype)
    code = codes.astype(np.int64)
    n = len(code)
    at = np.zeros((n, weights.shape[1]) if wide else n, weights.dtype)
    for i, j in _OFFSETS:
        if n <= j:
            continue
        same = word[:-j] == word[j:]
        triple = (code[: n - j] << 10) | (code[i : n - j + i] << 5) | code[j:]
        triple = np.where(same, triple, 0)  # a triple of gaps, whose weight is 0
        at[: n - j] += weights[triple] * weights.dtype.type(DECAY ** (j + 1))
    if n:
        starts = np.flatnonzero(np.diff(word, prepend=-1))
        length = norms(np.diff(starts, append=n)).astype(weights.dtype)
        out[word[starts]] = np.add.reduceat(at, starts, axis=0) / (length[:, None] if wide else length)
    return out


def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes and owners of single words."""
    parts = [np.frombuffer(w.encode(), np.uint8) for w in words]
    data = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
    owner = np.repeat(np.arange(len(words)), [len(p) for p in parts])
    codes = CODES[data]
    return with_starts(codes[codes > 0], owner[codes > 0])


def triple_table(words: list[str]) -> np.ndarray:
    """Triple weights of every word: a column per word, in the kernel's feature space."""
    codes, owner = encode(words)
    out = np.zeros((1 << 15, len(words)), np.float32)
    for i, j in _OFFSETS:
        if len(codes) > j:
            same = owner[:-j] == owner[j:]
            triple = (codes[:-j].astype(np.int64) << 10) | (codes[i : len(codes) - j + i].astype(np.int64) << 5) | codes[j:]
            np.add.at(out, (triple[same], owner[:-j][same]), DECAY ** (j + 1))
    out /= norms(np.bincount(owner, minlength=len(words))).astype(np.float32)
    return out


@dataclass(frozen=True)
class ToxicModel:
    """Weight of each triple, the floor, and the logistic curve."""

    weights: np.ndarray | None
    curve: tuple[float, float] = (0.0, 0.0)

    def highest(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The value of the most toxic word of each text, 0 where there is none."""
        out = np.zeros(len(offsets) - 1)
        if self.weights is None or not len(data):
            return out
        codes, word, text_of = char_words(data, offsets)
        if len(text_of):
            values = triple_sums(codes, word, len(text_of), self.weights)
            np.maximum.at(out, text_of, values)
        return out

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(offsets) - 1)
        slope, bias = self.curve
        return 1 / (1 + np.exp(-np.clip(slope * self.highest(data, offsets) + bias, -30, 30)))


def squared_hinge(z: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Primal Newton steps for the linear squared-hinge machine; the last entry is the bias."""
    width = z.shape[1] + 1
    beta = np.zeros(width)
    damp = np.full(width, ridge)
    damp[-1] = 1e-3
    for _ in range(20):
        left, right = np.diag(damp), np.zeros(width)
        for i in range(0, len(z), 1000):
            part, sign, cost = z[i : i + 1000].astype(float), y[i : i + 1000], weight[i : i + 1000]
            part = np.column_stack([part, np.ones(len(part))])
            on = sign * (part @ beta) < 1
            costly = part[on] * cost[on, None]
            left += costly.T @ part[on]
            right += costly.T @ sign[on]
        new = np.linalg.solve(left, right)
        if np.abs(new - beta).max() < 1e-8:
            break
        beta = new
    return beta


def logistic(x: np.ndarray, y: np.ndarray, totals: tuple[int, int] | None = None) -> tuple[float, float]:
    """Slope and bias of a logistic curve, with slightly softened labels.

    ``totals`` are the rows of each label that ``x`` and ``y`` are a sample of; the sample's rows
    get case weights (1 on average) that restore the labels' shares.
    """
    n = ((y == 0).sum(), (y == 1).sum())
    soft = np.where(y == 1, 1 - 1 / (n[1] + 2), 1 / (n[0] + 2))
    weight = np.ones(len(y))
    if totals:
        weight = np.where(y == 1, totals[1] / n[1], totals[0] / n[0]) * len(y) / sum(totals)
    scale = max(float(np.std(x)), 1e-9)
    a = np.column_stack([x / scale, np.ones(len(x))])
    beta = np.zeros(2)

    def loss(b: np.ndarray) -> float:
        v = a @ b
        return float(weight @ (np.logaddexp(0, v) - soft * v)) + 5e-5 * float(b @ b)

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        h = (a * (weight * p * (1 - p))[:, None]).T @ a + 1e-4 * np.eye(2)
        step = np.linalg.solve(h, a.T @ (weight * (soft - p)) - 1e-4 * beta)
        now = loss(beta)
        while np.abs(step).max() >= 1e-6 and loss(beta + step) > now:
            step = step / 2  # a full step may overshoot where the labels are all but separate
        beta = beta + step
        if np.abs(step).max() < 1e-6:
            break
    return float(beta[0] / scale), float(beta[1])


def fit(texts: list[str], toxic: list[int], totals: tuple[int, int] | None = None) -> ToxicModel:
    """Learn from labelled texts (see the module's text); for ``totals`` see ``logistic``."""
    y = np.array(toxic, int)
    if len(y) == 0 or y.min() == y.max():
        return ToxicModel(None)
    # Words of clean texts are counted text by text; only words of toxic texts are kept by text.
    clean_texts = [t for t, k in zip(texts, y, strict=True) if not k]
    bags = [bag_of(t) for t, k in zip(texts, y, strict=True) if k]
    seen = [Counter(), Counter()]
    for t in clean_texts:
        seen[0].update(bag_of(t))
    kinds = Counter()  # copies of a text count once
    for bag in {tuple(bag) for bag in bags}:
        kinds.update(bag)
    for bag in bags:
        seen[1].update(bag)
    n = [(y == 0).sum(), (y == 1).sum()]
    # Prefixes stand for inflected forms in choosing landmarks; those of words no clean text has will do.
    wanted = {w[:m] for w in seen[1] if w not in seen[0] for m in STEMS if len(w) >= m}

    def stems_of(bag):
        return {w[:m] for w in bag for m in STEMS if len(w) >= m} & wanted

    stems = [Counter(), Counter()]
    for t in clean_texts:
        stems[0].update(stems_of(bag_of(t)))
    for bag in bags:
        stems[1].update(stems_of(bag))

    def odds(c, w):
        return np.log((c[1][w] + 0.2) / (n[1] + 1)) - np.log((c[0][w] + 0.2) / (n[0] + 1))

    def blame(w):
        return max([odds(seen, w), *(odds(stems, w[:m]) for m in STEMS if len(w) >= m)])

    bags = [[w for w in bag if w not in seen[0]] for bag in bags if bag]  # no word of a clean text is to blame
    bags = [bag for bag in bags if bag]
    mine = sorted({w for bag in bags for w in bag})
    suspects = sorted((w for w in mine if len(w) >= 3), key=lambda w: (-blame(w), -seen[1][w], w))
    landmarks = suspects[:LANDMARKS]
    ordinary = sorted(seen[0], key=lambda w: (-seen[0][w], w))
    step = max(1, len(ordinary) // (ORDINARY // 2))
    landmarks += (ordinary[: ORDINARY // 2] + ordinary[:: step])[:ORDINARY]
    landmarks = list(dict.fromkeys(landmarks))
    columns = triple_table(landmarks)
    gram = (columns.T @ columns).astype(float)
    value, vector = np.linalg.eigh(gram + 1e-6 * np.eye(len(gram)))
    good = (value > 1e-4 * value.max()) & (np.arange(len(value)) >= len(value) - RANK)
    root = vector[:, good] / np.sqrt(value[good])
    features = columns @ root.astype(np.float32)  # of every triple
    del columns

    def nystroem(words: list[str]) -> np.ndarray:
        codes, owner = encode(words)
        return triple_sums(codes, owner, len(words), features)

    place = {w: i for i, w in enumerate(mine)}
    if not mine or not ordinary:
        return ToxicModel(None)
    clean = ordinary[:NEGATIVES]
    z_clean = np.empty((len(clean), features.shape[1]), np.float32)
    for i in range(0, len(clean), 1000):
        z_clean[i : i + 1000] = nystroem(clean[i : i + 1000])
    toxic_bags = [np.array([place[w] for w in bag], int) for bag in bags]
    order = np.array([blame(w) for w in mine])
    held = np.array([kinds[w] for w in mine])
    common = (held >= COMMON * len(toxic_bags)) & (held * np.log((n[0] + n[1]) / n[1]) >= SURE)
    del bags, stems, seen, kinds, wanted, suspects, ordinary
    give_back()
    weights = np.zeros(1 << 15)
    for turn in range(TURNS):
        picked = []
        for bag in toxic_bags:
            rank = order[bag]
            enough = max(rank.max() - (0.5 if turn == 0 else 0.0), 0.0)
            beside = bag[common[bag] & (rank >= (1.0 if turn == 0 else 0.0))]
            picked += np.unique(np.concatenate([bag[rank >= enough][:3], beside])).tolist()
        if not picked:
            break
        unique, again = np.unique(picked, return_inverse=True)
        z = np.concatenate([nystroem([mine[i] for i in unique])[again], z_clean])
        sign = np.concatenate([np.ones(len(picked)), -np.ones(len(clean))])
        cost = np.where(sign > 0, COST * max(1.0, 0.02 * len(clean) / len(picked)), COST)
        beta = squared_hinge(z, sign, cost)
        weights = features @ beta[:-1]
        order = np.concatenate([triple_sums(*encode(w), len(w), weights) for w in thousands(mine)])
        del z
    del z_clean, features
    give_back()
    model = ToxicModel(weights)
    peak = np.concatenate([model.highest(*flat(some)) for some in portions(texts)])
    return ToxicModel(weights, logistic(peak, y, totals))


def bag_of(text: str) -> list[str]:
    """The words of a text, each once, without marks around them."""
    return sorted({sys.intern(w.lower().strip(".,;:!?")) for w in text.split()} - {""})


def thousands(words: list[str]) -> Iterator[list[str]]:
    for i in range(0, len(words), 1000):
        yield words[i : i + 1000]


def portions(texts: list[str], limit: int = PIECE // 16) -> Iterator[list[str]]:
    """The texts in a row, some ``limit`` characters at a time; a longer text stands alone."""
    some, size = [], 0
    for text in texts:
        if some and size + len(text) > limit:
            yield some
            some, size = [], 0
        some.append(text)
        size += len(text)
    if some:
        yield some


def flat(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of some texts in a row, and where each begins."""
    parts = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return np.frombuffer(b"".join(parts), np.uint8), offsets


def learn(docs: DataFrame, labels: DataFrame, folds=FOLDS, held_out=HELD_OUT, most=SAMPLE) -> ToxicModel:
    """A model from at most ``most`` labelled texts of each kind outside the held-out fold, weighed by all of them."""
    rows = training_rows(docs, labels, "toxic", folds, held_out, most).collect()
    rows = sorted(rows, key=lambda r: (r["label"], r["text"] or ""))
    totals = label_totals(docs, labels, "toxic", folds, held_out)
    texts, toxic = [r["text"] or "" for r in rows], [r["label"] for r in rows]
    del rows
    give_back()
    model = fit(texts, toxic, totals)
    del texts
    give_back()
    return model


def score_toxicity(docs: DataFrame, model: ToxicModel, name: str = "toxicity") -> DataFrame:
    """All columns of ``docs`` and the score (0 to 1) of the column text, as ``name``.

    A column of that name gives way to the score; choose another name to keep it.
    """

    def scored(batches) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in arrays.pieces(batches, limit=PIECE):
            columns = [pa.concat_arrays(c.chunks) for c in rows.columns]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(model.score(data, offsets))], [*rows.column_names, name])

    plain = docs.drop(name)
    return in_tasks(plain, scored, plain.withColumn(name, F.lit(0.0)).schema)


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs = table(spark, sf_dir, "documents")
    scored = score_toxicity(docs.select("doc_id", "text"), learn(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= DECIDE).cast("int").alias("predicted"),
    )
