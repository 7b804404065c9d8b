"""Benchmark decontamination by winnowing.

Of the hashes of all ``GRAM``-word grams in each stretch of ``WINDOW`` words, the least is
kept as a fingerprint, on both sides. Two texts that share ``WINDOW`` words in a row keep
a common fingerprint there, so every shared window is found. A document's fingerprints that
may be in the benchmark are extended to the windows around them, and those join the
benchmark's windows by 128-bit names; the matches give the words hit and the items.

Scale. A fixed-size filter of the benchmark's fingerprints and one of its windows (bits set
by hash) go to the tasks, whatever the benchmark's size; a fuller filter only lets more
windows through to the join. What leaves the first pass is a row for each document with its
few candidate windows, so texts are read once and never shuffled. The join is Spark's: a
broadcast while the benchmark is below the threshold, else a shuffle that can split hot
windows. An item shorter than a window is one window; lengths that occur are looked up at
each word, through the same filter.

Defined results. NULL and empty texts have no words and no hits; items without words have no
window. Repeated rows, NULL ids and repeated ids: a result for each row of its own text.
NULL item ids hit words but are in no list. Extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airgrid.llm import arrays
from airgrid.llm.shipping import in_tasks
from airgrid.llm.text import let, rows_by_key, table
from airgrid.session import stored

WINDOW, GRAM = 10, 5
FILTER_BITS = 1 << 22


class Sequence:
    """The words of a piece of texts, and names of any stretch of them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        data = arrays.LOWER[data]
        starts, ends, self.first = arrays.find_words(data, offsets, arrays.NOT_PLAIN)
        self.n = len(starts)
        self.names = [arrays.Doubled(w, k) for k, w in enumerate(arrays.word_symbols(data, starts, ends, (0, 1)))]
        self.owner = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self.end = self.first[1:][self.owner]  # of each word's text

    def name(self, start: np.ndarray, length: int, which: int = 0) -> np.ndarray:
        return arrays.mix(self.names[which].of(start, start + length) + np.uint64(length))

    def starts_of(self, length: int) -> np.ndarray:
        """Where a stretch of so many words begins inside one text."""
        at = np.arange(self.n)
        return at[at + length <= self.end]

    def fingerprints(self, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
        """Winnowed places and their gram names: the least of each window, the last of equals."""
        starts = self.starts_of(window)
        if not len(starts):
            return starts, np.zeros(0, np.uint64)
        names = np.zeros(self.n, np.uint64)
        inner = self.starts_of(gram)
        names[inner] = self.name(inner, gram)
        best, place = names[starts], starts
        for shift in range(1, window - gram + 1):
            other = names[starts + shift]
            lower = other <= best
            best, place = np.where(lower, other, best), np.where(lower, starts + shift, place)
        chosen = np.zeros(self.n, bool)
        chosen[place] = True
        place = np.flatnonzero(chosen)
        return place, names[place]


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def benchmark_windows(items: DataFrame, window: int, gram: int) -> DataFrame:
    """Rows (kind, name1, name2, length, item_id); kind 0 a window, 1 a fingerprint."""
    kind_of = items.schema["item_id"].dataType.simpleString()

    def rows(batches) -> Iterator[pa.RecordBatch]:
        for piece, data, offsets in arrays.pieces(batches):
            words = Sequence(data, offsets)
            ids = pa.concat_arrays(piece.column("item_id").chunks)
            sizes = np.diff(words.first)
            parts = []
            at = words.starts_of(window)
            parts.append((0, at, window, words.name(at, window), words.name(at, window, 1)))
            for length in np.unique(sizes[(sizes > 0) & (sizes < window)]):
                at = words.first[:-1][sizes == length]
                parts.append((0, at, int(length), words.name(at, int(length)), words.name(at, int(length), 1)))
            at, names = words.fingerprints(window, gram)
            parts.append((1, at, gram, names, names))
            for kind, at, length, one, two in parts:
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(at), kind, np.int32)),
                            signed(one),
                            signed(two),
                            pa.array(np.full(len(at), length, np.int32)),
                            ids.take(pa.array(words.owner[at])),
                        ],
                        ["kind", "name1", "name2", "length", "item_id"],
                    )

    return in_tasks(
        items.select("item_id", "text"), rows, f"kind int, name1 bigint, name2 bigint, length int, item_id {kind_of}"
    )


def _filter(known: DataFrame, bits: int) -> np.ndarray:
    """A byte array with the bits of ``known.name1`` set; at most ``bits`` places come back."""
    places = known.select(F.pmod("name1", F.lit(bits)).cast("int").alias("bit")).distinct().toPandas()
    out = np.zeros(bits, bool)
    out[places["bit"].to_numpy(np.int64)] = True
    return np.packbits(out, bitorder="little")


def _maybe(bits: np.ndarray, names: np.ndarray) -> np.ndarray:
    place = names.view(np.int64) % (len(bits) * 8)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def candidate_windows(
    docs: DataFrame, prints: np.ndarray, windows: np.ndarray, short: list[int], window: int, gram: int
) -> DataFrame:
    """Every row of ``docs`` with n_words and the windows that pass the filters."""
    fields = "n_words bigint, windows array<struct<start:int,length:int,name1:bigint,name2:bigint>>"
    others = [c for c in docs.columns if c != "text"]
    kinds = [f"{c} {docs.schema[c].dataType.simpleString()}" for c in others]
    schema = ", ".join([*kinds, fields])

    def rows(batches) -> Iterator[pa.RecordBatch]:
        for piece, data, offsets in arrays.pieces(batches):
            words = Sequence(data, offsets)
            at, names = words.fingerprints(window, gram)
            at = at[_maybe(prints, names)]
            near = (at[:, None] - np.arange(window - gram + 1)).ravel()
            near = np.unique(near[near >= 0])
            near = near[(near + window <= words.end[near])] if len(near) else near
            found = [(near, window)]
            found += [(words.starts_of(length), length) for length in short]
            starts, lengths, ones, twos = [], [], [], []
            for at, length in found:
                one = words.name(at, length)
                ok = _maybe(windows, one)
                at = at[ok]
                starts.append(at)
                lengths.append(np.full(len(at), length))
                ones.append(one[ok])
                twos.append(words.name(at, length, 1))
            start = np.concatenate(starts)
            order = np.argsort(start, kind="stable")
            start = start[order]
            owner = words.owner[start] if len(start) else start
            counts = np.bincount(owner, minlength=len(offsets) - 1)
            structs = pa.StructArray.from_arrays(
                [
                    pa.array((start - words.first[owner]).astype(np.int32)),
                    pa.array(np.concatenate(lengths)[order].astype(np.int32)),
                    signed(np.concatenate(ones)[order]),
                    signed(np.concatenate(twos)[order]),
                ],
                ["start", "length", "name1", "name2"],
            )
            ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    *[pa.concat_arrays(piece.column(c).chunks) for c in others],
                    pa.array(np.diff(words.first).astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends), structs),
                ],
                [*others, "n_words", "windows"],
            )

    return in_tasks(docs, rows, schema)


def covered(ranges: Column) -> Column:
    """Words inside any of the (start, end) ranges."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("at"))

    def step(acc: Column, r: Column) -> Column:
        begin = F.greatest(acc["at"], r["start"])
        more = F.greatest(r["end"] - begin, F.lit(0)).cast("bigint")
        return F.struct((acc["n"] + more).alias("n"), F.greatest(acc["at"], r["end"]).alias("at"))

    return F.aggregate(F.sort_array(ranges), start, step, lambda acc: acc["n"])


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    bits: int = FILTER_BITS,
    with_text_hash: bool = False,
) -> DataFrame:
    """(doc_id, n_words, n_hit, items, spans) for every row: item ids sorted as strings, and
    the matching windows as (start, end) word ranges; on request text_hash (xxhash64)."""
    extra = ["text_hash"] if with_text_hash else []
    docs = docs.select("doc_id", "text", *[F.xxhash64(F.coalesce("text", F.lit(""))).alias(c) for c in extra])
    known = stored(benchmark_windows(items, window, gram), "benchmark_windows")
    full = known.where("kind = 0").select("name1", "name2", "length", "item_id").distinct()
    short = sorted(r["length"] for r in full.where(F.col("length") < window).select("length").distinct().collect())
    prints = _filter(known.where("kind = 1"), bits)
    windows = _filter(full, bits)
    rows = stored(
        candidate_windows(docs, prints, windows, short, window, gram).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "candidate_windows",
    )
    hits = (
        rows.select("row", F.explode("windows").alias("w"))
        .select("row", "w.*")
        .join(full, ["name1", "name2", "length"])
        .groupBy("row")
        .agg(
            F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end"))).alias("spans"),
            F.collect_set(F.col("item_id").cast("string")).alias("items"),
        )
    )
    joined = rows.select("row", "doc_id", "n_words", *extra).join(hits, "row", "left")
    no_items, no_spans = F.array().cast("array<string>"), F.array().cast("array<struct<start:int,end:int>>")
    return joined.select(
        "doc_id",
        "n_words",
        let(F.coalesce("spans", no_spans), covered).alias("n_hit"),
        F.sort_array(F.coalesce("items", no_items)).alias("items"),
        F.sort_array(F.coalesce("spans", no_spans)).alias("spans"),
        *extra,
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``docs`` without the rows of which a word is hit; all columns and other rows stay.

    Rows are told apart by id and text, so rows that repeat an id are judged each for itself.
    """
    found = decontaminate(docs, items, window, gram, with_text_hash=True).where("n_hit > 0")
    return rows_by_key(docs, found.select("doc_id", F.col("text_hash").alias("mark")), "left_anti")


def op4_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Every document against every benchmark item."""
    judged = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP4_SQL = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)
), doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), doc_windows AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i
        FROM doc_words CROSS JOIN (SELECT DISTINCT size FROM item_windows) WHERE len(w) >= size)
), hits AS (
  SELECT doc_id, i, d.size, item_id FROM doc_windows d JOIN item_windows t ON d.win = t.win AND d.size = t.size
), hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS items FROM hits GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(len(items), 0)::BIGINT AS n_items, sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
