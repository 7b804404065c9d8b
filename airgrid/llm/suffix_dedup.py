"""Suffix-array dedup: bytes covered by a long string that stands earlier go.

Induced sorting sorts only the suffixes at S*-places (a byte below its left and not above its
right neighbour) and induces the rest. Here, too, only sampled S*-suffixes are sorted: of
those in reach of a 100-byte window, the one with the least name, about one byte in thirty.
Their tuples (name of the bytes around the place, name of the stretch, document, position)
are sorted by Spark, which spills to disk, so that a shard may be far larger than memory; there are no
priority queues, no recursion and no common-prefix values (see the README). Equal stretches stand together after the
sort; where tuples agree around the place but not over the whole stretch, the common part is
settled window by window in a second sort (see ``repeats``). Windows at unsampled places take
the verdict of the suffix that they elect. The full order of all suffixes is never needed
for fixed-length repeats, and is not made.

Defined results. NULL and empty texts: no bytes, nothing removed. Texts below the length
lose nothing. Kept bytes are binary, as a cut may split a character. Rows that repeat an id
and its text count as one document, other rows of one id or of none as documents of their own
(see ``repeats``). Other columns do not matter.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgrid.llm import arrays
from airgrid.llm.repeats import Method, Parsed, without_repeats
from airgrid.llm.text import table

LENGTH, REACH = 100, 20
PIECE = 1 << 20


def parse(data: np.ndarray, offsets: np.ndarray) -> Parsed:
    """Bytes as symbols, S*-places as marks."""
    marks = np.zeros(len(data), bool)
    if len(data) > 2:
        marks[1:-1] = (data[:-2] > data[1:-1]) & (data[1:-1] <= data[2:])
    return Parsed((arrays.byte_symbols(0)[data], arrays.byte_symbols(1)[data]), offsets, marks)


def keep_bytes(data: np.ndarray, offsets: np.ndarray):
    """The first byte of each text, and a function from removed bytes to the kept ones."""

    def kept(removed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        stay = ~removed
        return data[stay], np.concatenate([[0], np.cumsum(stay)])[offsets]

    return offsets, kept


def remove_repeated_bytes(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n, n_removed, spans, kept): bytes counted and removed, removed runs, kept bytes."""
    return without_repeats(docs, Method(parse, length, REACH, PIECE), keep_bytes, "binary")


def op10_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Bytes of every document in long strings that stand earlier."""
    found = remove_repeated_bytes(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.col("n").alias("n_bytes"),
        "n_removed",
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
