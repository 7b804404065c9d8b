"""Substring dedup by recompression: words covered by a passage that stands earlier go.

Rounds over every text name runs and pairs of symbols. A run of two equal words becomes one
symbol; then a fair coin, thrown for each symbol's name in each round, calls it left or right,
and a left one followed by a right one becomes a symbol named after both. Names and coins are
hashes of the content, hence the same in all texts without a dictionary, and only symbols
of bounded length take part in a round, so that the interior of equal passages is parsed
alike: whether a symbol begins at a word depends on ``REACH`` words on either side (2 for the
run, 1, 2 and 2 for the pairs). Places where symbols of the last round begin reveal shared passages, and
``repeats`` verifies them: it names the words around such a place, sorts, and settles window by
window what names alone leave open.

Defined results. NULL and empty texts: no words, nothing removed, the kept text empty. Texts
below the window's length lose nothing. Rows that repeat an id and its text count as
one document, other rows of one id or of none as documents of their own (see ``repeats``). Other columns do not matter.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgrid.llm import arrays
from airgrid.llm.repeats import Method, Parsed, without_repeats
from airgrid.llm.text import table

WINDOW, REACH = 20, 7
PAIR_LIMITS = (1, 2, 2)  # longest symbols, in words, that a round of pairs joins


def symbol_starts(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where a symbol of the last round begins, one flag per word."""
    n = len(words)
    name, start, size = words.copy(), np.arange(n), np.ones(n, np.int64)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))

    def join(left: np.ndarray, seed: int) -> None:
        """Each symbol flagged in ``left`` takes in the next one."""
        nonlocal name, start, size, text
        at = np.flatnonzero(left)
        name[at] = arrays.mix(name[at] * np.uint64(3) + arrays.spread(name[at + 1], seed))
        size[at] += size[at + 1]
        stay = np.ones(len(name), bool)
        stay[at + 1] = False
        name, start, size, text = name[stay], start[stay], size[stay], text[stay]

    def with_next(flags: np.ndarray) -> np.ndarray:
        out = np.zeros(len(name), bool)
        out[:-1] = flags & (text[1:] == text[:-1])
        return out

    if n < 2:
        return np.ones(n, bool)
    equal = with_next(name[1:] == name[:-1])
    before = np.zeros(n, bool)
    before[1:] = equal[:-1]
    after = np.zeros(n, bool)
    after[:-1] = equal[1:]
    join(equal & ~before & ~after, 5)
    for turn, limit in enumerate(PAIR_LIMITS):
        if len(name) < 2:
            break
        coin = arrays.spread(name, 20 + turn) >> np.uint64(63)
        small = size <= limit
        join(with_next((coin[:-1] == 0) & (coin[1:] == 1) & small[:-1] & small[1:]), 30 + turn)
    out = np.zeros(n, bool)
    out[start] = True
    return out


def parse(data: np.ndarray, offsets: np.ndarray) -> Parsed:
    starts, ends, first = arrays.find_words(data, offsets, arrays.SPACES)
    one, two = arrays.word_symbols(data, starts, ends, (0, 1))
    return Parsed((one, two), first, symbol_starts(one, first))


def keep_words(data: np.ndarray, offsets: np.ndarray):
    """The first word of each text, and a function from removed words to the kept bytes."""
    starts, ends, first = arrays.find_words(data, offsets, arrays.SPACES)

    def kept(removed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        stay = np.flatnonzero(~removed)
        spaced = np.zeros(len(starts), bool)  # a kept word before another one of its text
        spaced[stay[:-1]] = text[stay[:-1]] == text[stay[1:]]
        change = np.zeros(len(data) + 2, np.int8)
        change[starts[stay]] += 1
        change[ends[stay] + spaced[stay]] -= 1
        inside = np.cumsum(change[:-2], dtype=np.int8) > 0
        out = data.copy()
        out[ends[spaced]] = 0x20
        cuts = np.concatenate([[0], np.cumsum(inside)])[offsets]
        return out[inside], cuts

    return first, kept


def remove_repeated_words(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n, n_removed, spans, kept): words counted and removed, removed runs, kept text."""
    if window < 2 * REACH + 4:
        raise ValueError(f"a window has {2 * REACH + 4} words at least")
    return without_repeats(docs, Method(parse, window, REACH, arrays.PIECE, arrays.Doubled), keep_words, "string")


def op3_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Words of every document in passages that stand earlier."""
    found = remove_repeated_words(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.col("n").alias("n_words"), "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


OP3_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - 18)) AS i FROM words WHERE len(w) >= 20)
), repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS k FROM windows)
  WHERE k > 1
), gone AS (
  SELECT doc_id, list(DISTINCT p) AS places
  FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM repeated) GROUP BY doc_id
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM words)
  LEFT JOIN gone USING (doc_id) WHERE places IS NULL OR NOT list_contains(places, p) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM words LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
