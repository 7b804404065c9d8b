"""Fill-in-middle: texts cut into prefix, middle and suffix at two unit ranks, and reordered.

A unit is a run of ASCII letters or any other single code point. The units of a text stand in
an indexable skip list: lane 0 links every unit, each express lane links about one in
``FAN`` of the lane below, and every link carries how many units and how many code points it
passes. A cut at rank r starts at the head of the top lane, follows links as long as their unit
widths stay within r, and goes down a lane where they do not; in lane 0 it stands exactly behind
r units, and the code-point widths passed on the way are the place of the cut in the text.

Cuts and forms come from the sha256 of ``seed:doc_id``, so reruns and other partitions agree.
The output is ``<P>prefix<S>suffix<M>middle`` (psm) or ``<S>suffix<P>prefix<M>middle`` (spm);
a text that holds one of the marks stays plain, so every output can be taken apart again.

Scale. One pass, no shuffle: each row is cut on its own, in pieces of bounded bytes (a longer text
is a piece of its own).

Defined results. NULL and empty texts: no units, plain, an empty output. A NULL id is written as
nothing in what is hashed, so such rows share their draws. Repeated rows: one result each. Extra
columns do not matter; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airgrid.llm import arrays
from airgrid.llm.shipping import in_tasks
from airgrid.llm.text import table

FAN = 4
PLAIN_FROM, SPM_BELOW = 90, 20  # of 100
MARKS = ("<P>", "<S>", "<M>")

_LETTER = np.zeros(256, bool)
_LETTER[list(range(0x41, 0x5B)) + list(range(0x61, 0x7B))] = True


class SkipList:
    """Units of one text by rank; ``lengths`` are their code points."""

    def __init__(self, lengths: np.ndarray) -> None:
        units, points = np.ones(len(lengths), np.int64), np.asarray(lengths, np.int64)
        self.n = len(units)
        #: From the bottom up: unit widths, code-point widths, and where a node stands one lane below.
        self.lanes = [(units, points, np.arange(self.n))]
        while len(units) > FAN:
            coin = arrays.spread(np.arange(len(units)), len(self.lanes)) % np.uint64(FAN) == 0
            coin[0] = True  # the head is in every lane
            below = np.flatnonzero(coin)
            if len(below) == len(units):
                break
            units, points = np.add.reduceat(units, below), np.add.reduceat(points, below)
            self.lanes.append((units, points, below))

    def find(self, rank: int) -> int:
        """Code points before the unit of this rank; rank n is the end."""
        if not 0 <= rank <= self.n:
            raise IndexError(rank)
        passed = at = place = 0
        for units, points, below in reversed(self.lanes):
            while place < len(units) and passed + units[place] <= rank:
                passed += int(units[place])
                at += int(points[place])
                place += 1
            if passed == rank:
                break
            place = int(below[place])
        return at


def unit_lengths(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of every unit of a piece of texts, and the first unit of each text."""
    letter = _LETTER[data]
    lead = (data & 0xC0) != 0x80
    joined = np.zeros(len(data), bool)
    joined[1:] = letter[1:] & letter[:-1]
    joined[offsets[:-1][offsets[:-1] < len(data)]] = False
    starts = np.flatnonzero(lead & ~joined)
    first = np.searchsorted(starts, offsets)
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum(lead, out=points[1:])
    return np.diff(points[np.append(starts, len(data))]), first


def draws(seed: str, doc_id) -> list[int]:
    """Four numbers of 32 bits fixed by the seed and the id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]


def cut(text: str, lengths: np.ndarray, numbers: list[int]) -> tuple[str, int | None, int | None, str]:
    """(form, prefix's and middle's code points, output) of one text."""
    if not text or any(mark in text for mark in MARKS) or numbers[2] % 100 >= PLAIN_FROM:
        return "plain", None, None, text
    units = SkipList(lengths)
    ranks = sorted(h % (units.n + 1) for h in numbers[:2])
    a, b = (units.find(r) for r in ranks)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if numbers[3] % 100 < SPM_BELOW:
        return "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def fill_in_middle(docs: DataFrame, seed: str = "1") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for every row; n counts units."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches) -> Iterator[pa.RecordBatch]:
        for piece, data, offsets in arrays.pieces(batches):
            lengths, first = unit_lengths(data, offsets)
            ids = pa.concat_arrays(piece.column("doc_id").chunks)
            texts = piece.column("text").to_pylist()
            parts = [
                cut(text or "", lengths[first[i] : first[i + 1]], draws(seed, doc))
                for i, (doc, text) in enumerate(zip(ids.to_pylist(), texts, strict=True))
            ]
            form, prefix, middle, output = zip(*parts, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(np.diff(first).astype(np.int64)),
                    pa.array(form, pa.string()),
                    pa.array(prefix, pa.int64()),
                    pa.array(middle, pa.int64()),
                    pa.array(output, pa.string()),
                ],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    schema = f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    return in_tasks(docs.select("doc_id", "text"), rows, schema)


def restored(output: Column, form: Column) -> Column:
    """The text an output was made of.

    A mark cannot begin in a part and end in the mark behind it, as '<' only begins marks; so
    splitting at the marks gives back the parts.
    """
    parts = F.split(output, "<P>|<S>|<M>", -1)
    psm = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))
    spm = F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op11_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    """Every document cut and rebuilt."""
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


OP11_SQL = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u FROM documents
), drawn AS (
  SELECT doc_id, text, u, len(u) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM units
), formed AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn
), parted AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS pre, coalesce(array_to_string(u[a + 1:b], ''), '') AS mid,
         coalesce(array_to_string(u[b + 1:n], ''), '') AS suf FROM formed
)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(pre) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid
              ELSE '<P>' || pre || '<S>' || suf || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parted
"""
