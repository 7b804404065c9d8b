"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash of the last ``CONTEXT`` bytes decides at every byte whether a chunk ends there:
at block size 2**k where the hash ends in k zero bits, so the boundaries of a block size are
among those of the size below, and an edit moves only the boundaries near it. Each chunk gives
one of 64 characters. A text's block size is the smallest with at most ``MOST`` boundaries;
its fingerprint is ``size:signature:signature:signature`` at that size and its two doubles.

Two fingerprints are compared by the signatures of the finest block size that both have: the
likeness is 1 - d / (both lengths), d the edit distance of insertions and deletions. It is 0
where the signatures share no run of a quarter of the shorter one's characters (3 at least
where there are as many, 7 at most), which keeps strange texts at 0, and 1 for equal fingerprints.

Neighbours. Documents are dealt by ranges of their order (one exchange of the texts), sorted,
and read through: each task gives all but its last document, which waits for the first one
of the next range. First and last documents, one of each per range, are written with their
texts and joined; only their range numbers, a few per task, are ordered in one window.

Defined results. NULL and empty texts: 0 characters and the fingerprint ``4:::``. The order is
descending doc_id, NULL last; rows of one id stand by their texts' hashes, so reruns agree.
The last row is followed by the first, a single row by itself. Repeated rows: one result each.
Extra columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airgrid.llm import arrays
from airgrid.llm.shipping import in_tasks
from airgrid.llm.text import table
from airgrid.session import stored

CONTEXT = 7
LEAST = 2  # block sizes are 4 and its doubles
SIZES = 3  # signatures in a fingerprint
MOST = 64
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)


def rolling(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The last ``CONTEXT`` bytes at every byte as one number; no byte of the text before."""
    inner = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    out = data.astype(np.uint64)
    for back in range(1, CONTEXT):
        earlier = np.where(inner[back:] >= back, data[:-back], 0) if back < len(data) else data[:0]
        out[back:] |= earlier.astype(np.uint64) << np.uint64(8 * back)
    return out


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> list[str]:
    """One for each text of a piece."""
    n = len(offsets) - 1
    seen = rolling(data, offsets)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(arrays.spread(seen, 1), out=sums[1:])
    hashed = arrays.spread(seen, 0)
    edge = np.flatnonzero(hashed & np.uint64((1 << LEAST) - 1) == 0)
    low = hashed[edge]
    level = np.bitwise_count((low & (~low + np.uint64(1))) - np.uint64(1)).astype(np.int64)
    text = np.searchsorted(offsets, edge, side="right") - 1
    counts = np.bincount(text * 65 + level, minlength=n * 65).reshape(n, 65)
    at_least = counts[:, ::-1].cumsum(axis=1)[:, ::-1]
    chosen = np.maximum((at_least > MOST).sum(axis=1), LEAST)  # at_least falls along a row
    signatures = []
    for coarser in range(SIZES):
        inside = level >= chosen[text] + coarser
        ends, owner = edge[inside] + 1, text[inside]
        last = np.setdiff1d(offsets[1:][np.diff(offsets) > 0], ends, assume_unique=True)  # an open chunk's end
        ends = np.sort(np.concatenate([ends, last]), kind="stable")
        owner = np.searchsorted(offsets, ends - 1, side="right") - 1
        begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        letters = ALPHABET[arrays.mix(sums[ends] - sums[begins]) >> np.uint64(58)].tobytes().decode()
        cuts = np.searchsorted(owner, np.arange(n + 1))
        signatures.append([letters[cuts[i] : cuts[i + 1]] for i in range(n)])
    return [":".join([str(1 << int(k)), *own]) for k, *own in zip(chosen, *signatures, strict=True)]


def common_length(a: str, b: str) -> int:
    """Longest common subsequence, by the bits of one number for all places of ``a``."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    whole = (1 << len(a)) - 1
    row = whole
    for c in b:
        match = row & places.get(c, 0)
        row = ((row + match) | (row - match)) & whole
    return len(a) - row.bit_count()


def signature_likeness(a: str, b: str) -> float:
    """1 - edit distance / lengths; 0 without a common run of a quarter of the shorter, 3 to 7."""
    shorter = min(len(a), len(b))
    run = max(1, min(shorter, 7, max(3, shorter // 4)))
    runs = {a[i : i + run] for i in range(len(a) - run + 1)}
    if not any(b[i : i + run] in runs for i in range(len(b) - run + 1)):
        return 0.0
    distance = len(a) + len(b) - 2 * common_length(a, b)
    return 1 - distance / (len(a) + len(b))


def likeness(one: str, two: str) -> float:
    """How like two fingerprints are, 0 to 1."""
    if one == two:
        return 1.0
    (size_a, *a), (size_b, *b) = one.split(":"), two.split(":")
    sizes = {int(size_a) << k: s for k, s in enumerate(a)}
    common = [(sizes[int(size_b) << k], s) for k, s in enumerate(b) if int(size_b) << k in sizes]
    return signature_likeness(*common[0]) if common else 0.0


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by the first as many code points of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def packed(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


def _compared(ids: list, texts: list[str], prints: list[str], schema: pa.Schema, part: int) -> pa.RecordBatch:
    """Results of all but the last document, each followed by the next in the lists."""
    changed = [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
    other = fingerprints(*packed(changed)) if changed else []
    n = len(changed)
    return pa.RecordBatch.from_pydict(
        {
            "part": [part] * n,
            "edge": [0] * n,
            "doc_id": ids[:n],
            "n_chars": [len(t) for t in texts[:n]],
            "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
            "fingerprint": prints[:n],
            "edited_fingerprint": other,
            "near_edited": [likeness(a, b) for a, b in zip(prints, other, strict=False)],
            "near_next": [likeness(a, b) for a, b in zip(prints, prints[1:], strict=False)],
            "text": [None] * n,
        },
        schema=schema,
    )


def _edge(edge: int, doc_id, text: str, fingerprint: str, schema: pa.Schema, part: int) -> pa.RecordBatch:
    row = {"part": part, "edge": edge, "doc_id": doc_id, "n_chars": len(text), "fingerprint": fingerprint, "text": text}
    return pa.RecordBatch.from_pylist([row], schema=schema)


FIRST, LAST = 1, 2


def _fields(docs: DataFrame) -> tuple[str, pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema["doc_id"].dataType
    return kind.simpleString(), to_arrow_type(kind)


def _arrow_schema(kind: pa.DataType) -> pa.Schema:
    return pa.schema(
        [("part", pa.int32()), ("edge", pa.int32()), ("doc_id", kind), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
         ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
         ("near_next", pa.float64()), ("text", pa.string())]
    )


def in_order(docs: DataFrame) -> DataFrame:
    """Rows (part, edge, results): all but the last of each range done; its first and last with texts."""
    kind, arrow_kind = _fields(docs)
    keys = [F.col("doc_id").desc_nulls_last(), F.col("mark")]
    dealt = (
        docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"))
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
    )

    def rows(batches) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, schema = TaskContext.get().partitionId(), _arrow_schema(arrow_kind)
        last: tuple[list, list, list] | None = None
        for piece, data, offsets in arrays.pieces(batches):
            ids = piece.column("doc_id").to_pylist()
            texts = [t or "" for t in piece.column("text").to_pylist()]
            prints = fingerprints(data, offsets)
            if last is None:
                yield _edge(FIRST, ids[0], texts[0], prints[0], schema, part)
            else:
                ids, texts, prints = last[0] + ids, last[1] + texts, last[2] + prints
            yield _compared(ids, texts, prints, schema, part)
            last = ids[-1:], texts[-1:], prints[-1:]
        if last is not None:
            yield _edge(LAST, last[0][0], last[1][0], last[2][0], schema, part)

    fields = (
        f"part int, edge int, doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double, text string"
    )
    return in_tasks(dealt, rows, fields)


def across_ranges(edges: DataFrame) -> DataFrame:
    """The results of the last document of each range, from the first one of the next range."""
    kind, arrow_kind = _fields(edges)
    firsts = edges.where(F.col("edge") == FIRST).select(
        F.col("part").alias("next_part"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_print")
    )
    order = edges.where(F.col("edge") == FIRST).select("part")  # a number for each range
    behind = order.select(
        "part",
        F.coalesce(
            F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy())
        ).alias("next_part"),
    )
    pairs = edges.where(F.col("edge") == LAST).join(behind, "part").join(firsts, "next_part")

    def rows(batches) -> Iterator[pa.RecordBatch]:
        schema = _arrow_schema(arrow_kind)
        for piece, _, _ in arrays.pieces(batches):
            for r in piece.to_pylist():
                yield _compared(
                    [r["doc_id"]], [r["text"], r["next_text"]], [r["fingerprint"], r["next_print"]], schema, r["part"]
                )

    return in_tasks(pairs, rows, edges.schema.simpleString()[len("struct<") : -1].replace(":", " "))


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)."""
    found = stored(in_order(docs), "fingerprints")
    joined = across_ranges(found.where("edge > 0"))
    return found.where("edge = 0").unionByName(joined).drop("part", "edge", "text")


def op13_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, and how like it is to its edited text's and the next document's."""
    return document_fingerprints(table(spark, sf_dir, "documents"))
