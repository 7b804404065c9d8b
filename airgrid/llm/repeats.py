"""Finding every window of a fixed length that occurs earlier in a corpus.

Shared by the operators that remove repeated passages. A text is a sequence of 64-bit
symbols (words or bytes). The caller marks places where its own parse of the text begins a
new symbol; whether a place is marked depends on at most ``reach`` symbols on either side. A
window elects the marked place of least name that is at least ``reach`` symbols from both of
its ends (any place, where none is marked). Equal windows therefore elect the same place, and
the ``2 * reach`` symbols around it, the core, are part of every window that elects it.
Successive windows that elect one place form a unit.

1. Each unit is a row (core, unit, document, start, count): far fewer rows than windows.
   Sorted by Spark, which spills, equal units stand together: all but the first are
   repeated as a whole. A first unit whose core also has other units is unsettled; a core
   that occurs once is settled at once, and most are.
2. Windows of unsettled units only are named one by one, sorted and settled in the same way.
3. What is repeated returns to its document.

Within a task equal units of a piece are settled before the shuffle, so a passage that a
third of all texts share sends one row for each piece. Names have 128 bits in all (core and
unit, or core and window). Texts travel twice, in the joins of steps 2 and 3. Groups collected
are the repeats of one document.

Rows that repeat an id and its text count as one document and each get its result. Rows of one
id and different texts are documents of their own, in the order of the texts' hashes. A NULL id
counts as lower than any other and names nothing: each such row is a document of its own, in the
order of the texts' hashes. ``row`` tells documents of one id apart.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airgrid.llm import arrays
from airgrid.llm.shipping import in_tasks
from airgrid.session import stored

_PLACE_BITS = 30
_COUNT_BITS = 15  # start, count and the settled flag travel in one number, as rows are many


@dataclass
class Parsed:
    """A piece of texts: two families of symbols, the first symbol of each text, the marks."""

    symbols: tuple[np.ndarray, np.ndarray]
    first: np.ndarray
    marks: np.ndarray


@dataclass(frozen=True)
class Method:
    """How texts become symbols, the window's length, how far a mark depends, how stretches are named."""

    parse: Callable[[np.ndarray, np.ndarray], Parsed]
    length: int
    reach: int
    piece: int
    naming: type = arrays.Ranges

    def __post_init__(self) -> None:
        if not 2 * self.reach + 2 <= self.length < 1 << _COUNT_BITS:
            raise ValueError(f"a window has {2 * self.reach + 2} to {(1 << _COUNT_BITS) - 1} symbols")


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of ``width`` values from each place on; shorter by ``width - 1``."""
    n = len(values)
    if n < width:
        return values[:0]
    rows = -(-n // width)
    grid = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    grid[:n] = values
    grid = grid.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


class Named:
    """Names of the cores, units and windows of a parsed piece."""

    def __init__(self, parsed: Parsed, method: Method) -> None:
        self.method, self.first = method, parsed.first
        self.marks = parsed.marks
        self.names = [method.naming(s, k) for k, s in enumerate(parsed.symbols)]
        self.n = len(parsed.symbols[0])
        self.sizes = np.diff(parsed.first)

    def core(self, place: np.ndarray) -> np.ndarray:
        reach = self.method.reach
        return self.names[0].of(place - reach, place + reach)

    def stretch(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self.names[1].of(start, end)

    def units(self) -> tuple[np.ndarray, ...]:
        """(text, start, count, place) of every unit; places count over the whole piece."""
        length, reach = self.method.length, self.method.reach
        nothing = np.zeros(0, np.int64)
        if self.n < length:
            return nothing, nothing, nothing, nothing
        if self.n >= 1 << _PLACE_BITS:
            raise ValueError(f"a text has more than {(1 << _PLACE_BITS) - 1} symbols")
        place = np.arange(reach, self.n - reach + 1)
        order = (self.core(place) >> np.uint64(1 + _PLACE_BITS)) << np.uint64(_PLACE_BITS)
        plain = np.ones(self.n + 1, bool)
        plain[: self.n] = ~self.marks
        order |= (plain[place].astype(np.uint64) << np.uint64(63)) | place.astype(np.uint64)
        least = sliding_least(order, length - 2 * reach + 1)
        del order
        text = np.repeat(np.arange(len(self.sizes)), np.maximum(self.sizes - length + 1, 0))
        begin = np.cumsum(np.maximum(self.sizes - length + 1, 0)) - np.maximum(self.sizes - length + 1, 0)
        start = np.arange(len(text)) - begin[text] + self.first[:-1][text]
        chosen = (least[start] & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
        if not len(start):
            return nothing, nothing, nothing, nothing
        new = np.ones(len(start), bool)
        new[1:] = (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1])
        at = np.flatnonzero(new)
        return text[at], start[at], np.diff(at, append=len(start)), chosen[at]


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, row, text) of all rows; ``row`` is 0 where an id has one text, as most have.

    Ids of several texts, of which there are few, get the text's hash; rows without an id are
    numbered in the order of their texts' hashes, whatever files they come from, and written, so
    that every reading sees the same numbers. Which of two equal texts is first does not matter.
    """
    docs = docs.select("doc_id", "text")
    named = docs.where(F.col("doc_id").isNotNull())
    text = F.xxhash64("text")
    several = named.groupBy(F.col("doc_id").alias("of")).agg(F.min(text).alias("a"), F.max(text).alias("b"))
    several = stored(several.where("a <> b").select("of"), "repeat_ids")
    row = F.when(F.col("of").isNotNull(), text).otherwise(F.lit(0).cast("bigint"))
    named = named.join(several, F.col("doc_id") == F.col("of"), "left").select("doc_id", row.alias("row"), "text")
    # The second key lets rows of one text go to several parts.
    unnamed = docs.where(F.col("doc_id").isNull()).withColumn("nth", F.monotonically_increasing_id())
    unnamed = unnamed.orderBy(text, "nth").select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    return named.unionByName(stored(unnamed, "repeat_unnamed"))


def _ranks(piece: pa.Table) -> np.ndarray:
    """Order of the documents by (doc_id, row), NULL first, rows of one document alike."""
    ids = pc.rank(_ids(piece), "ascending", null_placement="at_start", tiebreaker="dense").to_numpy()
    row = piece.column("row").to_numpy()
    order = np.lexsort((row, ids))
    new = np.ones(len(order), np.int64)
    new[1:] = (ids[order][1:] != ids[order][:-1]) | (row[order][1:] != row[order][:-1])
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def _settled(one: np.ndarray, two: np.ndarray, rank: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Rows whose names stand in this piece in an earlier place."""
    order = np.lexsort((start, rank, two, one))
    a, b, r, s = one[order], two[order], rank[order], start[order]
    head = np.ones(len(order), bool)
    head[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    of = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
    later = (r != r[of]) | (s != s[of])
    out = np.zeros(len(order), bool)
    out[order] = later
    return out


def _ids(piece: pa.Table) -> pa.Array:
    return pa.concat_arrays(piece.column("doc_id").chunks)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def _aside(one: np.ndarray, known: np.ndarray, rank: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Settled rows get a name of their own, so that they meet nowhere."""
    own = arrays.mix(arrays.spread(rank, 11) ^ arrays.spread(start, 12) ^ one)
    return np.where(known, own, one)


def unit_rows(docs: DataFrame, method: Method) -> DataFrame:
    """Step 1's rows of (doc_id, row, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches) -> Iterator[pa.RecordBatch]:
        for piece, data, offsets in arrays.pieces(batches, limit=method.piece):
            named = Named(method.parse(data, offsets), method)
            text, start, count, place = named.units()
            if not len(text):
                continue
            core = named.core(place)
            end = start + count - 1 + method.length
            unit = arrays.mix(named.stretch(start, end) + (place - start).astype(np.uint64))
            own = start - named.first[:-1][text]
            rank = _ranks(piece)[text]
            known = _settled(core, unit, rank, own)
            yield pa.RecordBatch.from_arrays(
                [
                    _signed(_aside(core, known, rank, own)),
                    _signed(unit),
                    _ids(piece).take(pa.array(text)),
                    pa.array(piece.column("row").to_numpy()[text]),
                    pa.array((own << _COUNT_BITS | count) << 1 | known),
                ],
                ["core", "unit", "doc_id", "row", "at"],
            )

    return in_tasks(docs, rows, f"core bigint, unit bigint, doc_id {kind}, row bigint, at bigint")


def window_rows(docs: DataFrame, method: Method) -> DataFrame:
    """Step 2's rows of (doc_id, row, text, open: the unsettled units' starts and counts)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches) -> Iterator[pa.RecordBatch]:
        for piece, data, offsets in arrays.pieces(batches, limit=method.piece):
            named = Named(method.parse(data, offsets), method)
            lists = pa.concat_arrays(piece.column("open").chunks)
            flat = lists.flatten()
            sizes = pc.list_value_length(lists).to_numpy()
            text = np.repeat(np.arange(len(lists)), sizes)
            begin = flat.field("start").to_numpy().astype(np.int64) + named.first[:-1][text]
            count = flat.field("count").to_numpy().astype(np.int64)
            core = np.repeat(flat.field("core").to_numpy(), count).view(np.uint64)
            text, total = np.repeat(text, count), np.cumsum(count)
            step = np.arange(total[-1] if len(total) else 0) - np.repeat(total - count, count)
            start = np.repeat(begin, count) + step
            if not len(start):
                continue
            name = named.stretch(start, start + method.length)
            own = start - named.first[:-1][text]
            rank = _ranks(piece)[text]
            known = _settled(core, name, rank, own)
            yield pa.RecordBatch.from_arrays(
                [
                    _signed(_aside(core, known, rank, own)),
                    _signed(name),
                    _ids(piece).take(pa.array(text)),
                    pa.array(piece.column("row").to_numpy()[text]),
                    pa.array(own << 1 | known),
                ],
                ["core", "name", "doc_id", "row", "at"],
            )

    return in_tasks(docs, rows, f"core bigint, name bigint, doc_id {kind}, row bigint, at bigint")


def settled_units(docs: DataFrame, method: Method) -> DataFrame:
    """Step 1, written: (doc_id, row, start, count, core, state); state 2 is repeated, 1 unsettled."""
    units = unit_rows(docs, method).repartition("core")
    earlier = F.rank().over(Window.partitionBy("core", "unit").orderBy("doc_id", "row", "at"))
    known = F.col("at").bitwiseAND(F.lit(1)) == 1
    shared = Window.partitionBy("core")
    judged = units.withColumn("place", earlier).withColumn(
        "mixed", F.min("unit").over(shared) != F.max("unit").over(shared)
    )
    state = F.when(known | (F.col("place") > 1), 2).when(F.col("mixed"), 1)
    start = F.shiftright("at", _COUNT_BITS + 1).cast("int").alias("start")
    count = F.shiftright("at", 1).bitwiseAND(F.lit((1 << _COUNT_BITS) - 1)).cast("int").alias("count")
    return stored(
        judged.select("doc_id", "row", start, count, "core", state.alias("state")).where("state IS NOT NULL"),
        "repeat_units",
    )


def _same_document() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("row") == F.col("nth"))


def settled_windows(docs: DataFrame, units: DataFrame, method: Method) -> DataFrame:
    """Step 2, written: (doc_id, row, start) of repeated windows in the unsettled units."""
    unsettled = (
        units.where("state = 1")
        .groupBy(F.col("doc_id").alias("of"), F.col("row").alias("nth"))
        .agg(F.collect_list(F.struct("start", "count", "core")).alias("open"))
    )
    texts = docs.join(unsettled, _same_document()).select("doc_id", "row", "text", "open")
    windows = window_rows(texts, method).repartition("core", "name")
    earlier = F.rank().over(Window.partitionBy("core", "name").orderBy("doc_id", "row", "at"))
    known = F.col("at").bitwiseAND(F.lit(1)) == 1
    windows = windows.withColumn("place", earlier).where(known | (F.col("place") > 1))
    return stored(windows.select("doc_id", "row", F.shiftright("at", 1).cast("int").alias("start")), "repeat_windows")


def repeated_ranges(docs: DataFrame, method: Method) -> DataFrame:
    """(doc_id, row, start, end) ranges of symbols in windows that start earlier, too.

    Each step is written in a function of its own, so that Spark may drop the shuffle files
    of a step when the next one begins.
    """
    units = settled_units(docs, method)
    windows = settled_windows(docs, units, method)
    length = F.lit(method.length)
    whole = units.where("state = 2").select(
        "doc_id", "row", "start", (F.col("start") + F.col("count") - 1 + length).alias("end")
    )
    return whole.unionByName(windows.select("doc_id", "row", "start", (F.col("start") + length).alias("end")))


def without_repeats(docs: DataFrame, method: Method, keep, kept_type: str) -> DataFrame:
    """(doc_id, n, n_removed, spans, kept) for every row of (doc_id, text).

    ``spans`` are the maximal removed runs as (start, end) in symbols. ``keep(data, offsets,
    removed)`` gives the bytes that stay, in a row, and where each text's part begins.
    """
    docs = keyed(docs)
    found = (
        repeated_ranges(docs, method)
        .groupBy(F.col("doc_id").alias("of"), F.col("row").alias("nth"))
        .agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    )
    joined = docs.join(found, _same_document(), "left").select("doc_id", "text", "ranges")
    kind = docs.schema["doc_id"].dataType.simpleString()
    arrow_type = pa.binary() if kept_type == "binary" else pa.string()

    def rows(batches) -> Iterator[pa.RecordBatch]:
        for piece, data, offsets in arrays.pieces(batches, limit=method.piece):
            first, keep_bytes = keep(data, offsets)
            n = int(first[-1])
            lists = pa.concat_arrays(piece.column("ranges").chunks)
            flat = lists.flatten()
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            base = np.repeat(first[:-1], sizes)
            change = np.zeros(n + 1, np.int64)
            np.add.at(change, flat.field("start").to_numpy() + base, 1)
            np.add.at(change, flat.field("end").to_numpy() + base, -1)
            removed = np.cumsum(change[:-1]) > 0
            text = np.repeat(np.arange(len(lists)), np.diff(first))
            before = np.zeros(n, bool)
            before[1:] = removed[:-1] & (text[1:] == text[:-1])
            after = np.zeros(n, bool)
            after[:-1] = removed[1:] & (text[1:] == text[:-1])
            begins, ends = np.flatnonzero(removed & ~before), np.flatnonzero(removed & ~after) + 1
            owner = text[begins]
            spans = pa.StructArray.from_arrays(
                [
                    pa.array((begins - first[owner]).astype(np.int32)),
                    pa.array((ends - first[owner]).astype(np.int32)),
                ],
                ["start", "end"],
            )
            of = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(lists)))]).astype(np.int32)
            out, cuts = keep_bytes(removed)
            buffers = [None, pa.py_buffer(cuts.astype(np.int32).tobytes()), pa.py_buffer(out.tobytes())]
            yield pa.RecordBatch.from_arrays(
                [
                    _ids(piece),
                    pa.array(np.diff(first).astype(np.int64)),
                    pa.array(arrays.per_text(removed, first).astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(of), spans),
                    pa.Array.from_buffers(arrow_type, len(lists), buffers),
                ],
                ["doc_id", "n", "n_removed", "spans", "kept"],
            )

    schema = f"doc_id {kind}, n bigint, n_removed bigint, spans array<struct<start:int,end:int>>, kept {kept_type}"
    return in_tasks(joined, rows, schema)
