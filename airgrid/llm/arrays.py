"""Texts of an Arrow batch as flat byte arrays, for work inside Spark tasks.

A batch is cut into pieces of at most ``PIECE`` bytes (a longer text is a piece of its own),
so memory per task is bounded by the longest text, whatever the batch size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20

#: Bytes between words where a word is a run without ASCII white space.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

#: Bytes between words where a word is a run of digits, a-z and all beyond ASCII.
NOT_PLAIN = np.ones(256, bool)
NOT_PLAIN[list(range(0x30, 0x3A)) + list(range(0x61, 0x7B)) + list(range(0x80, 0x100))] = False

#: A-Z to a-z, other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

ODD = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def pieces(batches, text: str = "text", limit: int = PIECE) -> Iterator[tuple]:
    """(rows, bytes, offsets) per piece; a NULL text counts as empty."""
    for batch in batches:
        table = pa.Table.from_batches([batch]) if isinstance(batch, pa.RecordBatch) else batch
        if not table.num_rows:
            continue
        column = table.column(text).combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
        if column.null_count:
            column = pc.fill_null(column, "")
        if not pa.types.is_large_string(column.type):
            column = column.cast(pa.large_string())
        _, offsets, data = column.buffers()
        ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        at = 0
        while at < len(column):
            to = int(np.searchsorted(ends, ends[at] + limit, side="right")) - 1
            to = min(max(to, at + 1), len(column))
            yield table.slice(at, to - at), raw[ends[at] : ends[to]], ends[at : to + 1] - ends[at]
            at = to


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spread(x: np.ndarray, seed: int) -> np.ndarray:
    """Numbers to unrelated 64-bit numbers, another set for each seed."""
    return mix(x.astype(np.uint64) * np.uint64(ODD[0]) + np.uint64((seed + 1) * ODD[1] % (1 << 64)))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of an odd base and of its inverse modulo 2**64."""
    have = _POWERS.get(which)
    if have is None or len(have[0]) < n:
        size = 1 << max(n - 1, 1).bit_length()
        base = ODD[which]
        inverse = pow(base, -1, 1 << 64)
        table = []
        for b in (base, inverse):
            out = np.ones(size, np.uint64)
            step = 1
            while step < size:
                out[step : 2 * step] = out[:step] * np.uint64(pow(b, step, 1 << 64))
                step *= 2
            table.append(out)
        have = _POWERS[which] = (table[0], table[1])
    return have


class Doubled:
    """Names of any stretch of a sequence of 64-bit symbols, without sums.

    Stretches of 2**k symbols are named after their two halves, and any other stretch after the
    first and the last 2**k symbols in it, so a name depends on all symbols and their order
    through mixings only. Takes one pass a doubling: for stretches of words, not of bytes.
    """

    def __init__(self, symbols: np.ndarray, which: int = 0) -> None:
        self.which = which
        self.levels = [symbols]

    def _level(self, k: int) -> np.ndarray:
        while len(self.levels) <= k:
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            out = last.copy()
            if half < len(last):
                out[:-half] = self._both(last[:-half], last[half:])
            self.levels.append(out)
        return self.levels[k]

    def _both(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return mix(mix(one + np.uint64(ODD[self.which])) * np.uint64(ODD[1 - self.which]) + two)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        size = np.broadcast_to(end - start, np.shape(start))
        out = np.zeros(len(size), np.uint64)
        for k in range(int(size.max()).bit_length() if len(size) else 0):
            at = np.flatnonzero((size >> k) == 1)
            if len(at):
                level, a = self._level(k), start[at]
                named = self._both(level[a], level[a + size[at] - (1 << k)])
                out[at] = mix(named + size[at].astype(np.uint64))
        return out


class Ranges:
    """Fingerprints of any stretch of a sequence of symbols, by power sums modulo 2**64.

    Sums of stretches that follow a Thue-Morse order of 1,024 symbols or more can be equal; for
    stretches of fewer symbols, such as windows of bytes.
    """

    def __init__(self, symbols: np.ndarray, which: int = 0) -> None:
        self.which = which
        n = len(symbols)
        forward, _ = powers(n + 1, which)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols * forward[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        _, back = powers(len(self.sums), self.which)
        return mix((self.sums[end] - self.sums[start]) * back[start])


def byte_symbols(seed: int = 0) -> np.ndarray:
    """A random 64-bit symbol for every byte value."""
    return spread(np.arange(1, 257), seed)


def find_words(data: np.ndarray, offsets: np.ndarray, between: np.ndarray):
    """(start, end) of every word in bytes, and the first word of every text."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~between[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    before &= ~edge[:n]
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after &= ~edge[1:]
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_symbols(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seeds: tuple[int, ...] = (0,)) -> list[np.ndarray]:
    """For each seed a 64-bit symbol per word, equal for equal words.

    A word is read in blocks of 8 bytes; each block's bytes and its number go through a mixing that
    is not linear before blocks are summed, so no pattern of letters makes sums of unlike words meet.
    """
    size = ends - starts
    blocks = -(-size // 8)
    if not len(size):
        return [np.zeros(0, np.uint64) for _ in seeds]
    before = np.cumsum(size) - size
    inner = np.arange(int(size.sum()), dtype=np.int32)  # a text has fewer than 2**31 bytes
    inner -= np.repeat(before.astype(np.int32), size)
    raw = data[inner + np.repeat(starts.astype(np.int32), size)].astype(np.uint64)
    inner &= 7
    inner <<= 3
    raw <<= inner.astype(np.uint64)
    del inner
    first = np.cumsum(blocks) - blocks
    turn = np.arange(int(blocks.sum())) - np.repeat(first, blocks)
    packed = np.add.reduceat(raw, np.repeat(before, blocks) + 8 * turn)
    del raw
    numbered = (turn.astype(np.uint64) + np.uint64(1)) * np.uint64(ODD[1])
    length = size.astype(np.uint64) * np.uint64(ODD[0])
    return [mix(np.add.reduceat(mix(spread(packed, seed) + numbered), first) + length) for seed in seeds]


def per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over the stretches between ``offsets``."""
    sums = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]
