"""Cross-tokenizer alignment: which tokens of two vocabularies stand for the same bytes.

A token covers a range of the text's bytes, so a tokenizer's result is a sparse incidence matrix
of tokens by bytes. With A and B in compressed rows, Gustavson's product row by row of A and the
transpose of B holds an entry for each pair of tokens whose ranges overlap: the overlap links.
Byte offsets where tokens of both end cut them into groups; the product of the two incidence
matrices of tokens by groups holds the shared-group links. Their number alone needs only the
product's row lengths, so a large group never becomes all its pairs.

The matrices are made for a piece of texts at a time, whose token ranges follow one another.

Corpus-wide counts: a text's distinct id pairs leave the tasks with their numbers, Spark sums
them (map-side first), and each text's pairs meet the sums again. The table of sums grows with
the vocabularies, not with the corpus; it is broadcast only while its counted rows are at most
``MOST_BROADCAST``, above that the join is Spark's own shuffle join.

Token ids of the byte-level vocabulary come from the faster of two libraries that share it where
both give the same by construction (code points below U+0380, no stretch above ``LONG_RUN`` bytes
without a change between space and other), else from the vocabulary file's own library.

Defined results. Texts that are NULL or empty, or whose tokens' joined bytes are not the text's
with a space before it, have no tokens: zeros and an empty string. Repeated rows, NULL ids and
repeated ids: each row by itself, all counted corpus-wide. Extra columns do not matter.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgrid.llm import arrays
from airgrid.llm.shipping import in_tasks
from airgrid.llm.text import table
from airgrid.session import stored

TOKENIZERS = "/opt/tokenizers"
MOST_BROADCAST = 1 << 20  # id pairs, some 20 MB
LONG_RUN = 400
B_BITS = 15  # ids of B; a pair is one 31-bit number with ids of A below 2 ** 16

#: Byte-level vocabularies write these bytes as they are, the others from U+0100 on.
AS_IS = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


@dataclass
class Csr:
    """A sparse matrix of ones: row i has its columns in ``columns[starts[i]:starts[i + 1]]``."""

    starts: np.ndarray
    columns: np.ndarray
    width: int

    def transposed(self) -> Csr:
        order = np.argsort(self.columns, kind="stable")
        counts = np.bincount(self.columns, minlength=self.width)
        rows = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))
        return Csr(np.concatenate([[0], np.cumsum(counts)]), rows[order], len(self.starts) - 1)


def product_sizes(left: Csr, right: Csr) -> np.ndarray:
    """Terms of each row of the product, before equal ones are added up."""
    terms = np.diff(right.starts)[left.columns]
    sums = np.concatenate([[0], np.cumsum(terms)])
    return sums[left.starts[1:]] - sums[left.starts[:-1]]


def product(left: Csr, right: Csr) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gustavson's product: (row, column, value) of its entries, in order.

    Row i of the product is the sum of the rows of ``right`` that row i of ``left`` names.
    """
    begin, terms = right.starts[left.columns], np.diff(right.starts)[left.columns]
    total = np.cumsum(terms)
    n = int(total[-1]) if len(total) else 0
    at = np.arange(n) - np.repeat(total - terms - begin, terms)
    row = np.repeat(np.repeat(np.arange(len(left.starts) - 1), np.diff(left.starts)), terms)
    key = row * np.int64(max(right.width, 1)) + right.columns[at]
    if n > 1 and not np.all(key[1:] >= key[:-1]):
        key = np.sort(key, kind="stable")
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    heads = np.flatnonzero(new)
    row, column = np.divmod(key[heads], max(right.width, 1))
    return row, column, np.diff(heads, append=n)


def byte_incidence(ends: np.ndarray, n_bytes: int) -> Csr:
    """Tokens by bytes, for tokens that follow one another and end at ``ends``."""
    return Csr(np.concatenate([[0], ends]), np.arange(n_bytes), n_bytes)


def group_incidence(ends: np.ndarray, common: np.ndarray) -> Csr:
    """Tokens by groups; a group ends at each of the ``common`` ends."""
    return Csr(np.arange(len(ends) + 1), np.searchsorted(common, ends), len(common))


class Vocabulary:
    """The bytes of every token id, one after another."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.data = np.frombuffer(b"".join(tokens), np.uint8)
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.size) - self.size

    def joined(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        ends = np.cumsum(size)
        n = int(ends[-1]) if len(ends) else 0
        return self.data[np.arange(n) + np.repeat(self.start[ids] - ends + size, size)]


def byte_level_tokens(vocabulary: dict[str, int]) -> list[bytes]:
    """Bytes by id of a byte-level vocabulary."""
    others = [b for b in range(256) if b not in set(AS_IS)]
    byte_of = {chr(b): b for b in AS_IS} | {chr(256 + k): b for k, b in enumerate(others)}
    out = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        out[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
    return out


class Encoders:
    """Both tokenizers of a folder."""

    def __init__(self, folder: str) -> None:
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
        with open(f"{folder}/byte_bpe_50k.json", encoding="utf-8") as file:
            spec = json.load(file)
        self.own = Tokenizer.from_str(json.dumps(spec))
        self.own.encode_special_tokens = True
        with open(f"{folder}/byte_bpe_50k.tiktoken", "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.a = Vocabulary(byte_level_tokens(self.own.get_vocab()))
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/piece_bpe_32k.model")
        ids = range(self.pieces.get_piece_size())
        names = self.pieces.id_to_piece(list(ids))
        self.b = Vocabulary(
            [
                bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace("▁", " ").encode()
                for i, p in zip(ids, names, strict=True)
            ]
        )
        if len(self.b.size) > 1 << B_BITS or len(self.a.size) > 1 << (31 - B_BITS):
            raise ValueError("a pair of ids does not fit into 31 bits")

    def encode_a(self, texts: list[str], plain: np.ndarray) -> list[list[int]]:
        """Ids of a space and the text; ``plain`` texts take the faster library."""
        out = [self.fast.encode_ordinary(" " + t) if p else None for t, p in zip(texts, plain, strict=True)]
        rest = np.flatnonzero(~plain)
        found = self.own.encode_batch([" " + texts[i] for i in rest], add_special_tokens=False) if len(rest) else []
        for i, encoding in zip(rest, found, strict=True):
            out[i] = encoding.ids
        return out

    def encode_b(self, texts: list[str]) -> list[list[int]]:
        return self.pieces.encode(texts, num_threads=1)


#: Fixed: the split pattern that belongs to the byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_ENCODERS: dict[str, Encoders] = {}


def encoders(folder: str) -> Encoders:
    if folder not in _ENCODERS:
        _ENCODERS[folder] = Encoders(folder)
    return _ENCODERS[folder]


def plain_texts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts of code points below U+0380 without long stretches of space or of other bytes."""
    odd = np.concatenate([[0], np.cumsum(data >= 0xCE)])
    out = odd[offsets[1:]] == odd[offsets[:-1]]
    if len(data):
        space = arrays.SPACES[data]
        change = np.ones(len(data) + 1, bool)
        change[1:-1] = space[1:] != space[:-1]
        change[offsets] = True
        at = np.flatnonzero(change)
        long = at[:-1][np.diff(at) > LONG_RUN]
        out[np.searchsorted(offsets, long, side="right") - 1] = False
    return out


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for x in lists], np.int64)
    flat = np.concatenate([np.array(x, np.int64) for x in lists]) if len(lists) else np.zeros(0, np.int64)
    return flat, np.concatenate([[0], np.cumsum(sizes)])


def _spelled(ids: np.ndarray, first: np.ndarray, expected: np.ndarray, offsets: np.ndarray, known: Vocabulary):
    """Texts of which the tokens' joined bytes are the expected ones."""
    sizes = arrays.per_text(known.size[ids], first)
    right = sizes == np.diff(offsets)
    keep = np.repeat(right, np.diff(first))
    wanted = np.repeat(right, np.diff(offsets))
    same = known.joined(ids[keep]) == expected[wanted]
    cuts = np.concatenate([[0], np.cumsum(np.where(right, np.diff(offsets), 0))])
    right[arrays.per_text(~same, cuts) > 0] = False
    return right


@functools.cache
def decimals(n: int) -> np.ndarray:
    """A row of digits for each number below n, padded with zero bytes, and a place behind."""
    out = np.zeros((n, 6), np.uint8)
    left = np.arange(n)
    for k in range(4, -1, -1):
        out[:, k] = np.where((left > 0) | (k == 4), left % 10 + 0x30, 0)
        left = left // 10
    return out


class Aligned:
    """The tokens of a piece of texts, the links between them and their groups."""

    def __init__(self, texts: list[str], data: np.ndarray, offsets: np.ndarray, both: Encoders) -> None:
        n = len(texts)
        spaced = np.empty(len(data) + n, np.uint8)
        at = offsets + np.arange(n + 1)
        spaced[np.arange(len(data)) + np.repeat(np.arange(1, n + 1), np.diff(offsets))] = data
        spaced[at[:-1]] = 0x20
        a, first_a = _flat(both.encode_a(texts, plain_texts(data, offsets)))
        b, first_b = _flat(both.encode_b(texts))
        ok = np.diff(offsets) > 0
        ok &= _spelled(a, first_a, spaced, at, both.a) & _spelled(b, first_b, spaced, at, both.b)
        sizes = np.where(ok, np.diff(at), 0)
        #: Ids, the first token of each text, and where tokens end in the texts that have tokens.
        self.a, self.first_a = a[np.repeat(ok, np.diff(first_a))], _offsets(np.where(ok, np.diff(first_a), 0))
        self.b, self.first_b = b[np.repeat(ok, np.diff(first_b))], _offsets(np.where(ok, np.diff(first_b), 0))
        self.ends_a, self.ends_b = np.cumsum(both.a.size[self.a]), np.cumsum(both.b.size[self.b])
        self.ok, self.n_bytes = ok, int(sizes.sum())
        self.common = np.intersect1d(self.ends_a, self.ends_b, assume_unique=True)
        self.first_group = np.searchsorted(self.common, _offsets(sizes)[1:], side="right")
        self.text_a = np.repeat(np.arange(n), np.diff(self.first_a))

    def overlap_links(self) -> tuple[np.ndarray, np.ndarray]:
        """(token of A, token of B) of all links by common bytes."""
        right = byte_incidence(self.ends_b, self.n_bytes).transposed()
        row, column, _ = product(byte_incidence(self.ends_a, self.n_bytes), right)
        return row, column

    def groups(self) -> tuple[Csr, Csr]:
        return group_incidence(self.ends_a, self.common), group_incidence(self.ends_b, self.common)

    def shared_group_links(self) -> tuple[np.ndarray, np.ndarray]:
        """(token of A, token of B) of all links by a common group."""
        left, right = self.groups()
        row, column, _ = product(left, right.transposed())
        return row, column

    def shared_group_counts(self) -> np.ndarray:
        """The number of shared-group links of each text, without making them."""
        left, right = self.groups()
        return arrays.per_text(product_sizes(left, right.transposed()), self.first_a)

    def written(self) -> tuple[np.ndarray, np.ndarray]:
        """``a1,a2|b1;a3|b2,b3`` of all texts in a row, and where each text's part begins.

        Every part but an empty one ends with a separator too many.
        """
        left, right = self.groups()
        group = np.concatenate([left.columns, right.columns])
        order = np.argsort(group, kind="stable")  # of one group A's tokens stand first
        side = order >= len(self.a)
        digits = decimals(1 << 16)[np.concatenate([self.a, self.b])[order]]
        group = group[order]
        last = np.ones(len(group), bool)
        last[:-1] = (group[1:] != group[:-1]) | (side[1:] != side[:-1])
        digits[:, 5] = np.where(last, np.where(side, ord(";"), ord("|")), ord(","))
        flat = digits.ravel()
        cuts = _offsets((digits != 0).sum(axis=1))
        return flat[flat != 0], cuts[self.first_a + self.first_b]


def _offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])


def linked_texts(docs: DataFrame, folder: str = TOKENIZERS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_shared, groups_sha256, links) for every row.

    ``links`` are the text's distinct id pairs (a << 15 | b) with the number of their overlap
    links; n_shared counts shared-group links.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches) -> Iterator[pa.RecordBatch]:
        both = encoders(folder)
        for piece, data, offsets in arrays.pieces(batches):
            n = len(offsets) - 1
            texts = [t or "" for t in piece.column("text").to_pylist()]
            found = Aligned(texts, data, offsets, both)
            i, j = found.overlap_links()
            text = found.text_a[i]
            pair = text << 31 | found.a[i] << B_BITS | found.b[j]
            distinct, counts = np.unique(pair, return_counts=True)
            bounds = np.searchsorted(distinct, np.arange(n + 1) << 31).astype(np.int32)
            links = pa.StructArray.from_arrays(
                [pa.array((distinct & ((1 << 31) - 1)).astype(np.int32)), pa.array(counts.astype(np.int32))],
                ["pair", "n"],
            )
            out, cuts = found.written()
            view = memoryview(out.tobytes())
            digests = [
                hashlib.sha256(view[cuts[k] : cuts[k + 1] - 1]).hexdigest() if found.ok[k] else "" for k in range(n)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays(piece.column("doc_id").chunks),
                    pa.array(np.diff(found.first_a)),
                    pa.array(np.diff(found.first_b)),
                    pa.array(np.diff(found.first_group, prepend=0)),
                    pa.array(np.bincount(text, minlength=n).astype(np.int64)),
                    pa.array(found.shared_group_counts()),
                    pa.array(digests, pa.string()),
                    pa.ListArray.from_arrays(pa.array(bounds), links),
                ],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_shared", "groups_sha256", "links"],
            )

    schema = (
        f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_shared bigint, "
        "groups_sha256 string, links array<struct<pair:int,n:int>>"
    )
    return in_tasks(docs.select("doc_id", "text"), rows, schema)


def pair_counts(texts: DataFrame) -> DataFrame:
    """(pair, count, best) corpus-wide; ``best`` where no pair of the same B id counts more."""
    pairs = texts.select(F.inline("links")).groupBy("pair").agg(F.sum("n").alias("count"))
    pairs = stored(pairs.withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << B_BITS) - 1))), "pair_counts")
    highest = pairs.groupBy("b").agg(F.max("count").alias("highest"))
    return pairs.join(highest, "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def align_tokens(docs: DataFrame, folder: str = TOKENIZERS, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """The columns of ``linked_texts`` but ``links``, with n_best and count_sum."""
    texts = stored(linked_texts(docs, folder).withColumn("row", F.monotonically_increasing_id()), "linked_texts")
    known = stored(pair_counts(texts), "pair_bests")
    if known.count() <= most_broadcast:
        known = F.broadcast(known)
    sums = (
        texts.select("row", F.inline("links"))
        .join(known, "pair")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
            F.sum(F.col("n") * F.col("count")).alias("count_sum"),
        )
    )
    nothing = F.lit(0).cast("bigint")
    return (
        texts.drop("links")
        .join(sums, "row", "left")
        .withColumns({c: F.coalesce(c, nothing) for c in ("n_best", "count_sum")})
        .drop("row")
    )


def op12_align_tokens(spark, sf_dir: str) -> DataFrame:
    """Every document's tokens of both vocabularies, linked."""
    return align_tokens(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_shared"
    )
