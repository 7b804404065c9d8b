"""Fill-in-middle, token alignment and fingerprints against plain Python, with awkward rows."""

import hashlib
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from airgrid.llm import align_tokens, arrays, fill_in_middle, piecewise_hash

SCHEMA = "doc_id bigint, text string, n int, row int, part int, edge int, mark string"
UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def corpus(spark, rows):
    """Rows of (doc_id, text) with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, 7, 7, 7, 7, "m") for i, t in rows], SCHEMA)


def awkward():
    rng = random.Random(3)
    words = ["alpha", "Größe", "日本", "x1", "it's", "𝄞", "été", "don't", "<S", "S>", "<", "▁", "\t", "\x00", "é"]
    texts = [" ".join(rng.choices(words[:11], k=rng.randint(1, 120))) for _ in range(60)]
    texts += [None, "", " ", "\n\n\n  x", "a", "<P>x", "y <M> z", "tail <", "<S", "<|endoftext|> <s> <0x41>", "▁a", "x\x00y"]
    texts += ["z" * 5000, " " * 3000 + "q", "日" * 900, "ab, " * 4000, texts[0], texts[0], "\r\n" * 30]
    return texts


@pytest.fixture(scope="module")
def rows():
    texts = awkward()
    out = [(i, t) for i, t in enumerate(texts)]
    return out + [(None, "no id one"), (None, "no id two"), (5, texts[5]), (5, "another text of five")]


def key(x):
    return repr(tuple(x))


def test_skip_list_reaches_every_rank():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 5, 64, 1000, 4097):
        lengths = rng.integers(1, 9, n)
        units = fill_in_middle.SkipList(lengths)
        sums = np.concatenate([[0], np.cumsum(lengths)])
        assert [units.find(r) for r in range(n + 1)] == sums.tolist()
        with pytest.raises(IndexError):
            units.find(n + 1)
    # Express lanes shorten the way: the top lane is short.
    assert len(fill_in_middle.SkipList(np.ones(100_000, int)).lanes[-1][0]) <= 16


def test_fill_in_middle(spark, rows):
    made = fill_in_middle.fill_in_middle(corpus(spark, rows))
    back = fill_in_middle.restored(F.col("output"), F.col("form"))
    got = Counter(key(r) for r in made.select("*", back.alias("back")).collect())
    want = Counter()
    for i, t in rows:
        t = t or ""
        u = UNIT.findall(t)
        h = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
        a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
        p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
        if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
            want[key((i, len(u), "plain", None, None, t, t))] += 1
        elif h4 % 100 < 20:
            want[key((i, len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", t))] += 1
        else:
            want[key((i, len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", t))] += 1
    assert got == want
    assert fill_in_middle.fill_in_middle(corpus(spark, [])).collect() == []


def test_csr_products_by_definition():
    rng = np.random.default_rng(2)
    for _ in range(20):
        dense = [rng.random((rng.integers(1, 9), 7)) < 0.3, rng.random((rng.integers(1, 9), 7)) < 0.3]
        a, b = (
            align_tokens.Csr(np.concatenate([[0], np.cumsum(d.sum(1))]), np.nonzero(d)[1], 7) for d in dense
        )
        row, column, value = align_tokens.product(a, b.transposed())
        full = dense[0].astype(int) @ dense[1].T.astype(int)
        assert np.array_equal(np.nonzero(full), (row, column)) and np.array_equal(full[row, column], value)
        assert np.array_equal(align_tokens.product_sizes(a, b.transposed()), full.sum(1))


FOLDER = align_tokens.TOKENIZERS
needs_tokenizers = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no vocabulary files here")


def plainly_aligned(rows):
    """Per row what the contract asks for, token by token."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(f"{FOLDER}/byte_bpe_50k.json")
    one.encode_special_tokens = True
    two = SentencePieceProcessor(model_file=f"{FOLDER}/piece_bpe_32k.model")
    letters = align_tokens.byte_level_tokens(one.get_vocab())

    def spans(tokens):
        ends = np.cumsum([len(t) for t in tokens]).tolist()
        return list(zip([0, *ends], ends, strict=False))

    found, counts = [], Counter()
    for i, t in rows:
        ids_a = one.encode(" " + (t or ""), add_special_tokens=False).ids
        ids_b = two.encode(t or "")
        a = [letters[x] for x in ids_a]
        b = [bytes([int(p[3:5], 16)]) if two.is_byte(x) else p.replace("▁", " ").encode() for x, p in zip(ids_b, map(two.id_to_piece, ids_b), strict=True)]
        if not t or b"".join(a) != (" " + t).encode() or b"".join(b) != (" " + t).encode():
            found.append((i, 0, 0, [], [], ""))
            continue
        a, b = spans(a), spans(b)
        links = [(ids_a[j], ids_b[k]) for j, (s, e) in enumerate(a) for k, (p, q) in enumerate(b) if s < q and p < e]
        groups, j, k = [], 0, 0
        for end in sorted({e for _, e in a} & {e for _, e in b}):
            left = [x for x, (s, e) in zip(ids_a, a, strict=True) if j < e <= end]
            right = [x for x, (s, e) in zip(ids_b, b, strict=True) if j < e <= end]
            groups.append((left, right))
            j = end
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        counts.update(links)
        found.append((i, len(ids_a), len(ids_b), groups, links, hashlib.sha256(text.encode()).hexdigest()))
    best = {}
    for (_, b), c in counts.items():
        best[b] = max(best.get(b, 0), c)
    return Counter(
        key((i, n_a, n_b, len(g), len(ls), sum(counts[x] == best[x[1]] for x in ls), sum(counts[x] for x in ls), sha,
             sum(len(x) * len(y) for x, y in g)))
        for i, n_a, n_b, g, ls, sha in found
    )


@needs_tokenizers
def test_align_tokens(spark, rows):
    short = [(i, t if t is None else t[:1500]) for i, t in rows]  # the plain version compares all pairs
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_shared"]
    want = plainly_aligned(short)
    for most in (align_tokens.MOST_BROADCAST, 0):  # with a broadcast, and with a shuffle
        got = align_tokens.align_tokens(corpus(spark, short), most_broadcast=most)
        assert Counter(key(r) for r in got.select(names).collect()) == want
    assert align_tokens.align_tokens(corpus(spark, [])).collect() == []


@needs_tokenizers
def test_shared_group_links_and_long_texts():
    both = align_tokens.encoders(FOLDER)
    texts = ["Größe 日本 it's", "x" * 30_000, " " * 20_000 + "日本" * 5_000]
    data, offsets = piecewise_hash.packed(texts)
    assert align_tokens.plain_texts(data, offsets).tolist() == [False, False, False]
    found = align_tokens.Aligned(texts, data, offsets, both)
    i, j = found.shared_group_links()
    counts = np.bincount(found.text_a[i], minlength=3)
    assert np.array_equal(counts, found.shared_group_counts())
    left, right = found.groups()
    assert np.array_equal(left.columns[i], right.columns[j])
    assert both.a.joined(found.a).tobytes() == "".join(" " + t for t in texts).encode()


def plain_fingerprint(text):
    """The definition, chunk by chunk."""
    raw = text.encode()
    seen = [int.from_bytes(raw[max(0, i - 6) : i + 1][::-1], "little") for i in range(len(raw))]
    hashed = arrays.spread(np.array(seen, np.uint64), 0).tolist()
    other = arrays.spread(np.array(seen, np.uint64), 1).tolist()
    k = 2
    while sum(h % 2**k == 0 for h in hashed) > 64:
        k += 1
    parts = [str(2**k)]
    for size in (k, k + 1, k + 2):
        chunks, current, open_ = [], 0, False
        for h, o in zip(hashed, other, strict=True):
            current, open_ = (current + o) % 2**64, True
            if h % 2**size == 0:
                chunks.append(current)
                current, open_ = 0, False
        chunks += [current] if open_ else []
        codes = arrays.mix(np.array(chunks, np.uint64)) >> np.uint64(58)
        parts.append("".join(chr(piecewise_hash.ALPHABET[c]) for c in codes))
    return ":".join(parts)


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last if x == y else 1 + min(row[j], row[j - 1])
    return row[-1]


def test_signature_distance():
    rng = random.Random(4)
    for _ in range(200):
        a, b = ("".join(rng.choices("abcd", k=rng.randint(0, 70))) for _ in range(2))
        assert len(a) + len(b) - 2 * piecewise_hash.common_length(a, b) == plain_distance(a, b)


def test_fingerprints(spark, rows):
    got = piecewise_hash.document_fingerprints(corpus(spark, rows).repartition(5))
    marked = corpus(spark, rows).select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    order = marked.orderBy(F.col("doc_id").desc_nulls_last(), "h").collect()
    want = Counter()
    for x, y in zip(order, order[1:] + order[:1], strict=True):
        a, b = x.text or "", y.text or ""
        half = len(a) // 2
        changed = a[: len(a) - half] + b[:half]
        one, two, three = map(plain_fingerprint, (a, changed, b))
        want[key((x.doc_id, len(a), hashlib.sha256(changed.encode()).hexdigest(), one, two,
                  piecewise_hash.likeness(one, two), piecewise_hash.likeness(one, three)))] += 1
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert Counter(key(r) for r in got.select(names).collect()) == want
    assert piecewise_hash.document_fingerprints(corpus(spark, [])).collect() == []
    alone = piecewise_hash.document_fingerprints(corpus(spark, [(1, "only one here")])).first()
    assert alone.near_next == 1.0


def test_likeness():
    rng = random.Random(6)
    text = " ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(800))
    strange = " ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(800))
    own, near, other = piecewise_hash.fingerprints(*piecewise_hash.packed([text, text[:2000] + "!" + text[2000:], strange]))
    assert piecewise_hash.likeness(own, near) > 0.9
    assert piecewise_hash.likeness(own, other) == 0
    assert piecewise_hash.likeness(own, own) == 1
