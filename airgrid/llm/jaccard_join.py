"""N-gram Jaccard join by filtering under several global orders of the tokens.

Any fixed order of all tokens gives an exact filter: two sets with Jaccard similarity t or
more share a token among the first ``n - ceil(t n) + 1`` of each. Here three orders, by three
unrelated hashes of the token, are used at once: a candidate pair must share such a prefix
token under the first, and under each of the others k tokens of the first p + k - 1, as any
similar pair does, before its sets are compared.

1. Each text becomes its set's size, a 64-bit class name (equal sets are one class), and its
   prefixes. Only classes go on.
2. Prefix tokens of the first order are sorted together; tokens of one class only are dropped.
3. Classes with the same least token under the first order and like size are compared among
   themselves inside a task, which joins most near copies; then those with the same least token
   under one of the others, but for groups that are one component by then. Large groups are
   dealt in pairs of blocks. Only links that join something leave the task.
4. Tokens that still stand in more than ``HOT`` groups go to the end of the first order (this is
   again one order of all tokens), and prefixes move on to the next tokens. A class whose list is too
   short for that, as it is mostly made of such tokens, is looked at whole.
5. Pairs of different components, not compared in step 3, that share a prefix token, have enough
   tokens after it, differ in few enough bits of a parity map of their sets and overlap under the
   second and third order, are compared in full.
6. Components of the links found; copies take their class's component.

Full sets are made again from the texts where they lie, with the names of their groups, for the
classes to compare only: bit arrays of bounded length tell tasks which texts to look at and which
groups to send them to. No text is shuffled, and sets only to the place where they are compared.
No link between different components is missed; pairs inside a group found in step 3 are not
listed, as they add nothing to the components. Groups are never collected; rows are sorted
by Spark, and copies inside a piece of texts send their prefixes once.

Defined results. NULL texts and texts without words: size 0, a component of their own.
Rows that repeat an id form one document. A NULL id is linked like any other, but is not the
name of a component; a component without any id has the name NULL. Other columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airgrid.llm import arrays
from airgrid.llm.components import components
from airgrid.llm.shipping import in_tasks
from airgrid.llm.text import rows_by_key, table
from airgrid.session import stored

WORDS, PERCENT = 5, 80
HOT = 24  # groups that may meet at a token before it goes to the end of the order
MOST_BITS = 1 << 27
BLOCK = 2048  # classes of one group that a task compares with as many others
SEEDS = (41, 42)  # of the second and third order
_POS_BITS = 31


def shingle_names(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the distinct shingles of each text, sorted within it, and the bounds."""
    starts, ends, first = arrays.find_words(arrays.LOWER[data], offsets, arrays.SPACES)
    ranges = arrays.Doubled(arrays.word_symbols(arrays.LOWER[data], starts, ends)[0])
    n_words = np.diff(first)
    n = np.where(n_words >= words, n_words - words + 1, np.minimum(n_words, 1))
    text = np.repeat(np.arange(len(n)), n)
    begin = np.arange(len(text)) - (np.cumsum(n) - n)[text] + first[:-1][text]
    size = np.minimum(n_words, words)[text]
    name = arrays.mix(ranges.of(begin, begin + size) + size.astype(np.uint64))
    order = np.lexsort((name, text))
    text, name = text[order], name[order]
    new = np.ones(len(name), bool)
    new[1:] = (name[1:] != name[:-1]) | (text[1:] != text[:-1])
    text, name = text[new], name[new]
    return name, np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(n)))])


def class_names(names: np.ndarray, bounds: np.ndarray, seed: int) -> np.ndarray:
    """A name of each set, whatever the order of its members."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(arrays.spread(names, seed))])
    return arrays.mix(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64))


def prefix_length(n, percent: int):
    """Tokens of which one is shared by any set that is similar enough."""
    return n - (percent * n + 99) // 100 + 1


def prefix_column(percent: int, n: Column | None = None) -> Column:
    """``prefix_length`` of a column, by default n."""
    n = F.col("n") if n is None else n
    return (n - F.floor((percent * n + 99) / 100) + 1).cast("bigint")


def longer(p):
    """How much of the first order is kept, for tokens that go to its end."""
    return p + p // 2 + 24


def _lists(values: np.ndarray, bounds: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The first ``lengths`` values of every stretch."""
    lengths = np.minimum(lengths, np.diff(bounds))
    ends = np.concatenate([[0], np.cumsum(lengths)])
    text = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(text)) - ends[:-1][text] + bounds[:-1][text]
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values[at]))


def least_tokens(names: np.ndarray, bounds: np.ndarray, full: np.ndarray) -> list[np.ndarray]:
    """The least token under each order of ``full``, all sets that are not empty."""
    if not len(full):
        return [np.zeros(0, np.uint64)] * 3
    orders = [names, *[arrays.spread(names, seed) for seed in SEEDS]]
    return [np.minimum.reduceat(v, bounds[full]) for v in orders]


def group_names(least: list[np.ndarray], n: np.ndarray, percent: int) -> list[np.ndarray]:
    """Under each order, a name of the least token and band of sizes.

    Bands are shifted by a third from order to order, so that sets of nearly one size share
    some band.
    """
    size = np.log(n) / math.log(100 / percent)
    return [
        arrays.spread(arrays.spread(token, 50 + k) + np.floor(size + k / 3).astype(np.uint64), 53 + k).view(np.int64)
        for k, token in enumerate(least)
    ]


def parity_maps(names: np.ndarray, bounds: np.ndarray, full: np.ndarray) -> list[np.ndarray]:
    """Two times 64 bits per set that is not empty, each the parity of the members that fall on it."""
    if not len(full):
        return [np.zeros(0, np.int64)] * 2
    place = arrays.spread(names, 60) >> np.uint64(57)
    bit = np.uint64(1) << (place & np.uint64(63))
    halves = [np.where(place >> np.uint64(6) == h, bit, np.uint64(0)) for h in (0, 1)]
    return [np.bitwise_xor.reduceat(h, bounds[full]).view(np.int64) for h in halves]


def class_rows(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, key, mark, n, cls, check, a, b, c, g0, g1, g2, odd0, odd1) per row.

    A copy inside a piece has no prefixes; only rows with prefixes have what follows them.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches) -> Iterator[pa.RecordBatch]:
        for piece, data, offsets in arrays.pieces(batches):
            names, bounds = shingle_names(data, offsets, words)
            n = np.diff(bounds)
            cls = class_names(names, bounds, 0)
            p = prefix_length(n, percent)
            once = np.zeros(len(n), bool)
            once[np.unique(cls, return_index=True)[1]] = True
            p = np.where(once & (n > 0), p, 0)
            text = np.repeat(np.arange(len(n)), n)
            others = []
            for seed in SEEDS:
                value = arrays.spread(names, seed)
                value = value[np.lexsort((value, text))]
                # Half a name is enough to sort out pairs; equal names have equal halves.
                others.append(_lists((value >> np.uint64(32)).astype(np.uint32).view(np.int32), bounds, np.where(p > 0, p + 16, 0)))
            full = np.flatnonzero(n > 0)
            facts = [
                *group_names(least_tokens(names, bounds, full), n[full], percent),
                *parity_maps(names, bounds, full),
            ]
            place = np.zeros(len(n), np.int64)
            place[full] = np.arange(len(full))
            where = pa.array(place, mask=p <= 0)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays(piece.column("doc_id").chunks),
                    pa.concat_arrays(piece.column("key").chunks),
                    pa.concat_arrays(piece.column("mark").chunks),
                    pa.array(n.astype(np.int64)),
                    pa.array(cls.view(np.int64)),
                    pa.array(class_names(names, bounds, 1).view(np.int64)),
                    _lists(names.view(np.int64), bounds, np.where(p > 0, longer(p), 0)),
                    *others,
                    *[pc.take(pa.array(f), where) for f in facts],
                ],
                ["doc_id", "key", "mark", "n", "cls", "check", "a", "b", "c", "g0", "g1", "g2", "odd0", "odd1"],
            )

    schema = f"doc_id {kind}, key string, mark bigint, n bigint, cls bigint, check bigint, a array<bigint>, b array<int>, c array<int>"
    schema += ", g0 bigint, g1 bigint, g2 bigint, odd0 bigint, odd1 bigint"
    return in_tasks(docs, rows, schema)


def bits_of(wanted: DataFrame, mark: Column) -> np.ndarray:
    """A bit array with a bit set for every ``mark``, a hash; at most ``MOST_BITS`` long.

    The fuller it is, the more is looked at in vain; nothing is missed.
    """
    bits = 1 << 16
    while bits < min(16 * wanted.count(), MOST_BITS):
        bits *= 2
    place = F.pmod(mark, F.lit(bits))
    one = F.expr("shiftleft(1L, cast(place % 64 as int))")
    words = (
        wanted.select(place.alias("place"))
        .groupBy(F.floor(F.col("place") / 64).cast("int").alias("word"))
        .agg(F.bit_or(one).alias("bits"))
        .toPandas()
    )
    out = np.zeros(bits // 64, np.int64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return out.view(np.uint8)


def maybe_set(bits: np.ndarray, marks: pa.Array) -> np.ndarray:
    """Whether the bits of some hashes are set."""
    place = marks.to_numpy(zero_copy_only=False) % (len(bits) * 8)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def maybe_in(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """The rows whose ``column`` is in ``wanted``, and a few others; nothing is shuffled."""
    bits = bits_of(wanted, F.xxhash64(column))

    def kept(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(maybe_set(bits, batch.column("mark"))))

    marked = rows.withColumn("mark", F.xxhash64(column))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in marked.schema)
    return in_tasks(marked, kept, schema).drop("mark")


def set_rows(
    texts: DataFrame, wanted: DataFrame, words: int, percent: int, groups: DataFrame | None = None, orders=()
) -> DataFrame:
    """(key, cls, name, members) of the texts whose ``key`` is in ``wanted``, and of a few others.

    With ``orders``, a row for each of them with the name of the set's group, where it is in
    ``groups`` (name), and for a few others; else ``name`` is 0. Texts are read where they lie.
    A text that repeats with its key may come more than once.
    """
    bits = bits_of(wanted, F.xxhash64("key"))
    name_bits = bits_of(groups, F.col("name")) if groups is not None else None

    def rows(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maybe = maybe_set(bits, batch.column("mark"))
            for piece, data, offsets in arrays.pieces([batch.filter(pa.array(maybe))]):
                names, bounds = shingle_names(data, offsets, words)
                n = np.diff(bounds)
                full = np.flatnonzero(n > 0)
                key = pa.concat_arrays(piece.column("key").chunks)
                cls = class_names(names, bounds, 0).view(np.int64)
                of_order = group_names(least_tokens(names, bounds, full), n[full], percent)
                for name in [of_order[k] for k in orders] or [np.zeros(len(full), np.int64)]:
                    some = full
                    if name_bits is not None:
                        chosen = maybe_set(name_bits, pa.array(name))
                        some, name = full[chosen], name[chosen]
                    members = [names[bounds[i] : bounds[i + 1]].tobytes() for i in some]
                    yield pa.RecordBatch.from_arrays(
                        [pc.take(key, pa.array(some)), pa.array(cls[some]), pa.array(name), pa.array(members, pa.binary())],
                        ["key", "cls", "name", "members"],
                    )

    marked = texts.select("key", "text", F.xxhash64("key").alias("mark"))
    return in_tasks(marked, rows, "key string, cls bigint, name bigint, members binary")


def similar(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets are as similar as asked."""
    if len(one) > len(two):
        one, two = two, one
    at = np.searchsorted(two, one)
    common = int((two[np.minimum(at, len(two) - 1)] == one).sum())
    return 100 * common >= percent * (len(one) + len(two) - common)


def overlapping(one: Column, n_one: Column, two: Column, n_two: Column, percent: int) -> Column:
    """Whether two sets of the given sizes may be similar, by their lists under one order.

    Of the first p + k - 1 tokens (p the prefix length) similar sets share k; the lists hold
    k = 17 or the whole set. Tokens of a list with equal halves count in favour.
    """
    p_one, p_two = prefix_column(percent, n_one), prefix_column(percent, n_two)
    more = F.least(F.size(one) - p_one, F.size(two) - p_two)
    one, two = F.slice(one, 1, (p_one + more).cast("int")), F.slice(two, 1, (p_two + more).cast("int"))
    equal_halves = F.size(one) - F.size(F.array_distinct(one))
    return F.size(F.array_intersect(one, two)) + equal_halves >= more + 1


def parted(groups: DataFrame, roots: DataFrame | None, orders: tuple[int, ...]) -> DataFrame:
    """(cls, name, size) of the groups under the given orders; not those that are one component.

    ``roots`` (cls, root) are the components known so far.
    """
    parts = groups.select("cls", F.explode(F.array(*[f"g{k}" for k in orders])).alias("name"))
    root = F.col("cls")
    if roots is not None:
        parts = parts.join(roots, "cls", "left")
        root = F.coalesce("root", "cls")
    facts = parts.groupBy("name").agg(
        F.min(root).alias("low"), F.max(root).alias("high"), F.count(F.lit(1)).alias("size")
    )
    facts = stored(facts.where("low <> high").select("name", "size"), "jaccard_group_sizes")
    return parts.join(facts, "name").select("cls", "name", "size")


def dealt(parts: DataFrame, block: int = BLOCK) -> DataFrame:
    """(name, last): the last block of the groups (cls, name, size) of more than ``block`` classes.

    Classes are dealt to blocks by hash, and each two blocks meet in a place of their own, so
    that no task holds much more than two blocks.
    """
    large = parts.where(F.col("size") > block).select("name", F.floor((F.col("size") - 1) / block).cast("int").alias("last"))
    return large.distinct()


def spanning_links(sets: list[tuple[int, np.ndarray]], percent: int) -> list[tuple[int, int]]:
    """Links that join what the similar pairs among some sets join."""
    sizes = np.array([len(m) for _, m in sets])
    values, token = np.unique(np.concatenate([m for _, m in sets]), return_inverse=True)
    bounds = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    root = np.arange(len(sets))
    mark = np.zeros(len(values), bool)
    out = []
    for i in range(len(sets) - 1):
        own = token[bounds[i] : bounds[i] + sizes[i]]
        mark[own] = True
        at = bounds[i + 1]
        common = np.add.reduceat(mark[token[at:]].astype(np.int32), bounds[i + 1 :] - at)
        mark[own] = False
        alike = 100 * common >= percent * (sizes[i] + sizes[i + 1 :] - common)
        for j in i + 1 + np.flatnonzero(alike & (root[i + 1 :] != root[i])):
            if root[j] != root[i]:
                root[root == root[j]] = root[i]
                out.append((sets[i][0], sets[j][0]))
    return out


def within_groups(sets: DataFrame, large: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) that join the similar classes of every group.

    Rows are (name, cls, members) and may repeat; ``large`` is what ``dealt`` gives.
    """
    last = F.coalesce("last", F.lit(0))
    rows = sets.join(large, "name", "left").withColumn("own", F.pmod(F.xxhash64("cls"), last + 1).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    rows = rows.select("name", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "cls", "members")
    rows = rows.repartition("name", "i", "j").sortWithinPartitions("name", "i", "j", "cls")

    def links(batches) -> Iterator[pa.RecordBatch]:
        place, held = None, []

        def found() -> pa.RecordBatch:
            pairs = spanning_links(held, percent) if len(held) > 1 else []
            return pa.RecordBatch.from_arrays(
                [pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["u", "v"]
            )

        for batch in batches:
            places = zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)
            for at, cls, members in zip(places, batch.column(3).to_pylist(), batch.column(4), strict=True):
                if at != place:
                    yield found()
                    place, held = at, []
                if not held or held[-1][0] != cls:
                    held.append((cls, np.frombuffer(members.as_buffer(), np.uint64).copy()))
        yield found()

    return in_tasks(rows, links, "u bigint, v bigint")


def filtered(pairs: DataFrame, prefixes: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (u, v) that overlap under the second and the third order."""
    ids = pairs.select(F.col("u").alias("cls")).unionByName(pairs.select(F.col("v").alias("cls")))
    ids = stored(ids.distinct(), "jaccard_ids")
    prefixes = stored(maybe_in(prefixes.select("cls", "n", "b", "c"), "cls", ids).dropDuplicates(["cls"]), "jaccard_lists")
    for order in "bc":
        one, two = (
            prefixes.select(F.col("cls").alias(x), F.col("n").alias(f"n_{x}"), F.col(order).alias(f"l_{x}"))
            for x in "uv"
        )
        ok = overlapping(F.col("l_u"), F.col("n_u"), F.col("l_v"), F.col("n_v"), percent)
        pairs = stored(pairs.join(one, "u").join(two, "v").where(ok).select("u", "v"), "jaccard_filtered")
    return pairs


def compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (u, v) whose sets (cls, members) are similar."""
    both = pairs.join(sets.select(F.col("cls").alias("u"), F.col("members").alias("one")), "u").join(
        sets.select(F.col("cls").alias("v"), F.col("members").alias("two")), "v"
    )

    def rows(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [
                similar(np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64), percent)
                for a, b in zip(batch.column(2), batch.column(3), strict=True)
            ]
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    return in_tasks(both.select("u", "v", "one", "two"), rows, "u bigint, v bigint")


def _pairs(left: DataFrame, right: DataFrame, percent: int, same: bool = False) -> DataFrame:
    """Pairs u < v of different roots that share a token and were in no place together, of rows
    (token, cls, root, n, rank, g0, g1, g2, odd0, odd1).

    What follows the first shared token on either side must be enough for the similarity, and
    no more members may differ than similar sets of these sizes can: parity maps differ in at
    most as many bits.
    """
    names = {"cls": "v", "root": "root_v", "n": "n_v", "rank": "rank_v", "odd0": "odd0_v", "odd1": "odd1_v"} | {f"g{k}": f"h{k}" for k in range(3)}
    other = right.select("token", *[F.col(c).alias(x) for c, x in names.items()])
    enough = (100 + percent) * F.least(F.col("n") - F.col("rank"), F.col("n_v") - F.col("rank_v")) >= percent * (
        F.col("n") + F.col("n_v")
    )
    apart = F.col("root") != F.col("root_v")
    if same:
        apart &= F.col("cls") < F.col("v")
    for k in range(3):
        apart &= F.col(f"g{k}") != F.col(f"h{k}")
    both = F.col("n") + F.col("n_v")
    common = F.floor((percent * both + 99 + percent) / (100 + percent))
    differ = [F.bit_count(F.col(f"odd{h}").bitwiseXOR(F.col(f"odd{h}_v"))) for h in (0, 1)]
    few = differ[0] + differ[1] <= both - 2 * common
    met = left.join(other, "token").where(enough & apart & few)
    return met.select(F.least("cls", "v").alias("u"), F.greatest("cls", "v").alias("v")).distinct()


def member_rows(sets: DataFrame) -> DataFrame:
    """(cls, token, pos) of all members of the sets (cls, members), in the first order."""

    def rows(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cls, members in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                tokens = np.frombuffer(members.as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(tokens), cls)), pa.array(tokens), pa.array(np.arange(len(tokens)))],
                    ["cls", "token", "pos"],
                )

    return in_tasks(sets, rows, "cls bigint, token bigint, pos bigint")


FACTS = ("root", "n", "g0", "g1", "g2", "odd0", "odd1")


def _facts(prefixes: DataFrame, roots: DataFrame, classes: DataFrame) -> DataFrame:
    """(cls, FACTS) of some classes."""
    own = prefixes.join(classes.distinct(), "cls", "left_semi").dropDuplicates(["cls"])
    return own.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls")).select("cls", *FACTS)


def candidates(
    shared: DataFrame, groups: DataFrame, roots: DataFrame, lists: DataFrame, sets_of, percent: int, hot: int = HOT
) -> DataFrame:
    """Pairs that share a prefix token, from rows (token, cls, pos) of tokens of two classes or more.

    The order is the first one, but tokens at which more than ``hot`` groups meet stand at its end. A class
    whose list holds too few other tokens for a prefix is looked at whole: ``sets_of(classes)`` gives its
    set, and so its prefix under that order. Such a prefix reaches tokens that are in one other
    list only, which ``shared`` leaves out; they are taken from ``lists`` (cls, n, a, ...), all lists.
    """
    grouped = shared.select("token", "cls", "pos").join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    met = grouped.groupBy("token", "root").agg(F.lit(1).alias("one")).groupBy("token").agg(F.count(F.lit(1)).alias("groups"))
    # A token of one group is not hot and makes no pair.
    met = stored(met.where("groups > 1").select("token", (F.col("groups") > hot).cast("int").alias("is_hot")), "jaccard_met")
    counted = stored(grouped.join(met, "token").drop("root"), "jaccard_tokens")
    facts = groups.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls")).select("cls", *FACTS)
    own = Window.partitionBy("cls")
    before = F.sum("is_hot").over(own.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    p = prefix_column(percent)
    kept = F.least(F.col("n"), (p + F.floor(p / 2) + 24).cast("bigint"))
    placed = counted.join(facts, "cls").withColumn("before", before).withColumn("all_hot", F.sum("is_hot").over(own))
    placed = placed.withColumn("p", p).withColumn("left_over", kept - F.col("all_hot")).withColumn("kept", kept)
    whole = F.col("kept") == F.col("n")
    placed = placed.withColumn("short", (F.col("left_over") < F.col("p")) & ~whole)
    # Cold tokens up to the prefix length, then hot ones if all are known.
    cold = (F.col("is_hot") == 0) & (F.col("pos") - F.col("before") < F.col("p"))
    rest = (F.col("is_hot") == 1) & whole & (F.col("left_over") + F.col("before") - 1 < F.col("p"))
    rank = F.when(F.col("is_hot") == 1, F.col("left_over") + F.col("before") - 1).otherwise(F.col("pos") - F.col("before"))
    row = ["token", "cls", *FACTS, "rank"]
    long_enough = stored(placed.where(~F.col("short") & (cold | rest)).withColumn("rank", rank).select(row), "jaccard_prefixes")

    short = stored(placed.where("short").select("cls").distinct(), "jaccard_short")
    members = member_rows(sets_of(short).select("cls", "members"))
    hot_tokens = met.where("is_hot = 1")
    judged = members.join(hot_tokens, "token", "left").withColumn("is_hot", F.coalesce("is_hot", F.lit(0)))
    judged = judged.withColumn("before", before).withColumn("all_hot", F.sum("is_hot").over(own))
    judged = judged.join(facts.join(short, "cls", "left_semi"), "cls").withColumn("left_over", F.col("n") - F.col("all_hot"))
    looked_at = stored(judged.withColumn("rank", rank).where(F.col("rank") < p).select(row), "jaccard_short_prefixes")

    alone = stored(looked_at.select("token").distinct().join(met, "token", "left_anti"), "jaccard_alone")
    others = lists.select("cls", F.posexplode("a").alias("pos", "token"))
    others = maybe_in(others, "token", alone).join(alone, "token", "left_semi").dropDuplicates(["token", "cls"])
    others = stored(others, "jaccard_others")
    n_hot = counted.groupBy("cls").agg(F.sum("is_hot").alias("all_hot"))
    # Hot tokens before a place are at most all of the class; a lower rank keeps more pairs.
    least = F.greatest(F.col("pos") - F.coalesce("all_hot", F.lit(0)), F.lit(0))
    others = others.join(_facts(lists, roots, others.select("cls")), "cls").join(n_hot, "cls", "left")
    others = others.withColumn("rank", least).where(F.col("rank") < p).select(row)
    both = long_enough.unionByName(looked_at)
    return _pairs(both, both, percent, same=True).unionByName(_pairs(looked_at, others, percent)).distinct()


def similar_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``."""
    return grouped_rows(docs, words, percent).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group of similar texts, all columns.

    The row of the lowest doc_id stays, of equal ids the one of the lowest text hash, of equal rows any; a
    row without an id stays only where no row of its group has one. Texts without words are in no
    group and all stay. Rows go by id and text hash; only rows that repeat both meet each other.
    """
    rows = stored(grouped_rows(docs, words, percent).where("n_shingles > 0"), "jaccard_rows")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "mark")
    first = stored(rows.groupBy("root").agg(F.min(place).alias("first")), "jaccard_first")
    judged = stored(rows.groupBy("root", "doc_id", "mark").agg(F.count(F.lit(1)).alias("copies")), "jaccard_keys")
    judged = judged.join(first, "root")  # of written tables, so that Spark can split a large group
    judged = stored(judged.select("doc_id", "mark", "copies", (place == F.col("first")).alias("stays")), "jaccard_judged")
    kept = rows_by_key(docs, judged.where("not stays"), "left_anti")
    repeated = judged.where("stays and copies > 1")
    once = rows_by_key(kept, repeated, "left_semi")
    numbered = once.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").alias("of"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"),
    ).dropDuplicates(["of", "mark"])
    return rows_by_key(kept, repeated, "left_anti").unionByName(numbered.select("row.*"))


def grouped_rows(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, mark, n_shingles, component_id, root) for every row; ``mark`` hashes the text, ``root``
    names the group, NULL without words."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("#"), F.md5(F.coalesce("text", F.lit("")))))
    texts = docs.select("doc_id", key.alias("key"), "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"))
    made = stored(class_rows(texts, words, percent), "jaccard_classes")
    made_of = made.where("n > 0")
    classes = made_of.groupBy("cls").agg(
        F.min("doc_id").alias("first_doc"), F.min("key").alias("key"), F.min("check").alias("low"), F.max("check").alias("high")
    )
    classes = stored(classes, "jaccard_copies")
    if classes.where("low <> high").limit(1).count():
        raise ValueError("two different sets have one name; change the seed of class_names")
    tokens = made_of.select("cls", "n", F.posexplode("a").alias("pos", "token"))
    tokens = tokens.select("token", "cls", F.shiftleft("n", _POS_BITS).bitwiseOR(F.col("pos").cast("bigint")).alias("place"))
    tokens = tokens.repartition("token").dropDuplicates(["token", "cls"])
    at_token = Window.partitionBy("token")
    tokens = tokens.withColumn("lowest", F.min("cls").over(at_token)).withColumn("highest", F.max("cls").over(at_token))
    shared = tokens.where("lowest <> highest").select(
        "token",
        "cls",
        F.shiftright("place", _POS_BITS).alias("n"),
        F.col("place").bitwiseAND(F.lit((1 << _POS_BITS) - 1)).alias("pos"),
    )
    shared = stored(shared, "jaccard_shared")
    prefixes = made_of.where(F.size("b") > 0)
    partnered = shared.select("cls").distinct()
    groups = prefixes.select("cls", "n", "g0", "g1", "g2", "odd0", "odd1").dropDuplicates(["cls"])
    groups = stored(groups.join(partnered, "cls", "left_semi"), "jaccard_groups")
    of_classes = classes.select("cls", "key")

    near, roots = None, None
    for orders in ((0,), (1, 2)):
        parts = stored(parted(groups, roots, orders), "jaccard_parts")
        large = stored(dealt(parts), "jaccard_large")
        wanted = stored(of_classes.join(parts.select("cls").distinct(), "cls", "left_semi"), "jaccard_wanted")
        names = stored(parts.select("name").distinct(), "jaccard_names")
        sets = set_rows(texts, wanted, words, percent, names, orders).select("name", "cls", "members")
        links = stored(within_groups(sets, large, percent), "jaccard_links")
        near = links if near is None else near.unionByName(links)
        roots = components(near).select(F.col("node").alias("cls"), "root")

    def sets_of(some: DataFrame) -> DataFrame:
        """(cls, members) of some classes, once each."""
        wanted = stored(of_classes.join(some.distinct(), "cls", "left_semi"), "jaccard_wanted")
        found = set_rows(texts, wanted, words, percent).join(wanted, ["key", "cls"], "left_semi").select("cls", "members")
        return stored(found.dropDuplicates(["cls"]), "jaccard_sets")

    pairs = stored(candidates(shared, groups, roots, prefixes, sets_of, percent), "jaccard_pairs")
    met = filtered(pairs, prefixes, percent)
    ids = met.select(F.col("u").alias("cls")).unionByName(met.select(F.col("v").alias("cls")))
    links = near.unionByName(compared(met, sets_of(ids), percent))
    reached = components(links).select(F.col("node").alias("cls"), "root")
    placed = classes.select("cls", "first_doc").join(reached, "cls", "left")
    placed = stored(placed.select("cls", "first_doc", F.coalesce("root", "cls").alias("root")), "jaccard_roots")
    named = placed.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    of_class = placed.join(named, "root").select("cls", "component_id", "root")
    joined = made.select("doc_id", "mark", "n", F.when(F.col("n") > 0, F.col("cls")).alias("cls")).join(of_class, "cls", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "mark", F.col("n").alias("n_shingles"), component.alias("component_id"), "root")


def op2_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Components of documents at 3 words and a similarity of 0.9."""
    return similar_groups(table(spark, sf_dir, "documents"), 3, 90)


OP2_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * k >= 90 * (p.n + q.n - k)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM words
  UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y
)
SELECT words.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, min(y) AS component_id
FROM words LEFT JOIN sizes USING (doc_id) JOIN reach ON reach.x = words.doc_id GROUP BY ALL
"""
