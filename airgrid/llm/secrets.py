"""Secret scans: three fixed patterns, and character Markov models for other random strings.

The patterns give the base spans. Beyond them, runs of ``LEAST_RUN`` or more letters and digits are
judged by two first-order Markov models: one of random strings, learned from the values of all base
spans in the corpus, one of ordinary words and identifiers, learned from all such runs that stand
twice or more in documents in which the patterns found nothing (a random string stands once). Both work alike: a step is the class that follows a class
(small letter, capital, digit), times the character that follows a character, case aside;
what is counted is mixed with fixed shares of a prior, so that a step the corpus never made costs
a bounded amount (``ratio_table``). A run whose total log-likelihood ratio reaches ``THRESHOLD`` is
a span of kind ``markov``: long runs need no more evidence than short ones. Runs of one character are
never judged. Base spans cut runs: what stands before or behind one is judged by itself, and a run
that still touches one is dropped.

All steps are column expressions. Texts are read twice: spans and runs are written (they
are a small part of the text), and the result is read off the written table; the second
reading counts the ordinary words. Words are counted before their character pairs, so that a
pair is made once for each distinct word of a task, not for each character. Positions are sums of the
lengths of matches and of the text between them, in two levels, so that the time grows with the
text and no match is searched twice. The models are 128 x 128 whole numbers, thousandths of the ratio.

Defined results. NULL and empty texts: no spans, the hash of the empty string. Repeated rows
and NULL ids: a result for each row. Texts of any length are scanned whole. Other columns do
not matter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airgrid.llm.text import let, table
from airgrid.session import stored

KINDS = ("assign", "access", "hex", "markov")

# Fixed patterns of the base spans; the last two in the form that fails below their least length.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE = 6

LEAST_RUN = 12
_BASE = (
    r"""(?i:(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,})"""
    r"|AKIA[A-Z0-9]{16,}|[0-9a-f]{24,}"
)
#: A base span, or a run that ends where one begins.
RUN = f"{_BASE}|((?:(?!{_BASE})[A-Za-z0-9]){{{LEAST_RUN},}}+)"
PLAIN_RUN = f"[A-Za-z0-9]{{{LEAST_RUN},}}"
ORDINARY = r"[A-Za-z0-9]{2,}"
THRESHOLD = 3500  # thousandths, of the whole run
FEW = 1000  # counted steps
SIZE = 128
BLOCK = 256
MASK = "[secret]"

_SPANS = "array<struct<start:int,rank:int,end:int,value:string>>"


def running(values: Column, block: int = BLOCK) -> Column:
    """The sum of the values before each one, in time linear in the array: blocks are summed first."""
    zero = F.lit(0)
    add = lambda s, x: s + x
    n_blocks = F.ceil(F.size(values) / F.lit(block)).cast("int")
    sums = F.transform(
        F.sequence(zero, F.greatest(n_blocks - 1, zero)),
        lambda b: F.aggregate(F.slice(values, b * block + 1, F.lit(block)), zero, add),
    )

    def placed(whole: Column) -> Column:
        before = F.transform(whole, lambda _, b: F.aggregate(F.slice(whole, F.lit(1), b), zero, add))
        return let(
            before,
            lambda starts: F.transform(
                values,
                lambda _, i: F.get(starts, F.floor(i / block).cast("int"))
                + F.aggregate(F.slice(values, i - i % block + 1, i % block), zero, add),
            ),
        )

    return let(sums, placed)


def located(text: Column, pattern: str, rank: int, value_group: int = 0, least: int = 0) -> Column:
    """All matches as array of (start, rank, end, value), in code points."""
    none = F.array().cast(_SPANS)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
    between = F.split(text, pattern, -1)

    def spans(rows: Column) -> Column:
        """Of (gap, all, value): one more gap than matches, the last without a match."""
        lengths = F.transform(rows, lambda m: F.char_length(m["gap"]) + F.coalesce(F.char_length(m["all"]), F.lit(0)))
        return let(
            let(lengths, lambda v: running(v)),
            lambda starts: F.filter(
                F.transform(
                    rows,
                    lambda m, i: F.struct(
                        (F.get(starts, i) + F.char_length(m["gap"])).alias("start"),
                        F.lit(rank).alias("rank"),
                        (F.get(starts, i) + F.char_length(m["gap"]) + F.char_length(m["all"])).alias("end"),
                        m["value"].alias("value"),
                    ),
                ),
                lambda s: s["end"].isNotNull() & (F.char_length(s["value"]) >= least),
            ),
        ).cast(_SPANS)

    zipped = F.arrays_zip(between.alias("gap"), found.alias("all"), values.alias("value"))
    return F.when(text.rlike(pattern), let(zipped, spans)).otherwise(none)


def base_spans(text: Column) -> Column:
    """All matches of the fixed patterns in a text that is not NULL."""
    return F.concat(located(text, ASSIGN, 0, 2, LEAST_VALUE), located(text, ACCESS, 1), located(text, HEX, 2))


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` with ``base`` (sorted spans) and ``tokens`` (runs to be judged)."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def with_runs(base: Column) -> Column:
        # Without base spans nothing cuts a run, and the plain pattern finds the same.
        runs = F.when(F.size(base) == 0, located(text, PLAIN_RUN, 3)).otherwise(located(text, RUN, 3, 1, LEAST_RUN))
        varied = F.filter(runs, lambda t: F.replace(t["value"], F.substring(t["value"], 1, 1), F.lit("")) != "")
        return F.struct(base.alias("base"), varied.alias("tokens"))

    return docs.withColumn("_found", let(F.sort_array(base_spans(text)), with_runs))


def _steps(value: Column) -> Column:
    """Places in the model of all character pairs of a token."""
    codes = let(F.split(value, ""), lambda cs: F.transform(cs, lambda c: F.ascii(c)))
    return let(
        codes,
        lambda cs: F.transform(
            F.slice(cs, 2, F.greatest(F.size(cs) - 1, F.lit(0))), lambda c, i: F.get(cs, i) * SIZE + c
        ),
    )


def _counts(values: DataFrame, least: int = 1) -> list[float]:
    """How often each pair of characters occurs in the values that stand ``least`` times or more."""
    out = [0.0] * (SIZE * SIZE)
    distinct = values.groupBy("value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    pairs = distinct.select("n", F.explode(_steps(F.col("value"))).alias("step")).where(
        F.col("step").between(0, SIZE * SIZE - 1)
    )
    for row in pairs.groupBy("step").agg(F.sum("n").alias("n")).collect():  # at most SIZE * SIZE rows
        out[row["step"]] = float(row["n"])
    return out


def _class(code: int) -> int:
    """0 small letter, 1 capital, 2 digit, -1 other."""
    c = chr(code)
    return 0 if "a" <= c <= "z" else 1 if "A" <= c <= "Z" else 2 if "0" <= c <= "9" else -1


class Markov:
    """Step probabilities of one kind of string from counted steps and a prior.

    ``stay`` is the prior's chance that a class is followed by itself, the rest in equal parts;
    None takes each class by its number of characters. ``learned`` is the share of the counts in
    what follows a class, ``paired`` their share in which character follows a character; the
    rest of the latter is half how common the character is and half all alike. Of few counted
    steps both shares are smaller, half as large at ``FEW``.
    """

    def __init__(self, counts: list[float], stay: float | None, learned: float, paired: float) -> None:
        sizes = (26, 26, 10)
        classes = [[0.0] * 3 for _ in range(3)]
        pairs: dict[str, dict[str, float]] = {}
        common = [dict.fromkeys("abcdefghijklmnopqrstuvwxyz", 0.0), dict.fromkeys("0123456789", 0.0)]
        for step, n in enumerate(counts):
            a, b = divmod(step, SIZE)
            if not n or _class(a) < 0 or _class(b) < 0:
                continue
            classes[_class(a)][_class(b)] += n
            one, two = chr(a).lower(), chr(b).lower()
            row = pairs.setdefault(one, {})
            row[two] = row.get(two, 0.0) + n
            common[two.isdigit()][two] += n
        trust = sum(map(sum, classes)) / (sum(map(sum, classes)) + FEW)
        learned, paired = learned * trust, paired * trust
        prior = lambda a, b: sizes[b] / 62 if stay is None else stay if a == b else (1 - stay) / 2
        self.follows = [
            [learned * row[b] / sum(row) + (1 - learned) * prior(a, b) if sum(row) else prior(a, b) for b in range(3)]
            for a, row in enumerate(classes)
        ]
        self.pairs, self.common, self.paired = pairs, common, paired

    def step(self, a: int, b: int) -> float:
        """The probability of the character b behind a."""
        one, two = chr(a).lower(), chr(b).lower()
        kind = self.common[two.isdigit()]
        total = sum(kind.values())
        alone = 0.5 * kind[two] / total + 0.5 / len(kind) if total else 1 / len(kind)
        row = {c: n for c, n in self.pairs.get(one, {}).items() if c in kind}
        beside = row.get(two, 0.0) / sum(row.values()) if row else alone
        return self.follows[_class(a)][_class(b)] * (self.paired * beside + (1 - self.paired) * alone)


def ratio_table(random: list[float], ordinary: list[float]) -> list[int]:
    """Thousandths of the log ratio of the two models' step probabilities, 0 for other characters.

    The prior of ordinary strings changes class once in six steps, as joined words do; that of random
    ones takes every character alike.
    """
    one, two = Markov(random, None, 0.5, 0.5), Markov(ordinary, 5 / 6, 0.5, 0.7)
    return [
        round(1000 * math.log(one.step(a, b) / two.step(a, b))) if _class(a) >= 0 <= _class(b) else 0
        for a in range(SIZE)
        for b in range(SIZE)
    ]


def train(found: DataFrame, docs: DataFrame) -> list[int]:
    """The ratio table from scanned rows (doc_id, base, tokens) and the texts."""
    random = _counts(found.select(F.explode("base").alias("s")).select("s.value"))
    clean = docs.select("text").where(F.size(base_spans(F.coalesce("text", F.lit("")))) == 0)
    words = clean.select(F.explode(F.regexp_extract_all("text", F.lit(ORDINARY), F.lit(0))).alias("value"))
    return ratio_table(random, _counts(words, 2))


def with_markov(found: DataFrame, ratios: list[int], threshold: int = THRESHOLD) -> DataFrame:
    """``found`` with ``spans``: the base spans and the runs judged random, sorted."""
    ratio = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<int>")

    def judged(t: Column) -> Column:
        total = F.aggregate(_steps(t["value"]), F.lit(0), lambda s, k: s + F.get(ratio, k))
        return total >= F.lit(threshold)

    def clear(t: Column) -> Column:
        return ~F.exists("base", lambda b: (t["start"] < b["end"]) & (t["end"] > b["start"]))

    random = F.filter(F.filter("tokens", judged), clear)
    return found.withColumn("spans", F.sort_array(F.concat("base", random)))


def find_secrets(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, base, tokens, spans) for every row; spans are (start, rank, end, value)."""
    rows = docs.select("doc_id", "text")
    found = stored(scan(rows).select("doc_id", "_found.base", "_found.tokens"), "secret_spans")
    return with_markov(found, train(found, rows), threshold)


def mask_secrets(docs: DataFrame, threshold: int = THRESHOLD, mask: str = MASK) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``mask``; other texts are unchanged.

    Spans that overlap a span before them are masked with it. All columns stay; ``n_chars``, where there is one, follows.
    """
    rows = docs.select("doc_id", "text")
    found = stored(scan(rows).select("doc_id", "_found.base", "_found.tokens"), "secret_spans")
    ratios = train(found, rows)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    judged = with_markov(
        scan(docs.select(whole, "text")).select("_row", "text", "_found.base", "_found.tokens"), ratios, threshold
    )
    text = F.col("text")

    def masked(spans: Column) -> Column:
        """The text between spans that overlap none before, a mask for each group of them."""
        ends = F.transform(spans, lambda s: s["end"])
        # A span opens a group where all spans before it end by its start; spans are few and start in order.
        before = F.transform(spans, lambda _, i: F.coalesce(F.array_max(F.slice(ends, F.lit(1), i)), F.lit(0)))

        def joined(reach: Column) -> Column:
            pieces = F.transform(
                spans,
                lambda s, i: F.when(
                    (s["start"] >= F.get(reach, i)),
                    F.concat(text.substr(F.get(reach, i) + 1, s["start"] - F.get(reach, i)), F.lit(mask)),
                ).otherwise(F.lit("")),
            )
            return F.concat(F.array_join(pieces, ""), text.substr(F.array_max(ends) + 1, F.char_length(text)))

        return let(before, joined)

    rows = judged.select("_row", F.when(F.size("spans") > 0, let(F.col("spans"), masked)).otherwise(text).alias("_text"))
    columns = []
    for name in docs.columns:
        column = F.col(f"_row.`{name}`")
        if name == "text":
            column = F.col("_text")
        elif name == "n_chars":
            column = F.coalesce(F.char_length("_text").cast(docs.schema[name].dataType), column)
        columns.append(column.alias(name))
    return rows.select(*columns)


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def op7_secret_scans(spark, sf_dir: str) -> DataFrame:
    """The secrets of every document."""
    found = find_secrets(table(spark, sf_dir, "documents"))
    count = lambda rank: F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("bigint")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )
