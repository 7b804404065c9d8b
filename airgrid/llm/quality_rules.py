"""Quality rules: base counts and a hashed n-gram log-likelihood ratio.

The ratio compares two multinomials over hashed word unigrams and bigrams, one counted on
trusted documents (labelled good), one on the whole corpus. A document's sum, divided by its
number of n-grams, is held against a fixed threshold, so every document is decided alike on
every run. Ratios are whole thousandths, which makes sums independent of their order.

Scale. One pass counts buckets (map-side, so a task sends at most one row per bucket), one
pass scores inside the row. The trusted documents are all that are labelled good. Their ids are
counted first: up to ``MOST_BROADCAST`` (some 50 MB) they are sent to the tasks and no text moves;
above that one shuffle joins texts and ids. Driver and tasks hold ``BUCKETS`` numbers. Within a document
the repeat search hashes windows, and only where hashes repeat are windows compared.

Defined results. NULL and empty texts: no words, base_failed. NULL ids are scored as any
other and are never trusted. Repeated rows: one result each. Without trusted documents the
ratio is 0 everywhere. Other columns of the input do not matter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airgrid.llm.text import WORD, let, table, words
from airgrid.session import stored

BUCKETS = 1 << 14
THRESHOLD = -100  # thousandths per n-gram; trusted text stays above
SYMBOLS = "#*$%&|<>"
SPAN = 8
MOST_BROADCAST = 1 << 21  # trusted ids


def grams(w: Column, buckets: int = BUCKETS) -> Column:
    """Bucket numbers of all unigrams and bigrams of a word array."""
    one = F.transform(w, lambda x: F.pmod(F.xxhash64(x), F.lit(buckets)).cast("int"))
    two = F.transform(
        F.slice(w, 2, F.greatest(F.size(w), F.lit(1))),
        lambda x, i: F.pmod(F.xxhash64(F.get(w, i), x), F.lit(buckets)).cast("int"),
    )
    return F.concat(one, two)


def repeated_words(w: Column, span: int = SPAN) -> Column:
    """Words of a word array inside windows of ``span`` words that occur twice or more."""

    def exact(hashes: Column) -> Column:
        marked = F.transform(
            hashes, lambda h, i: F.struct(h.alias("h"), F.slice(w, i + 1, span).alias("w"), i.alias("i"))
        )

        def covered(rows: Column) -> Column:
            same = lambda a, b: (a["h"] == b["h"]) & (a["w"] == b["w"])
            twice = F.filter(
                F.transform(
                    rows,
                    lambda r, k: F.when(
                        F.coalesce(same(F.get(rows, k - 1), r), F.lit(False))
                        | F.coalesce(same(F.get(rows, k + 1), r), F.lit(False)),
                        r["i"],
                    ),
                ),
                lambda i: i.isNotNull(),
            )
            return let(
                F.sort_array(twice),
                lambda at: F.aggregate(
                    F.transform(
                        at, lambda p, k: F.least(F.coalesce(F.get(at, k + 1) - p, F.lit(span)), F.lit(span))
                    ),
                    F.lit(0).cast("bigint"),
                    lambda total, x: total + x.cast("bigint"),
                ),
            )

        return let(F.sort_array(marked), covered)

    def judged(hashes: Column) -> Column:
        alone = F.size(hashes) == F.size(F.array_distinct(hashes))
        return F.when(alone, F.lit(0).cast("bigint")).otherwise(exact(hashes))

    def windows(h: Column) -> Column:
        starts = F.slice(h, span, F.greatest(F.size(h), F.lit(1)))
        return F.transform(starts, lambda _, i: F.xxhash64(*[F.get(h, i + k) for k in range(span)]))

    enough = let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: let(windows(h), judged))
    return F.when(F.size(w) >= span, enough).otherwise(F.lit(0).cast("bigint"))


def base_counts(text: Column, w: Column) -> dict[str, Column]:
    """The counted properties of one text with words ``w``."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    return {
        "n_words": F.size(w).cast("bigint"),
        "word_chars": F.char_length(F.array_join(w, "")).cast("bigint"),
        "n_symbols": (
            F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))
        ).cast("bigint"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"),
        "n_repeat_words": repeated_words(w),
    }


def trusted_ids(labels: DataFrame) -> DataFrame:
    """All ids labelled good."""
    return labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()


def flagged_texts(docs: DataFrame, trusted: DataFrame, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """(text, good) of all rows; ``good`` is 1 for trusted ids, else NULL.

    In the shuffle rows with NULL id, which are never trusted, pass the join by, as it would
    send them all to one task.
    """
    rows = docs.select("doc_id", "text")
    known = stored(trusted.select("doc_id", F.lit(1).alias("good")), "trusted_ids")
    if known.count() <= most_broadcast:
        return rows.join(F.broadcast(known), "doc_id", "left").select("text", "good")
    named = rows.where(F.col("doc_id").isNotNull()).join(known.hint("merge"), "doc_id", "left")
    unnamed = rows.where(F.col("doc_id").isNull()).withColumn("good", F.lit(None).cast("int"))
    return named.unionByName(unnamed).select("text", "good")


def gram_ratios(
    docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, most_broadcast: int = MOST_BROADCAST
) -> list[int]:
    """Per bucket the log-likelihood ratio in thousandths, with one added to every count.

    ``docs`` has doc_id and text; ``trusted`` has each doc_id once.
    """
    flagged = flagged_texts(docs, trusted, most_broadcast)
    counted = (
        flagged.select("good", F.explode(let(words(F.col("text")), lambda w: grams(w, buckets))).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("raw"), F.count("good").alias("target"))
        .collect()
    )
    raw, target = [0] * buckets, [0] * buckets
    for row in counted:
        raw[row["bucket"]], target[row["bucket"]] = row["raw"], row["target"]
    if not sum(target):
        return [0] * buckets
    total_raw, total_target = sum(raw) + buckets, sum(target) + buckets
    return [
        round(1000 * (math.log((t + 1) / total_target) - math.log((r + 1) / total_raw)))
        for r, t in zip(raw, target, strict=True)
    ]


def quality_rules(
    docs: DataFrame,
    trusted: DataFrame,
    threshold: int = THRESHOLD,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Base counts, base_failed, llr (thousandths per n-gram) and kept for every row."""
    ratios = gram_ratios(docs, trusted, buckets)
    ratio = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<int>")

    def judged(w: Column) -> Column:
        total = F.aggregate(
            grams(w, buckets), F.lit(0).cast("bigint"), lambda s, b: s + F.get(ratio, b).cast("bigint")
        )
        counts = [c.alias(n) for n, c in base_counts(F.col("text"), w).items()]
        return F.struct(*counts, total.alias("total"))

    rows = docs.select("doc_id", "text").select("doc_id", let(words(F.col("text")), judged).alias("q"))
    n = F.col("q.n_words")
    failed = (n < 20) | (100 * F.col("q.n_repeat_words") > 30 * n)
    n_grams = F.greatest(2 * n - 1, F.lit(1))
    return rows.select(
        "doc_id",
        n.alias("n_words"),
        *[f"q.{c}" for c in ("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        failed.alias("base_failed"),
        (~failed & (F.col("q.total") >= F.lit(threshold) * n_grams)).alias("kept"),
        (F.col("q.total") / n_grams).alias("llr"),
    )


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Every document against the base rules and the ratio."""
    trusted = trusted_ids(table(spark, sf_dir, "labels"))
    return quality_rules(table(spark, sf_dir, "documents"), trusted)
