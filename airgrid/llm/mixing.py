"""Mixing sources to target weights.

Tokens are summed per source (map-side, so a hot source costs one row per task), the
targets are found by filling from the smallest cap up, and every document is then taken
``floor(rate)`` times plus once more with the fraction as probability, decided by a hash of
its id. No document row is shuffled: the per-source facts are written first, and the join
is a broadcast only while they are below Spark's threshold; above it the keys are salted.

Defined results. NULL text: size 0. NULL source: a source of its own, last in the order.
A source without words has target 0 and rate 0. Rows that repeat an id get equal decisions.
NULL ids share one hash. An empty table gives an empty result. Columns of the input stay,
also where their names are those used inside.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airgrid.llm.text import count_words, table, unit_hash
from airgrid.session import stored

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
SEED = 20
SALTS = 32


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS
) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    ``weights`` go round over the sources by code point, NULL last, and share all tokens.
    No target exceeds ``most`` times its source; what is cut goes to the others by weight.
    With sources ordered by cap per weight, the capped ones are those before the first whose
    cap reaches its share of what is left. All sums are whole numbers, so any order of
    summing gives the same target.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    whole = "decimal(38,0)"
    common = 1
    for w in weights:
        common *= w
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (turn % len(weights) + 1))
    per = per.withColumn("weight", weight.cast(whole)).withColumn(
        "cap", (F.col("source_size") * F.lit(int(most))).cast(whole)
    )
    # Whole numbers, as every weight divides their product.
    per = per.withColumn("cap_per_weight", (F.col("cap") * (F.lit(common) / F.col("weight")).cast(whole)).cast(whole))
    rising = Window.orderBy("cap_per_weight", F.col("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    zero = F.lit(0).cast(whole)
    left_tokens = F.sum(F.col("source_size").cast(whole)).over(everything) - F.coalesce(
        F.sum("cap").over(before), zero
    )
    left_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), zero)
    per = per.withColumn("left_tokens", left_tokens.cast(whole)).withColumn(
        "left_weight", left_weight.cast(whole)
    )
    capped = F.col("cap") * F.col("left_weight") <= F.col("weight") * F.col("left_tokens")
    per = per.withColumn("capped", capped)
    place = F.struct("cap_per_weight", F.col("source").isNull().alias("last"), "source")
    first = F.min_by(F.struct("left_tokens", "left_weight"), F.when(~F.col("capped"), place))
    per = per.withColumn("share", first.over(everything))
    share = F.col("weight").cast("double") * F.col("share.left_tokens").cast("double") / F.col(
        "share.left_weight"
    ).cast("double")
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share)
    return per.select("source", "source_size", target.alias("target"))


def copies(doc: Column, size: Column, target: Column, seed: int = SEED) -> Column:
    """How often one document is taken: floor(rate) plus one hash-seeded Bernoulli copy."""
    rate = F.when(size > 0, target / size.cast("double")).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    return (whole + F.when(unit_hash(doc, seed) < rate - whole, 1).otherwise(0)).cast("int")


def mix(
    docs: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_REPEATS,
    seed: int = SEED,
) -> DataFrame:
    """(doc: the input row as a struct, size, source_size, target, copies) for every row."""
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col(f"`{source}`").alias("source"),
        count_words(F.col(f"`{text}`")).alias("size"),
    )
    facts = stored(source_targets(rows.select("source", "size"), weights, most), "mix_targets")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    facts = facts.select(F.col("source").alias("of"), "source_size", "target", salts)
    salt = F.pmod(F.xxhash64(F.col(f"doc.`{doc}`"), F.col("size")), F.lit(SALTS)).cast("int")
    joined = rows.withColumn("own_salt", salt).join(
        facts, F.col("source").eqNullSafe(F.col("of")) & (F.col("own_salt") == F.col("salt"))
    )
    # A row without an id is drawn by its text.
    unnamed = F.concat(F.lit("#"), F.md5(F.coalesce(F.col(f"doc.`{text}`"), F.lit(""))))
    drawn_by = F.coalesce(F.col(f"doc.`{doc}`").cast("string"), unnamed)
    taken = copies(drawn_by, F.col("source_size"), F.col("target"), seed)
    return joined.select("doc", "size", "source_size", "target", taken.alias("copies"))


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every input row as often as it is taken, numbered in ``copy``."""
    mixed = mix(docs, **options).where(F.col("copies") > 0)
    rows = mixed.select("doc.*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy"))
    name = "copy"
    while name in docs.columns:
        name = f"_{name}"
    return rows.withColumnRenamed("_copy", name) if name != "_copy" else rows


def op8_mix(spark, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    docs = table(spark, sf_dir, "documents")
    return mix(docs).select(
        "doc.doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).cast("bigint").alias("taken"),
    )


OP8_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
), per AS (
  SELECT source, sum(size)::HUGEINT AS source_size FROM sizes GROUP BY source
), weighted AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT]::HUGEINT AS weight
  FROM per
), left_over AS (
  SELECT *,
    (sum(source_size) OVER ())::HUGEINT
      - coalesce(sum(3 * source_size) OVER rising, 0)::HUGEINT AS left_tokens,
    (sum(weight) OVER ())::HUGEINT - coalesce(sum(weight) OVER rising, 0)::HUGEINT AS left_weight
  FROM weighted
  WINDOW rising AS (ORDER BY 30 * source_size // weight, source ASC NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), judged AS (
  SELECT *, 3 * source_size * left_weight <= weight * left_tokens AS capped FROM left_over
), share AS (
  SELECT left_tokens AS t, left_weight AS w FROM judged WHERE NOT capped
  ORDER BY 30 * source_size // weight, source ASC NULLS LAST LIMIT 1
), targets AS (
  SELECT source, source_size::BIGINT AS source_size,
    CASE WHEN capped THEN (3 * source_size)::DOUBLE
         ELSE weight::DOUBLE * (SELECT t FROM share)::DOUBLE / (SELECT w FROM share)::DOUBLE END AS target
  FROM judged
), rated AS (
  SELECT doc_id, size, source_size, target,
    CASE WHEN source_size > 0 THEN target / source_size::DOUBLE ELSE 0.0 END AS rate,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':20'), 1, 8))::BIGINT::DOUBLE / 4294967296.0 AS u
  FROM sizes JOIN targets ON sizes.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target,
       ((floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM rated
"""
