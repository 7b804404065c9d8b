"""Words, lengths and keys as column expressions, shared by the native operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airgrid.session import stored

#: A word is a longest run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """All words in order; NULL text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def count_words(text: Column) -> Column:
    """The number of words as bigint, 0 for NULL."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def let(value: Column, body) -> Column:
    """``body`` of ``value``, with ``value`` computed once.

    A plain column used inside a lambda is computed again for each element; the
    variable of an outer lambda is not.
    """
    return F.transform(F.array(value), body)[0]


def unit_hash(key: Column, seed: int) -> Column:
    """A number in [0, 1) fixed by ``key`` and ``seed``; SQL can repeat it (MD5)."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


MOST_KEYS = 1 << 20


def rows_by_key(docs: DataFrame, keys: DataFrame, how: str, most: int = MOST_KEYS) -> DataFrame:
    """The rows of ``docs`` whose id and text hash are among ``keys`` (doc_id, mark), or are not.

    ``how`` is left_semi or left_anti; NULL ids are alike. The keys are written and counted: up to
    ``most`` (some 40 MB) go to the tasks and no text moves, above that one shuffle joins them. The
    columns of ``docs`` are packed, so their names cannot clash.
    """
    known = keys.select(F.col("doc_id").alias("key_id"), F.col("mark").alias("key_mark")).distinct()
    known = stored(known, "keys")
    if known.count() <= most:
        known = F.broadcast(known)
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").alias("row_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("row_mark"),
    )
    same = F.col("row_id").eqNullSafe(F.col("key_id")) & (F.col("row_mark") == F.col("key_mark"))
    return packed.join(known, same, how).select("row.*")
