"""The bounded sample of labelled documents that the classifiers learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_ROWS = 20_000


def remainder(doc: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.pmod(F.crc32(doc.cast("string").cast("binary")), F.lit(folds))


def _known(labels: DataFrame, label: str, folds: int, held_out: int) -> DataFrame:
    """(doc_id, label) of all labelled ids outside the held-out fold."""
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
        .where(remainder(F.col("doc_id"), folds) != held_out)
    )


def label_totals(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int) -> tuple[int, int]:
    """Documents of label 0 and 1 among all training rows, which ``training_rows`` only samples."""
    rows = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    counted = _known(labels, label, folds, held_out).join(rows, "doc_id").groupBy("label").agg(F.sum("n").alias("n"))
    found = {r["label"]: r["n"] for r in counted.collect()}
    return found.get(0, 0), found.get(1, 0)


def training_rows(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    folds: int,
    held_out: int,
    most: int = MOST_ROWS,
) -> DataFrame:
    """(doc_id, text, label) of at most ``most`` labelled documents of each label.

    The ids of the lowest hashes outside the held-out fold; ids labelled both ways count as
    the larger label. The labels' shares in the sample are not those of all rows; see
    ``label_totals``.
    """
    known = _known(labels, label, folds, held_out)
    parts = [
        known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        for value in (0, 1)
    ]
    return docs.select("doc_id", "text").join(F.broadcast(parts[0].unionByName(parts[1])), "doc_id")
