"""The corpus pipeline: five stages over the documents, each written and read again.

1. toxicity: documents scored ``toxicity.DECIDE`` or more go.
2. n-gram Jaccard join: of each group of near copies (five words, similarity 0.8) one row stays, that
   of the lowest id; rows without an id and repeated rows go, too, where another row stays.
3. benchmark decontamination: documents that hold a window of a benchmark item go.
4. secret scans: every span found is replaced by a mask.
5. mixing sources to target weights: each document as often as the mix takes it; ``copy``
   numbers the repeats.

Stages 1 to 4 return the columns of documents, whatever their names; ``n_chars`` follows the
text. Texts without words are in no group and pass stage 2. An empty table passes all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgrid.llm import decontaminate, jaccard_join, mixing, secrets, toxicity
from airgrid.llm.text import table
from airgrid.session import stored


def toxicity_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic; the model learns from this stage's own labelled rows."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    score = "toxicity"
    while score in docs.columns:
        score += "_"
    kept = toxicity.score_toxicity(docs, model, score).where(F.col(score) < toxicity.DECIDE)
    return kept.select(docs.columns)


def jaccard_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard_join.one_of_each(docs)


def decontamination_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked."""
    return secrets.mask_secrets(docs)


def mixing_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixture(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("n-gram Jaccard join", jaccard_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secrets_stage),
    ("mixing sources to target weights", mixing_stage),
]

#: Learned scores are no SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
