"""A training corpus from raw documents: five stages, each written and read again.

Each stage works on all rows that its predecessor kept. All but the last return the columns
of ``documents``; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from culvert.llm import decontamination, jaccard, language, packing, quality, tokens
from culvert.llm.shared import fresh, stored, table

#: None: hashes, learned weights and token ids are not to be had in SQL.
ORACLE_SQL = None

VOCABULARY, CLOSE_ID = "byte_bpe_50k.json", 0
#: Of the stage on word shingles.
NEAR_WORDS, NEAR_PERCENT = 5, 85


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what passes the base rules and the log-likelihood ratio. An own column
    ``quality`` of the documents would be replaced, so the verdict takes another name."""
    judged = quality.judge(docs, table(spark, sf_dir, "labels"), name := fresh("quality"))
    return judged.filter(F.col(f"{name}.kept")).select(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what is in one of the learned languages."""
    found = language.identify(docs, names=(pred := fresh("lang"), score := fresh("score"), fresh("held")))
    known = (F.col(pred) != language.UNDETERMINED) & (F.col(score) >= language.MIN_SCORE)
    return found.filter(known).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of linked ones, that of the smallest id. Linked are
    those that have 85 percent of their runs of five words in common."""
    return jaccard.representatives(docs, NEAR_PERCENT, NEAR_WORDS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what holds no window of a benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences, closed by CLOSE_ID each."""
    return packing.pack(docs, tokens.vocabulary(VOCABULARY), CLOSE_ID)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
