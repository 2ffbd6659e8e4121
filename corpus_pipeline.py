"""The corpus pipeline: toxicity, quality, near-duplicates, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``. A stage works on all that its predecessor kept. Models are learned
from the labelled rows of ``documents`` that are still there, by the same rule as in the
single queries.

Cases: near-duplicates and decontamination decide by row and by text, so rows without an id, repeated
rows and rows that share an id are told apart; NULL and empty texts have no shingles and are dropped by
neither. What the other stages do with such rows is stated in their modules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# First, so that a missing subpackage is what the guard of __spark_entry__.py sees.
from postloom.llm import bpe, decontam, minhash, quality, toxicity
from postloom.llm.queries import RANKS
from postloom.llm.store import keep, table

import public_tokenizers


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be of low quality go."""
    model = quality.fit(quality.stored_statistics(docs), table(spark, sf_dir, "labels"))
    return quality.drop_low(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity 0.8 or more."""
    return minhash.drop_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the documents that are left."""
    return bpe.encode_digests(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# Learned models and token ids have no SQL form; tests/llm compares with a brute-force run.
ORACLE_SQL = None
