"""Corpus preparation: stages over the documents table, each written as Parquet and read by the next.

Every stage works on all rows that its predecessor kept, and all but the last return whole rows of
``documents``.  Null texts count as empty throughout; null and repeated ids are kept apart by their
text; extra columns are carried along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duesmith.llm.common import read_table, unused_name
from duesmith.llm.decontamination import clean_rows
from duesmith.llm.exact_dedup import keep_first
from duesmith.llm.packing import TOKENIZER, pack_documents
from duesmith.llm.simhash import one_of_near
from duesmith.llm.toxicity import learn, score_rows
from duesmith.sources.workspace import stored

#: Score from which a document is rejected.
TOXIC = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject; it learns from the given documents."""
    score = unused_name("score", docs)
    scored = score_rows(docs, learn(docs, read_table(spark, sf_dir, "labels")), score)
    return scored.where(F.col(score) < TOXIC).drop(score)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the smallest id."""
    return keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints link (four-word shingles, at most 4 bits) the one with the smallest id."""
    return one_of_near(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return clean_rows(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing of what is left: one row for each piece."""
    return pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("packing", pack),
]

#: The stages learn, retrieve and tokenize, which SQL cannot express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
