"""Corpus pipeline: documents -> packed training sequences, one stage per operator.

Each stage reads all that its predecessor kept, as Parquet in the shared folder.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from newsflow.llm import line_dedup, packing, pii, superminhash, toxicity
from newsflow.llm.common import stage, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents scored toxic at 0.5 or above go."""
    return toxicity.drop_toxic(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: of each group of near-duplicates (five words, 0.8) the smallest id stays."""
    return superminhash.keep_one(docs.select(*COLUMNS), words=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: passages that an earlier document holds are cut from the text."""
    return line_dedup.dedup_units(docs.select(*COLUMNS)).select(*COLUMNS)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: personal data is replaced by its kind."""
    return pii.mask_pii(docs.select(*COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: pieces of at most 2048 tokens with their place in a sequence."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

#: Models, hashing and tokenizers are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
