"""Registered queries of the corpus operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.llm import (collocations, langid, line_dedup, merge_dropout, packing, permutation_index, pii, quality,
                          simhash, superminhash, toxicity, whitening, winnowing)
from newsflow.llm.common import table
from newsflow.llm.collocations_sql import collocations_sql
from newsflow.llm.near_sql import near_duplicates_sql


def op1_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the text that stays, and what was removed as start:end code points."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = F.transform("removed", lambda s: F.concat_ws(":", s.start.cast("string"), s.end.cast("string")))
    return line_dedup.dedup_units(docs).select("doc_id", "text", F.array_join(spans, ",").alias("removed"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(table(spark, sf_dir, "documents"))


def op7_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return permutation_index.nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op8_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_dropout.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.compare_with_next(table(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_report(table(spark, sf_dir, "documents"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.top_phrases(table(spark, sf_dir, "documents"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pack_sequences": op1_pack_sequences,
    "op2_quality": op2_quality,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_toxicity": op4_toxicity,
    "op5_line_dedup": op5_line_dedup,
    "op6_pii": op6_pii,
    "op7_permutation_index": op7_permutation_index,
    "op8_merge_dropout": op8_merge_dropout,
    "op9_winnowing": op9_winnowing,
    "op10_language": op10_language,
    "op11_simhash": op11_simhash,
    "op12_whitening": op12_whitening,
    "op13_collocations": op13_collocations,
}

#: The other queries rest on tokenizers, hashes or trained models, beyond SQL.
ORACLE_SQL: dict[str, str] = {"op3_near_duplicates": near_duplicates_sql(), "op13_collocations": collocations_sql()}
