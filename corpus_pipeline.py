"""The corpus pipeline: documents in, packed token sequences out.

Each stage takes what its predecessor kept, written as Parquet and read again. All but the last return the columns
of documents. Every case that an operator defines (nulls, empty and very long texts, ties, repeated rows, empty
tables, extra columns) holds in its stage too; documents without an id can be told from no other and leave at the second stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wayfare.llm import exact_dedup, langid, near_dedup, packing, suffix_dedup
from wayfare.llm.common import stored, table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; those without a text or without a letter go. Learned from the labels of ``docs``."""
    return langid.identified(docs, langid.learn(docs.where(~langid.held_out())))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, compared without its white space."""
    return exact_dedup.kept_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked at a similarity of 0.8 or more."""
    return near_dedup.kept_documents(docs, percent=80)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 50-byte strings that one of smaller id has too; ``n_chars`` follows the text."""
    return suffix_dedup.cleaned_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of power-of-two length, one row per piece, with their ids."""
    return packing.pack(docs, WORD_BPE)


STAGES = [("language_id", language_id), ("exact_dedup", exact), ("near_dedup", near), ("suffix_dedup", repeats), ("packing", packed)]

# Classifiers, similarity joins and tokenizers are beyond SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
