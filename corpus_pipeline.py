"""The corpus pipeline: five stages from documents to token ids."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from heronlake.llm import bpe, exact_dedup, mixing, near_dedup, toxicity
from heronlake.llm.support import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity scorer doesn't reject."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.drop_repeats(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts linked by a similarity of 0.8 over five-word shingles the document with the smallest id.

    Texts meet by segments of long SimHash fingerprints, whose pigeonring has budgets for every chain from there; whole sets of
    shingles decide.
    """
    return near_dedup.drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight takes it."""
    return mixing.take_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens and ids (little-endian unsigned 32-bit integers) of each document of the mix."""
    coded = bpe.encode_texts(docs.select("doc_id", "source", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return coded.selectExpr("doc_id", "source", "cast(octet_length(ids) div 4 as bigint) AS n_tokens", "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("source mixing", mix),
    ("BPE encoding", encode),
]

#: SQL can express neither the toxicity score nor the shingles' similarities, the draws of the mix or the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
