"""Documents made ready for training: five stages, each over all that the one before kept.

run(spark, sf_dir) applies them to the table of documents. ORACLE_SQL is None: rules learnt from labels, fingerprints and
tokens are beyond SQL; tests/llm/test_corpus_pipeline.py holds the stages against brute force.

Defined results, for every stage: a null text counts as an empty one and stays null where the row stays; repeated rows are
near duplicates of each other, so one of them stays; an empty table gives an empty one; rows with a null id are kept like
others; columns beyond those of documents pass through all stages but the last, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import bpe, decontam, quality, simhash, suffixarray
from panelspark.llm.tables import stored, table


#: Bytes of a repeated passage, from which on it is taken out: fifty words of four letters, each with its blank, and a last
#: one of few letters less a margin. The operator's own query takes 400, by its contract.
REPEAT_BYTES = 240


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose predicted quality is 1."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id."""
    return simhash.one_of_each(docs, width=4, distance=4)


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the strings of REPEAT_BYTES bytes that start in more than one place."""
    cleaned = suffixarray.cleaned(docs, window=REPEAT_BYTES)
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontam.without(docs, table(spark, sf_dir, "benchmark"))


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of ids and of decoded bytes, one row for each document."""
    return bpe.digests(bpe.encode(docs, decoded=True))


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", near_duplicates_stage),
    ("suffix-array dedup", repeats_stage),
    ("benchmark decontamination", decontamination_stage),
    ("byte-level BPE", tokens_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
