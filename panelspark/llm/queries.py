"""One query for each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import archives, bpe, decontam, dialogues, embeddings, lexical, maxent, quality, simhash, substrings, suffixarray, tokencounts, toolcalls
from panelspark.llm.tables import ORACLES, QUERIES, query, table
from panelspark.session import scratch_path

__all__ = ["ORACLES", "QUERIES"]


@query("op1_simhash")
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints over shingles of four words, linked at four differing bits or fewer."""
    found = simhash.groups(table(spark, sf_dir, "documents"), width=4, distance=4)
    return found.select("doc_id", simhash.hexadecimal("fingerprint").alias("fingerprint"), "component_id")


@query("op2_tool_calls", toolcalls.ORACLE)
def op2_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every request of every conversation as a call, linked with its answer, ordered and checked."""
    calls, results, nodes = toolcalls.from_conversations(table(spark, sf_dir, "conversations"))
    return toolcalls.linked(calls, results, nodes=nodes)


@query("op3_byte_bpe")
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded: number of tokens, digests of the ids and of the decoded bytes."""
    return bpe.digests(bpe.encode(table(spark, sf_dir, "documents"), decoded=True))


@query("op4_embedding_neighbours")
def op4_embedding_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors linked at a cosine of 0.9 or more."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.9)


@query("op5_quality_rules")
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document, learnt from the labelled ones that are not held out."""
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_suffix_array")
def op6_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of strings of 400 bytes that also start elsewhere."""
    return suffixarray.report(table(spark, sf_dir, "documents"), window=400)


@query("op7_benchmark_templates")
def op7_benchmark_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with each benchmark item that it contains, values aside."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op8_arc_to_warc", archives.ORACLE)
def op8_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to legacy archives, converted, and read back from WARC."""
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    archives.write_arc(table(spark, sf_dir, "pages"), arc)
    archives.convert(spark, arc, warc)
    records = archives.read_warc(spark, warc)
    return records.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op9_token_counts")
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of the fields of every document, and of the first line and the rest of its text."""
    counts = tokencounts.token_counts(table(spark, sf_dir, "documents"))
    return counts.withColumn("n_tokens", F.col("n_tokens").cast("long"))


@query("op10_substrings")
def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of windows of 35 words that also start elsewhere."""
    return substrings.report(table(spark, sf_dir, "documents"), window=35)


@query("op11_dialogues", dialogues.ORACLE)
def op11_dialogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, some of its rows damaged, with its faults and the cheapest edits that repair it."""
    rows, copies = dialogues.damaged(table(spark, sf_dir, "conversations"))
    return dialogues.repair(rows, copies=copies)


@query("op12_maxent")
def op12_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by unigram counts and by a model learnt from the documents that are not held out."""
    return maxent.scored(table(spark, sf_dir, "documents"))


@query("op13_lexical_search", lexical.ORACLE)
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents ranked for each benchmark item, the ten best."""
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)
