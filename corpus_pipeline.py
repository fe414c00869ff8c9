"""Corpus pipeline: documents to token files, one operator a stage.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a frame, which is written as Parquet and read again as the next one's
documents.  All but the last return the columns of ``documents``.

Language ID drops documents whose language is rejected; of each group of near
copies one document stays: SimHash (operator 1) links documents, MinHash bands add
those whose fingerprints lie further apart, and an exact check of all links follows
(five-word shingles, Jaccard similarity 0.8 or more); documents that hold a benchmark item go; the mix
repeats or drops documents to meet its sources' targets; the last stage writes
token files and returns their digests.  Texts that are null or empty have no
language and go in the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.catalog.registry import register
from carelake.llm import decontaminate, language, mixing, near_copies, simhash, token_frames
from carelake.llm.common import Scratch
from carelake.llm.queries import table, tokenizer_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.accepted(docs, language.fit(docs, key=docs["doc_id"]))


def simhash_keys(docs: DataFrame) -> DataFrame:
    """Rows with the SimHash group they are linked into, as keys of near copies."""
    linked = simhash.groups(docs.select(near_copies.row_key("doc_id", "text").alias("row_key"), "text"), "row_key")
    return linked.select("row_key", F.xxhash64(F.lit("simhash"), "root").alias("key")).distinct()


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copies.drop(docs, candidates=simhash_keys(docs))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.take(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_frames.digests(token_frames.write_shards(docs, tokenizer_path()))


STAGES = [
    ("language", identify_language),
    ("near copies", drop_near_copies),
    ("benchmark", drop_benchmark),
    ("mix", mix_sources),
    ("tokens", write_tokens),
]
ORACLE_SQL = None  # language ID and tokenisation are beyond SQL; tests/llm compares the stage of near copies with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


register("pipeline", run, ORACLE_SQL)
