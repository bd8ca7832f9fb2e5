"""A training corpus from raw documents: five stages, each a Parquet table that the next one reads."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlake.llm import line_dedup, mixing, near_texts, packing, quality, token_store
from airlake.llm.common import stored, table, word_count


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the certified cut-offs."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that occur earlier; a document that loses all its words is a copy and goes."""
    cleaned = line_dedup.dedup_lines(docs)
    kept = cleaned.where((F.col("n_dropped") == 0) | (word_count(F.col("text")) > 0))
    fresh = {"text": F.col("text"), "n_chars": F.char_length("text").cast("long")}
    return kept.select(*[fresh.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-equal fingerprints (op6) and of texts whose five-word shingles are alike by 0.8 or more."""
    return near_texts.keep_one(docs, fingerprints=True)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents left out or repeated, shuffled by shard."""
    return mixing.mixed(mixing.plan_mix(docs)).select(*docs.columns)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences; a repeated document has the pieces of each copy."""
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    digests = token_store.with_crc(pieces.withColumn("length", F.size("ids").cast("long")))
    return digests.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("near dedup", near_dedup),
    ("source mixing", source_mixing),
    ("packing", sequence_packing),
]

# Hashing, tokenizing and iterated joins have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
