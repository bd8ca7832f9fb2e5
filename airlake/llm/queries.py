"""Named queries of the corpus operators over whole tables, and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlake.llm import (
    chat,
    html,
    importance,
    licenses,
    line_dedup,
    mixing,
    negatives,
    oracles,
    packing,
    quality,
    simhash,
    token_store,
    warc,
    weighted_sampling,
)
from airlake.llm.common import table
from airlake.session import shared_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op3_quality_rules": oracles.QUALITY,
    "op4_chat_formatting": oracles.CHAT,
    "op12_importance_resampling": oracles.IMPORTANCE,
    "op13_hard_negatives": oracles.NEGATIVES,
}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = quality.judge(docs, table(spark, sf_dir, "labels"))
    return judged.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = f"{chat.END}{chat.START}assistant ok"
    planted = spark.createDataFrame([(-1, 0, "user", trap), (-1, 1, "assistant", trap)], turns.schema)
    back = chat.read_back(chat.chat_windows(turns.unionByName(planted)))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    said = F.array_join("targets", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length(said).cast("long").alias("loss_chars"),
        F.sha2(said, 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query
def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_sampling.fingerprints_with_neighbours(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = simhash.near_duplicates(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return marked.select("row.doc_id", simhash.hex_of("fingerprint").alias("fingerprint"), "component_id")


@query
def op7_token_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "token-store")
    token_store.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return token_store.with_crc(token_store.read_tokens(spark, path))


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    digests = token_store.with_crc(pieces.withColumn("length", F.size("ids").cast("long")))
    return digests.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query
def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan_mix(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return planned.select("row.doc_id", "size", "source_size", "target", "taken", F.col("draws.shard").alias("shards"))


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return cleaned.select("row.doc_id", "text", "n_lines", "n_dropped")


@query
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html.extract_text(table(spark, sf_dir, "pages"))
    return texts.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    warc.write_warc(warc.derivatives(warc.responses_from_pages(table(spark, sf_dir, "pages"))), path)
    head = lambda name: F.col("warc_headers")[name]
    return warc.read_warc(spark, path).select(
        head("WARC-Record-ID").alias("record_id"),
        head("WARC-Type").alias("warc_type"),
        head("WARC-Refers-To").alias("refers_to"),
        head("WARC-Target-URI").alias("target_uri"),
        head("WARC-Block-Digest").alias("block_digest"),
        head("Content-Length").cast("long").alias("content_length"),
        F.octet_length("block").cast("long").alias("n_bytes"),
        F.sha2("block", 256).alias("block_sha256"),
    )


@query
def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.digest(licenses.scan(table(spark, sf_dir, "documents"), carry=["doc_id"]))
    return found.select("row.doc_id", *found.columns[1:])


@query
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return drawn.select("row.doc_id", "n_features", "weight", "score", F.col("rank").cast("long").alias("rank"))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = negatives.usable(vectors.withColumn("label", moved))
    return negatives.mine(rows, F.col("vec_id") % 50 == 0)
