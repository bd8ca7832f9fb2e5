"""Token ids as Parquet list columns that can be read in part.

Layout below one folder: ``tokens`` has part, doc_id, local_start, n_tokens and ids in ascending doc_id order, ``parts`` has
the number of ids before each part. Ids are dictionary encoded (their range is the vocabulary) or, with version 2 pages, delta
encoded; the ascending columns are always delta encoded. Row groups and pages are kept small, and pages carry the usual
column and offset indexes, so a reader of one document opens a few pages, and one of the metadata no ids at all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airlake.llm.tokens import crcs, encoder, id_list

BATCH_BYTES = 8 << 20  # ids handed to the writer at once


@dataclass(frozen=True)
class Layout:
    encoding: str = "dictionary"  # of the ids: dictionary or delta
    row_group_bytes: int = 32 << 20
    page_bytes: int = 128 << 10
    page_rows: int = 1_000

    def options(self) -> dict[str, str]:
        ids = "true" if self.encoding == "dictionary" else "false"
        return {
            "parquet.writer.version": "v2",
            "parquet.block.size": str(self.row_group_bytes),
            "parquet.page.size": str(self.page_bytes),
            "parquet.page.row.count.limit": str(self.page_rows),
            "parquet.enable.dictionary": "false",
            "parquet.enable.dictionary#ids.list.element": ids,
            "compression": "zstd",
        }


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, layout: Layout = Layout()) -> None:
    """Encode whole texts (null: empty), append ``end_id`` to each, and store them in ascending doc_id order.

    Null doc_ids come first; equal doc_ids are ordered by text. Every row is stored, repeated ones too. Other columns are
    ignored. Texts, not ids, are dealt out by ranges of doc_id, so each is encoded once.
    """
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all, start = encoder(tokenizer).encode_all, 0
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            ids = id_list([h[3] for h in held])
            parts, doc_ids, starts = ([h[k] for h in held] for k in range(3))
            columns = [
                pa.array(parts, pa.int64()), pa.array(doc_ids, pa.int64()), pa.array(starts, pa.int64()),
                pa.array([len(h[3]) // 4 for h in held], pa.int64()), ids,
            ]
            return pa.RecordBatch.from_arrays(columns, ["part", "doc_id", "local_start", "n_tokens", "ids"])

        for batch in batches:
            parts, doc_ids = (batch.column(n).to_pylist() for n in ("part", "doc_id"))
            for part, doc_id, ids in zip(parts, doc_ids, encode_all(batch.column("text")), strict=True):
                ids += end
                held.append((part, doc_id, start, ids))
                start += len(ids) // 4
                size += len(ids)
                if size >= BATCH_BYTES:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions(
        "doc_id", F.xxhash64("text"), "text"
    )
    placed = ordered.select(F.spark_partition_id().cast("long").alias("part"), "doc_id", "text")
    schema = "part bigint, doc_id bigint, local_start bigint, n_tokens bigint, ids array<int>"
    placed.mapInArrow(run, schema).write.options(**layout.options()).parquet(f"{path}/tokens")
    spark = docs.sparkSession
    sizes = (
        spark.read.parquet(f"{path}/tokens")
        .groupBy("part")
        .agg(F.sum("n_tokens").alias("n_tokens"), F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
    )
    # one row for each written part: as many as the shuffle has partitions
    before = Window.partitionBy(F.lit(1)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = F.coalesce(F.sum("n_tokens").over(before), F.lit(0))
    sizes.withColumn("part_start", starts).coalesce(1).write.parquet(f"{path}/parts")


def read_tokens(
    spark: SparkSession, path: str, columns: tuple[str, ...] = ("doc_id", "start", "n_tokens", "ids"),
    first_doc: int | None = None, last_doc: int | None = None,
) -> DataFrame:
    """Documents with the number of ids before each (``start``); only the named columns and the pages of a range are read."""
    tokens = spark.read.parquet(f"{path}/tokens")
    if first_doc is not None:
        tokens = tokens.where(F.col("doc_id") >= first_doc)
    if last_doc is not None:
        tokens = tokens.where(F.col("doc_id") <= last_doc)
    if "start" in columns:
        parts = spark.read.parquet(f"{path}/parts").select("part", "part_start")
        tokens = tokens.join(F.broadcast(parts), "part").withColumn("start", F.col("part_start") + F.col("local_start"))
    return tokens.select(*columns)


def with_crc(tokens: DataFrame) -> DataFrame:
    """The columns of ``tokens`` but ids, and ``ids_crc32`` of the ids read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [n for n in batch.schema.names if n != "ids"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(crcs(batch.column("ids")), pa.int64())],
                [*names, "ids_crc32"],
            )

    kept = [f"{f.name} {f.dataType.simpleString()}" for f in tokens.schema if f.name != "ids"]
    return tokens.mapInArrow(run, ", ".join([*kept, "ids_crc32 bigint"]))
