"""Shared column expressions and storage helpers of the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airlake.session import shared_path

#: The white space that separates words: space and \x09-\x0D. Nothing else does.
GAPS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spaced(text: Column) -> Column:
    """The words of a text joined by single spaces (null: empty)."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), GAPS, " "))


def words_of(spaced_text: Column) -> Column:
    """The words of a text already passed through :func:`spaced`, as an array (none: empty)."""
    return F.when(spaced_text == "", F.array().cast("array<string>")).otherwise(F.split(spaced_text, " "))


def word_count(text: Column) -> Column:
    """How many words a text has (null: none)."""
    words = spaced(text)
    gaps = F.char_length(words) - F.char_length(F.replace(words, F.lit(" "), F.lit("")))
    return F.when(words == "", F.lit(0)).otherwise(gaps + 1).cast("long")


def packed_row(df: DataFrame, *needed: str) -> list[Column]:
    """All input columns as one struct, so that no working column can clash with them, and copies of those needed."""
    return [F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[F.col(f"`{c}`").alias(c) for c in needed]]


FILTER_BUCKETS = 512  # of 4 KB each: a filter of 16.8 million bits, 2 MB whatever the data


def possible(df: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column) -> tuple[DataFrame, DataFrame]:
    """``df`` split into rows whose key may be among the wanted ones, and rows whose key is not.

    The keys are 64-bit hashes. A bitmap of bounded size is broadcast; it only spares moving rows (mostly long texts) that
    a join would drop anyway, so results do not depend on how full it is.
    """
    bucket = lambda k: F.pmod(k, F.lit(FILTER_BUCKETS))
    bit = lambda k: F.shiftrightunsigned(k, 20).bitwiseAND(F.lit(32767))
    maps = wanted.groupBy(bucket(wanted_key).alias("_bucket")).agg(F.bitmap_construct_agg(bit(wanted_key)).alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(F.col("_at"), 3) + 1, F.lit(1))), 16, 10).cast("int")
    place = F.col("_at").bitwiseAND(F.lit(7)).cast("int")
    hit = F.call_function("shiftright", byte, place).bitwiseAND(F.lit(1)) == 1
    asked = df.withColumns({"_bucket": bucket(key), "_at": bit(key)}).join(F.broadcast(maps), "_bucket", "left")
    asked = asked.withColumn("_hit", F.coalesce(hit, F.lit(False))).select(*df.columns, "_hit")
    return asked.where("_hit").drop("_hit"), asked.where("NOT _hit").drop("_hit")


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write to the cluster's shared folder and read back, so lost executors cost no recomputation.

    The shuffle files of the write go when it has ended, not when the driver next collects garbage; nothing reads them after.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        # texts take a third less space than by default
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
