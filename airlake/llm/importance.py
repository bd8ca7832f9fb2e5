"""Importance resampling towards a target distribution, ranked by a distributed LSD radix sort.

Features (runs of words) are hashed into buckets; counts over all documents and over all target texts give each bucket a gain, an
array of fixed size that scores every document. A document's score is its floored mean gain plus a Gumbel
number from its id, so the highest scores are a draw without replacement in proportion to the weights.

Ranks come from stable counting-sort passes over the digits of the key (score descending, doc_id ascending), least significant first.
In each pass rows lie in blocks of consecutive positions: digits are counted by block, prefix sums over (digit,
block) give every group its offset, and a row's new position is the offset plus its place within block and digit. No task sorts more
than a block, whatever the keys are, and only ids and keys move.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airlake.llm.common import packed_row, stored

#: UTF-8 bytes of texts: A-Z in lower case, and every ASCII character that is no letter or digit as a space.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
SCALE = 1000


@dataclass(frozen=True)
class Resampling:
    buckets: int = 10_000
    longest: int = 1  # words in a feature
    seed: int = 2024
    percent: int = 10
    least_words: int = 20


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


def buckets_of(words: list[bytes], plan: Resampling) -> np.ndarray:
    """The bucket of every feature: all runs of 1 to ``longest`` words, joined by one space."""
    runs = [words]
    runs += [list(map(b" ".join, zip(*[words[i:] for i in range(n)], strict=False))) for n in range(2, plan.longest + 1)]
    hashes = [np.fromiter(map(crc32, r), np.int64, len(r)) for r in runs]
    return np.concatenate(hashes) % plan.buckets


def bucket_counts(buckets: DataFrame, plan: Resampling) -> DataFrame:
    """(bucket, n) over all packed bucket lists of a table; each task sends one row a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(plan.buckets, np.int64)
        for batch in batches:
            packed = b"".join(x.as_py() for x in batch.column(0))
            total += np.bincount(np.frombuffer(packed, np.uint32), minlength=plan.buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])

    counted = buckets.select("buckets").mapInArrow(run, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def packed_buckets(df: DataFrame, text: str, plan: Resampling) -> DataFrame:
    """All columns but the text, with n_words and ``buckets`` (unsigned 32-bit numbers, packed)."""
    rest = [c for c in df.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [words_of(t.as_py()) for t in batch.column(text)]
            packed = pa.array([buckets_of(w, plan).astype(np.uint32).tobytes() for w in words], pa.binary())
            sizes = pa.array([len(w) for w in words], pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], sizes, packed], [*rest, "n_words", "buckets"])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != text]
    return df.mapInArrow(run, ", ".join([*kinds, "n_words long", "buckets binary"]))


def gains(source: dict[int, int], target: dict[int, int], plan: Resampling) -> np.ndarray:
    """The gain of every bucket: thousandths of the log ratio of smoothed shares, rounded down."""
    s_all, t_all = sum(source.values()) + plan.buckets, sum(target.values()) + plan.buckets
    ratio = lambda b: (float(target.get(b, 0) + 1) * s_all) / (float(source.get(b, 0) + 1) * t_all)
    return np.array([math.floor(SCALE * math.log(ratio(b))) for b in range(plan.buckets)], np.int64)


def gumbel(doc_id: int | None, seed: int) -> int:
    h = int(sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-SCALE * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, target: DataFrame, plan: Resampling = Resampling(), carry: list[str] | None = None) -> DataFrame:
    """``row`` (the carried columns), uid, doc_id, n_words, n_features, weight, score: one stored row per input row.

    Null texts have no words; without features the weight is 0. A null doc_id draws with an empty id.
    """
    rows = docs.select(*packed_row(docs.select(*(carry or docs.columns))), F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.withColumn("uid", F.monotonically_increasing_id())
    listed = stored(packed_buckets(rows, "text", plan), "importance-buckets")
    aimed = packed_buckets(target.select("text"), "text", plan)
    # at most one row a bucket: bounded by the plan
    table = lambda df: {r["bucket"]: r["n"] for r in bucket_counts(df, plan).collect()}
    gain = listed.sparkSession.sparkContext.broadcast(gains(table(listed), table(aimed), plan))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [np.frombuffer(x.as_py(), np.uint32) for x in batch.column("buckets")]
            weight = [int(gain.value[x].sum()) // len(x) if len(x) else 0 for x in lists]
            noise = [gumbel(d.as_py(), plan.seed) for d in batch.column("doc_id")]
            own = [batch.column(c) for c in ("row", "uid", "doc_id", "n_words")]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(list(map(len, lists)), pa.int64()), pa.array(weight, pa.int64()),
                 pa.array([a + b for a, b in zip(weight, noise, strict=True)], pa.int64())],
                ["row", "uid", "doc_id", "n_words", "n_features", "weight", "score"],
            )

    kind = listed.schema["row"].dataType.simpleString()
    numbers = "uid long, doc_id long, n_words long, n_features long, weight long, score long"
    return stored(listed.mapInArrow(run, f"row {kind}, {numbers}"), "importance-scores")


BLOCKS = 64  # at least, while a block has 1024 rows


def radix_ranks(keyed: DataFrame, keys: list[str], bits: int = 11, block: int = 1 << 16) -> DataFrame:
    """(uid, pos): the position, from 0, of every row in ascending order of ``keys`` (longs, the first counts most; null last).

    ``keyed`` has uid (unique) and the keys. Rows with equal keys keep an arbitrary order. The number of passes is given by the range of
    the keys; rows, the counts of (block, digit) and one row for each digit are all that moves. Blocks hold ``block`` rows, fewer in small tables.
    """
    spans = keyed.agg(F.count(F.lit(1)).alias("n"), *[F.min(k).alias(f"low_{k}") for k in keys], *[F.max(k).alias(f"high_{k}") for k in keys]).first()
    block = min(block, max(1024, spans["n"] // BLOCKS))
    digits = []  # least significant first: (key, shift)
    shifted = []
    for k in keys:
        low, high = spans[f"low_{k}"], spans[f"high_{k}"]
        low, span = (0, 0) if low is None else (low, high - low + 1)  # null takes the place after the highest
        shifted.append(F.coalesce(F.col(k) - F.lit(low), F.lit(span)).cast("long").alias(k))
        digits = [(k, s) for s in range(0, max(1, span.bit_length()), bits)] + digits
    # the first blocks are the stored table's partitions
    at = keyed.select("uid", *shifted, F.col("uid").alias("pos"), F.shiftright("uid", 33).alias("block"))
    for n, (key, shift) in enumerate(digits):
        digit = F.shiftright(F.col(key), shift).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")
        rows = at.withColumn("digit", digit)
        counts = stored(rows.groupBy("digit", "block").agg(F.count("*").alias("n")), f"radix-counts-{n}")
        totals = counts.groupBy("digit").agg(F.sum("n").alias("n"))
        # one row a digit, 2^bits at most
        base = totals.select("digit", (F.sum("n").over(Window.orderBy("digit")) - F.col("n")).alias("base"))
        before = Window.partitionBy("digit").orderBy("block")
        offsets = counts.withColumn("before", F.sum("n").over(before) - F.col("n")).join(F.broadcast(base), "digit")
        offsets = offsets.select("digit", "block", (F.col("base") + F.col("before")).alias("offset"))
        inside = Window.partitionBy("digit", "block").orderBy("pos")
        placed = rows.withColumn("_n", F.row_number().over(inside)).join(offsets, ["digit", "block"])
        placed = placed.withColumn("pos", F.col("offset") + F.col("_n") - 1)
        done = {k for k, _ in digits[n + 1 :]}
        left = [k for k in keys if k in done]
        at = stored(placed.select("uid", *left, "pos", F.floor(F.col("pos") / block).alias("block")), f"radix-pass-{n}")
    return at.select("uid", "pos")


def resample(docs: DataFrame, target: DataFrame, plan: Resampling = Resampling(), carry: list[str] | None = None) -> DataFrame:
    """``row`` (the carried columns), doc_id, n_words, n_features, weight, score, rank: one row per input row.

    Of the N documents with at least ``least_words`` words the floor(percent * N / 100) highest scores are drawn; rank counts from
    1 by score descending, then doc_id (null last), and is null for the rest. Repeated rows count each, as do
    equal ids, whose order among equal scores is arbitrary. Empty tables, of documents or of targets, are allowed.
    """
    rows = scored(docs, target, plan, carry)
    allowed = rows.where(F.col("n_words") >= plan.least_words)
    n = allowed.count() * plan.percent // 100
    places = radix_ranks(allowed.select("uid", (-F.col("score")).alias("falling"), "doc_id"), ["falling", "doc_id"])
    drawn = places.where(F.col("pos") < n).select("uid", (F.col("pos") + 1).alias("rank"))
    return rows.join(drawn, "uid", "left").drop("uid")
