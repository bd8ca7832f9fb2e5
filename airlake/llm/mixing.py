"""Mixing sources to target weights, by a multivariate-hypergeometric splitting tree over blocks.

Documents of a source fall into blocks of bounded size by hash. A source's target is reached in passes over its blocks, each
pass in its own random order: whole passes first, then one that stops where the target is met (inside its last block, among its
documents). All block draws of all sources form an urn; a binary tree over the output shards splits it: each node
draws how many blocks of each source go left (multivariate hypergeometric), so shards get exact, random quotas that add up
to all draws. Every node has its own seed, so any task can walk to its shards alone, and reruns agree. A shard takes its quota
as consecutive draws, which no other shard has, and orders its documents by hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlake.llm.common import packed_row, stored, word_count

CELL = 1024  # blocks that a prefix sum orders in one window


@dataclass(frozen=True)
class Mix:
    weights: tuple[float, ...] = (5, 2, 1)  # repeating, by sources in code-point order, null last
    share: float = 1.5  # words of the mix against words of all sources
    repeats: float = 2.0  # the most a source may be repeated
    block_words: int = 50_000
    block_docs: int = 1_000
    blocks_per_shard: int = 32
    seed: int = 17


def targets(sizes: dict[str | None, int], mix: Mix = Mix()) -> dict[str | None, float]:
    """Words to take of each source: shares by weight, what exceeds ``repeats`` times a source going to the others."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mix.weights[i % len(mix.weights)] for i, s in enumerate(names)}
    caps = {s: mix.repeats * sizes[s] for s in names}
    fixed: dict[str | None, float] = {}
    left = mix.share * sum(sizes.values())
    while True:
        free = [s for s in names if s not in fixed]
        total = sum(weight[s] for s in free)
        got = {s: left * weight[s] / total for s in free}
        over = [s for s in free if got[s] > caps[s]]
        if not over:
            return {s: float({**fixed, **got}[s]) for s in names}
        fixed |= {s: caps[s] for s in over}
        left = mix.share * sum(sizes.values()) - sum(fixed.values())


def shard_quotas(counts: list[int], shards: int, seed: int, first: int, last: int) -> Iterator[tuple[int, list, list]]:
    """(shard, first draw of each source, draws of each source) for shards first..last-1, by walking the tree."""

    def walk(lo: int, hi: int, before: np.ndarray, here: np.ndarray):
        if hi <= first or lo >= last:
            return
        if hi - lo == 1:
            yield lo, before.tolist(), here.tolist()
            return
        mid = (lo + hi) // 2
        total = int(here.sum())
        # shards get equal numbers of draws, to one
        share = total * (mid - lo) // (hi - lo)
        rng = np.random.default_rng([seed, lo, hi])
        left = rng.multivariate_hypergeometric(here, share, method="marginals")
        yield from walk(lo, mid, before, left)
        yield from walk(mid, hi, before + left, here - left)

    yield from walk(0, shards, np.zeros(len(counts), np.int64), np.array(counts, np.int64))


def _uniform(*of) -> Column:
    """A number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*of), 11) * F.lit(2.0**-53)


def _ordered(blocks: DataFrame) -> DataFrame:
    """rank and words before each block in the order of ``at``, by source and pass, in windows of about CELL blocks."""
    cells = blocks.withColumn("cell", F.floor(F.col("at") * F.ceil(F.col("n_blocks") / CELL)))
    keys = ["source_id", "pass"]
    inner = Window.partitionBy(*keys, "cell").orderBy("at", "block")
    so_far = inner.rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumns(
        {"rank": F.row_number().over(inner) - 1, "before": F.coalesce(F.sum("words").over(so_far), F.lit(0))}
    )
    sums = cells.groupBy(*keys, "cell").agg(F.count("*").alias("n"), F.sum("words").alias("w"))
    outer = Window.partitionBy(*keys).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        *keys, "cell",
        F.coalesce(F.sum("n").over(outer), F.lit(0)).alias("n0"), F.coalesce(F.sum("w").over(outer), F.lit(0)).alias("w0"),
    )
    both = cells.join(sums, [*keys, "cell"])
    return both.withColumns({"rank": F.col("rank") + F.col("n0"), "before": F.col("before") + F.col("w0")})


def plan_mix(docs: DataFrame, mix: Mix = Mix(), carry: list[str] | None = None) -> DataFrame:
    """``row`` (the carried columns, all by default), size, source_size, target, draws, taken: one row per input row.

    ``draws`` lists the (shard, pass) that take the document; ``taken`` is its size times their number, within ``repeats``
    times its size, and each source's total comes within a document of its target. Null texts have size 0; a null source
    is a source; null doc_ids and repeated rows are mixed like others, the latter alike. An empty table gives an empty result.

    The driver holds one row per source (the list to which weights are given), never blocks or documents.
    """
    key = F.xxhash64("doc_id", "text", "source")
    light = "text" not in (carry or docs.columns)
    rows = docs.select(
        *packed_row(docs.select(*(carry or docs.columns))), F.col("source").alias("of"), key.alias("key"),
        word_count(F.col("text")).alias("size"),
    )
    # texts are read where they lie and joined in place; only numbers are stored and shuffled to plan
    sized = stored(rows if light else rows.drop("row"), "mix-sizes")
    rows = sized if light else rows
    spark = docs.sparkSession
    totals = {r["of"]: (r["words"], r["docs"]) for r in sized.groupBy("of").agg(
        F.sum("size").alias("words"), F.count("*").alias("docs")).collect()}
    goal = targets({s: w for s, (w, _) in totals.items()}, mix) if totals else {}
    names = list(goal)
    listed = []
    for i, s in enumerate(names):
        words, n = totals[s]
        blocks = max(1, math.ceil(words / mix.block_words), math.ceil(n / mix.block_docs))
        whole = int(goal[s] // words) if words else 0
        listed.append((i, s, words, goal[s], blocks, whole, goal[s] - whole * words))
    schema = "source_id int, of string, source_size long, target double, n_blocks long, whole int, rest double"
    sources = spark.createDataFrame(listed, schema)

    def in_blocks(some: DataFrame) -> DataFrame:
        # one row per source, which the driver holds anyway
        named = some.join(F.broadcast(sources.withColumnRenamed("of", "name")), F.col("of").eqNullSafe(F.col("name")))
        return named.withColumn("block", F.pmod(F.xxhash64("key", F.lit(mix.seed)), F.col("n_blocks")))

    placed = in_blocks(sized)
    by_block = ["source_id", "block"]
    words = placed.groupBy(*by_block).agg(F.sum("size").alias("words"))
    # every pass over every block, in the pass's own order; the last pass stops where the rest is met
    passes = (
        words.join(sources.select("source_id", "n_blocks", "whole", "rest"), "source_id")
        .withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("whole"))))
        .withColumn("at", _uniform(F.lit(mix.seed), "source_id", "pass", "block"))
    )
    drawn = _ordered(passes).where(
        (F.col("pass") < F.col("whole")) | ((F.col("rest") > 0) & (F.col("before") < F.col("rest")) & (F.col("words") > 0))
    )
    cut = (F.col("pass") == F.col("whole")) & (F.col("before") + F.col("words") > F.col("rest"))
    drawn = drawn.withColumn("room", F.when(cut, F.col("rest") - F.col("before")))
    drawn = stored(drawn.select("source_id", "block", "pass", "rank", "room"), "mix-draws")
    # the one block of a source that is taken in part: its documents in the order of their keys, each if it still fits
    ends = drawn.where("room is not null").select(*by_block, "room")
    inside = placed.select(*by_block, "key", "size").join(ends, by_block)
    inside = inside.groupBy("source_id", "key").agg(F.sum("size").alias("size"), F.max("room").alias("room"))

    def fit(acc: Column, d: Column) -> Column:
        fits = d["size"] <= acc["room"]
        return F.when(
            fits, F.struct((acc["room"] - d["size"]).alias("room"), F.array_append(acc["keys"], d["key"]).alias("keys"))
        ).otherwise(acc)

    empty = F.array().cast("array<bigint>")
    limit = inside.groupBy("source_id").agg(
        F.max("room").alias("room"), F.sort_array(F.collect_list(F.struct("key", "size"))).alias("docs")
    )
    limit = limit.select(
        "source_id",
        F.aggregate("docs", F.struct("room", empty.alias("keys")), fit, lambda acc: acc["keys"]).alias("limit"),
    )
    # draws are numbered by source, pass after pass, over all sources' draws; the tree deals them out
    counted = {(r["source_id"], r["pass"]): r["n"] for r in drawn.groupBy("source_id", "pass").agg(
        F.count("*").alias("n")).collect()}
    counts, starts = [0] * len(names), []
    for (i, p), n in sorted(counted.items()):
        starts.append((i, p, counts[i]))
        counts[i] += n
    shards = max(1, math.ceil(sum(counts) / mix.blocks_per_shard))

    def quotas(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ids = frame["id"]
            for lo in range(0, len(ids), 1024):
                some = ids.iloc[lo : lo + 1024]
                got = shard_quotas(counts, shards, mix.seed, int(some.min()), int(some.max()) + 1)
                out = [(s, i, a[i], n[i]) for s, a, n in got for i in range(len(n)) if n[i]]
                yield pd.DataFrame(out, columns=["shard", "source_id", "first", "n"])

    dealt = (
        spark.range(shards)
        .mapInPandas(quotas, "shard long, source_id int, first long, n long")
        .select("shard", "source_id", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("draw"))
    )
    numbered = drawn.join(spark.createDataFrame(starts, "source_id int, pass int, start long"), ["source_id", "pass"])
    numbered = numbered.withColumn("draw", F.col("start") + F.col("rank"))
    uses = numbered.join(dealt, ["source_id", "draw"]).join(limit, "source_id", "left")
    use = F.struct(
        "shard", "pass", F.col("room").isNotNull().alias("in_part"), F.when(F.col("room").isNotNull(), F.col("limit")).alias("limit")
    )
    # at most a few passes draw a block
    uses = uses.groupBy(*by_block).agg(F.sort_array(F.collect_list(use)).alias("uses"))
    # stored, so that its size is known before the documents are: they stay where they are unless it is past the threshold
    uses = stored(uses, "mix-uses")
    taken_by = F.filter(
        F.coalesce("uses", F.array().cast("array<struct<shard:bigint,pass:int,in_part:boolean,limit:array<bigint>>>")),
        lambda u: ~u["in_part"] | F.coalesce(F.array_contains(u["limit"], F.col("key")), F.lit(False)),
    )
    out = in_blocks(rows).join(uses, by_block, "left").withColumn(
        "draws", F.transform(taken_by, lambda u: F.struct(u["shard"].alias("shard"), u["pass"].alias("pass")))
    )
    return out.select(
        "row", "key", "size", "source_size", "target", "draws", (F.col("size") * F.size("draws")).cast("long").alias("taken")
    )


def mixed(planned: DataFrame, seed: int = Mix.seed) -> DataFrame:
    """The documents of the mix, repeats included, with their own columns: shards in order, each shuffled within."""
    each = planned.select("row", "key", F.inline("draws"))
    dealt = each.repartitionByRange("shard", F.xxhash64(F.lit(seed), "key", "pass"))
    return dealt.sortWithinPartitions("shard", F.xxhash64(F.lit(seed), "key", "pass")).select("row.*")
