"""Document fingerprints by consistent weighted sampling.

A document is a bag of words; a word's weight is its count. For each of ``samples`` independent draws, every word gets
r ~ Gamma(2, 1), c ~ Gamma(2, 1) and beta ~ U(0, 1) from a hash of word and draw; with weight w, t = floor(ln w / r + beta) and
ln a = ln c - r (t - beta + 1). The draw keeps the word and level with the least a. Two documents agree in a draw
with probability sum(min(w)) / sum(max(w)), their generalised Jaccard similarity. As a is a function of word and level, the least
ln a itself serves as the sample; 16 bits of its hash are kept.

Everything is DataFrame functions: one shuffle brings neighbouring documents together, and the counting of words
and the minima run behind it on the same partitioning.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlake.llm.common import spaced, words_of

SAMPLES = 64
LANES = 4
SLICE_ROWS = 1024  # rows per slice of the doc_id order
MAX_SLICES = 20_000  # bounds the list of slice limits held by the driver


#: -ln((1 + u) / 2) for u in [0, 1] as a polynomial in u, to 2e-6: fitted by least squares at Chebyshev points.
LN_HALF = np.polynomial.Chebyshev.fit(
    *(lambda u: (u, -np.log((1 + u) / 2)))(0.5 + 0.5 * np.cos(np.pi * (np.arange(200) + 0.5) / 200)), 6, domain=[0, 1]
).convert(kind=np.polynomial.Polynomial).coef.tolist()


def _exponential(h: Column, at: int) -> Column:
    """An exponential number from 32 bits of a hash: -ln(2^-n v), n the length of a run of ones, v uniform in (1/2, 1].

    Shifts, a bit count and a polynomial: several times faster than the logarithm of a uniform number.
    """
    run = F.shiftrightunsigned(h, at).bitwiseAND(F.lit(0xFFFF))
    n = F.bit_count(run.bitwiseXOR(run + 1)) - 1
    u = (F.shiftrightunsigned(h, at + 16).bitwiseAND(F.lit(0xFFFF)) + F.lit(0.5)) * F.lit(2.0**-16)
    tail = F.lit(LN_HALF[-1])
    for c in LN_HALF[-2::-1]:
        tail = tail * u + F.lit(c)
    return n * F.lit(math.log(2)) + tail


def ln_samples(term: Column, draw: Column, ln_weights: list[Column]) -> list[Column]:
    """ln a of one word in one draw, for each of several weights (null weight: null).

    Three hashes of word and draw give r, c (sums of two exponential numbers, hence Gamma(2, 1)) and beta.
    """
    hashes = [F.xxhash64(term, draw, F.lit(i)) for i in range(3)]
    r = _exponential(hashes[0], 0) + _exponential(hashes[0], 32)
    ln_c = F.log(_exponential(hashes[1], 0) + _exponential(hashes[1], 32))
    beta = (F.shiftrightunsigned(hashes[2], 12) + F.lit(0.5)) * F.lit(2.0**-52)
    return [ln_c - r * (F.floor(w / r + beta) - beta + 1) for w in ln_weights]


def signature(samples: Column, side: str) -> Column:
    """Four hex digits a draw, from (a, b) in order of draws; a bag without words has the empty signature."""
    digits = F.transform(samples, lambda x: F.lower(F.substring(F.hex(F.xxhash64(x[side])), -4, 4)))
    return F.when(F.get(samples, F.lit(0))[side].isNull(), F.lit("")).otherwise(F.array_join(digits, ""))


def likeness(a: Column, b: Column) -> Column:
    """Share of draws in which two signatures agree; two empty ones are alike, an empty and another are not."""
    each = F.sequence(F.lit(0), F.floor(F.char_length(a) / 4).cast("int") - 1)
    same = F.filter(each, lambda i: F.substring(a, i * 4 + 1, F.lit(4)) == F.substring(b, i * 4 + 1, F.lit(4)))
    return (
        F.when((a == "") & (b == ""), F.lit(1.0))
        .when((a == "") | (b == ""), F.lit(0.0))
        .otherwise(F.size(same) / (F.char_length(a) / 4))
    )


def _slice_of(doc_id: Column, limits: list[int]) -> Column:
    """How many limits lie below a doc_id, by bisection over a constant array (null: 0)."""
    if not limits:
        return F.lit(0)
    bounds = F.split(F.lit(",".join(map(str, limits))), ",").cast("array<bigint>")
    found = F.aggregate(
        F.sequence(F.lit(1), F.lit(len(limits).bit_length() + 1)),
        F.struct(F.lit(0).alias("lo"), F.lit(len(limits)).alias("hi")),
        lambda acc, _: F.when(acc["lo"] >= acc["hi"], acc).otherwise(
            F.when(
                F.get(bounds, F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")) < doc_id,
                F.struct((F.floor((acc["lo"] + acc["hi"]) / 2) + 1).cast("int").alias("lo"), acc["hi"].alias("hi")),
            ).otherwise(
                F.struct(acc["lo"].alias("lo"), F.floor((acc["lo"] + acc["hi"]) / 2).cast("int").alias("hi"))
            )
        ),
        lambda acc: acc["lo"],
    )
    return F.when(doc_id.isNull(), F.lit(0)).otherwise(found)


def with_next(docs: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """slice, at, ghost, doc_id, text, next_text: the next document in ascending doc_id order, after the last the first.

    The order is cut into slices at quantiles of doc_id (at most MAX_SLICES). Each slice gets a copy of the first
    document of the next one, marked as ghost, so no window reaches beyond a slice and no task sees more than its slices.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = docs.count()
    n = min(MAX_SLICES, -(-total // slice_rows))
    limits: list[int] = []
    if n > 1:
        shares = [i / n for i in range(1, n)]
        got = docs.agg(F.percentile_approx("doc_id", shares, max(10_000, 20 * n))).first()[0] or []
        limits = sorted(set(got))
    sliced = docs.withColumn("slice", _slice_of(F.col("doc_id"), limits))
    tie = F.xxhash64("text")
    # the first document of each slice: by id alone, then the texts of those few
    heads = sliced.groupBy("slice").agg(F.min(F.coalesce("doc_id", F.lit(-(2**63)))).alias("head_id"))
    heads = (
        docs.withColumn("head_id", F.coalesce("doc_id", F.lit(-(2**63))))
        .join(F.broadcast(heads), "head_id")
        .groupBy("slice")
        .agg(F.min(F.struct("doc_id", tie.alias("tie"), "text")).alias("head"))
    )
    every = Window.partitionBy(F.lit(1)).orderBy("slice")  # at most MAX_SLICES rows
    heads = heads.withColumn(
        "for_slice",
        F.coalesce(F.lag("slice").over(every), F.last("slice").over(every.rowsBetween(0, Window.unboundedFollowing))),
    )
    ghosts = heads.select("head.doc_id", "head.text", F.col("for_slice").alias("slice"), F.lit(1).alias("ghost"))
    together = sliced.withColumn("ghost", F.lit(0)).unionByName(ghosts)
    w = Window.partitionBy("slice").orderBy("ghost", "doc_id", F.xxhash64("text"), "text")
    return together.withColumns({"at": F.row_number().over(w), "next_text": F.lead("text").over(w)})


def edited(text: Column, following: Column) -> Column:
    """The last quarter of the code points gives way to as many first ones of the following text (or all it has)."""
    n = F.char_length(text)
    cut = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - cut), F.substring(following, F.lit(1), cut))


def fingerprints_with_neighbours(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Null texts count as empty; a text without words has an empty fingerprint. Null doc_ids come first in the order, equal
    doc_ids are ordered by text; repeated rows are each other's neighbours. A single document is its own next one. An
    empty table has an empty result. Other columns are ignored.
    """
    ordered = with_next(docs)
    change = edited(F.col("text"), F.coalesce("next_text", F.lit("")))
    rows = ordered.select(
        "slice", "at", "ghost", "doc_id", F.char_length("text").alias("n_chars"), "text", change.alias("changed")
    ).withColumn("digest", F.sha2("changed", 256))
    part = lambda i: F.conv(F.substring("digest", 16 * i + 1, 16), 16, -10).cast("long")
    facts = {"doc_id": F.col("doc_id"), "ghost": F.col("ghost"), "n_chars": F.col("n_chars")}
    facts |= {f"sha{i}": part(i) for i in range(4)}
    # words of both texts as (kind 0, side, hash); what else is to be known of a document rides along as kinds 1, 2, ...
    entry = lambda value, kind, side: F.struct(
        F.lit(kind).alias("kind"), F.lit(side).alias("side"), value.cast("long").alias("term")
    )
    words = lambda c, side: F.transform(
        words_of(spaced(F.col(c))), lambda x: entry(F.xxhash64(x), 0, side)
    )
    known = F.array(*[entry(c, i, 0) for i, c in enumerate(facts.values(), 1)])
    entries = rows.select("slice", "at", F.inline(F.concat(known, words("text", 0), words("changed", 1))))
    counted = entries.groupBy("slice", "at", "kind", "term").agg(
        F.count_if(F.col("side") == 0).alias("w0"), F.count_if(F.col("side") == 1).alias("w1")
    )
    ln = lambda c: F.when(F.col("kind") == 0, F.log(F.col(c)))  # noqa: E731  ln 0 is null
    weighed = counted.select("slice", "at", "kind", "term", ln("w0").alias("ln0"), ln("w1").alias("ln1"))
    # a row per word and LANES draws, within one task and never materialised: the minima take each up at once
    lanes = list(range(0, samples, LANES))
    numbers = F.when(F.col("kind") == 0, F.lit(lanes)).otherwise(F.array(-F.col("kind")))
    evaluated = weighed.withColumn("draw", F.explode(numbers))
    pairs = [
        ln_samples(F.col("term"), F.col("draw") + j, [F.col("ln0"), F.col("ln1")]) for j in range(min(LANES, samples))
    ]
    least = evaluated.groupBy("slice", "at", "draw").agg(
        F.max("term").alias("value"),
        *[F.min(x).alias(f"{side}{j}") for j, pair in enumerate(pairs) for side, x in zip("ab", pair, strict=True)],
    )
    lane = F.array(*[F.struct(F.col(f"a{j}").alias("a"), F.col(f"b{j}").alias("b")) for j in range(len(pairs))])
    drawn = least.groupBy("slice", "at").agg(
        *[F.max(F.when(F.col("draw") == -i, F.col("value"))).alias(n) for i, n in enumerate(facts, 1)],
        F.sort_array(F.collect_list(F.when(F.col("draw") >= 0, F.struct("draw", lane.alias("lane"))))).alias("lanes"),
    ).withColumn("samples", F.flatten("lanes.lane"))
    signed = drawn.select(
        "slice", "at", *facts,
        signature(F.col("samples"), "a").alias("fingerprint"),
        signature(F.col("samples"), "b").alias("edited_fingerprint"),
    )
    w = Window.partitionBy("slice").orderBy("at")
    following = signed.withColumn("next_fingerprint", F.lead("fingerprint").over(w)).where("ghost = 0")
    digest = F.concat(*[F.lower(F.lpad(F.hex(f"sha{i}"), 16, "0")) for i in range(4)])
    return following.select(
        "doc_id", "n_chars", digest.alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
