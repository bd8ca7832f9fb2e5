"""Fuzzy line deduplication by MinHash: signatures of character shingles, bands, exact Jaccard verification, components.

1. Lines of at least ``min_equal`` characters (lower case, single spaces) are merged by a 128-bit hash when equal.
2. Each line of at least ``min_chars`` characters has a signature of BANDS x ROWS minima over the hashes of all its
   ``shingle``-character shingles, and one key for each band (``line_hashes.py``). Lines that share a key are candidates; crowds
   are compared until each is one component or all its pairs are done (``jaccard.py``).
3. Candidates are verified: exact Jaccard similarity of their sets, 0.8 or more.
4. Verified pairs are joined into components; the first occurrence (smallest doc_id, then position) of a component is kept.

A pair at 0.8 shares a band with probability 1 - (1 - 0.8^ROWS)^BANDS = 0.9993, one at 0.85 practically always.

Spark shuffles, joins and groups the lines; splitting, hashing and comparing them run over Arrow batches in its tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlake.llm.common import packed_row, possible, stored
from airlake.llm.components import connected_components
from airlake.llm.jaccard import similar_links
from airlake.llm.line_hashes import BANDS, lines_of, shingle_hashes, with_similar_pairs


@dataclass(frozen=True)
class Fuzzy:
    min_chars: int = 30
    shingle: int = 5
    min_equal: int = 30

    @property
    def least(self) -> int:
        return min(self.min_equal, self.min_chars)


def line_texts(docs: DataFrame, asked: DataFrame, how: Fuzzy) -> DataFrame:
    """id, norm of the lines ``asked`` for (id, h1, h2); only lines that may be among them are moved."""
    lines = lines_of(docs, how.least, texts=True).select("h1", "h2", "norm")
    likely, _ = possible(lines, F.col("h1"), asked, F.col("h1"))
    # equal lines meet before they are moved
    firsts = likely.groupBy("h1", "h2").agg(F.min("norm").alias("norm"))
    return firsts.join(asked, ["h1", "h2"]).select("id", "norm")


def distinct_lines(docs: DataFrame, how: Fuzzy) -> DataFrame:
    """id, h1, h2, n (occurrences) and k0, k1, ... (band keys, null for lines too short to be compared) of each different line."""
    keyed = lines_of(docs, how.least, how.min_chars, how.shingle)
    # keys follow from the line, so any occurrence's will do; numbers only, so that they aggregate without sorting
    merged = keyed.groupBy("h1", "h2").agg(F.count("*").alias("n"), *[F.min(f"k{b}").alias(f"k{b}") for b in range(BANDS)])
    return stored(merged.withColumn("id", F.monotonically_increasing_id()), "distinct-lines")


def repeated_lines(docs: DataFrame, how: Fuzzy = Fuzzy()) -> DataFrame:
    """doc_id, text_hash, dropped: the positions of the lines of each document that an earlier occurrence makes redundant."""
    distinct = distinct_lines(docs, how)
    texts = lambda ids: line_texts(docs, distinct.select("id", "h1", "h2").join(ids, "id"), how)
    keyed = distinct.where("k0 is not null").select("id", F.explode(F.array(*[f"k{b}" for b in range(BANDS)])).alias("key"))
    check = lambda pairs: with_similar_pairs(pairs, how.shingle)
    sets = lambda lines: shingle_hashes(lines, how.shingle)
    parts = connected_components(similar_links(keyed, texts, check, sets, "line"))
    known = distinct.select("id", "h1", "h2", "n").join(parts.withColumnRenamed("node", "id"), "id", "left")
    known = known.where("n > 1 or component is not null")
    known = stored(known.select("h1", "h2", F.coalesce("component", "id").alias("group")), "line-groups")
    places = lines_of(docs, how.least)
    likely, _ = possible(places, F.col("h1"), known, F.col("h1"))
    found = stored(likely.join(known, ["h1", "h2"]).select("doc_id", "text_hash", "pos", "group"), "line-places")
    here = F.struct("doc_id", "text_hash", "pos")
    extra = found.join(found.groupBy("group").agg(F.min(here).alias("keep")), "group").where(~here.eqNullSafe(F.col("keep")))
    # repeated rows (same doc_id and text) are one document here
    return extra.groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("dropped"))


def dedup_lines(docs: DataFrame, how: Fuzzy = Fuzzy(), carry: list[str] | None = None) -> DataFrame:
    """``row`` (the carried columns, all by default), text without its redundant lines, n_lines, n_dropped.

    Of lines that are equal or similar (also through others) one occurrence stays, the one of the smallest doc_id and
    position (null doc_ids first). Lines under ``min_equal`` characters are left alone, and those under ``min_chars`` merge with equal
    ones only. Null and empty texts have one empty line and stay as they are
    (null: empty). Rows equal in doc_id and text are one document, and each keeps the same lines. An empty table has an
    empty result; other columns ride along untouched.
    """
    dropped = stored(repeated_lines(docs.select("doc_id", "text"), how), "dropped-lines")
    source = docs.select(
        *packed_row(docs.select(*(carry or docs.columns))),
        F.col("doc_id").alias("own_id"), F.xxhash64("text").alias("own_hash"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    # documents that keep all their lines stay where they are
    changed, whole = possible(source, F.xxhash64("own_id", "own_hash"), dropped, F.xxhash64("doc_id", "text_hash"))
    joined = changed.join(
        dropped,
        F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_hash") == F.col("text_hash")),
        "left",
    ).select("row", "text", "dropped")
    joined = joined.unionByName(whole.select("row", "text", F.lit(None).cast("array<int>").alias("dropped")))
    lines = F.split("text", "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("dropped"))
    n = F.coalesce(F.size("dropped"), F.lit(0))
    return joined.withColumn("lines", lines).select(
        "row",
        F.when(F.col("dropped").isNull(), F.col("text"))
        .otherwise(F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n"))
        .alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("dropped").isNull(), F.lit(0)).otherwise(n).cast("long").alias("n_dropped"),
    )
