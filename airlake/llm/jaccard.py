"""Pairs of sets with a Jaccard similarity of 0.8 or more, among sets that share a MinHash band key (``line_hashes.py``).

Sets that share a key are candidates; all are verified by exact Jaccard similarity. A key of more than CROWD sets is compared in
blocks (``crowds.py``): the members of each block with each other and with LEADERS of the crowd. Where a crowd of several blocks
still holds different components, its blocks are all compared with each other, so that none is left out; members already connected
need no more links.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlake.llm.common import stored
from airlake.llm.components import connected_components
from airlake.llm.crowds import Sets, across, in_blocks, within

SIMILARITY = 0.8
CROWD = 32
LEADERS = 3


def by_shingles(shingles: Callable[[Column], Column]) -> Callable[[DataFrame], DataFrame]:
    """A check of pairs (src, dst and the texts a, b): those whose sets of shingles have a similarity of at least SIMILARITY."""

    def check(pairs: DataFrame) -> DataFrame:
        sets = pairs.select("src", "dst", shingles(F.col("a")).alias("a"), shingles(F.col("b")).alias("b"))
        shared = F.size(F.array_intersect("a", "b"))
        return sets.where(10 * shared >= int(10 * SIMILARITY) * (F.size("a") + F.size("b") - shared)).select("src", "dst")

    return check


def verified(pairs: DataFrame, texts: DataFrame, check: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The pairs of texts (id, norm) that pass the exact check."""
    both = pairs.join(texts.select(F.col("id").alias("src"), F.col("norm").alias("a")), "src").join(
        texts.select(F.col("id").alias("dst"), F.col("norm").alias("b")), "dst"
    )
    return check(both)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).where("src <> dst").distinct()


def _labelled(crowd: DataFrame, links: DataFrame) -> DataFrame:
    """Members (key, id, ...) of the crowds that hold more than one component, with their component."""
    parts = connected_components(links)
    known = crowd.join(parts.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    torn = known.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b")
    return known.join(torn.select("key"), "key", "left_semi")


def similar_links(
    keyed: DataFrame, texts_of: Callable[[DataFrame], DataFrame], check: Callable[[DataFrame], DataFrame], sets: Sets, name: str
) -> DataFrame:
    """Verified pairs (src, dst) that connect all similar sets.

    ``keyed``: id and keys (an array), or rows of id and key; ``texts_of`` gives the texts (id, norm) of a table of ids;
    ``check`` keeps the similar ones of pairs (src, dst, a, b); ``sets`` are the shingles of texts, for blocks of crowds.
    """
    if "keys" in keyed.columns:
        keyed = keyed.select("id", F.explode("keys").alias("key"))
    shared = stored(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), f"{name}-shared")
    members = stored(keyed.join(shared, "key"), f"{name}-members")
    texts = stored(texts_of(members.select("id").distinct()), f"{name}-texts")
    few, crowd = members.where(F.col("n") <= CROWD), members.where(F.col("n") > CROWD)
    pairs = few.select("key", F.col("id").alias("a")).join(few.select("key", F.col("id").alias("b")), "key").where("a < b")
    links = stored(verified(_ordered(pairs.select("a", "b")), texts, check), f"{name}-links")
    if crowd.isEmpty():
        return links
    placed = stored(in_blocks(crowd, texts), f"{name}-crowd")
    links = links.unionByName(stored(within(placed, texts, sets, LEADERS), f"{name}-links-within"))
    large = placed.where("blocks > 1")
    if large.isEmpty():
        return links
    torn = stored(_labelled(large, links), f"{name}-torn")
    if torn.isEmpty():
        return links
    return links.unionByName(stored(across(torn, texts, sets), f"{name}-links-across"))
