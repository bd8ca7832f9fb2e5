"""Near-equal documents: exact Jaccard similarity of their sets of five-word shingles, 0.8 or more.

Words are parted by white space, in lower case; a document of fewer words is one shingle. Equal word sequences meet
first by a 128-bit hash; the others by MinHash: a signature over all shingles, cut into bands (``line_hashes.py``). A pair at 0.8
shares a band with probability 0.9993, and every candidate is verified. The links of op6's fingerprints (``simhash.py``) may be
added; components then run over links of both kinds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlake.llm import simhash
from airlake.llm.common import packed_row, spaced, stored
from airlake.llm.components import connected_components
from airlake.llm.jaccard import by_shingles, similar_links
from airlake.llm.line_hashes import with_set_keys, word_shingle_hashes

SHINGLE = 5


def shingles_of(norm: Column) -> Column:
    """The different hashes of all word shingles of a spaced text."""

    def hashes(words: Column) -> Column:
        n = F.size(words)
        run = lambda i: F.xxhash64(F.slice(words, i + 1, SHINGLE))
        return F.transform(F.sequence(F.lit(0), F.greatest(n - SHINGLE, F.lit(0))), run)

    return F.array_distinct(F.get(F.transform(F.array(F.split(norm, " ")), hashes), F.lit(0)))


def _normal(text: Column) -> Column:
    return F.lower(spaced(text))


def _fingerprint_links(marked: DataFrame, distinct: DataFrame) -> DataFrame:
    """src, dst (ids of texts): each row's text and that of the first row of its component of fingerprints within two bits."""
    # numbers of rows stand for doc_ids, which may repeat or be null
    rows = marked.select(F.col("uid").alias("doc_id"), F.col("row.text").alias("text"))
    found = simhash.near_duplicates(rows, carry=["doc_id"]).select(F.col("row.doc_id").alias("b"), F.col("component_id").alias("a"))
    text = marked.select("uid", "h1", "h2").join(distinct.select("h1", "h2", "id"), ["h1", "h2"])
    ends = [text.select(F.col("uid").alias(end), F.col("id").alias(to)) for end, to in (("a", "src"), ("b", "dst"))]
    return found.where("a <> b").join(ends[0], "a").join(ends[1], "b").select("src", "dst")


def near_duplicates(docs: DataFrame, fingerprints: bool = False) -> DataFrame:
    """``row`` (all columns), component_id, is_first: one row per input row.

    ``component_id`` is the smallest doc_id reachable over links of similarity 0.8 or more, and with ``fingerprints`` also over links
    of op6's fingerprints; ``is_first`` marks one row of each component, the one of the smallest doc_id (of equal ids, any one). Null and wordless texts are equal to each other.
    Null doc_ids come last; a component of nulls only has a null id. An empty table has an empty result.
    """
    norm = _normal(F.col("text"))
    named = docs.select(*packed_row(docs, "text")).withColumn("uid", F.monotonically_increasing_id())
    hashes = {"h1": F.xxhash64(norm), "h2": F.xxhash64(norm, F.lit(1))}
    marked = stored(named.withColumns(hashes).drop("text"), "near-marked")
    order = F.struct(F.col("row.doc_id").isNull().alias("no_id"), F.col("row.doc_id").alias("doc_id"), "uid")
    keyed = marked.select("h1", "h2", order.alias("place"), shingles_of(_normal(F.col("row.text"))).alias("shingles"))
    distinct = with_set_keys(keyed, "shingles").groupBy("h1", "h2").agg(F.min("place").alias("first"), F.first("keys").alias("keys"))
    # one of the rows with the text of each group stands for it
    distinct = stored(distinct.select("h1", "h2", "first", F.col("first.uid").alias("id"), "keys"), "near-distinct")

    def texts(ids: DataFrame) -> DataFrame:
        rows = marked.select(F.col("uid"), _normal(F.col("row.text")).alias("norm"))
        return rows.join(ids.withColumnRenamed("id", "uid"), "uid").select(F.col("uid").alias("id"), "norm")

    sets = lambda norms: word_shingle_hashes(norms, SHINGLE)
    links = similar_links(distinct.select("id", "keys"), texts, by_shingles(shingles_of), sets, "near")
    if fingerprints:
        links = links.unionByName(_fingerprint_links(marked, distinct))
    parts = connected_components(links)
    roots = distinct.drop("keys").join(parts.withColumnRenamed("node", "id"), "id", "left")
    roots = roots.withColumn("component", F.coalesce("component", "id"))
    leads = roots.groupBy("component").agg(F.min("first").alias("lead"))
    of = roots.select("h1", "h2", "component").join(leads, "component").select("h1", "h2", "lead")
    return marked.join(of, ["h1", "h2"]).select(
        "row", F.col("lead.doc_id").alias("component_id"), (F.col("uid") == F.col("lead.uid")).alias("is_first")
    )


def keep_one(docs: DataFrame, fingerprints: bool = False) -> DataFrame:
    """One document of each component, with its own columns."""
    return near_duplicates(docs, fingerprints).where("is_first").select("row.*")
