"""SimHash near-duplicates, found with Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits, each read as a 23-bit word. The binary Golay code is
perfect: every 23-bit word lies within three bits of exactly one codeword, named by its 12 message bits. The keys of
a segment are the codewords nearest to it and to its one-bit neighbours (one, or six for most words). Two
segments that differ in at most two bits have a common one-bit neighbour, hence a common codeword.

Of two errors in three segments, at least one segment has none. So fingerprints within two bits agree exactly in some segment i
and share a codeword of segment i + 1: the join key is (i, segment i, codeword of segment i + 1), and no link is lost.
Joined candidates are verified on all bits.

Equal fingerprints meet first. A key that more than CROWD different fingerprints share is not expanded
into pairs: its fingerprints are linked through the words one bit away from each (two fingerprints within two bits have
one in common), which is exact too and emits a fixed number of rows for each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlake.llm.common import packed_row, stored
from airlake.llm.components import connected_components

SHINGLE = 3
BITS = 2
CROWD = 8
WIDTHS, STARTS = (22, 21, 21), (0, 22, 43)
GENERATOR = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit b is set when it is set in over half of the XXH64 hashes (seed 42) of all word shingles; no words: 0."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    if len(words) < shingle:
        runs = [b" ".join(words)]
    else:
        runs = map(b" ".join, zip(*[words[i:] for i in range(shingle)], strict=False))
    hashes = np.fromiter((xxh64_intdigest(x, 42) for x in runs), np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.int64)[0])


def _remainder(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the low 12 and the high 11 bits, and the error of weight three or less for each remainder."""
    low = np.array([_remainder(x) for x in range(1 << 12)], np.int32)
    high = np.array([_remainder(x << 12) for x in range(1 << 11)], np.int32)
    errors = np.zeros(1 << 11, np.int32)
    bits = [0] + [1 << b for b in range(23)]
    for a in bits:
        for b in bits:
            for c in bits:
                e = a ^ b ^ c
                errors[low[e & 0xFFF] ^ high[e >> 12]] = e
    return low, high, errors


def codewords(segments: np.ndarray, width: int, tables) -> np.ndarray:
    """For each segment the codeword indices of itself and of its one-bit neighbours; repeats are -1."""
    low, high, errors = tables
    near = np.concatenate([[0], 1 << np.arange(width)]).astype(np.int32)
    words = segments.astype(np.int32)[:, None] ^ near
    index = (words ^ errors[low[words & 0xFFF] ^ high[words >> 12]]) >> 11
    index.sort(axis=1)
    index[:, 1:][index[:, 1:] == index[:, :-1]] = -1
    return index


def key_rows(fingerprints: np.ndarray, tables) -> tuple[np.ndarray, np.ndarray]:
    """(position in the input, key) for every key of every fingerprint."""
    words = fingerprints.view(np.uint64)
    parts = [
        (words >> np.uint64(s)).astype(np.int64) & ((1 << w) - 1) for s, w in zip(STARTS, WIDTHS, strict=True)
    ]
    rows, keys = [], []
    for i in range(3):
        j = (i + 1) % 3
        near = codewords(parts[j], WIDTHS[j], tables)
        row, col = np.nonzero(near >= 0)
        rows.append(row)
        keys.append((i << 34) | (parts[i][row] << 12) | near[row, col])
    return np.concatenate(rows), np.concatenate(keys)


def with_fingerprint(docs: DataFrame, carry: list[str]) -> DataFrame:
    """``row`` (the columns to carry), ``uid`` (unique) and ``fingerprint`` (signed 64 bits), stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [fingerprint(t.as_py()) for t in batch.column("text")]
            columns = [batch.column(n) for n in batch.schema.names if n != "text"]
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(got, pa.int64())], [*names, "fingerprint"])

    packed = docs.select(*packed_row(docs.select(*carry)), "text")
    kind = packed.select("row").schema["row"].dataType.simpleString()
    # the number is given out before Python and stored with the row, so it stays the same for all later readers
    numbered = packed.withColumn("uid", F.monotonically_increasing_id())
    return stored(numbered.mapInArrow(run, f"row {kind}, uid bigint, fingerprint bigint"), "fingerprints")


def links(fingerprints: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(src, dst) pairs that connect all distinct fingerprints (column ``fingerprint``) within two bits."""

    def keys(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = _tables()
        for frame in frames:
            values = frame["fingerprint"].to_numpy(np.int64)
            row, key = key_rows(values, tables)
            yield pd.DataFrame({"key": key, "fingerprint": values[row]})

    keyed = stored(fingerprints.mapInPandas(keys, "key bigint, fingerprint bigint"), "golay-keys")
    near = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= BITS
    buckets = (
        keyed.groupBy("key")
        .agg(F.count("*").alias("n"), F.min("fingerprint").alias("src"), F.max("fingerprint").alias("dst"))
        .where("n > 1")
    )
    buckets = stored(buckets, "golay-buckets")
    couples = buckets.where("n = 2").where(near("src", "dst")).select("src", "dst")
    members = keyed.join(buckets.where("n > 2").select("key", "n"), "key")
    few = members.where(F.col("n") <= crowd)
    pairs = (
        few.select("key", F.col("fingerprint").alias("src"))
        .join(few.select("key", F.col("fingerprint").alias("dst")), "key")
        .where("src < dst")
        .where(near("src", "dst"))
        .select("src", "dst")
    )
    crowded = members.where(F.col("n") > crowd).select("fingerprint").distinct()
    flips = F.array(*[F.lit(0), *[F.lit(1 << b if b < 63 else -(1 << 63)) for b in range(64)]])
    around = crowded.select(
        "fingerprint", F.explode(F.transform(flips, lambda f: F.col("fingerprint").bitwiseXOR(f))).alias("middle")
    )
    # at most 65 fingerprints lie around one word
    met = around.groupBy("middle").agg(F.sort_array(F.collect_list("fingerprint")).alias("met")).where("size(met) > 1")
    stars = met.select(
        F.get("met", F.lit(0)).alias("src"), F.explode(F.slice("met", 2, 65)).alias("dst")
    )
    return couples.unionByName(pairs).unionByName(stars)


def near_duplicates(docs: DataFrame, carry: list[str] | None = None, crowd: int = CROWD) -> DataFrame:
    """``row`` (the carried columns, all by default), fingerprint, component_id, is_first: one row per input row.

    ``component_id`` is the smallest doc_id reachable over links of at most two differing bits; ``is_first`` marks
    one row of each component, the one of the smallest doc_id (of equal ids, any one). Null and wordless texts have fingerprint
    zero and link like others. Null doc_ids come last; a component of nulls only has a null id. Repeated rows
    are members of one component. An empty table has an empty result; input columns cannot clash with working ones.
    """
    marked = with_fingerprint(docs, carry or docs.columns)
    doc_id = F.col("row")["doc_id"]
    order = F.struct(doc_id.isNull().alias("no_id"), doc_id.alias("doc_id"), F.col("uid").alias("uid"))
    distinct = stored(marked.groupBy("fingerprint").agg(F.min(order).alias("first")), "distinct-fingerprints")
    parts = connected_components(links(distinct.select("fingerprint"), crowd))
    roots = distinct.join(parts.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn(
        "component", F.coalesce("component", "fingerprint")
    )
    firsts = roots.groupBy("component").agg(F.min("first").alias("lead"))
    of = roots.select("fingerprint", "component").join(firsts, "component").select("fingerprint", "lead")
    return marked.join(of, "fingerprint").select(
        "row", "fingerprint", F.col("lead.doc_id").alias("component_id"), (F.col("uid") == F.col("lead.uid")).alias("is_first")
    )


def hex_of(fingerprint_column: str):
    return F.lower(F.lpad(F.hex(fingerprint_column), 16, "0"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, with its own columns."""
    return near_duplicates(docs).where("is_first").select("row.*")
