"""Links among the sets of a crowd, the many that share one MinHash band key, by exact Jaccard similarity.

A crowd is dealt into blocks of bounded size. The members of a block, or of two blocks, are compared with each other in one task:
counts of shared shingles are products of 0/1 matrices for the shingles that many sets hold, and sums over pairs for the others.
So no pair is a row: what is moved are the members, once for each block they meet.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 1024  # members
CHARS = 1 << 19  # of their texts together
COLUMNS = 1024  # of a matrix at once
PAIRS = 1 << 20  # of members at once
OFTEN = 16  # a shingle in more than one set of so many is a column of a matrix

#: The hashes of the shingles of some texts, one text after the other, and how many each has (one at least).
Sets = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]


def near(hashes: np.ndarray, counts: np.ndarray, cut: int = 0) -> np.ndarray:
    """Whether each set before ``cut`` and each from ``cut`` on (0: all and all) have a Jaccard similarity of 0.8 or more."""
    m = len(counts)
    column = np.unique(hashes, return_inverse=True)[1]
    cells = np.sort(column * m + np.repeat(np.arange(m), counts))
    # each set holds a shingle once
    column, own = np.divmod(cells[np.concatenate([[True], cells[1:] != cells[:-1]])], m)
    sizes = np.bincount(own, minlength=m)
    times = np.bincount(column)
    rows, cols = (cut, m - cut) if cut else (m, m)
    shared = np.zeros((rows, cols), np.float32)  # whole numbers below 2^24
    held = times[column]
    often = held > max(1, m // OFTEN)
    place, wide = np.unique(column[often], return_inverse=True)[1], own[often]
    for at in range(0, place[-1] + 1 if len(place) else 0, COLUMNS):
        a, b = np.searchsorted(place, (at, at + COLUMNS))
        matrix = np.zeros((COLUMNS, m), np.float32)
        matrix[place[a:b] - at, wide[a:b]] = 1
        shared += matrix[:, : cut or m].T @ matrix[:, cut:]
    found, n = [], 0

    def added() -> None:
        nonlocal n
        shared.ravel()[:] += np.bincount(np.concatenate(found), minlength=shared.size)
        found.clear()
        n = 0

    for k in np.unique(held[~often & (held > 1)]):
        # k sets in a row hold one shingle, in order
        sets = own[held == k].reshape(-1, k)
        for part in np.array_split(sets, -(-sets.size // PAIRS)):
            for step in range(1, k):
                one, other = part[:, :-step].ravel(), part[:, step:].ravel()
                if cut:
                    across = (one < cut) & (other >= cut)
                    one, other = one[across], other[across]
                found.append(one * cols + other - cut)
                if not cut:
                    found.append(other * cols + one)
                n += len(found[-1])
                if n > PAIRS:
                    added()
    if found:
        added()
    total = sizes[: cut or m, None] + sizes[None, cut:]
    return 9 * shared.astype(np.int64) >= 4 * total


def forest(links: np.ndarray) -> list[tuple[int, int]]:
    """Pairs that connect what a symmetric table of links connects, one less than the members of each component."""
    todo, pairs = np.ones(len(links), bool), []
    for start in range(len(links)):
        if not todo[start]:
            continue
        todo[start], waiting = False, [start]
        while waiting:
            at = waiting.pop()
            new = np.flatnonzero(links[at] & todo)
            todo[new] = False
            pairs += [(at, int(x)) for x in new]
            waiting += new.tolist()
    return pairs


def linked(rows: DataFrame, texts: DataFrame, sets: Sets) -> DataFrame:
    """src, dst: similar pairs that connect the members (id, component) of each (key, row, col).

    With row and col equal all members are compared, else those of block row with those of block col and another component.
    """

    def compare(group: pa.Table) -> pa.Table:
        row, col = group["row"][0].as_py(), group["col"][0].as_py()
        ids, block, component = (group[c].to_numpy() for c in ("id", "block", "component"))
        order = np.lexsort((ids, block))
        cut = int((block == row).sum()) if row != col else 0
        links: list[tuple[int, int]] = []
        if row == col or 0 < cut < len(ids):
            alike = near(*sets(group["norm"].take(pa.array(order)).to_pylist()), cut)
            if row == col:
                links = forest(alike)
            else:
                a, b = np.nonzero(alike)
                ends = component[order[a]], component[order[b + cut]]
                a, b = (x[ends[0] != ends[1]] for x in (a, b))
                # one link joins two components
                both = np.stack([component[order[a]], component[order[b + cut]]], axis=1)
                one = np.unique(both, axis=0, return_index=True)[1]
                links = list(zip(a[one].tolist(), (b[one] + cut).tolist(), strict=True))
        ends = [ids[order[[x[k] for x in links]]] if links else np.zeros(0, np.int64) for k in (0, 1)]
        return pa.table({"src": pa.array(ends[0], pa.int64()), "dst": pa.array(ends[1], pa.int64())})

    members = rows.join(texts, "id").select("key", "row", "col", "block", "id", "component", "norm")
    return members.groupBy("key", "row", "col").applyInArrow(compare, "src bigint, dst bigint")


def in_blocks(crowd: DataFrame, texts: DataFrame) -> DataFrame:
    """The members (key, id) of crowds with the block of each and the blocks of its crowd."""
    sizes = crowd.join(texts.select("id", F.char_length("norm").alias("chars")), "id")
    sizes = sizes.groupBy("key").agg(F.greatest(F.count("*") / BLOCK, F.sum("chars") / CHARS).alias("share"))
    blocks = sizes.select("key", F.greatest(F.ceil("share"), F.lit(1)).cast("bigint").alias("blocks"))
    return crowd.select("key", "id").join(blocks, "key").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))


def within(placed: DataFrame, texts: DataFrame, sets: Sets, leaders: int) -> DataFrame:
    """Links in each block; some leaders of a crowd of several blocks are members of all of them."""
    own = placed.select("key", F.col("block").alias("row"), "id")
    heads = placed.where("blocks > 1").groupBy("key", "blocks")
    heads = heads.agg(F.array(*[F.min_by("id", F.xxhash64("id", F.lit(k))) for k in range(leaders)]).alias("ids"))
    heads = heads.select("key", F.explode("ids").alias("id"), F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1).alias("rows"))
    rows = own.unionByName(heads.select("key", F.explode("rows").alias("row"), "id")).distinct()
    same = {"col": F.col("row"), "block": F.col("row"), "component": F.col("id")}
    return linked(rows.withColumns(same), texts, sets)


def across(placed: DataFrame, texts: DataFrame, sets: Sets) -> DataFrame:
    """Links between the blocks of a crowd, of members (with their component) that no link connects yet."""
    others = F.filter(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1), lambda x: x != F.col("block"))
    rows = placed.select("key", "id", "component", "block", F.explode(others).alias("other"))
    met = {"row": F.least("block", "other"), "col": F.greatest("block", "other")}
    return linked(rows.withColumns(met).drop("other"), texts, sets)
