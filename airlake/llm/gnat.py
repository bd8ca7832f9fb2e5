"""Exact score searches in a multiway hyperplane tree with distance ranges (GNAT).

Integer vectors get one more component that brings all of them to the same length, so an inner product is a distance: for a
query a (whose further component is zero) and a row v, d(a, v)^2 = |a|^2 + M^2 - 2 a.v, with M the common length. A window of
scores is then an annulus around the query.

The tree is fitted on a bounded sample: every node has up to DEGREE split points, far from one another, and a row belongs to
the nearest one (the borders are hyperplanes). All rows are indexed: each goes down to its leaf, and for every pair of siblings (i, j)
the node keeps the least and greatest distance from split point i to the rows below j. A subtree j is passed over when,
for some i, no distance within its range can reach the annulus; leaves that are left are compared in full, so results
are exact whatever the sample was.

The tree and its ranges have a bounded size and are broadcast. Leaves are stored as packed blocks of about BLOCK rows,
queries travel in packs to the blocks of the leaves they may need. No leaf, however full, is one task: its blocks are joined by (leaf, block).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airlake.llm.common import stored

SAMPLE = 8192  # rows the split points are chosen from; every row is indexed
DEGREE = 8
LEAF = 1024  # rows a leaf has on average, up to LEAVES leaves
LEAVES = 4096
BLOCK = 2048
PACK = 256
ANY = 1 << 62


@dataclass
class Node:
    points: np.ndarray
    children: list  # of Node, or of the number of a leaf
    number: int
    low: np.ndarray = field(default=None)  # [i, j]: least distance from split point i to a row below j
    high: np.ndarray = field(default=None)


@dataclass
class Tree:
    root: Node | int
    length2: float  # M^2
    width: int
    nodes: list[Node]

    def lift(self, vectors: np.ndarray) -> np.ndarray:
        gap = np.sqrt(np.maximum(0.0, self.length2 - (vectors * vectors).sum(axis=1)))
        return np.hstack([vectors, gap[:, None]])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d2 = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(0.0, d2))


def matrix(vectors, width: int) -> np.ndarray:
    """Rows as doubles; vectors with fewer components are continued with zeros."""
    out = np.zeros((len(vectors), width))
    for n, v in enumerate(vectors):
        out[n, : len(v)] = v
    return out


def fit(sample: np.ndarray, length2: float, leaves: int, degree: int = DEGREE, seed: int = 7) -> Tree:
    """A tree with about ``leaves`` leaves over distinct sample rows. Split points: of 3 x degree drawn rows, greedily the farthest ones."""
    tree = Tree(0, length2, sample.shape[1], [])
    lifted = tree.lift(sample)
    rng = np.random.default_rng(seed)
    n_leaves = 0

    def leaf() -> int:
        nonlocal n_leaves
        n_leaves += 1
        return n_leaves - 1

    def grow(rows: np.ndarray, want: int):
        m = min(degree, want, len(rows))
        if m < 2:
            return leaf()
        drawn = lifted[rng.choice(rows, min(len(rows), 3 * m), replace=False)]
        chosen, gap = [0], distances(drawn, drawn[:1])[:, 0]
        while len(chosen) < m:
            chosen.append(int(gap.argmax()))
            gap = np.minimum(gap, distances(drawn, drawn[chosen[-1:]])[:, 0])
        node = Node(drawn[chosen], [], len(tree.nodes))
        tree.nodes.append(node)
        nearest = distances(lifted[rows], node.points).argmin(axis=1)
        for j in range(m):
            below = rows[nearest == j]
            node.children.append(grow(below, round(want * len(below) / len(rows))))
        return node

    tree.root = grow(np.arange(len(sample)), leaves)
    return tree


def descend(tree: Tree, vectors: np.ndarray, measured: list | None = None) -> np.ndarray:
    """The leaf of each row; ``measured`` gets (node, child, least, greatest distances to the split points) on the way."""
    lifted, out = tree.lift(vectors), np.zeros(len(vectors), np.int64)

    def go(node, rows: np.ndarray) -> None:
        if isinstance(node, int):
            out[rows] = node
            return
        far = distances(lifted[rows], node.points)
        nearest = far.argmin(axis=1)
        for j, child in enumerate(node.children):
            inside = nearest == j
            if inside.any():
                if measured is not None:
                    measured.append((node.number, j, far[inside].min(axis=0), far[inside].max(axis=0)))
                go(child, rows[inside])

    go(tree.root, np.arange(len(vectors)))
    return out


def reached(tree: Tree, queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, positions of the queries) for all leaves in which a row may have a score within a window [low, high] of a query.

    ``low`` and ``high`` are [query, window]; a window with low > high is none.
    """
    lifted = np.hstack([queries, np.zeros((len(queries), 1))])
    base = (queries * queries).sum(axis=1)[:, None] + tree.length2
    slack = 1e-6 + 1e-9 * np.sqrt(base)
    outer = np.sqrt(np.maximum(0.0, base - 2 * low)) + slack
    inner = np.sqrt(np.maximum(0.0, base - 2 * high)) - slack
    outer = np.where(low > high, -1.0, outer)

    def go(node, rows: np.ndarray):
        if isinstance(node, int):
            yield node, rows
            return
        far = distances(lifted[rows], node.points)
        for j, child in enumerate(node.children):
            lo, hi = node.low[:, j], node.high[:, j]
            nearest = np.maximum(far - hi, lo - far).max(axis=1)
            farthest = (far + hi).min(axis=1)
            may = ((nearest[:, None] <= outer[rows]) & (farthest[:, None] >= inner[rows])).any(axis=1)
            if may.any():
                yield from go(child, rows[may])

    live = np.flatnonzero((outer >= 0).any(axis=1))
    if len(live):
        yield from go(tree.root, live)


@dataclass
class Index:
    tree: Tree
    rows: DataFrame  # cls, leaf, vector, label, ids
    blocks: DataFrame  # leaf, block, vectors, labels, ids
    directory: DataFrame  # leaf, n_blocks


def build(classes: DataFrame) -> Index | None:
    """The index over ``classes`` (cls long, vector array<int>, label long, ids array<long> ascending); None for an empty table."""
    spark = classes.sparkSession
    square = F.aggregate("vector", F.lit(0).cast("double"), lambda s, x: s + x.cast("double") * x)
    n, length2, width = classes.agg(F.count("*"), F.max(square), F.max(F.size("vector"))).first()
    if not n:
        return None
    width = max(1, width)
    drawn = classes.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(SAMPLE).collect()
    sample = np.unique(matrix([r[0] for r in drawn], width), axis=0)
    tree = fit(sample, length2, min(LEAVES, -(-n // LEAF)))
    shared = spark.sparkContext.broadcast(tree)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(leaf=descend(shared.value, matrix(frame["vector"], width)))

    kinds = "cls long, vector array<int>, label long, ids array<long>"
    rows = stored(classes.select("cls", "vector", "label", "ids").mapInPandas(place, f"{kinds}, leaf long"), "gnat-rows")

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        low, high = {}, {}
        for frame in frames:
            seen: list = []
            descend(shared.value, matrix(frame["vector"], width), seen)
            for node, j, least, most in seen:
                low[node, j] = np.minimum(low.get((node, j), np.inf), least)
                high[node, j] = np.maximum(high.get((node, j), -np.inf), most)
        for (node, j), least in low.items():
            yield pd.DataFrame({"node": node, "j": j, "i": range(len(least)), "low": least, "high": high[node, j]})

    ranges = rows.select("vector").mapInPandas(measure, "node int, j int, i int, low double, high double")
    for node in tree.nodes:
        m = len(node.points)
        node.low, node.high = np.full((m, m), np.inf), np.full((m, m), -np.inf)
    # bounded by the tree: at most DEGREE rows for each of its inner and outer nodes
    for r in ranges.groupBy("node", "j", "i").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
        tree.nodes[r["node"]].low[r["i"], r["j"]] = r["low"]
        tree.nodes[r["node"]].high[r["i"], r["j"]] = r["high"]

    sizes = rows.groupBy("leaf").agg(F.count("*").alias("n"))
    directory = stored(sizes.select("leaf", F.ceil(F.col("n") / BLOCK).cast("int").alias("n_blocks")), "gnat-directory")

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.iloc[frame["ids"].str[0].argsort(kind="stable")]
        packed = matrix(frame["vector"], width).astype(np.int32).tobytes()
        ids = [[list(map(int, x)) for x in frame["ids"]]]
        head = {"leaf": [frame["leaf"].iloc[0]], "block": [frame["block"].iloc[0]], "vectors": [packed]}
        return pd.DataFrame({**head, "labels": [frame["label"].tolist()], "ids": ids})

    # a block is a share of a leaf by hash, about BLOCK rows each
    part = F.pmod(F.xxhash64("cls"), F.col("n_blocks")).cast("int").alias("block")
    dealt = rows.join(F.broadcast(directory), "leaf").select("leaf", part, "vector", "label", "ids")
    blocks = dealt.groupBy("leaf", "block").applyInPandas(
        pack, "leaf long, block int, vectors binary, labels array<long>, ids array<array<long>>"
    )
    return Index(tree, rows, stored(blocks, "gnat-blocks"), directory)


def search(index: Index, queries: DataFrame, k: int, same_label: bool, home_only: bool = False) -> DataFrame:
    """(cls, w, score, ids): for each query and window the k best rows with the same, or another, label.

    ``queries``: cls, vector, label, leaf, low and high (arrays of scores, as many windows in each). Best is a higher score, then
    a smaller first id. ``home_only`` looks into the query's own leaf alone, which is enough for a first bound.
    """
    tree, width = index.tree, index.tree.width
    exact = np.float64 if tree.length2 < 2**53 else np.int64
    shared = queries.sparkSession.sparkContext.broadcast(tree)

    def windows(column: pd.Series) -> list:
        most = max(map(len, column), default=1)
        return [list(map(int, x)) + [None] * (most - len(x)) for x in column]

    def visits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), PACK):
                part = frame.iloc[at : at + PACK]
                vectors = matrix(part["vector"], width)
                if home_only:
                    homes = part["leaf"].to_numpy()
                    goals = [(int(x), np.flatnonzero(homes == x)) for x in np.unique(homes)]
                else:
                    low, high = (np.array(windows(part[c]), dtype=object) for c in ("low", "high"))
                    low[low == None], high[high == None] = 1, 0  # noqa: E711
                    goals = reached(shared.value, vectors, low.astype(float), high.astype(float))
                ints = vectors.astype(np.int32)
                out = []
                for leaf, rows in goals:
                    pick = part.iloc[rows]
                    out.append((leaf, pick["cls"].tolist(), ints[rows].tobytes(), pick["label"].tolist(),
                                [list(map(int, x)) for x in pick["low"]], [list(map(int, x)) for x in pick["high"]]))
                yield pd.DataFrame(out, columns=["leaf", "cls", "asked", "asked_labels", "low", "high"])

    packs = queries.select("cls", "vector", "label", "leaf", "low", "high").mapInPandas(
        visits,
        "leaf long, cls array<long>, asked binary, asked_labels array<long>, low array<array<long>>, high array<array<long>>",
    )
    addressed = packs.join(F.broadcast(index.directory), "leaf").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))
    )
    met = addressed.join(index.blocks, ["leaf", "block"]).drop("leaf", "block", "n_blocks")

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples():
                rows = np.frombuffer(r.vectors, np.int32).reshape(-1, width).astype(exact)
                asked = np.frombuffer(r.asked, np.int32).reshape(-1, width).astype(exact)
                scores = (asked @ rows.T).astype(np.int64)
                n = len(rows)
                fits = (np.asarray(r.asked_labels)[:, None] == np.asarray(r.labels)[None, :]) == same_label
                # rows lie in order of their first ids
                order = scores * n + (n - 1 - np.arange(n)) if exact is np.float64 else None
                found = []
                for q in range(len(asked)):
                    for w, (low, high) in enumerate(zip(r.low[q], r.high[q], strict=True)):
                        at = np.flatnonzero(fits[q] & (scores[q] >= low) & (scores[q] <= high))
                        if len(at) > k and order is not None:
                            at = at[np.argpartition(order[q, at], len(at) - k)[len(at) - k :]]
                        elif len(at) > k:
                            at = at[np.lexsort((at, -scores[q, at]))[:k]]
                        found += [(r.cls[q], w, scores[q, x], r.ids[x]) for x in at]
                yield pd.DataFrame(found, columns=["cls", "w", "score", "ids"])

    found = met.mapInPandas(compare, "cls long, w int, score long, ids array<long>")
    best = Window.partitionBy("cls", "w").orderBy(F.col("score").desc(), F.get("ids", F.lit(0)))
    ranked = found.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k).drop("_n")
    return stored(ranked, "gnat-found")


def top_k(index: Index, queries: DataFrame, k: int, same_label: bool) -> DataFrame:
    """As :func:`search`, over all leaves, after the query's own leaf has raised the lower ends of the windows."""
    first = search(index, queries, k, same_label, home_only=True)
    full = first.groupBy("cls", "w").agg(F.count("*").alias("n"), F.min("score").alias("bound")).where(F.col("n") == k)
    bounds = full.groupBy("cls").agg(F.map_from_entries(F.collect_list(F.struct("w", "bound"))).alias("bounds"))
    raised = F.transform("low", lambda x, w: F.greatest(x, F.coalesce(F.col("bounds")[w], x)))
    narrowed = queries.join(bounds, "cls", "left").withColumn("low", raised).drop("bounds")
    return search(index, stored(narrowed, "gnat-queries"), k, same_label)


def empty_result(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "cls long, w int, score long, ids array<long>")
