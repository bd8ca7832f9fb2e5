"""Hard negatives: for each anchor and each of its nearest rows of the same label, the best rows of other labels
whose score lies in a window below the positive's. Searched exactly with the tree of :mod:`airlake.llm.gnat`.

Rows with equal vector and label are one class: its smallest ids stand for it, as no more of them can be among the first
few, so a vector that a third of all rows share costs one search and one place in the index.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlake.llm import gnat
from airlake.llm.common import stored

CUT = 1 << 26


@dataclass(frozen=True)
class Mining:
    positives: int = 5
    negatives: int = 3
    least: int = 50  # percent of the positive's score
    most: int = 95
    scale: int = 256


def usable(df: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """vec_id, label, vector of the rows that take part: nothing null, every component finite.

    Components become floor(scale * x), cut off at +-2^26. Rows are told apart by vec_id, so one without takes no part, and of
    several rows with one id that of the smallest label and vector stands.
    """
    x = F.col("embedding").cast("array<double>")
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    whole = F.transform(x, lambda c: F.floor(F.greatest(F.least(c * mining.scale, F.lit(float(CUT))), F.lit(float(-CUT)))).cast("int"))
    known = df.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(F.forall(x, finite))
    one = known.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(
        F.min(F.struct(F.col("label").cast("long").alias("label"), whole.alias("vector"))).alias("r")
    )
    return one.select("vec_id", "r.label", "r.vector")


def mine(rows: DataFrame, is_anchor: Column, mining: Mining = Mining()) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows``: vec_id, label, vector (array of ints) as from :func:`usable`. An anchor's positives are its best other rows of the same label;
    its negatives those of other labels with least * positive_score <= 100 * negative_score <= most * positive_score. Higher
    scores first, ties by smaller vec_id. Anchors without positives, and positives without negatives, have no rows. An empty
    table has none.
    """
    rows = stored(rows, "mining-rows")
    keep = mining.positives + 1  # one of them may be the anchor itself
    first = Window.partitionBy("vector", "label").orderBy("vec_id")
    few = rows.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= keep)
    classes = few.groupBy("vector", "label").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    classes = stored(classes.withColumn("cls", F.get("ids", F.lit(0))), "mining-classes")
    index = gnat.build(classes)
    if index is None:
        return rows.sparkSession.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        )

    anchors = rows.where(is_anchor).join(classes.select("vector", "label", "cls"), ["vector", "label"])
    anchors = stored(anchors.select(F.col("vec_id").alias("anchor_id"), "cls"), "mining-anchors")
    asked = index.rows.join(anchors.select("cls").distinct(), "cls", "left_semi").select("cls", "vector", "label", "leaf")
    everything = F.array(F.lit(-gnat.ANY)).alias("low"), F.array(F.lit(gnat.ANY)).alias("high")
    like = gnat.top_k(index, stored(asked.select("*", *everything), "mining-asked"), keep, same_label=True)

    single = like.select("cls", "score", F.explode("ids").alias("id"))
    best = Window.partitionBy("cls").orderBy(F.col("score").desc(), "id")
    single = single.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= keep)
    lists = single.groupBy("cls").agg(F.sort_array(F.collect_list(F.struct("_n", "id", "score"))).alias("list"))
    others = F.slice(F.filter("list", lambda x: x["id"] != F.col("anchor_id")), 1, mining.positives)
    positives = anchors.join(lists, "cls").select("anchor_id", "cls", F.inline(others))
    positives = stored(
        positives.select("anchor_id", "cls", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "mining-positives"
    )

    low = F.ceil(F.col("positive_score") * mining.least / 100).cast("long")
    high = F.floor(F.col("positive_score") * mining.most / 100).cast("long")
    # the exact test of integers decides where division rounds
    low = F.when(100 * (low - 1) >= mining.least * F.col("positive_score"), low - 1).otherwise(low)
    high = F.when(100 * (high + 1) <= mining.most * F.col("positive_score"), high + 1).otherwise(high)
    wanted = positives.select("cls", "positive_score").distinct().select(
        "cls", "positive_score", low.alias("low"), high.alias("high")
    ).where("low <= high")
    windows = wanted.groupBy("cls").agg(F.sort_array(F.collect_list(F.struct("positive_score", "low", "high"))).alias("windows"))
    windows = stored(windows, "mining-windows")
    inside = asked.join(windows, "cls").select("cls", "vector", "label", "leaf", "windows.low", "windows.high")
    unlike = gnat.top_k(index, stored(inside, "mining-inside"), mining.negatives, same_label=False)

    single = unlike.select("cls", "w", "score", F.explode("ids").alias("id"))
    best = Window.partitionBy("cls", "w").orderBy(F.col("score").desc(), "id")
    single = single.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= mining.negatives)
    scores = windows.select("cls", F.posexplode("windows").alias("w", "of")).select("cls", "w", "of.positive_score")
    negatives = single.join(scores, ["cls", "w"])
    return positives.join(negatives, ["cls", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
