"""Values met with a table of bands [low, high], either end open: a range join as an equality join on cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlake.session import stored

CELLS_PER_BAND = 64  # on average, at most
CELLS_OF_ONE = 65_536
WIDTHS = [2.0**e for e in range(-30, 63)]


def join_bands(df: DataFrame, value: Column, bands: DataFrame, low: str, high: str, how: str = "left") -> DataFrame:
    """``df`` with the columns of every band that holds ``value`` (ends included; a null end is open).

    The axis is cut into cells of one width, the smallest power of two for which the table stays within 64 cells a band;
    beyond the outermost finite ends lies one cell each. Bands are spread over their cells and
    values join on theirs, so narrow bands are compared with few values however many there are; which plan carries the join
    is left to Spark. Bands may overlap (a row for each). With ``how="left"`` a value in no band, a null and a NaN have null
    columns. Bands with low > high hold nothing. Column names of both sides must differ.
    """
    lo, hi = F.col(low).cast("double"), F.col(high).cast("double")
    usable = bands.where(F.coalesce(F.col(low) <= F.col(high), F.lit(True)))
    ends = [F.min(F.least(lo, hi)).alias("first"), F.max(F.greatest(lo, hi)).alias("last"), F.count(F.lit(1)).alias("n")]
    extent = usable.agg(*ends).first()
    first, last = extent["first"] or 0.0, extent["last"] or 0.0
    span = lambda w: F.floor(F.coalesce(hi, F.lit(last)) / w) - F.floor(F.coalesce(lo, F.lit(first)) / w) + 2
    sums = [F.sum(span(w).cast("double")).alias(f"s{n}") for n, w in enumerate(WIDTHS)]
    most = [F.max(span(w).cast("double")).alias(f"m{n}") for n, w in enumerate(WIDTHS)]
    # one row: the number of cells at each width
    size = usable.agg(*sums, *most).first()
    width = next(
        (w for n, w in enumerate(WIDTHS)
         if extent["n"] and size[f"s{n}"] <= CELLS_PER_BAND * extent["n"] and size[f"m{n}"] <= CELLS_OF_ONE
         and max(abs(first), abs(last)) / w < 2.0**52),
        WIDTHS[-1],
    )
    bottom, top = int(first // width) - 1, int(last // width) + 1
    limited = lambda c: F.greatest(F.least(c / width, F.lit(float(top))), F.lit(float(bottom)))
    cell = lambda c: F.floor(limited(c)).cast("long")
    start = F.when(lo.isNull(), F.lit(bottom)).otherwise(cell(lo))
    stop = F.when(hi.isNull(), F.lit(top)).otherwise(cell(hi))
    keyed = usable.select("*", F.explode(F.sequence(start.cast("long"), stop.cast("long"))).alias("_cell"))
    number = F.when(~F.isnan(value.cast("double")), value)
    asked = df.withColumn("_value", number).withColumn("_at", cell(F.col("_value").cast("double")))
    holds = (F.col("_at") == F.col("_cell")) & F.coalesce(F.col("_value") >= F.col(low), F.col(low).isNull())
    holds = holds & F.coalesce(F.col("_value") <= F.col(high), F.col(high).isNull())
    return asked.join(keyed, holds, how).drop("_value", "_at", "_cell")


def band_totals(df: DataFrame, value: Column, bands: DataFrame, low: str, high: str, totals: dict[str, tuple[Column, str]]) -> DataFrame:
    """``df`` with totals over the bands that hold ``value`` (null where none does), without a row for each such band.

    ``totals`` names aggregates of the bands, each with the function (``sum``, ``min``, ``max``) that merges two of them. The
    different values are ranked, so that a band is a run of ranks, and a run falls into at most two aligned blocks of
    each power of two. Blocks are totalled once; a value has one block of each size. The work grows with the rows of both sides
    times the logarithm of the different values, however many bands hold a value. Ends are as in :func:`join_bands`; as in SQL
    NaN lies above all numbers, and a null is held by bands open at both ends.
    """
    asked = df.withColumn("_value", value)
    usable = bands.where(F.coalesce(F.col(low) <= F.col(high), F.lit(True)))
    alike = usable.groupBy(F.col(low).alias("_lo"), F.col(high).alias("_hi")).agg(*[c.alias(n) for n, (c, _) in totals.items()])
    alike = stored(alike, "bands-alike")
    # at one place a low end comes before the value, a high end after it
    place = lambda rows, c, kind: rows.select(F.col(c).alias("_at"), F.lit(kind).alias("_kind")).where("_at IS NOT NULL").distinct()
    places = place(alike, "_lo", 0).unionByName(place(asked, "_value", 1)).unionByName(place(alike, "_hi", 2))
    parted = stored(places.repartitionByRange("_at").withColumn("_part", F.spark_partition_id()), "band-places")
    is_value = (F.col("_kind") == 1).cast("long")
    parts = parted.groupBy("_part").agg(F.sum(is_value).alias("_n"))
    # one row a partition
    before = F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")
    inside = F.sum(is_value).over(Window.partitionBy("_part").orderBy("_at", "_kind")) - is_value
    ranked = parted.withColumn("_inside", inside).join(parts.select("_part", before.alias("_before")), "_part")
    # how many values lie before a place
    ranked = stored(ranked.select("_at", "_kind", (F.col("_inside") + F.col("_before")).alias("_rank")), "band-ranks")
    n = ranked.where("_kind = 1").count()
    levels = F.sequence(F.lit(0), F.lit(n.bit_length()))
    side = lambda kind, at, name: ranked.where(F.col("_kind") == kind).select(F.col("_at").alias(at), F.col("_rank").alias(name))
    runs = alike.join(side(0, "_lo", "_a"), "_lo", "left").join(side(2, "_hi", "_z"), "_hi", "left")
    merged = [getattr(F, how)(name).alias(name) for name, (_, how) in totals.items()]
    runs = runs.groupBy(F.coalesce("_a", F.lit(0)).alias("_a"), F.coalesce("_z", F.lit(n)).alias("_z")).agg(*merged).where("_a < _z")
    # blocks of the run [a, z) that are not part of a larger one
    width = lambda level: F.call_function("shiftleft", F.lit(1).cast("long"), level)
    level = F.col("_level")
    first, end = F.ceil(F.col("_a") / width(level)), F.floor(F.col("_z") / width(level))
    ends = runs.withColumn("_level", F.explode(levels)).withColumns({"_first": first, "_end": end}).where("_first < _end")
    left = F.when(F.col("_first") % 2 == 1, F.col("_first"))
    right = F.when(F.col("_end") % 2 == 1, F.col("_end") - 1)
    blocks = ends.withColumn("_block", F.explode(F.array(left, right))).where("_block IS NOT NULL")
    blocks = blocks.groupBy("_level", "_block").agg(*merged)
    ranks = side(1, "_value", "_rank").withColumn("_level", F.explode(levels))
    found = ranks.withColumn("_block", F.floor(F.col("_rank") / width(level))).join(blocks, ["_level", "_block"])
    none = alike.where("_lo IS NULL AND _hi IS NULL").agg(*merged).withColumn("_value", F.lit(None))
    totalled = found.groupBy("_value").agg(*merged).unionByName(none).withColumnRenamed("_value", "_met")
    return asked.join(totalled, F.col("_value").eqNullSafe(F.col("_met")), "left").drop("_value", "_met")
