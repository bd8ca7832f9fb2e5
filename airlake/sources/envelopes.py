"""Raw JSON envelopes, detection CSVs and dimension CSVs, plus flattening of their nested arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airlake import schemas
from airlake.functions.text import SOURCE_FILE, match
from airlake.functions.time import iso_ts, whole


def read_envelopes(spark: SparkSession, path: str, schema: str, since: Column | None = None) -> DataFrame:
    """One JSON document per line; malformed input is an error. ``since`` prunes partitions."""
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return df if since is None else df.filter(since)


def read_fires(spark: SparkSession, path: str, since: str = "0000") -> DataFrame:
    """All-string detection files of 14 or 15 columns, with their source name from the file path."""
    df = (
        spark.read.schema(schemas.FIRES_CSV + ", dt string")
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    return with_source_name(df.filter(F.col("dt") >= since))


def with_source_name(df: DataFrame) -> DataFrame:
    return df.withColumn("source", match(F.col("_metadata.file_path"), SOURCE_FILE))


def read_dim(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema(schemas.DIMENSIONS[name]).option("header", True).csv(path)


def read_served(spark: SparkSession, path: str, schema: str, since_day: str) -> DataFrame:
    """Feature rows served since a day (partition-pruned)."""
    return read_envelopes(spark, path, f"{schema}, dt string, hour string", F.col("dt") >= since_day)


# --- flattening -------------------------------------------------------------------------------


def station_pages(df: DataFrame, *keep: str) -> DataFrame:
    """``stations`` map -> (location_id, page)."""
    return df.select(*keep, F.explode("stations").alias("_id", "_pages")).select(
        *keep, F.col("_id").cast("bigint").alias("location_id"), F.explode("_pages").alias("page")
    )


def page_results(df: DataFrame, *keep: str) -> DataFrame:
    """``pages`` / ``page`` results -> one row ``m`` per measurement."""
    if "page" not in df.columns:
        df = df.select(*keep, F.explode("pages").alias("page"))
    return df.select(*keep, F.explode("page.results").alias("m"))


def point_responses(df: DataFrame, *keep: str) -> DataFrame:
    """Pair each point with its response (position by position)."""
    pairs = F.arrays_zip(F.col("points").alias("pt"), F.try_element_at("responses", F.lit(1)).alias("r"))
    return df.select(*keep, F.explode(pairs).alias("z")).select(
        *keep, F.col("z.pt.id").alias("point_id"), F.col("z.r").alias("r")
    )


def hourly_rows(df: DataFrame, variables, *keep: str) -> DataFrame:
    """Parallel hourly arrays -> one row per time; shorter or absent arrays pad with NULL."""

    def present(name: str, kind: str) -> Column:
        empty = F.array().cast(f"array<{kind}>")
        return F.coalesce(F.col(f"r.hourly.{name}"), empty).alias(name)

    arrays = F.arrays_zip(present("time", "string"), *[present(v, "double") for v in variables])
    return df.select(*keep, F.inline(arrays))


# --- validation splits ------------------------------------------------------------------------


def split(df: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    """(good, quarantined); unknown counts as bad."""
    known = F.coalesce(ok, F.lit(False))
    return df.filter(known), df.filter(~known)


def valid_response(variables) -> Column:
    """UTC offset 0, times present, every array as long as the times."""
    n = F.size("r.hourly.time")
    ok = (F.col("r.utc_offset_seconds") == 0) & F.col("r.hourly.time").isNotNull()
    for v in variables:
        ok = ok & (F.size(f"r.hourly.{v}") == n)
    return ok


def valid_detection() -> Column:
    t = F.col("acq_time").try_cast("int")
    return (
        F.lower(F.trim("confidence")).isin("l", "n", "h")
        & t.between(0, 2359)
        & ((t % 100) < 60)
    )


def on_time(fetched: str = "fetched_at", logical: str = "logical_hour", hours: int = 2) -> Column:
    """A forecast labelled with an hour far from when it was fetched is refused."""
    return F.abs(whole("SECOND", iso_ts(logical), iso_ts(fetched))) <= hours * 3600
