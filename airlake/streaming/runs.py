"""Running streams to completion: file source, available-now trigger, idempotent sinks."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from airlake.functions.numeric import exact
from airlake.functions.time import as_ts
from airlake.operators.dedupe import latest_wins
from airlake.session import stored
from airlake.sources.envelopes import split
from airlake.sources.files import children
from airlake.sources.tables import MONTH, add_sums, month_between, read_table, upsert, with_month
from airlake.streaming.windows import sliding_sums

STORE_KEY = "spark.sql.streaming.stateStore.providerClass"
IDLE_KEY = "spark.sql.streaming.noDataMicroBatches.enabled"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_files(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """Parquet file stream over a directory, or over a single file given by its path.

    The trailing ``*`` makes the path a glob, which accepts both.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{path}*")


def run_available(
    stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "update"
) -> list[dict]:
    """Process everything that has arrived, then stop; the progress of each batch. Restarting continues from the checkpoint.

    State lives in RocksDB on the executors with its changes in the shared checkpoint folder. Batches without new rows are
    left out: values with a time to live would ask for them without end.
    """
    conf, settings = stream.sparkSession.conf, {STORE_KEY: STATE_STORE, IDLE_KEY: "false"}
    before = {k: conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            conf.set(k, v)
        query = (
            stream.writeStream.outputMode(mode)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .foreachBatch(each)
            .start()
        )
    finally:
        for k, v in before.items():
            conf.set(k, v)
    query.awaitTermination()
    return query.recentProgress


def run_upsert(
    spark: SparkSession, stream: DataFrame, table: str, checkpoint: str, keys: Sequence[str],
    order: Sequence[Column], ts: str,
) -> None:
    """Merge every micro-batch by key. A batch replayed after a failure gives the same table."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        upsert(spark, table, batch, keys, order, ts)

    run_available(stream, checkpoint, merge)


def run_upsert_windows(
    spark: SparkSession, stream: DataFrame, table: str, checkpoint: str, keys: Sequence[str], ts: str
) -> None:
    """Windowed aggregates in update mode: the newest batch holds the newest total of a window."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        versioned = batch.withColumn("batch", F.lit(batch_id).cast("long"))
        upsert(spark, table, versioned, keys, [F.col("batch").desc()], ts)

    run_available(stream, checkpoint, merge)


def hour_deltas(batch: DataFrame, by: Sequence[str], ts: str, value: str) -> DataFrame:
    """Count and exact sum of a micro-batch by key and hour; rows without a time count nowhere."""
    hours = batch.where(F.col(ts).isNotNull()).groupBy(*by, F.date_trunc("hour", ts).alias("hour_utc"))
    return hours.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(exact(value)), F.lit(0)).cast("decimal(38,12)").alias("total"))


def run_hours(
    spark: SparkSession, stream: DataFrame, table: str, checkpoint: str, by: Sequence[str], ts: str, value: str
) -> list[dict]:
    """Hourly counts and sums (``n``, ``total``) by key in a stored table, whatever the order of arrival.

    A micro-batch is aggregated by itself and its sums are added to the stored hours, so the stream keeps no state, drops nothing
    as too late, and the work is that of the months the batch touches.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        add_sums(spark, table, hour_deltas(batch, by, ts, value), [*by, "hour_utc"], ["n", "total"], "hour_utc", batch_id)

    return run_available(stream, checkpoint, merge, mode="append")


def run_sliding(
    spark: SparkSession, stream: DataFrame, hours_table: str, table: str, checkpoint: str,
    by: Sequence[str], ts: str, value: str, width: int,
) -> list[dict]:
    """Sliding sums kept up to date: a batch is added to the stored hours, then only the windows it touches are made anew."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        deltas = stored(hour_deltas(batch, by, ts, value), "changed-hours")
        low, high = deltas.agg(
            F.min("hour_utc").cast("timestamp_ntz"), F.max("hour_utc").cast("timestamp_ntz")
        ).first()
        if low is None:
            return
        add_sums(spark, hours_table, deltas, [*by, "hour_utc"], ["n", "total"], "hour_utc", batch_id)
        reach = timedelta(hours=width)
        near = read_table(spark, hours_table).filter(
            month_between(low - reach, high + reach)
            & F.col("hour_utc").between(as_ts(low - reach), as_ts(high + reach))
        )
        touched = sliding_sums(near, by, width).filter(
            (F.col("window_start_utc") > as_ts(low - reach)) & (F.col("window_start_utc") <= as_ts(high))
        )
        upsert(
            spark, table, touched.withColumn("batch", F.lit(batch_id).cast("long")),
            [*by, "window_start_utc"], [F.col("batch").desc()], "window_start_utc",
        )

    return run_available(stream, checkpoint, merge, mode="append")


def run_first_seen(
    spark: SparkSession, stream: DataFrame, table: str, checkpoint: str, keys: Sequence[str], ts: str, ties: Sequence[str] = ()
) -> list[dict]:
    """Append the first row of each key to arrive (within a batch the earliest by ``ts``, then ``ties``); repeats are dropped.

    What was seen is the table itself, read for the months of the batch only: no state in the stream, no lateness. ``ts`` must be part of
    the key, or follow from it. A replayed batch replaces its own rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        order = [F.col(ts).asc(), *[F.col(c).asc() for c in ties]]
        fresh = stored(with_month(latest_wins(batch, keys, *order), ts), "first-seen")
        months = [r[0] for r in fresh.select(MONTH).distinct().collect()]  # one value a month
        if not months:
            return
        fresh = fresh.withColumn("batch", F.lit(batch_id).cast("long"))
        if children(spark, table):
            seen = spark.read.schema(fresh.schema).parquet(table)
            seen = seen.where(F.col(MONTH).isin(*months) & (F.col("batch") != batch_id)).select(*[F.col(k).alias(f"_{k}") for k in keys])
            same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
            fresh = stored(fresh.join(seen, same, "left_anti"), "first-fresh")
        writer = fresh.hint("rebalance", MONTH).write.mode("overwrite").partitionBy(MONTH, "batch")
        writer.option("partitionOverwriteMode", "dynamic").parquet(table)

    return run_available(stream, checkpoint, write, mode="append")


def read_json_files(spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    """JSON lines as a file stream; a line that does not parse has only ``_corrupt_record``."""
    reader = spark.readStream.schema(f"{schema}, _corrupt_record string").option("mode", "PERMISSIVE")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def run_envelopes(
    spark: SparkSession, stream: DataFrame, table: str, quarantine: str, checkpoint: str,
    flatten: Callable[[DataFrame], DataFrame], ok: Column, stage: Callable[[DataFrame], DataFrame],
    keys: Sequence[str], order: Sequence[Column], ts: str,
) -> list[dict]:
    """Nested envelopes, batch by batch: valid parts staged and merged by key, the others set aside with their content.

    ``flatten`` turns documents into the parts that ``ok`` judges (unknown is bad), ``stage`` valid parts into rows for the table, where
    ``order`` (such as the fetch time, newest first) decides. ``quarantine`` gets reason and document, a folder for each batch;
    a replayed batch replaces its own, and merging again changes nothing.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        docs = stored(batch, "envelopes")
        good, bad = split(flatten(docs.where("_corrupt_record IS NULL").drop("_corrupt_record")), ok)
        broken = docs.where("_corrupt_record IS NOT NULL").select(F.lit("unreadable").alias("reason"), F.col("_corrupt_record").alias("document"))
        invalid = bad.select(F.lit("invalid").alias("reason"), F.to_json(F.struct("*")).alias("document"))
        broken.unionByName(invalid).write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id}")
        # pruned before it is staged by month: a batch holds many fetches of one key
        upsert(spark, table, latest_wins(stage(good), keys, *order), keys, order, ts)

    return run_available(stream, checkpoint, each, mode="append")


def run_append(stream: DataFrame, table: str, checkpoint: str) -> list[dict]:
    """Append-only results, one directory per micro-batch; a replayed batch replaces its own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    return run_available(stream, checkpoint, write, mode="append")
