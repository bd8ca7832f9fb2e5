"""Parquet tables partitioned by month: rebuild, keyed upsert, compaction."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from airlake.functions.time import month_key
from airlake.operators.dedupe import latest_wins
from airlake.session import shared_path
from airlake.sources.files import children, delete_tree, exists, move, read_text, sizes, write_text

MONTH = "month"


def with_month(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn(MONTH, month_key(ts))


def month_between(start: datetime, end: datetime) -> Column:
    """The month predicate that plain Parquet needs next to any time-range filter."""
    return F.col(MONTH).between(start.strftime("%Y-%m"), end.strftime("%Y-%m"))


def write_months(df: DataFrame, path: str, mode: str = "overwrite", dynamic: bool = False) -> None:
    """Write by month. The rebalance hint lets AQE split a month that holds most rows over many
    tasks and merge small ones, so files come out near the advisory size either way."""
    writer = df.hint("rebalance", MONTH).write.mode(mode).partitionBy(MONTH)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def _schema_file(path: str) -> str:
    return f"{path.rstrip('/')}.schema.json"  # beside the data


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A month table by its stored schema; only tables written by other means have all footers merged."""
    if schema is None and exists(spark, _schema_file(path)):
        schema = StructType.fromJson(json.loads(read_text(spark, _schema_file(path))))
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", "true").parquet(path)


def rebuild(df: DataFrame, base: str, version: str) -> str:
    """Full rebuild into a fresh versioned directory; callers switch to the returned path."""
    path = f"{base}/version={version}"
    df.write.mode("overwrite").parquet(path)
    return path


def merge_months(
    spark: SparkSession, path: str, incoming: DataFrame, ts: str, combine: Callable[[DataFrame | None, DataFrame], DataFrame]
) -> list[str]:
    """Rewrite the months that ``incoming`` touches as ``combine(stored rows or None, incoming)``; the months touched.

    ``incoming`` is computed once, into a staging table whose month directories say which months to read
    and rewrite. The merged months are staged too and then swapped in with a dynamic partition overwrite: a failure before the
    swap changes nothing.
    """
    arrived = shared_path(spark, "incoming")
    schema = with_month(incoming, ts).schema
    write_months(with_month(incoming, ts), arrived)
    touched = [c.split("=", 1)[1] for c in children(spark, arrived) if c.startswith(f"{MONTH}=")]
    if not touched:
        return touched
    current = read_table(spark, path).filter(F.col(MONTH).isin(*touched)) if children(spark, path) else None
    final = combine(current, spark.read.schema(schema).parquet(arrived))
    staging = shared_path(spark, "staging")
    write_months(final, staging)
    write_months(spark.read.schema(final.schema).parquet(staging), path, dynamic=True)
    write_text(spark, _schema_file(path), final.schema.json())
    for done in (arrived, staging):
        delete_tree(spark, done)
    return touched


def upsert(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    ts: str,
) -> None:
    """Keyed merge, newest wins, new columns appended. Running again after a failure gives the same table.

    ``ts`` must be part of the key, so a key never moves to another month.
    """

    def newest(current: DataFrame | None, arrived: DataFrame) -> DataFrame:
        both = arrived if current is None else current.unionByName(arrived, allowMissingColumns=True)
        return latest_wins(both, keys, *order)

    merge_months(spark, path, incoming, ts, newest)


def add_sums(
    spark: SparkSession, path: str, deltas: DataFrame, keys: Sequence[str], sums: Sequence[str], ts: str, batch_id: int
) -> None:
    """Add counts and sums (longs, or decimals of twelve places) to the stored ones by key.

    Each row remembers the batch it was last added to in ``batch``. Batches come in order, so one that is replayed after a failure, whole
    or half done, adds to no row twice. ``ts`` must be part of the key.
    """
    kinds = dict(deltas.dtypes)

    def plus(current: DataFrame | None, arrived: DataFrame) -> DataFrame:
        rows = arrived.withColumns({"batch": F.lit(batch_id).cast("long"), "_new": F.lit(True)})
        if current is not None:
            rows = rows.unionByName(current.withColumn("_new", F.lit(False)))
        old = [F.sum(F.when(~F.col("_new"), F.col(c))).alias(f"_old_{c}") for c in sums]
        new = [F.sum(F.when(F.col("_new"), F.col(c))).alias(f"_add_{c}") for c in sums]
        done = F.max(F.when(~F.col("_new"), F.col("batch"))).alias("_done")
        met = rows.groupBy(*keys, MONTH).agg(*old, *new, F.max("batch").alias("batch"), done)
        fresh = F.coalesce(F.col("_done") < batch_id, F.lit(True))
        total = lambda c: (
            F.coalesce(F.col(f"_old_{c}"), F.lit(0)).cast(_addend(kinds[c]))
            + F.when(fresh, F.coalesce(F.col(f"_add_{c}"), F.lit(0))).otherwise(F.lit(0)).cast(_addend(kinds[c]))
        )
        return met.select(*keys, *[total(c).cast(kinds[c]).alias(c) for c in sums], "batch", MONTH)

    merge_months(spark, path, deltas, ts, plus)


def _addend(kind: str) -> str:
    """A type with room for one more digit in the sum."""
    return "decimal(37,12)" if kind.startswith("decimal") else kind


def rebuild_and_switch(spark: SparkSession, df: DataFrame, base: str, version: str) -> str:
    """Full rebuild whose readers (:func:`read_current`) move over in one step, when the new version is whole."""
    path = rebuild(df, base, version)
    write_text(spark, f"{base}/current.json", json.dumps({"path": path, "schema": df.schema.json()}))
    return path


def read_current(spark: SparkSession, base: str) -> DataFrame:
    at = json.loads(read_text(spark, f"{base}/current.json"))
    return spark.read.schema(StructType.fromJson(json.loads(at["schema"]))).parquet(at["path"])


def _packed(small: dict[str, int], target: int) -> list[list[str]]:
    """File names in bins of at most ``target`` bytes, largest first into the first bin with room; single files stay out."""
    bins: list[tuple[int, list[str]]] = []
    for name, size in sorted(small.items(), key=lambda f: (-f[1], f[0])):
        for n, (room, names) in enumerate(bins):
            if size <= room:
                bins[n] = (room - size, [*names, name])
                break
        else:
            bins.append((target - size, [name]))
    return [names for _, names in bins if len(names) > 1]


def compact(spark: SparkSession, path: str, months: Sequence[str], target_mb: float = 256) -> int:
    """Pack the small files of the given months into files near ``target_mb``; the number of files written.

    Only files under half the target are read and rewritten, one task and file a bin; others keep their names. The file list of the given
    months is all the driver holds. New files are staged, then a journal beside the table names what comes and what goes: a
    failure before it changes nothing, one after it is finished by the next call. A reader that lists a month just then may see rows twice.
    """
    path, target = path.rstrip("/"), int(target_mb * 2**20)
    _finish_compaction(spark, path)
    plan = []
    for month in months:
        found = sizes(spark, f"{path}/{MONTH}={month}")
        packed = _packed({n: s for n, s in found.items() if 2 * s < target}, target)
        plan += [(month, name, len(plan) + k) for k, names in enumerate(packed) for name in names]
    if not plan:
        return 0
    table = read_table(spark, path)
    schema = table.schema
    paths = [f"{path}/{MONTH}={month}/{name}" for month, name, _ in plan]
    bins = spark.createDataFrame(plan, f"{MONTH} string, _name string, _bin int")  # one row a small file
    rows = spark.read.schema(schema).option("basePath", path).parquet(*paths)
    rows = rows.withColumn("_name", F.substring_index("_metadata.file_path", "/", -1)).join(F.broadcast(bins), [MONTH, "_name"])
    staging, n = shared_path(spark, "compact"), len({b for *_, b in plan})
    rows.drop("_name").repartition(n, "_bin").write.partitionBy(MONTH, "_bin").parquet(staging)
    come = []
    for month in sorted({m for m, *_ in plan}):
        folder = f"{staging}/{MONTH}={month}"
        for b in children(spark, folder):
            come += [(f"{folder}/{b}/{name}", f"{path}/{MONTH}={month}/{b[1:]}-{name}") for name in sizes(spark, f"{folder}/{b}")]
    write_text(spark, _journal(path), json.dumps({"come": come, "go": paths, "staging": staging}))
    _finish_compaction(spark, path)
    return len(come)


def _journal(path: str) -> str:
    return f"{path}.compaction.json"


def _finish_compaction(spark: SparkSession, path: str) -> None:
    if not exists(spark, _journal(path)):
        return
    todo = json.loads(read_text(spark, _journal(path)))
    for staged, final in todo["come"]:
        if exists(spark, staged):
            move(spark, staged, final)
    for old in todo["go"]:
        delete_tree(spark, old)
    delete_tree(spark, todo["staging"])
    delete_tree(spark, _journal(path))
