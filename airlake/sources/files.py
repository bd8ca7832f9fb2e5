"""Tiny helpers over Spark's own Hadoop file system, so paths work on any store."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Sorted names directly below a directory ([] when it does not exist)."""
    fs, p, _ = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """Bytes of each data file directly below a directory."""
    fs, p, _ = _fs(spark, path)
    found = fs.listStatus(p) if fs.exists(p) else []
    plain = {s.getPath().getName(): s.getLen() for s in found if s.isFile()}
    return {name: size for name, size in plain.items() if name[0] not in "._"}


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, p, jvm = _fs(spark, source)
    to = jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(to.getParent())
    if not fs.rename(p, to):
        raise OSError(f"could not move {source} to {target}")


def delete_tree(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, then rename it over the old one, so readers see either whole file."""
    fs, p, jvm = _fs(spark, path)
    tmp = jvm.org.apache.hadoop.fs.Path(f"{path}.tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    # replaces an older file in one step where the store can, so there is never no file
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(tmp, p, how)


def read_text(spark: SparkSession, path: str) -> str:
    rows = spark.read.text(path, wholetext=True).collect()
    return rows[0][0]
