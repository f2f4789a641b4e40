"""The few file-system calls that DataFrame readers and writers do not offer."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a directory; none when it is missing."""
    fs, p = _open(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def any_match(spark: SparkSession, pattern: str) -> bool:
    fs, p = _open(spark, pattern)
    return len(fs.globStatus(p) or ()) > 0


def create_new(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file, whole or not at all; an error when it is there already."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    fs, p = _open(spark, path)
    folder, name = path.rstrip("/").rsplit("/", 1)
    _, draft = _open(spark, f"{folder}/_draft-{uuid.uuid4().hex}-{name}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(p).toUri(), conf)
    keep_both = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(p), keep_both)
    except Exception:
        fs.delete(draft, False)
        raise


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a directory, if it is there."""
    fs, p = _open(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r[0] for r in spark.read.text(path).collect())
