"""Shared steps: tables in the shared folder, gapless numbers, text helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from doclog.functions.scale import shared_dir

#: White space of all the operators here.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Rows that one task numbers at a time.
ROWS_PER_CHUNK = 1 << 14


def ship(spark: SparkSession) -> None:
    """Let Spark send this library's code to the executors, once per application; they may not have it installed."""
    sc = spark.sparkContext
    if getattr(sc, "_doclog_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if not os.path.isdir(package):  # itself in an archive that was sent
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="doclog-code-"), "doclog.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, files in os.walk(package):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("doclog", os.path.relpath(path, package)))
    sc.addPyFile(archive)
    sc._doclog_shipped = True


class Scratch:
    """Tables of one job in the shared folder. They cut lineage, survive lost executors and go once superseded."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        ship(spark)
        self.spark = spark
        self.root = f"{shared_dir(spark)}/doclog-{name}-{uuid.uuid4().hex}"
        self._paths: dict[int, str] = {}
        self._n = 0

    def save(self, df: DataFrame, *by: str) -> DataFrame:
        """Write `df` (in folders by the columns `by`) and read it back."""
        self._n += 1
        path = f"{self.root}/{self._n}"
        writer = df.write.partitionBy(*by) if by else df.write
        writer.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = path
        out._scratch = path  # keeps id() from being used again while the table is known
        return out

    def drop(self, df: DataFrame, part: str = "") -> None:
        """Delete a table that nothing reads any more, or one of its folders."""
        path = self._paths[id(df)] + (f"/{part}" if part else "")
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


def normal_space(text: Column) -> Column:
    """Each run of white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def utf8(text: Column) -> Column:
    return F.encode(F.coalesce(text, F.lit("")), "UTF-8")


def number_rows(df: DataFrame, rows: int, by: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """`df` with `name`: 0, 1, 2, ... within each group of `by`, without gaps.

    A group of any size is dealt over chunks by a hash of `order`; a task numbers one chunk, and the chunks' counts give
    where each starts. `df` must be a stored table, since it is read twice; `rows` is about its size.
    """
    chunks = rows // ROWS_PER_CHUNK + 1
    by = list(by)
    cut = df.withColumn("_chunk", F.pmod(F.xxhash64(*order), F.lit(chunks)).cast("int"))
    counts = cut.groupBy(*by, "_chunk").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*by, "_chunk", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*by, "_chunk").orderBy(*order)
    numbered = cut.withColumn("_at", F.row_number().over(inside))
    joined = numbered.join(starts, [*by, "_chunk"])
    return joined.withColumn(name, F.col("_start") + F.col("_at") - 1).drop("_chunk", "_at", "_start")
