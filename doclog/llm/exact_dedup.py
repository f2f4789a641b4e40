"""Exact duplicates by distributed MSD radix partitioning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, normal_space

#: Bytes of the first digit; each later digit is four times as wide, up to the last value.
FIRST_DIGIT, WIDEST_DIGIT = 64, 1 << 20
MAX_BYTES = (1 << 31) - 1


def _groups(scratch: Scratch, cut: DataFrame, by: list[str]) -> DataFrame:
    """The groups of two and more, with their size, smallest id and a number that no other group of the level has."""
    counted = cut.groupBy(*by).agg(F.count("*").alias("_size"), F.min("_id").alias("_leader")).where("_size > 1")
    return scratch.save(counted.withColumn("_next", F.monotonically_increasing_id()))


def _split(joined: DataFrame, width: int) -> DataFrame:
    """Documents that are alone or have ended, with their result; the others with their group and the rest of the text."""
    alone = F.col("_size").isNull()
    done = alone | (F.length("_digit") < width)
    return joined.select(
        "_id",
        "_sha",
        F.when(done, F.when(alone, F.col("_id")).otherwise(F.col("_leader"))).alias("_keep"),
        F.when(done, F.coalesce("_size", F.lit(1).cast("long"))).alias("_n"),
        F.when(~done, F.col("_next")).alias("_group"),
        F.when(~done, F.col("_rest")).alias("_rest"),
        done.alias("_done"),
    )


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of documents whose texts are equal after each run of white space became one space.

    Returns a row per row of `docs`: `id_col`, keep_id, group_size, kept, text_sha256.

    Most significant digit first: documents are split by the first 64 bytes of the text, the groups by the next 256, and
    so on. A document that is alone in its group is unique; documents that end in one group are equal. Equality is that
    of the bytes, text_sha256 is only reported. Each level counts (group, digit) with partial aggregation, so that a
    group of any size leaves one row per task, and only groups of two and more go on to the next level with what is
    left of their texts. The join back is from documents to the few groups; Spark splits its skewed partitions.

    Null texts count as empty, and empty texts are equal. A null id comes after all others: it is kept only if no equal
    text has an id. Rows that repeat an id and a text count in group_size, and one of them is kept. Other columns are
    ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "radix")
    text = docs.select(F.col(id_col).alias("_id"), normal_space(F.col(text_col)).alias("_text"))
    data = F.encode("_text", "UTF-8")

    width = FIRST_DIGIT
    cut = text.select(
        "_id",
        F.unhex(F.sha2(data, 256)).alias("_sha"),
        F.substring(data, 1, width).alias("_digit"),
        F.substring(data, width + 1, MAX_BYTES).alias("_rest"),
    )
    first = scratch.save(cut.drop("_rest"))
    groups = _groups(scratch, first, ["_digit"])
    found = [
        first.join(groups.select("_digit"), "_digit", "left_anti").select(
            "_id", "_sha", F.col("_id").alias("_keep"), F.lit(1).cast("long").alias("_n")
        )
    ]
    # A sort-merge join at every size: its skewed partitions are split, and the disk it needs follows the input.
    level = scratch.save(_split(cut.join(groups.hint("merge"), "_digit"), width), "_done")
    while True:
        found.append(level.where("_done").select("_id", "_sha", "_keep", "_n"))
        active = level.where("NOT _done")
        if active.isEmpty():
            break
        width = min(width * 4, WIDEST_DIGIT)
        cut = active.select(
            "_id",
            "_sha",
            "_group",
            F.substring("_rest", 1, width).alias("_digit"),
            F.substring("_rest", width + 1, MAX_BYTES).alias("_rest"),
        )
        groups = _groups(scratch, cut, ["_group", "_digit"])
        deeper = scratch.save(_split(cut.join(groups, ["_group", "_digit"], "left"), width), "_done")
        scratch.drop(level, "_done=false")
        level = deeper

    rows = reduce(DataFrame.unionByName, found)
    same = Window.partitionBy("_id", "_sha").orderBy("_keep")
    return rows.select(
        F.col("_id").alias(id_col),
        F.col("_keep").alias("keep_id"),
        F.col("_n").alias("group_size"),
        (F.col("_id").eqNullSafe(F.col("_keep")) & (F.row_number().over(same) == 1)).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )
