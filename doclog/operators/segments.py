"""Reports over segments, and how a consumer finds its next one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doclog import schema as S
from doclog.functions.requests import next_position


def segment_stats(log: DataFrame) -> DataFrame:
    """Requests, bytes and seq range per segment; the items of a bulk count as one request."""
    one = F.count("*")
    if "in_bulk" in log.columns:
        one = F.count_if(~F.col("in_bulk") | (F.col("item") == 0))
    return log.groupBy("segment_id").agg(
        one.alias("requests"),
        F.sum("bytes").alias("bytes"),
        F.min("seq").alias("min_seq"),
        F.max("seq").alias("max_seq"),
    )


def next_segment(positions: DataFrame, segments: DataFrame, lookup: int = S.LOOKUP_SEGMENTS) -> DataFrame:
    """Add `ready` (the segment at the position exists) and `next_segment`: it, or else the first existing one among
    the `lookup` following ids, or null to wait.

    Ids are grouped into blocks of `lookup`, so a position meets its candidates in at most two bounded blocks by
    equality joins instead of a range join.
    """
    blocks = segments.groupBy(F.expr(f"segment_id div {lookup}L").alias("block")).agg(
        F.collect_set("segment_id").alias("ids")
    )

    def block_at(offset: int, name: str) -> DataFrame:
        return blocks.select((F.col("block") - offset).alias("block"), F.col("ids").alias(name))

    p, start = F.col("file_position"), F.col("__start")

    def first_of(ids: str) -> Column:
        return F.array_min(F.filter(ids, lambda x: (x >= start) & (x - start < lookup)))

    own = blocks.select(F.col("block").alias("own_block"), F.col("ids").alias("__own"))
    rows = (
        positions.withColumn("__start", next_position(p))
        .withColumn("block", F.expr(f"__start div {lookup}L"))
        .withColumn("own_block", F.expr(f"file_position div {lookup}L"))
        .join(block_at(0, "__here"), "block", "left")
        .join(block_at(1, "__after"), "block", "left")
        .join(own, "own_block", "left")
    )
    ready = F.coalesce(F.array_contains("__own", p), F.lit(False))
    following = F.coalesce(first_of("__here"), first_of("__after"))
    return rows.select(
        *positions.columns,
        ready.alias("ready"),
        F.when(ready, p).otherwise(following).alias("next_segment"),
    )


def page(df: DataFrame, sort: list[str], start: int = 0, size: int = S.PAGE_SIZE) -> DataFrame:
    """Rows `start` .. `start + size - 1` in ascending order of `sort`."""
    return df.orderBy(*sort).offset(start).limit(size)


def count_hits(df: DataFrame, name: str = "total") -> DataFrame:
    return df.agg(F.count("*").alias(name))
