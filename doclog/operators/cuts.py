"""Size cuts by a counter that starts again at every cut, found without walking through the log.

Where a segment ends depends on where it began, so the cuts form a chain: from a segment's first offset (bytes before a
request) to the first offset more than the limit behind it. The offsets are dealt to blocks of one limit, so that a
segment's successor lies in a later block and a block holds at most one cut. Going up, the blocks of a level are put
together by two: an offset's link becomes the link that leaves the larger block, and only offsets that some link reaches
are kept, so the levels shrink. Going down, the one known start of the log becomes the starts of all blocks. Each step
is a join on the offset; a log of n limits takes 2 log2(n) of them over narrow rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doclog import schema as S
from doclog.functions.prefix import ROLL_BITS, before_chunk, running_before
from doclog.functions.scale import broadcast_if_small, materialize

WRITE_EVERY = 5
"""Steps down between two written tables: bounds the plan."""


def _links(offsets: DataFrame, step: int) -> DataFrame:
    """Every offset with the first offset at least `step` behind it (`to`, null: none). `offsets` are distinct.

    Offsets and the places looked for meet in their block of `step` bytes; where the block has none that is large
    enough, it is the first of the next block that has any.
    """
    block = F.expr(f"b div {step}L")
    here = offsets.select(block.alias("block"), F.col("b").alias("v"), F.lit(0).alias("asks"), "b")
    asked = offsets.select((block + 1).alias("block"), (F.col("b") + step).alias("v"), F.lit(1).alias("asks"), "b")
    order = Window.partitionBy("block").orderBy(F.desc("v"), "asks").rowsBetween(Window.unboundedPreceding, 0)
    found = F.min(F.when(F.col("asks") == 0, F.col("b"))).over(order)
    inside = here.unionByName(asked).withColumn("to", found).where("asks = 1").select("block", "b", "to")
    # The first offset of a block, as a maximum over blocks counted backwards; blocks that are only asked have none.
    firsts = here.select("block", (-F.col("b")).alias("first"))
    firsts = firsts.unionByName(asked.select("block", F.lit(None).cast("long").alias("first")))
    totals = firsts.groupBy((-F.col("block")).alias("chunk")).agg(F.max("first").alias("first"))
    later = before_chunk(totals, ["first"], F.max).select((-F.col("chunk")).alias("block"), (-F.col("first")).alias("later"))
    return inside.join(later, "block").select("b", F.coalesce("to", "later").alias("to"))


def segment_starts(offsets: DataFrame, step: int) -> DataFrame:
    """The chain from the smallest of the distinct `offsets` (`b`) on, each at least `step` behind the one before."""
    first, last = offsets.agg(F.min("b"), F.max("b")).first()
    spark = offsets.sparkSession
    if first is None:
        return offsets.select("b")

    def block(c: str, level: int) -> Column:
        return F.expr(f"{c} div {step << level}L")

    level, levels = 0, [materialize(_links(offsets, step), "links")]
    while last // (step << level) > first // (step << level):
        now, level = levels[-1], level + 1
        stays = block("to", level) == block("b", level)
        near = now.where(stays).join(now.select(F.col("b").alias("to"), F.col("to").alias("beyond")), "to")
        joined = materialize(
            near.select("b", F.col("beyond").alias("to")).unionByName(now.where(~F.coalesce(stays, F.lit(False)))), "links"
        )
        reached = joined.select(F.col("to").alias("b")).where("b is not null").distinct()
        reached = reached.unionByName(spark.range(1).select(F.lit(first).cast("long").alias("b")))
        levels.append(materialize(joined.join(reached, "b", "left_semi"), "links"))
    starts = spark.range(1).select(F.lit(first).cast("long").alias("b"))
    for n in range(level, 0, -1):
        met = starts.join(levels[n - 1], "b", "left")
        below = F.when(block("to", n) == block("b", n), F.array("b", "to")).otherwise(F.array("b"))
        starts = met.select(F.explode(below).alias("b"))
        if n % WRITE_EVERY == 0:
            starts = materialize(starts, "starts")
    return starts


def roll_by_counter(
    log: DataFrame, max_bytes: int = S.SEGMENT_BYTES, chunk_bits: int = ROLL_BITS, first: int = 1
) -> DataFrame:
    """Add `segment_id`: a request opens a new segment when those in the open one hold more than `max_bytes`.

    The same cuts as a writer makes that counts the bytes of its open file. Requests with the same `seq` (items of a
    bulk) stay together; null bytes count as none.
    """
    step = int(max_bytes) + 1
    rows = running_before(log, {"bytes_before": F.coalesce("bytes", F.lit(0))}, chunk_bits).drop("chunk")
    rows = rows.withColumn("__block", F.expr(f"bytes_before div {step}L"))
    offsets = rows.select(F.col("bytes_before").alias("b")).distinct()
    starts = materialize(segment_starts(offsets, step).withColumn("chunk", F.expr(f"b div {step}L")), "starts")
    # A start is the only one of its block; blocks without one lie in the segment that is open there.
    blocks = offsets.select(F.expr(f"b div {step}L").alias("chunk")).distinct().join(starts, "chunk", "left")
    opened = F.col("b").isNotNull().cast("long")
    earlier = before_chunk(blocks.select("chunk", opened.alias("opened")), ["opened"])
    blocks = blocks.join(earlier, "chunk").select(
        F.col("chunk").alias("__block"), F.col("b").alias("__start"), F.coalesce("opened", F.lit(0)).alias("__opened")
    )
    inside = F.coalesce((F.col("bytes_before") >= F.col("__start")).cast("long"), F.lit(0))
    numbered = rows.join(broadcast_if_small(blocks), "__block")
    return numbered.withColumn("segment_id", F.col("__opened") + inside + F.lit(first - 1)).drop(
        "bytes_before", "__block", "__start", "__opened"
    )
