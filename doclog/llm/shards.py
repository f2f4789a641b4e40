"""Shards of near equal size by best-fit-decreasing bin packing of indivisible groups."""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, number_rows, utf8

#: Group sizes are rounded up to so many leading bits: a size grows by less than 1 / 1024, and sizes up to 2**62 have
#: at most 54,000 classes however many groups there are.
CLASS_BITS = 10
#: Groups of a class that one row of the plan's lookup covers.
BLOCK = 1 << 12


def best_fit_decreasing(classes: list[tuple[int, int]], capacity: int, most: int | None = None):
    """Runs (size, first, last, bin) that put the groups, from the largest, into the tightest bin that has room.

    `classes` holds (size, number of groups). Open bins are kept in a balanced order by remaining capacity; a group
    enters the first with enough, else a new bin opens. A bin that took a group is still the tightest, so equal groups
    enter it together. A group above `capacity` gets a bin of its own. None when more than `most` bins are needed.
    """
    runs, open_bins, bins = [], [], 0
    for size, count in sorted(classes, reverse=True):
        at = 0
        while at < count:
            k = bisect_left(open_bins, (size, -1))
            if k < len(open_bins):
                left, target = open_bins.pop(k)
            else:
                if bins == most:
                    return None
                left, target = max(capacity, size), bins
                bins += 1
            take = min(count - at, left // size)
            runs.append((size, at, at + take - 1, target))
            at += take
            insort(open_bins, (left - take * size, target))
    return runs


def plan_shards(classes: list[tuple[int, int]], shards: int):
    """Runs for a fixed number of shards: the smallest capacity for which best fit decreasing needs no more bins.

    A group as large as an even share of what is left takes a shard alone; the others share the remaining shards.
    """
    classes = sorted(classes, reverse=True)
    runs, first = [], 0
    taken: dict[int, int] = {}
    while shards - first > 1 and classes:
        size, count = classes[0]
        total = sum(s * c for s, c in classes)
        if size * (shards - first) < total:
            break
        runs.append((size, taken.get(size, 0), taken.get(size, 0), first))
        taken[size] = taken.get(size, 0) + 1
        first += 1
        classes = ([(size, count - 1)] if count > 1 else []) + classes[1:]
    if not classes:
        return runs
    left = shards - first
    low = max(classes[0][0], -(-sum(s * c for s, c in classes) // left))
    high, best = low, None
    while (best := best_fit_decreasing(classes, high, left)) is None:
        high = high * 17 // 16 + 1
    while low < high:
        mid = (low + high) // 2
        found = best_fit_decreasing(classes, mid, left)
        low, high, best = (low, mid, found) if found is not None else (mid + 1, high, best)
    return runs + [(s, a + taken.get(s, 0), b + taken.get(s, 0), t + first) for s, a, b, t in best]


def best_fit_shards(
    docs: DataFrame,
    shards: int | None = None,
    capacity: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Put whole documents into shards: `shards` of near equal size, or as few as possible of at most `capacity` bytes.

    Returns a row per row of `docs`: `id_col`, size (UTF-8 bytes and 1), text_crc32, shard, slot (from 0 in each shard,
    without gaps). Documents of equal text form an indivisible group.

    Groups enter from the largest into the bin with the least sufficient remaining capacity. The plan needs the number of
    groups of each size class only, at most CLASS_BITS-bound many rows, so it is made on the driver whatever the number
    of groups; groups are numbered within their class on Spark and look their shard up by number. Sizes are rounded up
    to their class, so a capacity is never exceeded.

    Null texts count as empty (size 1). A group above `capacity` has a shard of its own. Rows that repeat an id are rows
    of their own; null ids are allowed. Other columns are ignored. An empty table gives no rows.
    """
    if (shards is None) == (capacity is None):
        raise ValueError("give either a number of shards or a capacity")
    spark = docs.sparkSession
    scratch = Scratch(spark, "shards")
    data = utf8(F.col(text_col))
    rows = scratch.save(
        docs.select(
            F.col(id_col).alias("_id"),
            (F.length(data) + 1).cast("long").alias("_size"),
            F.crc32(data).alias("_crc"),
            F.unhex(F.sha2(data, 256)).alias("_key"),
        )
    )
    total = F.col("_total")
    shift = F.greatest(F.lit(0), F.length(F.bin(total)) - CLASS_BITS - 1)
    # Rounded up to a multiple of 2**shift.
    rounded = F.expr("shiftleft(shiftright(_total + shiftleft(1L, _shift) - 1, _shift), _shift)")
    groups = scratch.save(
        rows.groupBy("_key")
        .agg(F.sum("_size").alias("_total"), F.count("*").alias("_rows"))
        .withColumn("_shift", shift)
        .select("_key", rounded.alias("_class"), "_rows")
    )
    classes = [tuple(r) for r in groups.groupBy("_class").count().collect()]
    runs = plan_shards(classes, shards) if shards else best_fit_decreasing(classes, capacity)
    plan = spark.createDataFrame(runs, "_class long, _first long, _last long, shard int")
    plan = plan.withColumn("_block", F.explode(F.expr(f"sequence(_first div {BLOCK}, _last div {BLOCK})")))
    numbered = number_rows(groups, groups.count(), ["_class"], ["_key"], "_n")
    placed = (
        numbered.withColumn("_block", F.expr(f"_n div {BLOCK}"))
        .join(plan, ["_class", "_block"])
        .where("_n BETWEEN _first AND _last")
        .select("_key", "shard")
    )
    assigned = scratch.save(rows.join(placed, "_key").drop("_key"))
    return number_rows(assigned, assigned.count(), ["shard"], ["_id", "_crc"], "slot").select(
        F.col("_id").alias(id_col),
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        "shard",
        "slot",
    )
