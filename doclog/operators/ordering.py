"""The order of the log and how it is cut into segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doclog import schema as S
from doclog.functions.prefix import ROLL_BITS, before_chunk, before_seq, running_before
from doclog.functions.scale import chunk_of, materialize

_ROW_BITS = 33  # monotonically_increasing_id keeps the row's place in its partition in the low 33 bits


def order_log(reqs: DataFrame, keys: Sequence[str], start: int = 0) -> DataFrame:
    """Number requests densely from `start` in the order of `keys`, as column `seq`.

    One range shuffle. The sorted partitions are written once, so the places of the rows are fixed whatever is
    recomputed later; numbering then only adds each partition's offset. `keys` should order the rows totally; ties
    are spread by a hash of the row.
    """
    plain = [f.name for f in reqs.schema.fields if not _has_map(f.dataType)]
    order = [*keys, "__tie"]
    placed = (
        reqs.withColumn("__tie", F.xxhash64(*plain))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("__tie")
        .withColumn("__place", F.monotonically_increasing_id())
    )
    placed = materialize(placed, "order").withColumn("__part", F.shiftright("__place", _ROW_BITS))
    sizes = placed.groupBy("__part").agg(F.count("*").alias("size"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset"))
    row = F.col("__place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1).cast("long"))
    # One row per shuffle partition, so the broadcast does not grow with the data.
    numbered = placed.join(F.broadcast(offsets), "__part").withColumn("seq", F.col("offset") + row + F.lit(start))
    return numbered.drop("__part", "__place", "offset")


def _has_map(t: T.DataType) -> bool:
    if isinstance(t, T.MapType):
        return True
    if isinstance(t, T.ArrayType):
        return _has_map(t.elementType)
    if isinstance(t, T.StructType):
        return any(_has_map(f.dataType) for f in t.fields)
    return isinstance(t, T.VariantType)


def roll_by_size(
    log: DataFrame, max_bytes: int = S.SEGMENT_BYTES, chunk_bits: int = ROLL_BITS, first: int = 1
) -> DataFrame:
    """Add `segment_id`: a request opens a new segment when the bytes before it pass a multiple of the limit.

    A request is never split, so a segment may exceed the limit by one request.
    """
    rows = running_before(log, {"bytes_before": F.col("bytes")}, chunk_bits)
    cut = F.expr(f"bytes_before div {int(max_bytes)}L") + F.lit(first)
    return rows.withColumn("segment_id", cut).drop("bytes_before", "chunk")


def roll_by_marker(
    log: DataFrame,
    marker: str = "marker",
    max_bytes: int = S.SEGMENT_BYTES,
    chunk_bits: int = ROLL_BITS,
    first: int = 1,
) -> DataFrame:
    """Add `segment_id`: rows with `marker` set close the segment and are no requests themselves; size cuts too.

    A marker on an empty segment does nothing, so ids are dense. The byte count restarts after a marker.
    """
    is_marker = F.coalesce(F.col(marker), F.lit(False))
    size = F.when(is_marker, F.lit(0).cast("long")).otherwise(F.col("bytes"))

    def in_chunk(df: DataFrame) -> DataFrame:
        """Bytes and markers before the row, and bytes before its latest marker, all counted inside the chunk."""
        seen = df.withColumns(
            {
                "__bytes": F.coalesce(F.sum(size).over(before_seq()), F.lit(0)),
                "__epoch": F.coalesce(F.count_if(is_marker).over(before_seq()), F.lit(0)),
            }
        )
        return seen.withColumn("__mark", F.max(F.when(is_marker, F.col("__bytes"))).over(before_seq()))

    rows = log.withColumn("chunk", chunk_of(F.col("seq"), chunk_bits))
    narrow = in_chunk(rows.select("chunk", "seq", "bytes", marker))

    # One small row per chunk, written once: what the chunk adds, then what lies before it.
    adds = narrow.groupBy("chunk").agg(
        F.sum(size).alias("bytes"),
        F.count_if(is_marker).alias("epoch"),
        F.max(F.when(is_marker, F.col("__bytes"))).alias("mark"),
    )
    adds = materialize(adds, "chunks")
    heads = before_chunk(adds, ["bytes", "epoch"])
    marks = adds.join(heads.select("chunk", F.col("bytes").alias("b")), "chunk").select(
        "chunk", (F.coalesce("b", F.lit(0)) + F.col("mark")).alias("mark")
    )
    heads = heads.join(before_chunk(marks, ["mark"], F.max), "chunk").select(
        "chunk", *[F.coalesce(n, F.lit(0)).alias(f"__head_{n}") for n in ("bytes", "epoch", "mark")]
    )

    def placed(df: DataFrame) -> DataFrame:
        """Add the epoch (markers so far) and the size bucket inside it; markers themselves leave."""
        start = F.coalesce(F.col("__head_bytes") + F.col("__mark"), F.col("__head_mark"))
        return (
            df.join(heads, "chunk")
            .where(~is_marker)
            .withColumns({"__start": start, "__epoch": F.col("__epoch") + F.col("__head_epoch")})
            .withColumn("__bucket", F.expr(f"(__bytes + __head_bytes - __start) div {int(max_bytes)}L"))
        )

    # Segments in order of their first chunk; few rows again, so numbering them is cheap.
    pair = ["__epoch", "__bucket"]
    seen = materialize(placed(narrow).select("chunk", *pair).distinct(), "cuts")
    opened = seen.groupBy(*pair).agg(F.min("chunk").alias("chunk"))
    place = Window.partitionBy("chunk").orderBy(*pair)
    counts = before_chunk(opened.groupBy("chunk").agg(F.count("*").alias("earlier")), ["earlier"])
    numbers = opened.withColumn("n", F.row_number().over(place)).join(counts, "chunk").select(
        *pair, (F.coalesce("earlier", F.lit(0)) + F.col("n")).alias("number")
    )
    bases = seen.join(numbers, pair).groupBy("chunk").agg(F.min("number").alias("__base"))

    in_order = Window.partitionBy("chunk").orderBy("seq")
    now, last = F.struct(*pair), F.lag(F.struct(*pair)).over(in_order)
    return (
        placed(in_chunk(rows))
        .withColumn("__opens", F.when(last.isNotNull() & (last != now), 1).otherwise(0))
        .withColumn("__step", F.sum("__opens").over(in_order))
        .join(bases, "chunk")
        .withColumn("segment_id", F.col("__base") + F.col("__step") + F.lit(first - 1))
        .select(*log.columns, "segment_id")
    )
