"""Running totals along the log order without a global window.

Three levels: rows inside a chunk of the order, chunks inside a span of chunks, and spans. Only the last level is
unpartitioned, and it holds one row per 2**26 consecutive seq values.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from doclog.functions.scale import chunk_of

ROLL_BITS = 14
"""Rows are spread by 2**14 consecutive seq values, so writers share a batch and a task holds whole documents of few."""

SPAN_BITS = 12


def before_seq() -> WindowSpec:
    """Rows of the same chunk with a smaller seq; the items of one request see the same rows."""
    return Window.partitionBy("chunk").orderBy("seq").rangeBetween(Window.unboundedPreceding, -1)


def before_chunk(
    totals: DataFrame, names: Sequence[str], combine: Callable[[Column], Column] = F.sum, span_bits: int = SPAN_BITS
) -> DataFrame:
    """Per chunk, `combine` (sum or max) of every named column over all earlier chunks; null before the first."""
    spans = totals.withColumn("span", F.shiftright("chunk", span_bits))
    inside = Window.partitionBy("span").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    heads = (
        spans.groupBy("span")
        .agg(*[combine(F.col(n)).alias(n) for n in names])
        .select("span", *[combine(F.col(n)).over(over).alias(f"span_{n}") for n in names])
    )
    local = spans.select("span", "chunk", *[combine(F.col(n)).over(inside).alias(n) for n in names])
    both = local.join(heads, "span")
    joined = {n: combine_two(combine, F.col(f"span_{n}"), F.col(n)) for n in names}
    return both.select("chunk", *[c.alias(n) for n, c in joined.items()])


def combine_two(combine: Callable[[Column], Column], a: Column, b: Column) -> Column:
    merged = F.greatest(a, b) if combine is F.max else a + b
    return F.coalesce(merged, a, b)


def running_before(log: DataFrame, values: dict[str, Column], chunk_bits: int = ROLL_BITS) -> DataFrame:
    """Add `chunk` and, per entry of `values`, its total over all requests with a smaller seq.

    The rows are shuffled once, by chunk; a chunk has a bounded number of requests.
    """
    names = list(values)
    rows = log.withColumn("chunk", chunk_of(F.col("seq"), chunk_bits))
    totals = rows.groupBy("chunk").agg(*[F.sum(v).alias(n) for n, v in values.items()])
    heads = before_chunk(totals, names)
    inside = rows.withColumns({f"in_{n}": F.sum(v).over(before_seq()) for n, v in values.items()})
    sums = {
        n: F.coalesce(F.col(f"in_{n}"), F.lit(0)) + F.coalesce(F.col(n), F.lit(0)) for n in names
    }
    return inside.join(heads, "chunk").withColumns(sums).drop(*[f"in_{n}" for n in names])
