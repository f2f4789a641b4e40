"""Helpers that keep plans bounded: durable cut points, checked broadcasts, chunks of the log order."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK_BITS = 18
"""A chunk is 2**18 consecutive seq values, so a (key, chunk) group is bounded whatever the key's share of the log."""

BROADCAST_ROWS = 100_000


def shared_dir(spark: SparkSession) -> str:
    """The folder the session names in `spark.checkpoint.dir` for durable intermediate data.

    Only a local session may do without: it gets a temporary folder of its own.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    path = path or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        path = tempfile.mkdtemp(prefix="doclog-")
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/doclog-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting that `df` is within `max_rows`; otherwise leave the join to shuffle."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


GROUP_ROWS = 1 << CHUNK_BITS


def meet(
    df: DataFrame, by: Sequence[str], within: str = "seq", rows: int = GROUP_ROWS, stored: bool = False
) -> DataFrame:
    """`df` dealt so that a group of `by` meets in one task, and one of more than `rows` in as many as it takes.

    `df` is stored first, unless it is `stored`. Large groups are dealt by a hash of `within`; at most one group in
    `rows` rows is large.
    """
    by, table = list(by), df if stored else materialize(df, "dealt")
    large = table.groupBy(*by).agg(F.count("*").alias("__rows")).where(F.col("__rows") > rows)
    parts = F.coalesce(F.expr(f"__rows div {rows}L"), F.lit(0)) + 1
    sized = table.join(broadcast_if_small(materialize(large, "large")), by, "left")
    return sized.repartition(*by, F.pmod(F.xxhash64(within), parts)).select(*df.columns)


def chunk_of(seq: Column, bits: int = CHUNK_BITS) -> Column:
    return F.shiftright(seq, bits)


HOT_ROWS = 1 << CHUNK_BITS
SAMPLE = 0.01
HOT_KEYS = 10_000


def hot_keys(log: DataFrame, keys: Sequence[str]) -> list[tuple]:
    """Keys that probably hold more than HOT_ROWS rows, the largest first; of more than HOT_KEYS, one beyond it.

    Reads the key columns only and shuffles a sample of them. A key just missed is merely worked on as a small one.
    """
    counts = log.select(*keys).sample(SAMPLE, seed=17).groupBy(*keys).count()
    large = counts.where(F.col("count") > HOT_ROWS * SAMPLE).dropna(subset=list(keys))
    return [tuple(r)[:-1] for r in large.orderBy(F.desc("count")).limit(HOT_KEYS + 1).collect()]


def by_heat(
    log: DataFrame,
    rows: DataFrame,
    keys: Sequence[str],
    run: Callable[[DataFrame, int | None], DataFrame],
    hot: list[tuple] | None = None,
    chunk_bits: int = CHUNK_BITS,
) -> DataFrame:
    """`run(rows, None)`, except that hot keys of `log` go through `run(rows, chunk_bits)` on their own.

    With more than HOT_KEYS of them, all keys go through it, so that no key is left to one task whatever their number.
    """
    keys = list(keys)
    hot = hot_keys(log, keys) if hot is None else hot
    if not hot:
        return run(rows, None)
    if len(hot) > HOT_KEYS:
        return run(rows, chunk_bits)
    schema = T.StructType([log.schema[k] for k in keys])
    # At most HOT_KEYS rows, whatever the size of the log.
    listed = F.broadcast(log.sparkSession.createDataFrame(hot, schema))
    cold = run(rows.join(listed, keys, "left_anti"), None)
    return cold.unionByName(run(rows.join(listed, keys, "left_semi"), chunk_bits))
