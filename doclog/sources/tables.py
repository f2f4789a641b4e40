"""Target tables: Parquet snapshots whose commit record holds the table's parts and the log position together.

Layout: `v=N.A/bucket=B/*.parquet`, a folder for each attempt A at version N, and `_commits/N.json`. A commit is one
small file created whole and only if it is not there, so a table and its position move together or not at all, and
of two writers one gets an error and leaves nothing. A publish rewrites only the buckets that changed. A run that
touches few keys adds a layer instead (`layers.py`), which readers put together with the table's parts.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doclog import schema as S
from doclog.sources import files

BUCKETS = 64
_WIDTH = 12


@dataclass
class Commit:
    version: int
    position: int
    buckets: int = BUCKETS
    node: str = ""
    ts: float = 0.0
    parts: dict[str, str] = field(default_factory=dict)
    """bucket -> folder that holds it"""
    rows: dict[str, int] = field(default_factory=dict)
    """bucket -> rows in its folder"""
    layers: list[dict] = field(default_factory=list)
    """delta layers from the oldest: folder, level, and rows by bucket"""


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


class CommitConflict(RuntimeError):
    """Another writer committed first."""


def last_commit(spark: SparkSession, path: str) -> Commit | None:
    """The last commit that can be read. A record without content was never a commit; its number counts as used."""
    done = sorted((n for n in files.names(spark, f"{path}/_commits") if n[0].isdigit()), reverse=True)
    for name in done:
        found = read_commit(spark, path, name)
        if found is not None:
            found.version = int(done[0].split(".")[0])
            return found
    return None


def read_commit(spark: SparkSession, path: str, name: str) -> Commit | None:
    try:
        return Commit(**json.loads(files.read_text(spark, f"{path}/_commits/{name}")))
    except ValueError:
        return None


def rows_by_bucket(spark: SparkSession, folder: str) -> dict[str, int]:
    """Rows of each bucket that was written; the files' footers tell."""
    if not any(n.startswith("bucket=") for n in files.names(spark, folder)):
        return {}
    return {str(r[0]): r[1] for r in spark.read.parquet(folder).groupBy("bucket").count().collect()}


def commit(spark: SparkSession, path: str, record: Commit) -> None:
    name = f"{path}/_commits/{record.version:0{_WIDTH}d}.json"
    try:
        files.create_new(spark, name, json.dumps(asdict(record)))
    except Exception as e:
        if files.exists(spark, name):
            raise CommitConflict(f"version {record.version} of {path} is taken") from e
        raise


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    at: Commit | None = None,
    buckets: Iterable[int] | None = None,
    keys: Sequence[str] = ("id",),
) -> DataFrame:
    """The table as of a commit (the last one by default), or only some of its buckets; layers are put together with
    the table by `keys`."""
    at = at or last_commit(spark, path)
    buckets = None if buckets is None else list(buckets)
    wanted = None if buckets is None else {str(b) for b in buckets}
    parts = [] if at is None else [
        f"{path}/{v}/bucket={b}" for b, v in sorted(at.parts.items()) if wanted is None or b in wanted
    ]
    base = spark.read.schema(schema).parquet(*parts) if parts else spark.createDataFrame([], schema)
    if at is None or not at.layers:
        return base
    from doclog.sources import layers

    fields = [f for f in schema.fields if f.name not in keys]
    kind = layers.layer_schema([schema[k] for k in keys], fields)
    return layers.merged(base, layers.read_layers(spark, path, at.layers, kind, buckets), keys)


def publish_table(
    state: DataFrame,
    path: str,
    position: int,
    keys: Sequence[str] = ("id",),
    changed: Iterable[int] | None = None,
    buckets: int = BUCKETS,
    node: str | None = None,
    ts: float = 0.0,
    base: Commit | None | str = "last",
) -> Commit:
    """Write `state` and commit it with the position reached.

    `base` is the commit that `state` was made from; the new one must be the next after it, else CommitConflict is
    raised and what was written goes. Without it, the last commit is taken.

    `changed` names the buckets `state` covers; the others stay as the last commit has them. None means all. The
    owner stays the same unless `node` is given.
    """
    spark = state.sparkSession
    before = last_commit(spark, path) if base == "last" else base
    version = 1 if before is None else before.version + 1
    buckets = buckets if before is None else before.buckets
    folder = f"v={version}.{uuid.uuid4().hex}"
    # Rebalance splits a large bucket over several tasks and joins small ones.
    rows = state.withColumn("bucket", bucket_of(keys, buckets)).hint("rebalance", "bucket")
    rows.write.partitionBy("bucket").parquet(f"{path}/{folder}")
    here = rows_by_bucket(spark, f"{path}/{folder}")
    gone = None if changed is None else {str(b) for b in changed}

    def others(of: dict) -> dict:
        return {} if before is None or gone is None else {b: v for b, v in of.items() if b not in gone}

    # `state` has the layers of its buckets in it.
    left = [] if before is None else [{**layer, "rows": others(layer["rows"])} for layer in before.layers]
    node = (before.node if before else "") if node is None else node
    record = Commit(
        version,
        position,
        buckets,
        node,
        ts,
        others(before.parts if before else {}) | {b: folder for b in here},
        others(before.rows if before else {}) | here,
        [layer for layer in left if layer["rows"]],
    )
    try:
        commit(spark, path, record)
    except CommitConflict:
        files.remove(spark, f"{path}/{folder}")
        raise
    return record


def move_position(
    spark: SparkSession,
    path: str,
    position: int,
    node: str | None = None,
    ts: float = 0.0,
    buckets: int = BUCKETS,
    base: Commit | None | str = "last",
) -> Commit:
    """Commit a new position or owner over an unchanged table."""
    before = last_commit(spark, path) if base == "last" else base
    node = (before.node if before else "") if node is None else node
    record = (
        Commit(1, position, buckets, node, ts)
        if before is None
        else replace(before, version=before.version + 1, position=position, node=node, ts=ts)
    )
    commit(spark, path, record)
    return record


def read_positions(spark: SparkSession, root: str, target: str | None = None) -> DataFrame:
    """Where the target tables under `root` stand, one row each, or only `target`; one read of all commit records.

    `ts` is the owner's last sign of life, a commit or a beat of `leases`.
    """
    pattern = f"{root}/{target or '*'}/_commits/[0-9]*.json"
    columns = "position long, node string, ts double"
    if not files.any_match(spark, pattern):
        return spark.createDataFrame([], S.POSITIONS)
    place = F.regexp_extract("_metadata.file_path", "([^/]+)/_commits/([0-9]+)[.]json$", 1)
    version = F.regexp_extract("_metadata.file_path", "([^/]+)/_commits/([0-9]+)[.]json$", 2).cast("long")
    read = spark.read.option("wholetext", True).text(pattern)
    found = read.select(
        F.url_decode(F.replace(place, F.lit("+"), F.lit("%2B"))).alias("target"),
        version.alias("version"),
        F.from_json("value", columns).alias("c"),
    )
    last = found.where("c.position IS NOT NULL").groupBy("target").agg(F.max_by("c", "version").alias("c"))
    last = last.select("target", "c.*")
    beats = f"{root}/{target or '*'}/_beats/[0-9]*.json"
    if files.any_match(spark, beats):
        owner = F.regexp_extract("_metadata.file_path", "([^/]+)/_beats/[0-9]+[.]json$", 1)
        signs = spark.read.schema("node string, ts double").option("ignoreMissingFiles", True).json(beats)
        signs = signs.select(F.url_decode(F.replace(owner, F.lit("+"), F.lit("%2B"))).alias("target"), "node", "ts")
        signs = signs.groupBy("target", "node").agg(F.max("ts").alias("sign"))
        last = last.join(signs, ["target", "node"], "left").withColumn("ts", F.greatest("ts", "sign"))
    rows = last.select(
        "target",
        F.lit("index").alias("doc_type"),
        F.col("node").alias("node_name"),
        F.col("position").alias("file_position"),
        F.timestamp_seconds("ts").alias("ts"),
    )
    return rows.to(S.POSITIONS)
