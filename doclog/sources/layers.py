"""Delta layers of a table: a run writes only what it did to the keys it touched, and readers put it together.

A layer has one row per touched key: the run's combined effect on a document that was absent and on one that was
present. So it is made without reading the table, and layers of consecutive runs combine into one layer the same way.
Layout: `d=N.A/bucket=B/*.parquet` beside the table's parts; the commit record lists the layers from the oldest. Layers of
one level are combined into one of the next when there are FAN of them, and all go into the table when they hold a large
share of its rows. Every such swap is one commit, made only if it is the next after the one it started from.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doclog.functions.scale import CHUNK_BITS
from doclog.operators.barriers import fold_steps, reduce_epochs
from doclog.operators.consumers import effects_from_each
from doclog.sources import files, tables

FAN = 4
"""Layers of a level that are combined; a key is written once per level, so about log(runs) / log(FAN) times."""

LEVELS = 3
FOLD_SHARE = 0.5
"""Layers with more rows than this share of the table's go into the table."""


def layer_schema(keys: Sequence[T.StructField], fields: Sequence[T.StructField]) -> T.StructType:
    parts = [T.StructField("exists", T.BooleanType())]
    parts += [T.StructField(f.name, T.StructType([T.StructField("v", f.dataType)])) for f in fields]
    case = T.StructType(parts)
    return T.StructType([*keys, T.StructField("if_absent", case), T.StructField("if_present", case)])


def effects_of(
    log: DataFrame, keys: Sequence[str] = ("id",), hot: list[tuple] | None = None, chunk_bits: int = CHUNK_BITS
) -> DataFrame:
    """One row per key that a log of keyed requests touches, with its combined effect."""
    steps = reduce_epochs(log.withColumn("epoch", F.lit(0)), keys, hot, chunk_bits)
    one = F.element_at("steps", 1)
    return steps.select(*keys, one["if_absent"].alias("if_absent"), one["if_present"].alias("if_present"))


def _write(rows: DataFrame, path: str, prefix: str, version: int, keys: Sequence[str], buckets: int) -> tuple[str, dict[str, int]]:
    """(folder, rows by bucket) of rows written by bucket."""
    folder = f"{prefix}={version}.{uuid.uuid4().hex}"
    placed = rows.withColumn("bucket", tables.bucket_of(keys, buckets)).hint("rebalance", "bucket")
    placed.write.partitionBy("bucket").parquet(f"{path}/{folder}")
    return folder, tables.rows_by_bucket(rows.sparkSession, f"{path}/{folder}")


def _commit(spark: SparkSession, path: str, record: tables.Commit, folder: str | None) -> tables.Commit:
    try:
        tables.commit(spark, path, record)
    except tables.CommitConflict:
        if folder is not None:
            files.remove(spark, f"{path}/{folder}")
        raise
    return record


def publish_layer(
    effects: DataFrame,
    path: str,
    position: int,
    base: tables.Commit,
    keys: Sequence[str] = ("id",),
    node: str | None = None,
    ts: float = 0.0,
) -> tables.Commit:
    """Write `effects` as the newest layer and commit it with the position reached; `base` is the commit that the run
    started from, and the new one must be the next after it."""
    spark = effects.sparkSession
    folder, rows = _write(effects, path, "d", base.version + 1, keys, base.buckets)
    layers = [*base.layers, {"folder": folder, "level": 0, "rows": rows}] if rows else base.layers
    record = replace(
        base, version=base.version + 1, position=position, ts=ts, node=base.node if node is None else node, layers=layers
    )
    return _commit(spark, path, record, folder)


def read_layers(
    spark: SparkSession, path: str, layers: Sequence[dict], schema: T.StructType, buckets: Iterable[int] | None = None
) -> DataFrame | None:
    """Rows of the layers with their place in `epoch`; only some buckets of them."""
    wanted = None if buckets is None else {str(b) for b in buckets}
    out = None
    for k, layer in enumerate(layers):
        folders = [f"{path}/{layer['folder']}/bucket={b}" for b in sorted(layer["rows"]) if wanted is None or b in wanted]
        if folders:
            part = spark.read.schema(schema).parquet(*folders).withColumn("epoch", F.lit(k))
            out = part if out is None else out.unionByName(part)
    return out


def _steps(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key its effects in the order of the layers; no more than there are layers."""
    return rows.groupBy(*keys).agg(F.collect_list(F.struct("epoch", "if_absent", "if_present")).alias("steps"))


def merged(base: DataFrame, layers: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """The table as its layers leave it. One shuffle by key serves the layers and the join."""
    if layers is None:
        return base
    keys = list(keys)
    fields = [f for f in base.schema.fields if f.name not in keys]
    steps = _steps(layers, keys)
    start = F.struct(*[F.col(f.name) for f in fields])
    none = F.array().cast(steps.schema["steps"].dataType)
    per_key = base.select(*keys, start.alias("start")).join(steps, keys, "full").withColumn("steps", F.coalesce("steps", none))
    state = fold_steps(per_key, [], fields, keys, steps.schema["steps"].dataType.elementType)
    return state.where("state.exists").select(*keys, *[F.col(f"state.doc.{f.name}").alias(f.name) for f in fields])


def combined(layers: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One layer in place of several consecutive ones."""
    steps = _steps(layers, keys)
    kind = steps.schema["steps"].dataType.elementType
    whole = F.element_at(effects_from_each(F.col("steps"), kind, fields), -1)
    rows = steps.select(*keys, whole.alias("whole"))
    return rows.select(*keys, F.col("whole.if_absent").alias("if_absent"), F.col("whole.if_present").alias("if_present"))


def _rows(layer: dict) -> int:
    return sum(layer["rows"].values())


def compact(spark: SparkSession, path: str, schema: T.StructType, at: tables.Commit, keys: Sequence[str] = ("id",)) -> tables.Commit:
    """Combine layers of a level, or put all layers into the table, if that is due; the commit after that.

    Loses nothing when another writer commits first: CommitConflict is raised and the table stays as that one left it.
    """
    keys = list(keys)
    fields = [f for f in schema.fields if f.name not in keys]
    of_layers = layer_schema([schema[k] for k in keys], fields)
    held = sum(at.rows.values())
    if at.layers and (sum(map(_rows, at.layers)) > FOLD_SHARE * held or at.layers[0]["level"] >= LEVELS):
        touched = sorted({b for layer in at.layers for b in layer["rows"]}, key=int)
        state = tables.read_table(spark, path, schema, at, map(int, touched), keys)
        return tables.publish_table(
            state, path, at.position, keys, map(int, touched), at.buckets, at.node, at.ts, base=at
        )
    for level in range(LEVELS):
        some = [k for k, layer in enumerate(at.layers) if layer["level"] == level]
        if len(some) < FAN:
            continue
        parts = [at.layers[k] for k in some]
        rows = combined(read_layers(spark, path, parts, of_layers), keys, [f.name for f in fields])
        folder, counts = _write(rows, path, "d", at.version + 1, keys, at.buckets)
        # Levels fall from the oldest layer to the newest, so those of one level are consecutive.
        layers = [*at.layers[: some[0]], {"folder": folder, "level": level + 1, "rows": counts}, *at.layers[some[-1] + 1 :]]
        at = _commit(spark, path, replace(at, version=at.version + 1, layers=layers), folder)
    return at


def vacuum(spark: SparkSession, path: str, keep: int = 10) -> list[str]:
    """Delete folders that none of the last `keep` commits names and that are older than these; their names.

    Runs under way write folders with later numbers, and readers of the last commits find all of theirs.
    """
    names = sorted((n for n in files.names(spark, f"{path}/_commits") if n[0].isdigit()), reverse=True)[:keep]
    kept = [c for c in (tables.read_commit(spark, path, n) for n in names) if c is not None]
    if not kept:
        return []
    used = {f for c in kept for f in [*c.parts.values(), *(layer["folder"] for layer in c.layers)]}
    oldest = min(c.version for c in kept)
    gone = []
    for name in files.names(spark, path):
        if name[:2] in ("v=", "d=") and name not in used and int(name[2:].split(".")[0]) <= oldest:
            files.remove(spark, f"{path}/{name}")
            gone.append(name)
    return gone
