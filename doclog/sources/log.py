"""The segmented log: Parquet data per captured batch, a manifest of its segments, and a commit that makes both visible.

Layout: `data/batch_id=B/epoch=E/segment_id=N/*.parquet`, `manifest/batch_id=B/epoch=E/*.json`, `writers/E.json` and
`commits/N.json`. A writer opens an epoch, which ends those before it. Its batch is readable once the commit named by
the batch's first segment is there. Commits are created whole and only if they are not there, so of two captures that
go on from one state of the log only one comes to hold an id, and the other gets an error.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doclog import schema as S
from doclog.functions.requests import request_code
from doclog.functions.scale import materialize, meet
from doclog.operators.segments import segment_stats
from doclog.sources import files

BATCH_PATHS = 1000
_WIDTH = 19
COMMIT = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("epoch", T.LongType()),
        T.StructField("first", T.LongType()),
        T.StructField("last", T.LongType()),
        T.StructField("max_seq", T.LongType()),
        T.StructField("top_batch", T.LongType()),
        T.StructField("writer", T.StringType()),
    ]
)
"""`top_batch` is the largest batch id so far."""


@dataclass(frozen=True)
class Writer:
    """The right to append to a log, until another writer is opened."""

    epoch: int
    name: str = ""


class WriterFenced(RuntimeError):
    """A later writer has been opened for this log."""


class SegmentsTaken(RuntimeError):
    """The segment ids of a batch belong to a batch that was committed first."""


def _numbered(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(n.split(".")[0]) for n in files.names(spark, folder) if n[0].isdigit())


def open_writer(spark: SparkSession, path: str, name: str = "") -> Writer:
    """Take the log over: writers opened before can commit nothing any more."""
    while True:
        epoch = max(_numbered(spark, f"{path}/writers"), default=0) + 1
        file = f"{path}/writers/{epoch:0{_WIDTH}d}.json"
        try:
            files.create_new(spark, file, json.dumps({"name": name, "opened_at": time.time()}))
            return Writer(epoch, name)
        except Exception:
            if not files.exists(spark, file):
                raise


def check_writer(spark: SparkSession, path: str, writer: Writer) -> None:
    latest = max(_numbered(spark, f"{path}/writers"), default=0)
    if latest != writer.epoch:
        raise WriterFenced(f"writer {writer.epoch} of {path} was followed by writer {latest}")


def last_commit(spark: SparkSession, path: str) -> dict | None:
    done = _numbered(spark, f"{path}/commits")
    return json.loads(files.read_text(spark, f"{path}/commits/{done[-1]:0{_WIDTH}d}.json")) if done else None


def write_segments(
    log: DataFrame, path: str, batch_id: int, writer: Writer | None = None
) -> DataFrame:
    """Write a log with `segment_id` as one batch, commit it and return its manifest rows.

    A segment becomes one file, or several where it has more than GROUP_ROWS rows: the limit it was cut at bounds the
    bytes that its requests declare, not the rows that a task holds. Segment ids must lie behind those of the log. Without `writer` one is opened for this batch. WriterFenced or SegmentsTaken leave the log as it is; what
    was written then is never visible.
    """
    spark = log.sparkSession
    writer = writer or open_writer(spark, path)
    place = f"batch_id={batch_id}/epoch={writer.epoch}"
    data, manifest = f"{path}/data/{place}", f"{path}/manifest/{place}"
    # Stored before it is dealt, so the statistics need not list and open every segment's file again.
    log = materialize(log, "segments")
    (
        meet(log, ["segment_id"], stored=True)
        .sortWithinPartitions("segment_id", "seq", *(["item"] if "item" in log.columns else []))
        .write.mode("overwrite").partitionBy("segment_id").parquet(data)
    )
    stats = segment_stats(log).withColumn("finished_at", F.current_timestamp())
    stats.write.mode("overwrite").json(manifest)
    kinds = S.SEGMENTS.fields[:-1]
    wrote = spark.read.schema(T.StructType(kinds)).json(manifest).withColumn("batch_id", F.lit(batch_id).cast("long"))
    first, last, max_seq = wrote.agg(F.min("segment_id"), F.max("segment_id"), F.max("max_seq")).first()
    if first is not None:
        _commit(spark, path, batch_id, writer, first, last, max_seq)
    return wrote


def _commit(spark: SparkSession, path: str, batch_id: int, writer: Writer, first: int, last: int, max_seq: int) -> None:
    place = f"{path}/data/batch_id={batch_id}/epoch={writer.epoch}"
    name = f"{path}/commits/{first:0{_WIDTH}d}.json"
    taken = f"segments from {first} of {path} belong to another batch"
    try:
        check_writer(spark, path, writer)
        before = last_commit(spark, path)
        if before is not None and before["last"] >= first:
            raise SegmentsTaken(taken)
        top = batch_id if before is None else max(batch_id, before["top_batch"])
        record = (batch_id, writer.epoch, first, last, max_seq, top, writer.name)
        try:
            files.create_new(spark, name, json.dumps(dict(zip(COMMIT.names, record))))
        except Exception as e:
            if files.exists(spark, name):
                raise SegmentsTaken(taken) from e
            raise
    except (WriterFenced, SegmentsTaken):
        files.remove(spark, place)
        raise


def read_commits(spark: SparkSession, path: str) -> DataFrame:
    """One row per visible batch."""
    if not files.exists(spark, f"{path}/commits"):
        return spark.createDataFrame([], COMMIT)
    return spark.read.schema(COMMIT).json(f"{path}/commits")


def read_manifest(spark: SparkSession, path: str, batch_id: int | None = None) -> DataFrame:
    """One row per visible segment, of the whole log or of one batch."""
    manifest = f"{path}/manifest" if batch_id is None else f"{path}/manifest/batch_id={batch_id}"
    if not files.exists(spark, manifest):
        return spark.createDataFrame([], S.SEGMENTS)
    schema = T.StructType([*S.SEGMENTS.fields, T.StructField("epoch", T.LongType())])
    rows = spark.read.schema(schema).option("basePath", f"{path}/manifest").json(manifest)
    visible = read_commits(spark, path).select("batch_id", "epoch")
    return rows.join(visible, ["batch_id", "epoch"], "left_semi").select(*S.SEGMENTS.names)


def last_written(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """(largest segment id, largest seq, largest batch id) in the log; (0, -1, -1) when it is empty. Only the last
    commit is read, however long the log is."""
    last = last_commit(spark, path)
    return (0, -1, -1) if last is None else (last["last"], last["max_seq"], last["top_batch"])


def vacuum_log(spark: SparkSession, path: str) -> list[str]:
    """Delete the data of runs that can never become visible: those of epochs before the last committed one that are
    in no commit. Returns the folders."""
    done = {(r.batch_id, r.epoch) for r in read_commits(spark, path).select("batch_id", "epoch").toLocalIterator()}
    last, gone = max((e for _, e in done), default=0), []
    for batch in files.names(spark, f"{path}/data"):
        for run in files.names(spark, f"{path}/data/{batch}"):
            number, epoch = (int(n.split("=")[1]) for n in (batch, run))
            if epoch < last and (number, epoch) not in done:
                gone.append(f"{path}/data/{batch}/{run}")
                files.remove(spark, gone[-1])
    return gone


def _stored_schema(spark: SparkSession, data: str, batch: str, first: int) -> T.StructType:
    """Columns of a batch as they are stored. One segment tells; the whole batch is listed only where it cannot."""
    reader = spark.read.option("basePath", data)
    try:
        return reader.parquet(f"{data}/{batch}/segment_id={first}").schema
    except Exception:  # the segment's files are gone or broken
        return reader.parquet(f"{data}/{batch}").schema


def scan_segments(
    spark: SparkSession, path: str, lo: int | None = None, hi: int | None = None, check: bool = True
) -> DataFrame:
    """Requests of the visible segments lo..hi, with `segment_id`.

    Only directories of matching batches and segments are read. With `check`, meeting a request of unknown kind is
    an error; without, such rows come through for the caller to judge.
    """
    bounds, among = F.lit(True), F.lit(True)
    if lo is not None:
        bounds, among = bounds & (F.col("segment_id") >= lo), among & (F.col("last") >= lo)
    if hi is not None:
        bounds, among = bounds & (F.col("segment_id") <= hi), among & (F.col("first") <= hi)
    commits = read_commits(spark, path).where(among)
    wanted = commits.select("batch_id", "epoch")
    found = commits.select("batch_id", "epoch", "first").limit(BATCH_PATHS + 1).collect()
    batches = [f"batch_id={r.batch_id}/epoch={r.epoch}" for r in found]
    data = f"{path}/data"
    if not batches:
        empty = T.StructType([*S.REQUEST.fields, T.StructField("segment_id", T.LongType())])
        return spark.createDataFrame([], empty)
    sample = _stored_schema(spark, data, batches[0], found[0].first)
    parts = ("segment_id", "batch_id", "epoch")
    schema = T.StructType(
        [T.StructField(f.name, T.LongType() if f.name in parts else f.dataType) for f in sample]
    )
    if "in_bulk" in sample.names:
        # The first batch may be older than a column of the request.
        for f in S.ITEM.fields:
            if f.name not in sample.names:
                schema.add(f.name, f.dataType)
    reader = spark.read.schema(schema).option("basePath", data)
    if len(batches) <= BATCH_PATHS:
        rows = reader.parquet(*[f"{data}/{b}" for b in batches])
    else:
        rows = reader.parquet(data).join(wanted, ["batch_id", "epoch"], "left_semi")
    rows = rows.where(bounds).drop("batch_id", "epoch")
    if not check:
        return rows
    known = F.coalesce(request_code(F.col("action")) != S.CODE_UNKNOWN, F.lit(False))
    message = F.concat(F.lit("The log does not know this kind of request, seq "), F.col("seq").cast("string"))
    return rows.withColumn("action", F.when(known, F.col("action")).otherwise(F.raise_error(message).cast("string")))
