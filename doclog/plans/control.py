"""Starting, stopping and watching the consumers of a log whose tables lie under one root."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclog import schema as S
from doclog.operators.consumers import consumer_list, start_consumer, stop_consumer, target_status
from doclog.operators.shaping import gather_bulks, render_requests
from doclog.sources import leases, tables
from doclog.sources.log import read_manifest, scan_segments


def start_target(spark: SparkSession, root: str, target: str, node: str, position: int = 0) -> dict:
    """Make `node` the owner of a target, at `position` if positive, else where it stands, else at 1.

    An error when another node owns it; of two that start at once one gets CommitConflict. `replay_target(..., node=node)` then works until the owner changes.
    """
    path = f"{root}/{target}"
    at = tables.last_commit(spark, path)
    row = start_consumer(tables.read_positions(spark, root, target), target, node, F.current_timestamp(), position).first()
    tables.move_position(spark, path, row.file_position, node, time.time(), base=at)
    return {"node_name": node, "file_position": row.file_position, "doc_type": row.doc_type}


def stop_target(spark: SparkSession, root: str, target: str, node: str) -> dict:
    """Give a target up: the owner is blanked, the position stays. Only the owner can."""
    path = f"{root}/{target}"
    at = tables.last_commit(spark, path)
    reply = stop_consumer(tables.read_positions(spark, root, target), target, node).first()
    if reply.stop:
        tables.move_position(spark, path, at.position, "", time.time(), base=at)
    return {"found": reply.found, "stop": reply.stop, "working": reply.working}


def take_over_lost(spark: SparkSession, root: str, node: str, alive_seconds: int = S.ALIVE_SECONDS) -> list[str]:
    """Make `node` the owner of all targets under `root` whose owners give no sign of life, and return those it got.

    Every node calls this from time to time and then replays what it got; of several nodes one gets a target.
    """
    positions = tables.read_positions(spark, root)
    age = F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("ts")
    lost = positions.where((F.trim("node_name") != "") & (F.col("node_name") != node) & (age >= alive_seconds))
    names = [r.target for r in lost.select("target").orderBy("target").toLocalIterator()]
    return [t for t in names if leases.take_over(spark, root, t, node, alive_seconds)]


def status(
    spark: SparkSession,
    log_path: str,
    root: str,
    target: str | None = None,
    start: int = 0,
    size: int = S.PAGE_SIZE,
    alive_seconds: int = S.ALIVE_SECONDS,
) -> DataFrame:
    """Status of one target, or a page of all of them."""
    positions, segments = tables.read_positions(spark, root), read_manifest(spark, log_path)
    now = F.current_timestamp()
    if target is not None:
        return target_status(positions, segments, target, now, alive_seconds)
    return consumer_list(positions, segments, now, start, size, alive_seconds)


def dump_segment(spark: SparkSession, log_path: str, segment_id: int) -> DataFrame:
    """The requests of one segment as text lines, in the order of `seq`; an error when there is no such segment."""
    if read_manifest(spark, log_path).where(F.col("segment_id") == segment_id).isEmpty():
        raise FileNotFoundError(f"segment {segment_id} does not exist in {log_path}")
    rows = scan_segments(spark, log_path, segment_id, segment_id)
    return render_requests(gather_bulks(rows) if "in_bulk" in rows.columns else rows)
