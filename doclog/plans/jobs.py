"""Whole jobs: capture a batch of requests into the log, replay the log into a table."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doclog import schema as S
from doclog.functions.requests import admin_action
from doclog.functions.scale import hot_keys, materialize
from doclog.operators.barriers import outcomes_with_queries, replay_with_queries
from doclog.operators.documents import check_docs, replay_documents, replay_documents_with_queries
from doclog.operators.failures import apply_error_policy, dead_letters, segment_errors, split_failures
from doclog.operators.fold import parse_docs, replay, request_outcomes
from doclog.operators.ordering import order_log, roll_by_marker, roll_by_size
from doclog.operators.routing import classify_requests, is_renew, route_requests
from doclog.operators.shaping import log_rows
from doclog.sources import layers, leases, tables
from doclog.sources.dead_letters import SEGMENT_ERROR, write_dead_letter, write_segment_errors
from doclog.sources.log import Writer, last_written, open_writer, read_manifest, scan_segments, write_segments

SEGMENTS_PER_COMMIT = 10_000
LAYER_SHARE = 0.25
"""A run with at most this share of the table's rows as requests adds a layer; a larger one rewrites buckets."""


@dataclass
class Captured:
    segments: DataFrame
    """manifest rows of the batch"""
    rejected: DataFrame
    """requests aimed only partly at targets"""
    passed: DataFrame
    """requests for other indices and of kinds the log does not take: it leaves them alone"""


def capture_batch(
    reqs: DataFrame,
    path: str,
    targets: Sequence[str],
    batch_id: int,
    order_by: Sequence[str] | None = None,
    max_bytes: int = S.SEGMENT_BYTES,
    writer: Writer | None = None,
    renew_actions: Sequence[str] = S.RENEW_ACTIONS,
) -> Captured:
    """Append the requests aimed at `targets` to the log as new segments.

    The order is `seq` as given, or a new numbering by `order_by` that goes on after the last request of the log. A
    batch whose `seq` does not lie behind the log's last is moved there as a whole, so that the order of requests and
    that of segments are one, and a replay comes out the same however segments are grouped into runs. A batch already
    in the log is not written again.

    Administrative requests of `renew_actions` that concern a target cut the segment where they stand, and are among
    `passed`, since they go on to the index. A boolean column `marker`, if there, cuts segments too.

    `writer` is the right to append (`open_writer`); without it, this call takes the log over. WriterFenced or
    SegmentsTaken tell that another capture came first; the log then holds nothing of this batch.
    """
    spark = reqs.sparkSession
    writer = writer or open_writer(spark, path)
    written = read_manifest(spark, path, batch_id)
    marker = F.coalesce(F.col("marker"), F.lit(False)) if "marker" in reqs.columns else F.lit(False)
    named = F.coalesce("indices", F.when(F.col("index").isNotNull(), F.array("index")))
    renews = is_renew(admin_action(F.col("action")), named, targets, renew_actions)
    routed = classify_requests(route_requests(reqs, targets)).withColumn("renews", F.coalesce(renews, F.lit(False)))
    route = F.when(F.col("code") == S.CODE_UNKNOWN, "pass").otherwise(F.col("route"))
    routed = routed.withColumn("route", F.when(marker, "marker").otherwise(route)).drop("code")
    cuts = F.col("renews") | (F.col("route") == "marker")
    rejected, passed = (routed.where(F.col("route") == r).drop("route", "renews") for r in ("reject", "pass"))
    if not written.isEmpty():
        return Captured(written, rejected, passed)
    segment, seq, _ = last_written(spark, path)
    size = F.coalesce("bytes", F.length(F.to_json(F.struct(*S.REQUEST.names))).cast("long"))
    taken = routed.where((F.col("route") == "capture") | cuts).withColumns({"bytes": size, "marker": cuts})
    log = taken.select(*S.REQUEST.names, "marker")
    if order_by is not None:
        # Ordering columns beyond the request's own travel along only until the rows are numbered.
        extra = [c for c in order_by if c not in log.columns]
        kept = log.columns
        log = order_log(taken.select(*kept, *extra).drop("seq"), order_by, seq + 1).select(*kept)
    else:
        # Stored, since numbering, cutting and writing each read the requests.
        log = materialize(log, "taken")
        low = log.agg(F.min("seq")).first()[0] if seq >= 0 else None
        if low is not None and low <= seq:
            log = log.withColumn("seq", F.col("seq") + (seq + 1 - low))
    if log.where("marker").isEmpty():
        log = roll_by_size(log.drop("marker"), max_bytes, first=segment + 1)
    else:
        log = roll_by_marker(log, "marker", max_bytes, first=segment + 1).drop("marker")
    return Captured(write_segments(log_rows(log), path, batch_id, writer=writer), rejected, passed)


def table_schema(doc_type: T.StructType | None) -> T.StructType:
    """Columns of a target table: the key, then the declared fields or the document as JSON."""
    fields = [T.StructField("doc", T.StringType())] if doc_type is None else doc_type.fields
    return T.StructType([T.StructField("id", T.StringType()), *fields])


class SegmentError(RuntimeError):
    """Replay stopped at a segment it could not apply."""


def due_segments(manifest: DataFrame, start: int, lookup: int, limit: int) -> list[int]:
    """The next segments from position `start`, at most `limit`, not reaching over a gap of more than `lookup`."""
    ids = manifest.where(F.col("segment_id") >= start).select("segment_id").distinct()
    due, position = [], start
    for (found,) in ids.orderBy("segment_id").limit(limit).collect():
        if found - position > lookup:
            break
        due.append(found)
        position = found + 1
    return due


def replay_target(
    spark: SparkSession,
    log_path: str,
    table_path: str,
    doc_type: T.StructType | None,
    position: int = 0,
    dead_letter_path: str | None = None,
    retry: int = S.SEGMENT_RETRIES,
    request_retry: int = S.REQUEST_RETRIES,
    skip_error: bool = True,
    lookup: int = S.LOOKUP_SEGMENTS,
    max_segments: int = SEGMENTS_PER_COMMIT,
    until: int | None = None,
    node: str | None = None,
    buckets: int = tables.BUCKETS,
    retry_wait: float = S.POLL_SECONDS,
    beat_seconds: float = S.ALIVE_SECONDS / 4,
) -> int:
    """Bring a target table up to date with the log and return the position reached.

    `doc_type` declares the fields of the documents; None keeps them as JSON text in a column `doc`.

    Runs of segments are folded as one distributed job each and committed together with the position, so a run is
    applied exactly once. Only a segment whose files cannot be read is skipped, or stops the replay when `skip_error`
    is off, after `retry` more tries with `retry_wait` seconds between; any other error is raised and changes nothing. With
    `node`, the replay ends when the table belongs to somebody else or has been stopped, and while a run works the node
    gives a sign of life every `beat_seconds`; a run that lost its table in between raises CommitConflict.
    """
    size, tries = max_segments, 0
    while True:
        owner = at = tables.last_commit(spark, table_path)
        if node is not None and owner is not None and owner.node != node:
            return owner.position
        start = position if position > 0 else (at.position if at else 1)
        manifest = read_manifest(spark, log_path)
        if until is not None:
            manifest = manifest.where(F.col("segment_id") < until)
        due = due_segments(manifest, start, lookup, size)
        if not due:
            if position > 0 and (at is None or at.position != start):
                tables.move_position(spark, table_path, start, node, time.time(), buckets, at)
            return start
        try:
            with leases.alive(spark, table_path, node, beat_seconds):
                _replay_run(
                    spark, log_path, table_path, doc_type, due, dead_letter_path, request_retry, skip_error, node,
                    buckets, at,
                )
            size, tries, position = max_segments, 0, 0
        except (SegmentError, tables.CommitConflict):
            raise
        except Exception as e:
            bad = _first_unreadable(spark, log_path, due)
            if bad is None:
                raise
            if bad != due[0]:
                size = due.index(bad)
                continue
            tries += 1
            if tries <= retry:
                time.sleep(retry_wait)
                size = 1
                continue
            row = [(bad, None, str(e), tries, skip_error)]
            write_segment_errors(spark.createDataFrame(row, SEGMENT_ERROR), table_path)
            if not skip_error:
                raise SegmentError(f"segment {bad} failed {tries} times") from e
            tables.move_position(spark, table_path, bad + 1, node, time.time(), buckets, at)
            size, tries, position = max_segments, 0, 0


def _first_unreadable(spark: SparkSession, log_path: str, due: Sequence[int]) -> int | None:
    """The first of the segments `due` whose files cannot be read, by halves."""

    def readable(some: Sequence[int]) -> bool:
        try:
            scan_segments(spark, log_path, some[0], some[-1], check=False).write.format("noop").mode("overwrite").save()
        except Exception:  # whatever the reader says about a broken file
            return False
        return True

    if readable(due):
        return None
    while len(due) > 1:
        half = len(due) // 2
        due = due[half:] if readable(due[:half]) else due[:half]
    return due[0]


def _replay_run(
    spark, log_path, table_path, doc_type, due, dead_letter_path, request_retry, skip_error, node, buckets, at
) -> None:
    """Fold one run of segments into the table as it was committed last (`at`)."""
    target = table_path.rstrip("/").rsplit("/", 1)[-1]
    lo, end = due[0], due[-1] + 1
    raw = scan_segments(spark, log_path, lo, due[-1], check=False)
    flat = raw if "in_bulk" in raw.columns else log_rows(raw)
    log = check_docs(flat) if doc_type is None else parse_docs(flat, doc_type, strict=True)
    schema = table_schema(doc_type)
    buckets = at.buckets if at else buckets

    # One narrow pass tells what the run needs: at most one row per bucket comes back.
    facts = (
        classify_requests(flat)
        .groupBy(tables.bucket_of(["id"], buckets).alias("bucket"))
        .agg(
            F.count_if(F.col("action").isin(*S.BY_QUERY)).alias("by_query"),
            F.count_if(F.col("code") == S.CODE_UNKNOWN).alias("unknown"),
            F.count("*").alias("requests"),
        )
        .collect()
    )
    by_query = any(f.by_query for f in facts)
    stopped = None
    if any(f.unknown for f in facts):
        errors = segment_errors(log)
        stopped = None if skip_error else errors.agg(F.min("segment_id")).first()[0]
        log, report = apply_error_policy(log, errors, skip_error)
        write_segment_errors(report, table_path)
    changed = None if by_query else [f.bucket for f in facts]
    base = tables.read_table(spark, table_path, schema, at, changed) if at else None
    few = at is not None and sum(f.requests for f in facts) <= LAYER_SHARE * sum(at.rows.values())
    as_layer = few and not by_query and doc_type is not None

    hot = hot_keys(log, ["id"])

    def outcomes() -> DataFrame:
        if not by_query:
            return request_outcomes(log, base, hot=hot)
        if doc_type is None:
            return replay_documents_with_queries(log, base)[1]
        return outcomes_with_queries(log, base, hot=hot)

    def fold() -> DataFrame:
        if doc_type is None:
            return replay_documents_with_queries(log, base)[0] if by_query else replay_documents(log, base, hot=hot)
        return replay_with_queries(log, base, hot=hot) if by_query else replay(log, base, hot=hot)

    if request_retry < 0:
        # Without dead letters a failing request ends its segment, and what follows is judged from the state there.
        failed = split_failures(outcomes(), request_retry)[2]
        first = failed.orderBy("seq").select("segment_id", "seq", "reason").limit(1).collect()
        if first:
            bad, seq, reason = first[0]
            row = [(bad, seq, reason, 1, skip_error)]
            write_segment_errors(spark.createDataFrame(row, SEGMENT_ERROR), table_path)
            log, end = log.where(F.col("seq") < seq), bad + 1
            stopped = None if skip_error else bad
    elif dead_letter_path is not None:
        failed = split_failures(outcomes(), request_retry)[1]
        write_dead_letter(dead_letters(flat, failed, target), dead_letter_path)

    if stopped is not None:
        end = stopped
    if as_layer:
        done = layers.publish_layer(layers.effects_of(log, hot=hot), table_path, end, at, node=node, ts=time.time())
        try:
            layers.compact(spark, table_path, schema, done)
        except tables.CommitConflict:
            pass  # whoever came first compacts next time
    else:
        tables.publish_table(fold(), table_path, end, ["id"], changed, buckets, node, time.time(), at)
    if stopped is not None:
        raise SegmentError(f"segment {stopped} cannot be applied")
