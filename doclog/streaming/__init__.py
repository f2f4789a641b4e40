"""Structured Streaming capture and replay."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from doclog import schema as S
from doclog.plans.jobs import capture_batch, replay_target
from doclog.sources.log import COMMIT, open_writer


def _trigger(writer, available_now: bool, seconds: int):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{seconds} seconds")


def capture_stream(
    requests: DataFrame,
    log_path: str,
    targets: Sequence[str],
    checkpoint: str,
    order_by: Sequence[str] | None = None,
    max_bytes: int = S.SEGMENT_BYTES,
    available_now: bool = False,
    poll_seconds: int = S.POLL_SECONDS,
    first_batch: int = 0,
    name: str = "",
) -> StreamingQuery:
    """Append a stream of requests to the log; each micro-batch closes its segments.

    A repeated micro-batch is recognised by its number and not written twice. A capture that starts over with a new
    checkpoint must set `first_batch` past the batches already in the log. Requests refused because they are aimed
    only partly at targets are kept under `rejected`. A refresh or another administrative request on a target cuts the
    segment where it stands.

    The stream takes the log over as writer `name` when it starts; one that ran before fails at its next batch, without
    leaving anything visible.
    """
    writer_of_log = open_writer(requests.sparkSession, log_path, name)

    def take(batch: DataFrame, batch_id: int) -> None:
        number = first_batch + batch_id
        got = capture_batch(batch, log_path, targets, number, order_by, max_bytes, writer_of_log)
        got.rejected.write.mode("overwrite").parquet(f"{log_path}/rejected/batch_id={number}")

    writer = requests.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return _trigger(writer, available_now, poll_seconds).start()


def replay_stream(
    spark: SparkSession,
    log_path: str,
    table_path: str,
    doc_type: T.StructType | None,
    checkpoint: str,
    available_now: bool = False,
    poll_seconds: int = S.POLL_SECONDS,
    **options,
) -> StreamingQuery:
    """Keep a target table following the log.

    The stream are the commits of the log, so a segment is only seen whole; the table's own commit decides what is due, which
    makes a repeated micro-batch harmless and gives every target its own offset. `options` go to `replay_target`; a
    `position` among them holds for the first micro-batch of the checkpoint only.
    """
    position = options.pop("position", 0)
    commits = spark.readStream.schema(COMMIT).json(f"{log_path}/commits")

    def follow(batch: DataFrame, batch_id: int) -> None:
        first = position if batch_id == 0 else 0
        replay_target(batch.sparkSession, log_path, table_path, doc_type, position=first, **options)

    writer = commits.writeStream.foreachBatch(follow).option("checkpointLocation", checkpoint)
    return _trigger(writer, available_now, poll_seconds).start()
