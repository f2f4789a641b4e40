"""What happens to requests and segments that cannot be applied."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from doclog import schema as S
from doclog.functions.requests import request_code
from doclog.functions.scale import broadcast_if_small


def split_failures(
    outcomes: DataFrame, request_retry: int = S.REQUEST_RETRIES
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(applied, dead letters, failures that fail their segment).

    A request fails for a reason that trying again would not change, so it is tried once; what can pass on a second
    try is a lost task, which Spark repeats itself. A negative `request_retry` switches dead letters off: the
    failures then count against their segment.
    """
    failed = outcomes.where("failed").withColumn("attempts", F.lit(1))
    none = failed.where(F.lit(False))
    applied = outcomes.where("not failed")
    return (applied, none, failed) if request_retry < 0 else (applied, failed, none)


def with_segment_position(log: DataFrame) -> DataFrame:
    """Add `position`: the request's place in its segment, from 1; items of a bulk share it.

    A segment is bounded by its size limit, so one fits a task.
    """
    return log.withColumn("position", F.dense_rank().over(Window.partitionBy("segment_id").orderBy("seq")))


def dead_letters(log: DataFrame, failed: DataFrame, target: str) -> DataFrame:
    """Failed requests as they are stored, in the schema LETTERS: the request as it was logged, with target, segment,
    position in it, reason and attempts."""
    places = with_segment_position(log.select("segment_id", "seq").distinct())
    rows = failed.join(places, ["segment_id", "seq"]).withColumn("target", F.lit(target))
    if "raw" in failed.columns:
        rows = rows.withColumn("doc", F.col("raw"))
    if "raw_upsert" in failed.columns:
        rows = rows.withColumn("upsert", F.col("raw_upsert"))
    kept = [F.col(f.name) if f.name in rows.columns else F.lit(None).alias(f.name) for f in S.LETTERS.fields]
    return rows.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(kept, S.LETTERS.fields)])


def segment_errors(log: DataFrame, failures: DataFrame | None = None) -> DataFrame:
    """First request of each segment that stops it (`stop`, its seq): of unknown kind, or one of `failures`."""
    stops = log.where(request_code(F.col("action")) == S.CODE_UNKNOWN).select(
        "segment_id", "seq", F.lit("kind of request not known").alias("reason")
    )
    if failures is not None:
        stops = stops.unionByName(failures.select("segment_id", "seq", "reason"))
    return stops.groupBy("segment_id").agg(F.min("seq").alias("stop"), F.min_by("reason", "seq").alias("reason"))


def apply_error_policy(
    log: DataFrame, errors: DataFrame, skip_error: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(requests that take effect, report of the segments in error).

    A segment takes effect up to the request that stops it. With `skip_error` the log goes on with the next segment,
    otherwise it ends there. A request of unknown kind stays so, hence each segment is tried once.
    """
    if not skip_error:
        errors = errors.orderBy("segment_id").limit(1)
    marked = broadcast_if_small(errors.select("segment_id", "stop"))
    kept = log.join(marked, "segment_id", "left").where("stop is null or seq < stop")
    if not skip_error:
        last = errors.agg(F.max("segment_id").alias("last")).scalar()
        kept = kept.where(last.isNull() | (F.col("segment_id") <= last))
    report = errors.select(
        "segment_id",
        F.col("stop").alias("seq"),
        "reason",
        F.lit(1).alias("tries"),
        F.lit(skip_error).alias("skipped"),
    )
    return kept.select(*log.columns), report
