"""Consumers of the log: where they start, many at once, starting, stopping and status."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doclog import schema as S
from doclog.functions.scale import CHUNK_BITS, hot_keys
from doclog.operators.barriers import count_below, reduce_epochs
from doclog.operators.fold import doc_fields
from doclog.operators.positions import replay_targets_with_queries
from doclog.operators.segments import page

ROUND_POSITIONS = 64
TARGET_PAGE = 1000


def resolve_start(positions: DataFrame, requested: DataFrame) -> DataFrame:
    """Per requested target its `start`: the position asked for if positive, else the stored one, else 1."""
    stored = positions.select("target", F.col("file_position").alias("stored"))
    asked = F.col("requested")
    start = F.when(asked > 0, asked).otherwise(F.coalesce("stored", F.lit(1).cast("long")))
    return requested.join(stored, "target", "left").withColumn("start", start)


def replay_targets(
    log: DataFrame,
    positions: DataFrame,
    base: DataFrame | None = None,
    keys: Sequence[str] = ("id",),
    hot: list[tuple] | None = None,
    chunk_bits: int = CHUNK_BITS,
) -> DataFrame:
    """Replay one log into many targets, each from its own `file_position`; `base` holds their tables by `target`.

    The log is read and reduced once, between the distinct positions; a target then combines the reduced rows from
    its position on. So the wide rows are never copied per target. A target without a position takes no part. With
    by-query requests in the log, targets go through `positions.replay_targets_with_queries`.
    """
    if "query" in log.columns and not log.where(F.col("action").isin(*S.BY_QUERY)).isEmpty():
        return replay_targets_with_queries(log, positions, base, keys, hot=hot, chunk_bits=chunk_bits)
    hot = hot_keys(log, keys) if hot is None else hot
    parts = [
        _replay_round(log, some, base, list(keys), hot, chunk_bits) for some in _rounds_of_targets(positions)
    ]
    if not parts:
        raise ValueError("no positions to replay from")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _rounds_of_targets(positions: DataFrame) -> Iterator[dict[int, list[str]]]:
    """Targets by position, in rounds of bounded size; the control table is fetched page by page."""
    order = F.struct("file_position", "target")
    listed = positions.where("file_position is not null").select(order.alias("at"))
    last = None
    while True:
        rest = listed if last is None else listed.where(F.col("at") > F.struct(*[F.lit(v) for v in last]))
        rows = [r[0] for r in rest.orderBy("at").limit(TARGET_PAGE).collect()]
        some: dict[int, list[str]] = {}
        for at in rows:
            if at.file_position not in some and len(some) == ROUND_POSITIONS:
                yield some
                some = {}
            some.setdefault(at.file_position, []).append(at.target)
        if some:
            yield some
        if len(rows) < TARGET_PAGE:
            return
        last = rows[-1]


def _replay_round(log, targets: dict[int, list[str]], base, keys: list[str], hot, chunk_bits: int) -> DataFrame:
    fields = doc_fields(log)
    starts = sorted(targets)
    used = log.where(F.col("segment_id") >= starts[0])
    epoch = count_below(starts, lambda p: F.col("segment_id") >= p)
    steps = reduce_epochs(used.withColumn("epoch", epoch), keys, hot, chunk_bits)
    step_type = steps.schema["steps"].dataType.elementType

    def names(p: int) -> Column:
        return F.array(*[F.lit(t) for t in targets[p]]).alias("targets")

    # `later` holds, for each touched epoch, the effect of everything from it on; a position needs one of them.
    cuts = F.array(*[F.struct(F.lit(i + 1).alias("from_epoch"), names(p)) for i, p in enumerate(starts)])
    per_target = (
        steps.withColumn("later", effects_from_each(F.col("steps"), step_type, [f.name for f in fields]))
        .select(*keys, "later", F.inline(cuts))
        .withColumn("effect", F.expr("try_element_at(filter(later, s -> s.epoch >= from_epoch), -1)"))
        .where("effect is not null")
        .select(F.explode("targets").alias("target"), *keys, "effect")
    )
    if base is None:
        alone = F.col("effect.if_absent")
        values = [alone.getField(f.name).getField("v").alias(f.name) for f in fields]
        return per_target.where(alone.getField("exists")).select("target", *keys, *values)
    mine = base.where(F.col("target").isin(*[t for names in targets.values() for t in names]))
    start = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
    joined = per_target.join(mine.select("target", *keys, start.alias("start")), ["target", *keys], "full")
    was = F.col("start").isNotNull()
    effect = F.when(was, F.col("effect.if_present")).otherwise(F.col("effect.if_absent"))
    values = []
    for f in fields:
        new = effect.getField(f.name)
        old = F.col("start").getField(f.name)
        values.append(F.when(new.isNotNull(), new.getField("v")).otherwise(old).alias(f.name))
    return joined.where(F.coalesce(effect.getField("exists"), was)).select("target", *keys, *values)


def effects_from_each(steps: Column, step_type: T.DataType, fields: Sequence[str]) -> Column:
    """For each step, latest first, the combined effect of it and all later ones, on an absent and a present document."""
    parts = ["exists", *fields]
    case_type = step_type["if_absent"].dataType

    def then(first: Column, present: bool, rest: Column) -> Column:
        """The effect `first` on a document that is (not) there, followed by `rest`."""
        there = F.coalesce(first["exists"], F.lit(present))
        second = F.when(there, rest["if_present"]).otherwise(rest["if_absent"])
        return F.struct(*[F.coalesce(second[n], first[n]).alias(n) for n in parts]).cast(case_type)

    def add(done: Column, step: Column) -> Column:
        both = F.struct(
            step["epoch"].alias("epoch"),
            then(step["if_absent"], False, done["rest"]).alias("if_absent"),
            then(step["if_present"], True, done["rest"]).alias("if_present"),
        ).cast(step_type)
        return F.struct(both.alias("rest"), F.array_append(done["all"], both).alias("all"))

    nothing = F.struct(*[F.lit(None).cast(case_type[n].dataType).alias(n) for n in parts]).cast(case_type)
    none = F.struct(F.lit(0).alias("epoch"), nothing.alias("if_absent"), nothing.alias("if_present")).cast(step_type)
    zero = F.struct(none.alias("rest"), F.array().cast(T.ArrayType(step_type)).alias("all"))
    latest_first = F.array_sort(steps, lambda a, b: b["epoch"] - a["epoch"])
    return F.aggregate(latest_first, zero, add, lambda done: done["all"])


def start_consumer(positions: DataFrame, target: str, node: str, now: Column, position: int = 0) -> DataFrame:
    """The target's new position row, owned by `node`; an error when another node owns the target."""
    asked = positions.sparkSession.range(1).select(
        F.lit(target).alias("target"), F.lit(position).cast("long").alias("requested")
    )
    owner = positions.select("target", F.col("node_name").alias("owner"))
    busy = (F.trim(F.coalesce("owner", F.lit(""))) != "") & (F.col("owner") != node)
    message = F.concat(F.lit("Another node replays this target: "), F.col("owner"))
    return resolve_start(positions, asked).join(owner, "target", "left").select(
        "target",
        F.lit("index").alias("doc_type"),
        F.when(busy, F.raise_error(message).cast("string")).otherwise(F.lit(node)).alias("node_name"),
        F.col("start").alias("file_position"),
        now.alias("ts"),
    )


def stop_consumer(positions: DataFrame, target: str, node: str) -> DataFrame:
    """One row `found`, `stop`, `working`: stopping blanks the owner and keeps the position; only the owner can."""
    asked = positions.sparkSession.range(1).select(F.lit(target).alias("target"))
    stored = positions.select("target", F.coalesce("node_name", F.lit("")).alias("owner"), F.lit(True).alias("known"))
    owner = F.coalesce("owner", F.lit(""))
    return asked.join(stored, "target", "left").select(
        "target",
        F.coalesce("known", F.lit(False)).alias("found"),
        (owner == node).alias("stop"),
        owner.alias("working"),
    )


def release(positions: DataFrame, target: str, node: str, now: Column) -> DataFrame:
    """Positions after `stop_consumer`."""
    stopped = (F.col("target") == target) & (F.col("node_name") == node)
    return positions.withColumns(
        {
            "node_name": F.when(stopped, "").otherwise(F.col("node_name")),
            "ts": F.when(stopped, now).otherwise(F.col("ts")),
        }
    )


def consumer_status(
    positions: DataFrame, segments: DataFrame, now: Column, alive_seconds: int = S.ALIVE_SECONDS
) -> DataFrame:
    """Per consumer: its row, whether it runs, when its last finished segment was written, and its distance to the
    writer (`writer_position` is the segment being written next)."""
    done = segments.select(
        (F.col("segment_id") + 1).alias("file_position"), F.col("finished_at").alias("file_timestamp")
    )
    writer = segments.agg(F.max("segment_id").alias("last"), F.max_by("finished_at", "segment_id").alias("at"))
    writer_position = (F.coalesce(writer.select("last").scalar(), F.lit(0)) + 1).cast("long")
    age = F.unix_timestamp(now) - F.unix_timestamp(F.col("ts"))
    running = (F.trim(F.coalesce("node_name", F.lit(""))) != "") & (age < alive_seconds)
    return positions.join(done, "file_position", "left").select(
        "target",
        F.lit(True).alias("found"),
        "doc_type",
        "node_name",
        "file_position",
        "ts",
        F.coalesce(running, F.lit(False)).alias("running"),
        "file_timestamp",
        writer_position.alias("writer_position"),
        writer.select("at").scalar().alias("writer_timestamp"),
        (writer_position - F.col("file_position")).alias("lag"),
    )


def target_status(
    positions: DataFrame, segments: DataFrame, target: str, now: Column, alive_seconds: int = S.ALIVE_SECONDS
) -> DataFrame:
    """Status of one target; `found` is false, and the rest of its row empty, when it has no position."""
    asked = positions.sparkSession.range(1).select(F.lit(target).alias("target"))
    status = consumer_status(positions.where(F.col("target") == target), segments, now, alive_seconds)
    return asked.join(status, "target", "left").withColumn("found", F.coalesce("found", F.lit(False)))


def consumer_list(
    positions: DataFrame,
    segments: DataFrame,
    now: Column,
    start: int = 0,
    size: int = S.PAGE_SIZE,
    alive_seconds: int = S.ALIVE_SECONDS,
) -> DataFrame:
    """One page of consumer statuses, by target. The page is taken before the joins."""
    listed = page(positions.where(F.col("doc_type") == "index"), ["target"], start, size)
    return consumer_status(listed, segments, now, alive_seconds)
