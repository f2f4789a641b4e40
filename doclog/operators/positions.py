"""One log replayed from many positions at once, with by-query requests among it.

What a by-query request does depends on the document at that point, so requests do not combine into one effect ahead
of time. Instead every position opens a lane with an absent document, and all open lanes of a key move on together,
step by step and by-query request by by-query request. Lanes that hold the same document from some point on are one
lane from there on: after the first whole write of a key, all earlier positions share the rest of the work. A target
that already holds the document starts from its own, over the same reduced steps.

The log is reduced once between the cuts (positions and by-query requests). A round takes a bounded number of cuts, which
bounds the rows of a key that meet in one task; the lanes are written between rounds.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doclog import schema as S
from doclog.functions.scale import CHUNK_BITS, hot_keys, materialize
from doclog.operators.barriers import (
    ROUND,
    Rule,
    advance,
    after,
    applicable,
    by_key,
    count_below,
    entry_type,
    reduce_epochs,
    rule_literal,
)
from doclog.operators.fold import doc_fields


@dataclass
class Cut:
    """A position where targets begin (`rule` is None), or a by-query request."""

    segment: int
    kind: int
    seq: int
    item: int
    rule: Rule | None = None

    @property
    def place(self) -> tuple[int, int, int, int]:
        return (self.segment, self.kind, self.seq, self.item)

    def is_past(self) -> Column:
        return F.col("segment_id") >= self.segment if self.rule is None else after(self.rule.position)


def _next_cuts(log: DataFrame, positions: DataFrame, past: Cut | None, limit: int) -> list[Cut]:
    """The first `limit` cuts behind `past`, in log order; a position lies before the requests of its segment."""
    rules = log.where(F.col("action").isin(*S.BY_QUERY)).select(
        "segment_id", F.lit(1).alias("kind"), "seq", "item", "action", "query", "set"
    )
    starts = positions.select(
        F.col("file_position").alias("segment_id"), F.lit(0).alias("kind"), F.lit(S.MIN_LONG).alias("seq"), F.lit(0).alias("item")
    ).distinct()
    at = F.struct("segment_id", "kind", "seq", "item")
    both = rules.unionByName(starts, allowMissingColumns=True)
    if past is not None:
        names = ("segment_id", "kind", "seq", "item")
        both = both.where(at > F.struct(*(F.lit(v).cast(both.schema[n].dataType).alias(n) for n, v in zip(names, past.place))))
    out = []
    for r in both.orderBy(at).limit(limit).collect():
        rule = Rule(r.seq, r.item, r.action, r.query.asDict(), r.set) if r.kind else None
        out.append(Cut(r.segment_id, r.kind, r.seq, r.item, rule))
    return out


def _comparable(kind: T.DataType) -> bool:
    if isinstance(kind, (T.MapType, T.VariantType)):
        return False
    if isinstance(kind, T.ArrayType):
        return _comparable(kind.elementType)
    return all(_comparable(f.dataType) for f in kind.fields) if isinstance(kind, T.StructType) else True


class _Round:
    """The steps of a round with its cuts in between, as one array of entries per key."""

    def __init__(self, log: DataFrame, cuts: Sequence[Cut], past: Cut | None, more: bool, keys, hot, chunk_bits) -> None:
        self.cuts, self.keys = cuts, list(keys)
        self.fields = doc_fields(log)
        self.doc_type = T.StructType([T.StructField(f.name, f.dataType) for f in self.fields])
        part = log.where(~F.col("action").isin(*S.BY_QUERY))
        if past is not None:
            part = part.where(past.is_past())
        if more:
            part = part.where(~cuts[-1].is_past())
        part = part.withColumn("epoch", count_below(cuts, Cut.is_past))
        self.steps = reduce_epochs(part, keys, hot, chunk_bits)
        self.step_type = self.steps.schema["steps"].dataType.elementType

    def todo(self) -> Column:
        kind = entry_type(self.step_type).add("start", T.LongType())
        none = {f.name: F.lit(None).cast(f.dataType) for f in kind.fields}

        def entry(**known: Column) -> Column:
            return F.struct(*((known.get(n, v)).cast(kind[n].dataType).alias(n) for n, v in none.items()))

        steps = F.transform("steps", lambda s: entry(at=s["epoch"] * 2, step=s))
        cuts = [
            entry(at=F.lit(2 * k + 1), start=F.lit(c.segment))
            if c.rule is None
            else entry(at=F.lit(2 * k + 1), rule=rule_literal(c.rule))
            for k, c in enumerate(self.cuts)
        ]
        whole = F.coalesce(steps, F.array().cast(T.ArrayType(kind)))
        if cuts:
            whole = F.concat(whole, F.array(*cuts))
        return F.array_sort(whole, lambda a, b: a["at"] - b["at"])

    def move(self, exists: Column, doc: Column, e: Column, frame: DataFrame) -> Column:
        """The document after an entry, null when there is none."""
        key = {k: (F.col(k), frame.schema[k].dataType) for k in self.keys}
        still, values = advance(exists, doc, e, self.fields, key)
        made = F.struct(*(v.cast(self.doc_type[n].dataType).alias(n) for n, v in values.items()))
        return F.when(still, made).otherwise(F.lit(None).cast(self.doc_type))

    def lanes(self, before: DataFrame | None, begun: Sequence[int]) -> DataFrame:
        """Keys and `lanes`: positions (`from`) and the document that they share (null: absent)."""
        lane = T.StructType([T.StructField("from", T.ArrayType(T.LongType())), T.StructField("doc", self.doc_type)])
        nothing = F.lit(None).cast(self.doc_type)
        frame = self.steps if before is None else before.join(self.steps, self.keys, "full")
        zero = F.array().cast(T.ArrayType(lane))
        if begun:
            zero = F.array(F.struct(F.array(*map(F.lit, begun)).alias("from"), nothing.alias("doc")).cast(lane))
        if before is not None:
            zero = F.coalesce("lanes", zero)

        def together(lanes: Column) -> Column:
            """Lanes of the same document become one."""
            if not _comparable(self.doc_type):
                held = F.filter(lanes, lambda x: x["doc"].isNotNull())
                absent = F.filter(lanes, lambda x: x["doc"].isNull())
                one = F.struct(F.flatten(absent["from"]).alias("from"), nothing.alias("doc")).cast(lane)
                return F.when(F.size(absent) > 0, F.concat(held, F.array(one))).otherwise(held)
            docs = F.array_distinct(F.transform(lanes, lambda x: F.struct(x["doc"].alias("doc"))))

            def all_with(d: Column) -> Column:
                same = F.filter(lanes, lambda x: F.struct(x["doc"].alias("doc")).eqNullSafe(d))
                return F.struct(F.flatten(same["from"]).alias("from"), d["doc"].alias("doc")).cast(lane)

            return F.transform(docs, all_with)

        def merge(lanes: Column, e: Column) -> Column:
            opened = F.struct(F.array(e["start"]).alias("from"), nothing.alias("doc")).cast(lane)
            moved = F.transform(
                lanes,
                lambda x: F.struct(
                    x["from"].alias("from"), self.move(x["doc"].isNotNull(), x["doc"], e, frame).alias("doc")
                ).cast(lane),
            )
            return together(F.when(e["start"].isNotNull(), F.array_append(lanes, opened)).otherwise(moved))

        return frame.select(*self.keys, F.aggregate(self.todo(), zero, merge).alias("lanes"))

    def held(self, before: DataFrame, begun: Sequence[int]) -> DataFrame:
        """`before` (target, file_position, keys, `doc`) with each target's own document after the round."""
        opened = [(c.segment, 2 * k + 1) for k, c in enumerate(self.cuts) if c.rule is None]
        first = F.when(F.lit(False), 0)
        for segment, at in opened:
            first = first.when(F.col("file_position") == segment, at)
        last = begun[-1] if begun else S.MIN_LONG
        first = first.when(F.col("file_position") <= last, -1).otherwise(2 * len(self.cuts) + 2)
        frame = before.join(self.steps, self.keys, "left").withColumn("__first", first)
        todo = F.filter(self.todo(), lambda e: (e["at"] > F.col("__first")) & e["start"].isNull())
        doc = F.aggregate(todo, F.col("doc"), lambda d, e: self.move(d.isNotNull(), d, e, frame))
        return frame.select("target", "file_position", *self.keys, doc.alias("doc"))


def replay_targets_with_queries(
    log: DataFrame,
    positions: DataFrame,
    base: DataFrame | None = None,
    keys: Sequence[str] = ("id",),
    size: int = ROUND,
    hot: list[tuple] | None = None,
    chunk_bits: int = CHUNK_BITS,
) -> DataFrame:
    """Replay a log with by-query requests into many targets, each from its own `file_position`; `base` holds their
    tables by `target`. A target without a position takes no part; by-query requests of no known kind change nothing.

    `segment_id` must grow along the log's order, as in a log that was captured.
    """
    keys = list(keys)
    asked = positions.where("file_position IS NOT NULL").select("target", "file_position")
    first = asked.agg(F.min("file_position")).first()[0]
    if first is None:
        raise ValueError("no positions to replay from")
    log = by_key(applicable(log.where(F.col("segment_id") >= first)), keys)
    hot = hot_keys(log, keys) if hot is None else hot
    fields = doc_fields(log)
    doc_type = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    own = None
    if base is not None:
        doc = F.struct(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in fields)).cast(doc_type)
        own = base.join(asked, "target").select("target", "file_position", *keys, doc.alias("doc"))
    lanes, held, past = None, own, None
    begun: list[int] = []
    while True:
        found = _next_cuts(log, asked, past, size + 1)
        cuts, more = found[:size], len(found) > size
        step = _Round(log, cuts, past, more, keys, hot, chunk_bits)
        lanes = step.lanes(lanes, begun)
        held = None if held is None else step.held(held, begun)
        begun += [c.segment for c in cuts if c.rule is None]
        if not more:
            break
        past = cuts[-1]
        lanes = materialize(lanes, "lanes")
        held = None if held is None else materialize(held, "held")
    names = [f.name for f in fields]
    fresh = (
        lanes.select(*keys, F.inline("lanes"))
        .where("doc IS NOT NULL")
        .select(F.explode("from").alias("file_position"), *keys, "doc")
        .join(asked, "file_position")
        .select("target", *keys, *(F.col(f"doc.{n}").alias(n) for n in names))
    )
    if held is None:
        return fresh
    fresh = fresh.join(own.select("target", *keys), ["target", *keys], "left_anti")
    return fresh.unionByName(
        held.where("doc IS NOT NULL").select("target", *keys, *(F.col(f"doc.{n}").alias(n) for n in names))
    )
