"""Replaying logs that also hold by-query requests, which touch every document matching at that point.

A by-query request looks at one document at a time, so the log still splits by key. The requests between two by-query
ones form an epoch. Whatever a key did in an epoch is reduced, before the shuffle by key, to its effect on a document
that is absent and on one that is present; a key then has at most one small row per epoch, and the by-query requests
(a bounded batch of them, held as a literal) are applied between those rows. Longer lists of by-query requests run as
several such rounds with the table written in between.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doclog import schema as S
from doclog.functions.scale import CHUNK_BITS, by_heat, hot_keys, materialize
from doclog.operators.fold import (
    doc_fields,
    effects,
    label_outcomes,
    merge_effects,
    replay,
    request_outcomes,
    with_state,
    without_key,
)

ROUND = 64
"""By-query requests per round: bounds the rows of one key that meet in one task and the size of the plan."""

Position = tuple[int, int]


def after(position: Position) -> Column:
    seq, item = position
    return (F.col("seq") > seq) | ((F.col("seq") == seq) & (F.col("item") > item))


def count_below(cuts: Sequence, is_past) -> Column:
    """How many of the ascending `cuts` the row is past, as a balanced tree of comparisons."""

    def pick(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(is_past(cuts[mid]), pick(mid + 1, hi)).otherwise(pick(lo, mid))

    return pick(0, len(cuts))


@dataclass
class Rule:
    """A by-query request: structured `query` and string `set`, or a condition `where` and expressions `assign`,
    each a column or SQL text."""

    seq: int
    item: int
    action: str
    query: dict | None = None
    set: dict[str, str] | None = None
    where: str | Column | None = None
    assign: dict[str, str | Column] = field(default_factory=dict)

    @property
    def position(self) -> Position:
        return (self.seq, self.item)


def by_key(log: DataFrame, keys: Sequence[str] = ("id",), patch: Column | None = None) -> DataFrame:
    """Turn by-query requests for one value of the key into plain requests for that key.

    They then need no round of their own. `lenient` marks them: unlike plain updates they do not fail when nothing
    matches. `patch` is the document an update by query amounts to, by default a struct of the declared fields.
    """
    if len(keys) != 1 or "query" not in log.columns:
        return log
    (key,) = keys
    kind, query, action = log.schema[key].dataType, F.col("query"), F.col("action")
    hit = F.coalesce(
        action.isin(*S.BY_QUERY) & (query["kind"] == "term") & (query["field"] == key), F.lit(False)
    )
    none = F.lit(None)
    if patch is None:
        patch = F.struct(
            *[_assigned(F.struct("set"), f, none.cast(f.dataType)).alias(f.name) for f in doc_fields(log)]
        )
    is_update = hit & (action == "update_by_query")
    changes = {
        "action": F.when(is_update, "update").when(hit, "delete").otherwise(action),
        key: F.when(hit, query["lo"].try_cast(kind)).otherwise(F.col(key)),
        "doc": F.when(is_update, patch).otherwise(F.col("doc")),
        "lenient": hit,
    }
    carried = F.coalesce(F.map_keys("set"), F.array().cast("array<string>"))
    before = F.col("present") if "present" in log.columns else none.cast("array<string>")
    changes["present"] = F.when(is_update, carried).otherwise(before)
    changes |= {c: F.when(~hit, F.col(c)) for c in ("upsert", "doc_as_upsert") if c in log.columns}
    # A value that is no key at all matches nothing.
    return log.withColumns(changes).where(~(F.col("lenient") & F.col(key).isNull()))


def applicable(log: DataFrame) -> DataFrame:
    """`log` without by-query requests whose query is of no known kind; these fail and change nothing."""
    return log if "query" not in log.columns else log.where(~unknown_query())


def unknown_query() -> Column:
    known = F.coalesce(F.col("query.kind").isin(*S.QUERY_KINDS), F.lit(False))
    return F.col("action").isin(*S.BY_QUERY) & ~known


def next_rules(log: DataFrame, past: Position | None, limit: int) -> list[Rule]:
    """The first `limit` by-query requests after `past`, in log order."""
    rows = log.where(F.col("action").isin(*S.BY_QUERY))
    if past is not None:
        rows = rows.where(after(past))
    picked = rows.select("seq", "item", "action", "query", "set").orderBy("seq", "item").limit(limit).collect()
    return [Rule(r.seq, r.item, r.action, r.query.asDict() if r.query else {}, r.set) for r in picked]


def apply_delete_by_query(state: DataFrame, predicate: Column) -> DataFrame:
    return state.where(~F.coalesce(predicate, F.lit(False)))


def apply_update_by_query(state: DataFrame, predicate: Column, assign: dict[str, Column]) -> DataFrame:
    """Assign to the matching rows; every expression sees the row as it was before."""
    return state.select(
        *[
            F.when(predicate, assign[c].cast(state.schema[c].dataType)).otherwise(F.col(c)).alias(c)
            if c in assign
            else F.col(c)
            for c in state.columns
        ]
    )


def reduce_epochs(
    keyed: DataFrame,
    keys: Sequence[str],
    hot: list[tuple] | None = None,
    chunk_bits: int = CHUNK_BITS,
) -> DataFrame:
    """Per key one array `steps` with its effect in each `epoch` it was touched in."""
    fields = doc_fields(keyed)

    def reduce(part: DataFrame, bits: int | None) -> DataFrame:
        rows = with_state(part, keys, bits, ["epoch"])
        both = [
            *effects(rows, fields, F.coalesce("known", F.lit(False)), "_a"),
            *effects(rows, fields, F.coalesce("known", F.lit(True)), "_p"),
        ]
        if bits is None:
            return rows.groupBy(*keys, "epoch").agg(*both)
        chunks = rows.groupBy(*keys, "epoch", "chunk").agg(*both)
        return chunks.groupBy(*keys, "epoch").agg(
            *merge_effects(fields, "chunk", "_a"), *merge_effects(fields, "chunk", "_p")
        )

    def case(suffix: str) -> Column:
        return F.struct(*[F.col(f"{n}{suffix}").alias(n) for n in ["exists", *[f.name for f in fields]]])

    step = F.struct("epoch", case("_a").alias("if_absent"), case("_p").alias("if_present"))
    return by_heat(keyed, keyed, keys, reduce, hot, chunk_bits).groupBy(*keys).agg(F.collect_list(step).alias("steps"))


def _matches(rule: Column, doc: Column, key: dict[str, tuple[Column, T.DataType]], fields) -> Column:
    """Does the document match the rule's query? Values are compared in the field's own type."""
    match = F.lit(False)
    known = {f.name: (doc.getField(f.name), f.dataType) for f in fields} | key
    for name, (value, kind) in known.items():
        if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            continue
        lo, hi = rule["lo"].try_cast(kind), rule["hi"].try_cast(kind)
        within = (rule["lo"].isNull() | (value >= lo)) & (rule["hi"].isNull() | (value <= hi))
        hit = F.when(rule["kind"] == "term", value == lo).when(rule["kind"] == "range", within)
        match = F.when(rule["field"] == name, hit).otherwise(match)
    return F.coalesce(F.when(rule["kind"] == "match_all", F.lit(True)).otherwise(match), F.lit(False))


def _assigned(rule: Column, f: T.StructField, old: Column) -> Column:
    text = F.try_element_at(rule["set"], F.lit(f.name))
    nested = isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
    new = F.from_json(text, f.dataType) if nested else text.try_cast(f.dataType)
    return F.when(F.coalesce(F.map_contains_key(rule["set"], F.lit(f.name)), F.lit(False)), new).otherwise(old)


_RULE = "struct<action:string,kind:string,field:string,lo:string,hi:string,set:map<string,string>>"


def rule_literal(rule: Rule) -> Column:
    query = rule.query or {}
    assign = (
        F.create_map(*[F.lit(v) for kv in rule.set.items() for v in kv]) if rule.set else F.lit(None)
    ).cast("map<string,string>")
    text = {n: query.get(n) for n in ("kind", "field", "lo", "hi")}
    values = [F.lit(None if v is None else str(v)).cast("string").alias(n) for n, v in text.items()]
    return F.struct(F.lit(rule.action).alias("action"), *values, assign.alias("set")).cast(_RULE)


def advance(exists: Column, doc: Column, e: Column, fields: Sequence[T.StructField], key: dict) -> tuple[Column, dict]:
    """(does the document exist, its fields) after the entry `e`: a reduced step, or a by-query request."""
    step, rule = e["step"], e["rule"]
    is_step = step.isNotNull()
    effect = F.when(exists, step["if_present"]).otherwise(step["if_absent"])
    hit = exists & _matches(rule, doc, key, fields)
    still = F.when(is_step, F.coalesce(effect["exists"], exists)).otherwise(
        exists & ~(hit & (rule["action"] == "delete_by_query"))
    )
    values = {}
    for f in fields:
        old, new = doc.getField(f.name), effect.getField(f.name)
        by_rule = F.when(hit & (rule["action"] == "update_by_query"), _assigned(rule, f, old)).otherwise(old)
        values[f.name] = F.when(is_step, F.when(new.isNotNull(), new.getField("v")).otherwise(old)).otherwise(by_rule)
    return still, values


def fold_steps(
    per_key: DataFrame, rules: Sequence[Rule], fields: Sequence[T.StructField], keys: Sequence[str], step_type
) -> DataFrame:
    """Run each key's steps and the rules between them, from the document in column `start` (null: absent).

    Adds `state`: whether the document exists, its fields, and whether it existed when each epoch began.
    """
    doc_type = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    typed_key = {k: (F.col(k), per_key.schema[k].dataType) for k in keys}
    no_step, no_rule = F.lit(None).cast(step_type), F.lit(None).cast(_RULE)

    def entry(at: Column, step: Column, rule: Column) -> Column:
        return F.struct(at.cast("int").alias("at"), step.alias("step"), rule.alias("rule"))

    todo = F.transform("steps", lambda s: entry(s["epoch"] * 2, s, no_rule))
    if rules:
        todo = F.concat(
            F.coalesce(todo, F.array().cast(T.ArrayType(entry_type(step_type)))),
            F.array(*[entry(F.lit(2 * i + 1), no_step, rule_literal(r)) for i, r in enumerate(rules)]),
        )
    todo = F.array_sort(todo, lambda a, b: a["at"] - b["at"])

    def as_state(exists: Column, values: dict[str, Column], began: Column) -> Column:
        doc = F.struct(*[v.cast(doc_type[n].dataType).alias(n) for n, v in values.items()])
        return F.struct(exists.alias("exists"), doc.alias("doc"), began.alias("began"))

    began_type = "array<struct<epoch:int,exists:boolean>>"
    zero = as_state(
        F.col("start").isNotNull(),
        {f.name: F.col("start").getField(f.name) for f in fields},
        F.array().cast(began_type),
    )

    def merge(state: Column, e: Column) -> Column:
        step, exists = e["step"], state["exists"]
        is_step = step.isNotNull()
        still, values = advance(exists, state["doc"], e, fields, typed_key)
        mark = F.struct(step["epoch"].cast("int").alias("epoch"), exists.alias("exists"))
        began = F.when(is_step, F.array_append(state["began"], mark)).otherwise(state["began"])
        return as_state(still, values, began.cast(began_type))

    return per_key.withColumn("state", F.aggregate(todo, zero, merge))


def entry_type(step_type) -> T.StructType:
    rule = T.StructType(
        [T.StructField(n, T.StringType()) for n in ("action", "kind", "field", "lo", "hi")]
        + [T.StructField("set", S.SET)]
    )
    return T.StructType(
        [T.StructField("at", T.IntegerType()), T.StructField("step", step_type), T.StructField("rule", rule)]
    )


def _round(part: DataFrame, base: DataFrame | None, rules: Sequence[Rule], keys: Sequence[str], hot, chunk_bits: int):
    """(keyed rows with their epoch, per-key states) of one round."""
    keys = list(keys)
    fields = doc_fields(part)
    keyed = part.where(~F.col("action").isin(*S.BY_QUERY))
    keyed = keyed.withColumn("epoch", count_below([r.position for r in rules], after))
    steps = reduce_epochs(keyed, keys, hot, chunk_bits)
    start = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
    if base is None:
        per_key = steps.withColumn("start", F.lit(None).cast(_type_of(fields)))
    else:
        per_key = steps.join(base.select(*keys, start.alias("start")), keys, "full")
    step_type = steps.schema["steps"].dataType.elementType
    return keyed, fold_steps(per_key, rules, fields, keys, step_type)


def _type_of(fields) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in fields])


def _states(per_key: DataFrame, keys: Sequence[str]) -> DataFrame:
    return per_key.where("state.exists").select(*keys, "state.doc.*")


def rounds(log: DataFrame, size: int):
    """Yield (part of the log, its by-query requests, last?) with at most `size` requests each."""
    past: Position | None = None
    while True:
        found = next_rules(log, past, size + 1)
        rules, more = found[:size], len(found) > size
        part = log if past is None else log.where(after(past))
        if more:
            part = part.where(~after(rules[-1].position))
        yield part, rules, not more
        if not more:
            return
        past = rules[-1].position


def replay_with_queries(
    log: DataFrame,
    base: DataFrame | None = None,
    keys: Sequence[str] = ("id",),
    size: int = ROUND,
    hot: list[tuple] | None = None,
    chunk_bits: int = CHUNK_BITS,
) -> DataFrame:
    """Fold a log that may hold by-query requests (columns `query`, `set`) into the table of surviving documents.

    By-query requests whose query is of no known kind change nothing.
    """
    log, state = by_key(applicable(log), keys), base
    hot = hot_keys(log, keys) if hot is None else hot
    for part, rules, last in rounds(log, size):
        if not rules:
            return replay(part, state, keys, hot, chunk_bits)
        state = _states(_round(part, state, rules, keys, hot, chunk_bits)[1], keys)
        if not last:
            state = materialize(state, "round")
    return state


def outcomes_with_queries(
    log: DataFrame,
    base: DataFrame | None = None,
    keys: Sequence[str] = ("id",),
    size: int = ROUND,
    hot: list[tuple] | None = None,
    chunk_bits: int = CHUNK_BITS,
) -> DataFrame:
    """`request_outcomes` for a log that may hold by-query requests: one outcome for every request.

    A by-query request fails when its query is of no known kind, whatever it would have met.
    """
    keys = list(keys)
    whole, log = log, by_key(applicable(log), keys)
    hot = hot_keys(log, keys) if hot is None else hot
    own = ~F.col("lenient") if "lenient" in log.columns else F.lit(True)
    state, parts = base, [] if "query" not in whole.columns else [by_query_outcomes(whole, log.columns)]
    for part, rules, last in rounds(log, size):
        if not rules:
            parts.append(request_outcomes(part, state, keys, hot, chunk_bits).where(own))
            break
        keyed, per_key = _round(part, state, rules, keys, hot, chunk_bits)
        began = per_key.select(*keys, F.inline("state.began")).withColumnRenamed("exists", "began")
        judged = by_heat(keyed, keyed, keys, lambda rows, bits: _judge(rows, began, keys, bits), hot, chunk_bits)
        parts.append(label_outcomes(without_key(keyed.drop("epoch"), judged, keys).where(own), keys))
        if not last:
            state = materialize(_states(per_key, keys), "round")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def by_query_outcomes(log: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Outcomes of the by-query requests themselves, with `columns` as far as the log has them."""
    rows = log.where(F.col("action").isin(*S.BY_QUERY))
    reason = F.when(unknown_query(), "kind of query not known")
    done = F.when(F.col("action") == "delete_by_query", "deleted").otherwise("updated")
    kept = [F.col(c) if c in log.columns else F.lit(None).alias(c) for c in columns]
    return rows.select(*kept, F.lit(False).alias("exists_before"), reason.alias("reason")).withColumns(
        {
            "failed": F.col("reason").isNotNull(),
            "result": F.when(F.col("reason").isNotNull(), "failed").otherwise(done),
        }
    )


def _column(e: str | Column) -> Column:
    return F.expr(e) if isinstance(e, str) else e


def _judge(rows: DataFrame, began: DataFrame, keys: list[str], bits: int | None) -> DataFrame:
    """Add `exists_before` to rows, given whether their document existed when their epoch began."""
    names, state = rows.columns, with_state(rows, keys, bits, ["epoch"])
    group = [*keys, "epoch"]
    if bits is not None:
        # Epoch starts meet the rows chunk by chunk, so a hot key is not joined as one group.
        began = state.select(*group, "chunk").distinct().join(began, group)
        group = [*group, "chunk"]
    exists = F.coalesce("known", "began", F.lit(False)).alias("exists_before")
    return state.join(began, group).select(*[n for n in names if n != "epoch"], exists)


def replay_by_epochs(
    log: DataFrame, rules: Sequence[Rule], base: DataFrame | None = None, keys: Sequence[str] = ("id",)
) -> DataFrame:
    """Fold with by-query requests given as SQL, one epoch after another: any predicate, any expression.

    The table is written after each epoch, so the plan stays flat. For a handful of rules; `replay_with_queries`
    handles many at once.
    """
    keyed = log.where(~F.col("action").isin(*S.BY_QUERY))
    fields, past, state = doc_fields(log), None, base
    for rule in sorted(rules, key=lambda r: r.position):
        part = keyed.where(~after(rule.position))
        if past is not None:
            part = part.where(after(past))
        past = rule.position
        if state is None or not part.isEmpty():
            state = replay(part, state, keys)
        where = _column(rule.where)
        if rule.action == "delete_by_query":
            state = apply_delete_by_query(state, where)
        else:
            state = apply_update_by_query(state, where, {n: _column(e) for n, e in rule.assign.items()})
        state = materialize(state, "epoch")
    rest = keyed if past is None else keyed.where(after(past))
    return replay(rest, state, keys).select(*keys, *[f.name for f in fields])
