"""The fold for documents without a declared schema: `doc` is JSON text before and after.

A patch merges into the document at every level: objects meet field by field, everything else is replaced. Documents
are taken apart into paths, the objects on the way included, and what is left of a path is decided by three maxima,
which combine over chunks in any order: its latest write, its latest write of something other than an object (which
ends all that lay below), and the latest write of the whole document. Values travel as variants, so numbers, arrays and
nulls come out as they went in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doclog import schema as S
from doclog.functions.scale import CHUNK_BITS, by_heat, hot_keys, materialize
from doclog.operators.barriers import (
    ROUND,
    Rule,
    after,
    applicable,
    apply_delete_by_query,
    apply_update_by_query,
    by_key,
    by_query_outcomes,
    rounds,
)
from doclog.operators.fold import brings, readable, request_outcomes, takes_effect, upsert_text, with_base, with_state

FIELDS = "map<string,variant>"


MAX_DEPTH = 20
"""Objects are merged down to this level; deeper ones are values, replaced as a whole."""

_PART = "struct<path:array<string>,leaf:boolean,value:variant>"


def check_docs(log: DataFrame) -> DataFrame:
    """Add `valid`, unless a captured log has it, and complete `upsert`."""
    valid = {} if "valid" in log.columns else {"valid": readable(log)}
    return log.withColumns(valid | upsert_text(log))


def paths(doc: Column, depth: int = MAX_DEPTH) -> Column:
    """The JSON object `doc` as an array of (path, leaf, value): objects on the way have no value and are no leaves."""
    none = F.array().cast(f"array<{_PART}>")

    def parts(fields: Column, above: Column, left: int) -> Column:
        def one(e: Column) -> Column:
            path = F.array_append(above, e["key"])
            leaf = F.struct(path.alias("path"), F.lit(True).alias("leaf"), e["value"].alias("value")).cast(_PART)
            if left <= 1:
                return F.array(leaf)
            inner = F.try_variant_get(e["value"], "$", FIELDS)
            node = F.struct(path.alias("path"), F.lit(False).alias("leaf"), F.lit(None).cast("variant").alias("value"))
            below = F.concat(F.array(node.cast(_PART)), parts(inner, path, left - 1))
            return F.when(inner.isNull(), F.array(leaf)).otherwise(below)

        return F.flatten(F.transform(F.map_entries(fields), one))

    return F.coalesce(parts(F.from_json(doc, FIELDS), F.array().cast("array<string>"), depth), none)


def _entries(full: Column, live: Column, doc: Column) -> Column:
    """An entry without a path for a full write, and one entry per path."""
    kind = "array<struct<path:array<string>,live:boolean,leaf:boolean,value:variant>>"
    none = F.array().cast(kind)
    mark = F.struct(
        F.lit(None).cast("array<string>").alias("path"), live.alias("live"), F.lit(False).alias("leaf"),
        F.lit(None).cast("variant").alias("value"),
    )
    below = F.transform(
        paths(doc),
        lambda e: F.struct(e["path"].alias("path"), F.lit(True).alias("live"), e["leaf"].alias("leaf"), e["value"].alias("value")),
    )
    return F.concat(F.when(full, F.array(mark).cast(kind)).otherwise(none), F.coalesce(below.cast(kind), none))


def _text(parts: Column) -> Column:
    """The JSON object made of (path, leaf, value) in the order of their paths, each behind the object it lies in."""

    def levels(e: Column) -> Column:
        """Objects that are open behind an entry."""
        return F.size(e["path"]) + F.when(e["leaf"], 0).otherwise(1)

    def piece(e: Column, i: Column) -> Column:
        before = F.get(parts, i - 1)
        still = F.when(i == 0, 1).otherwise(levels(before))
        depth = F.size(e["path"])
        first = (i == 0) | (~before["leaf"] & (depth > F.size(before["path"])))
        named = F.to_json(F.array(F.element_at(e["path"], -1)))
        # `["name"]` without its brackets is the name as JSON writes it.
        name = F.substring(named, F.lit(2), F.length(named) - 2)
        value = F.when(e["leaf"], F.coalesce(F.to_json(e["value"]), F.lit("null"))).otherwise("{")
        return F.concat(F.repeat(F.lit("}"), still - depth), F.when(first, "").otherwise(","), name, F.lit(":"), value)

    last = F.get(parts, F.size(parts) - 1)
    closing = F.when(F.size(parts) == 0, 1).otherwise(levels(last))
    return F.concat(F.lit("{"), F.array_join(F.transform(parts, piece), ""), F.repeat(F.lit("}"), closing))


def _latest(place: Column, leaf: Column, around: Column, kept: Column) -> list[Column]:
    return [
        F.max_by(kept, place).alias("kept"),
        F.max(place).alias("at"),
        F.max(leaf).alias("leaf_at"),
        F.max(around).alias("around"),
    ]


def replay_documents(
    log: DataFrame,
    base: DataFrame | None = None,
    keys: Sequence[str] = ("id",),
    hot: list[tuple] | None = None,
    chunk_bits: int = CHUNK_BITS,
) -> DataFrame:
    """Fold a log of index, create, update and delete requests into keys and JSON documents.

    Paths are reduced where the rows of their key are; those of a hot key inside each of its chunks first.
    """
    keys, log = list(keys), check_docs(log)
    full, writes = F.col("action").isin(*S.FULL_WRITES), F.col("action").isin(*S.DOC_WRITES)

    def fold(part: DataFrame, bits: int | None) -> DataFrame:
        rows = with_state(part, keys, bits)
        exists = F.coalesce("known", F.lit(False))
        opens, doc = brings(rows) & ~exists, F.when(writes, F.col("doc"))
        if "upsert" in rows.columns:
            doc = F.when(opens, F.col("upsert")).otherwise(doc)
        chunk = F.lit(0).cast("long") if bits is None else F.col("chunk")
        parts = rows.where(takes_effect(rows, exists)).select(
            *keys, chunk.alias("chunk"), "code", F.inline(_entries(full | opens, F.col("action") != "delete", doc))
        )
        at, kept = F.struct("chunk", "code"), F.struct("live", "leaf", "value")
        first = _latest(at, F.when(F.col("leaf"), at), ~F.col("leaf"), kept)
        if bits is None:
            return parts.groupBy(*keys, "path").agg(*first)
        chunks = parts.groupBy(*keys, "chunk", "path").agg(*first)
        return chunks.groupBy(*keys, "path").agg(
            *_latest(F.col("at"), F.col("leaf_at"), F.col("around"), F.col("kept"))
        )

    found = by_heat(log, with_base(log, base, keys), keys, fold, hot, chunk_bits)
    # What was written before the last full write is gone.
    mark = F.max(F.when(F.col("path").isNull(), F.struct("at", "kept.live"))).over(Window.partitionBy(*keys))
    alive = found.withColumn("mark", mark).where("mark.live and at >= mark.at")
    part = F.struct("path", "kept.leaf", "kept.value", "at", "leaf_at", "around")
    parts = F.array_sort(
        F.collect_list(F.when(F.col("path").isNotNull(), part)),
        lambda a, b: F.when(a["path"] < b["path"], -1).when(a["path"] > b["path"], 1).otherwise(0),
    )
    # So is what was written before the last value in the place of an object around it. Few paths were ever both.
    whole = alive.groupBy(*keys).agg(parts.alias("parts"))
    ends = F.map_from_entries(
        F.transform(
            F.filter("parts", lambda e: e["leaf_at"].isNotNull() & e["around"]), lambda e: F.struct(e["path"], e["leaf_at"])
        )
    )

    def covered(e: Column, ends: Column) -> Column:
        around = F.transform(F.sequence(F.lit(1), F.size(e["path"]) - 1), lambda n: F.slice(e["path"], F.lit(1), n))
        ended = F.exists(around, lambda p: F.coalesce(F.try_element_at(ends, p) > e["at"], F.lit(False)))
        return (F.size(e["path"]) > 1) & ended

    whole = whole.withColumn("ends", ends)
    kept = whole.select(*keys, F.filter("parts", lambda e: ~covered(e, F.col("ends"))).alias("parts"))
    return kept.select(*keys, _text(F.col("parts")).alias("doc"))


def _field(name: str) -> Column:
    return F.try_element_at(F.from_json("doc", FIELDS), F.lit(name))


def _literal(text: str) -> Column:
    """A value given as text: JSON if it reads as JSON, else a string."""
    return F.coalesce(F.try_parse_json(F.lit(text)), F.lit(text).cast("variant"))


def document_rule(rule: Rule, keys: Sequence[str] = ("id",)) -> Rule:
    """A structured by-query request as a condition on JSON documents and a new document."""
    q = rule.query or {}
    name, lo, hi = q.get("field"), q.get("lo"), q.get("hi")
    text = F.col(name).cast("string") if name in keys else _field(name or "").cast("string")

    def compare(bound: str, op) -> Column:
        number, limit = text.try_cast("double"), F.lit(bound).try_cast("double")
        return F.when(limit.isNotNull() & number.isNotNull(), op(number, limit)).otherwise(op(text, F.lit(bound)))

    if q.get("kind") == "match_all":
        where = F.lit(True)
    elif q.get("kind") == "term":
        where = text == F.lit(lo)
    else:
        where = F.lit(True) if lo is None else compare(lo, lambda a, b: a >= b)
        where = where & (F.lit(True) if hi is None else compare(hi, lambda a, b: a <= b))
    assign = {}
    if rule.set:
        old = F.map_filter(F.from_json("doc", FIELDS), lambda k, v: ~k.isin(*rule.set))
        new = F.create_map(*[c for n, v in rule.set.items() for c in (F.lit(n), _literal(v))])
        assign = {"doc": F.to_json(F.map_concat(old, new))}
    return Rule(rule.seq, rule.item, rule.action, where=F.coalesce(where, F.lit(False)), assign=assign)


def replay_documents_with_queries(
    log: DataFrame, base: DataFrame | None = None, keys: Sequence[str] = ("id",), size: int = ROUND
) -> tuple[DataFrame, DataFrame]:
    """(documents, outcomes of the keyed requests) of a log that may hold by-query requests.

    By-query requests for one key are plain requests; others are taken one after another, with the documents written
    in between. Those whose query is of no known kind fail.
    """
    patch = F.to_json(F.transform_values("set", lambda k, v: F.coalesce(F.try_parse_json(v), v.cast("variant"))))
    whole, log = check_docs(log), by_key(applicable(log), keys, patch)
    own = ~F.col("lenient") if "lenient" in log.columns else F.lit(True)
    state, hot = base, hot_keys(log, keys)
    outcomes = [by_query_outcomes(whole, check_docs(log).columns)]
    for part, rules, last in rounds(log, size):
        keyed, past = part.where(~F.col("action").isin(*S.BY_QUERY)), None
        for rule in [document_rule(r, keys) for r in rules]:
            piece = keyed.where(~after(rule.position))
            if past is not None:
                piece = piece.where(after(past))
            past = rule.position
            outcomes.append(request_outcomes(check_docs(piece), state, keys, hot).where(own))
            state = replay_documents(piece, state, keys, hot)
            if rule.action == "delete_by_query":
                state = apply_delete_by_query(state, rule.where)
            else:
                state = apply_update_by_query(state, rule.where, rule.assign)
            state = materialize(state, "documents")
        if last:
            rest = keyed if past is None else keyed.where(after(past))
            outcomes.append(request_outcomes(check_docs(rest), state, keys, hot).where(own))
            state = replay_documents(rest, state, keys, hot)
    out = outcomes[0]
    for o in outcomes[1:]:
        out = out.unionByName(o)
    return state, out
