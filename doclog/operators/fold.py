"""Applying keyed mutations: per-request outcomes and the fold of a log into a table.

A request's fate depends only on whether its document exists, and existence depends only on the last index, create
or delete before it: a running value along each key's rows, after which every field is the latest one written.

Most keys are small and are folded in one group each, with one shuffle. Keys that may hold a large share of the log
are found from a sample of the key column and cut into chunks of the log order: their (key, chunk) groups are bounded,
and what crosses a chunk is one flag. The sample only decides how a key is worked on, never what comes out.

A log for this module has `seq`, `item`, `action`, the key columns and the document: a struct column `doc` plus,
optionally, `present` (names of the fields the request carries; null means all), `valid` (false for an
unreadable document), `fits` (false for one whose values are not of the fields' types) and `upsert`, the document that
an update writes where there is none. Such an update never fails, and its document exists afterwards either way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doclog import schema as S
from doclog.functions.scale import CHUNK_BITS, by_heat, chunk_of


_ODD = "__odd"
"""Where the JSON reader puts a document with a value that is not of its field's type."""


def readable(log: DataFrame) -> Column:
    """Requests that bring a document must bring a JSON object, and so must updates that bring one to insert."""
    action = F.col("action")
    whole = F.json_object_keys("doc").isNotNull() | ~action.isin(*S.DOC_WRITES)
    if "upsert" not in log.columns:
        return whole
    return whole & (F.col("upsert").isNull() | (action != "update") | F.json_object_keys("upsert").isNotNull())


def brings(log: DataFrame) -> Column:
    """Is it an update that brings a document to insert? A stored log says so, and needs no document for it."""
    if "brings" in log.columns:
        return F.coalesce("brings", F.lit(False))
    if "upsert" not in log.columns:
        return F.lit(False)
    given = F.col("upsert").isNotNull()
    if "doc_as_upsert" in log.columns:
        given = given | F.coalesce("doc_as_upsert", F.lit(False))
    return (F.col("action") == "update") & given


def upsert_text(log: DataFrame) -> dict[str, Column]:
    """The column `upsert` of updates: as given, or the patch itself where `doc_as_upsert` says so. What was given stays
    in `raw_upsert`, for dead letters."""
    if "upsert" not in log.columns or "raw_upsert" in log.columns:
        return {}
    given = F.col("upsert")
    if "doc_as_upsert" in log.columns:
        given = F.when(F.col("doc_as_upsert"), F.col("doc")).otherwise(given)
    return {"brings": brings(log), "raw_upsert": F.col("upsert"), "upsert": F.when(F.col("action") == "update", given)}


def parse_docs(log: DataFrame, doc_type: T.StructType, strict: bool = False) -> DataFrame:
    """Turn JSON `doc` into a struct of the declared fields, keeping which fields a patch gives.

    A log that was captured already says which documents are readable; then the columns that decide existence can be
    read without the documents. With `strict` a document with a value that is not of its field's type does not fit, and
    its request fails as a whole; without, such a value is null. `raw` keeps the text for dead letters; nothing else
    reads it.
    """
    valid = F.col("valid") if "valid" in log.columns else readable(log)
    log = log.withColumns(upsert_text(log))
    texts = ["doc", "upsert"] if "upsert" in log.columns else ["doc"]
    columns = {
        "raw": F.col("doc"),
        "valid": valid,
        "present": F.when(F.col("action") == "update", F.json_object_keys("doc")),
    }
    if not strict:
        return log.withColumns(columns | {c: F.when(valid, F.from_json(c, doc_type)) for c in texts})
    whole = T.StructType([*doc_type.fields, T.StructField(_ODD, T.StringType())])
    parsed = {
        f"__{c}": F.when(valid, F.from_json(c, whole, {"columnNameOfCorruptRecord": _ODD})) for c in texts
    }
    rows = log.withColumns(columns | parsed)
    fits = F.lit(True)
    for c in parsed:
        fits = fits & (F.col(c).isNull() | F.col(c).getField(_ODD).isNull())

    def declared(c: str) -> Column:
        return F.struct(*[F.col(c).getField(f.name).alias(f.name) for f in doc_type.fields])

    docs = {c: F.when(F.col(f"__{c}").isNotNull() & fits, declared(f"__{c}")) for c in texts}
    return rows.withColumns({"fits": fits} | docs).drop(*parsed)


def doc_fields(log: DataFrame) -> list[T.StructField]:
    return list(log.schema["doc"].dataType.fields)


def is_valid(log: DataFrame) -> Column:
    """Does the request bring a document that can be applied, if it brings one?"""
    flags = [F.coalesce(F.col(c), F.lit(True)) for c in ("valid", "fits") if c in log.columns]
    return flags[0] & flags[1] if len(flags) == 2 else flags[0] if flags else F.lit(True)


def keyed_rows(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Requests that touch one document. Those without its key touch none; other kinds are an error."""
    known = F.coalesce(F.col("action").isin(*S.KEYED), F.lit(False))
    # The empty end of the message is not deterministic, which keeps the test above the filters that come before it.
    none = F.substring(F.uuid(), 1, 0)
    message = F.concat(F.lit("replay cannot apply requests of this kind: "), F.coalesce("action", F.lit("none")), none)
    rows = log.where(F.col(keys[0]).isNotNull() | ~known)
    return rows.where(F.when(known, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def without_key(log: DataFrame, judged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`judged` together with the requests of `log` that name no document."""
    lost = log.where(F.col(keys[0]).isNull() & F.col("action").isin(*S.KEYED))
    return judged.unionByName(lost.withColumn("exists_before", F.lit(False)).select(*judged.columns))


def _defines(log: DataFrame) -> Column:
    """Rows after which existence is known: even a failed create leaves a document behind."""
    return (F.col("action").isin(*S.FULL_WRITES) | brings(log)) & is_valid(log)


def with_base(log: DataFrame, base: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """The log preceded by the documents of `base`, each as a whole write before all others."""
    if base is None:
        return log
    kind = log.schema["doc"].dataType
    if isinstance(kind, T.StructType):
        doc = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in kind.fields])
    else:
        doc = F.col("doc")
    first = {"seq": F.lit(S.MIN_LONG), "item": F.lit(0), "action": F.lit("index"), "doc": doc}
    for flag in ("valid", "fits"):
        if flag in log.columns:
            first[flag] = F.lit(True)
    rows = base.select(*keys, *[c.alias(n) for n, c in first.items()])
    return log.unionByName(rows, allowMissingColumns=True)


def with_state(
    log: DataFrame, keys: Sequence[str], chunk_bits: int | None = None, splits: Sequence[str] = ()
) -> DataFrame:
    """Add `known` (does the document exist before this request?) and `code` (the request's place in its group).

    `known` is null while no earlier request of the same (key, splits) decides it. With `chunk_bits`, groups are cut
    by `chunk` and the last state before each chunk is carried into it.
    """
    keys, splits = list(keys), list(splits)
    log = keyed_rows(log, keys)
    defines, leaves = _defines(log), (F.col("action") != "delete").cast("long")
    if chunk_bits is not None:
        log = log.withColumn("chunk", chunk_of(F.col("seq"), chunk_bits))
    group = [*keys, *splits, *([] if chunk_bits is None else ["chunk"])]
    order = Window.partitionBy(*group).orderBy("seq", "item")
    before = F.last(F.when(defines, leaves), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = log.withColumns({"known": before, "code": F.row_number().over(order).cast("long")})
    if chunk_bits is None:
        return rows.withColumn("known", F.col("known") == 1)
    tails = log.groupBy(*group).agg(
        F.max(F.when(defines, F.struct("seq", "item", leaves.alias("state")))).getField("state").alias("tail")
    )
    earlier = Window.partitionBy(*keys, *splits).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.withColumn("carried", F.last("tail", ignorenulls=True).over(earlier)).drop("tail")
    return (
        rows.join(carried, group).withColumn("known", F.coalesce("known", "carried") == 1).drop("carried")
    )


def takes_effect(log: DataFrame, exists: Column) -> Column:
    action = F.col("action")
    missing = (action == "update") & ~exists & ~brings(log)
    return is_valid(log) & ~((action == "create") & exists) & ~missing


def request_outcomes(
    log: DataFrame,
    base: DataFrame | None = None,
    keys: Sequence[str] = ("id",),
    hot: list[tuple] | None = None,
    chunk_bits: int = CHUNK_BITS,
) -> DataFrame:
    """Add `exists_before`, `failed`, `reason` and `result` to every keyed request; one without an id fails."""

    def judge(part: DataFrame, bits: int | None) -> DataFrame:
        rows = with_state(part, keys, bits).where(F.col("seq") != S.MIN_LONG)
        return rows.select(*log.columns, F.coalesce("known", F.lit(False)).alias("exists_before"))

    judged = by_heat(log, with_base(log, base, keys), keys, judge, hot, chunk_bits)
    return label_outcomes(without_key(log, judged, keys), keys)


def label_outcomes(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    action, exists = F.col("action"), F.col("exists_before")
    fits = F.coalesce(F.col("fits"), F.lit(True)) if "fits" in rows.columns else F.lit(True)
    reason = (
        F.when(F.col(keys[0]).isNull(), "no id")
        .when(~fits, "document does not fit the fields")
        .when(~is_valid(rows), "unreadable document")
        .when((action == "create") & exists, "document exists")
        .when((action == "update") & ~exists & ~brings(rows), "document missing")
    )
    done = (
        F.when(action == "delete", F.when(exists, "deleted").otherwise("not_found"))
        .when(action.isin("index", "update") & exists, "updated")
        .otherwise("created")
    )
    return (
        rows.withColumn("reason", reason)
        .withColumn("failed", F.col("reason").isNotNull())
        .withColumn("result", F.when(F.col("failed"), "failed").otherwise(done))
    )


def carries(log: DataFrame, field: str) -> Column:
    """Does this request say something about `field`? A full write does about all of them."""
    full = F.col("action").isin(*S.FULL_WRITES)
    if "present" not in log.columns:
        return F.lit(True)
    return full | F.col("present").isNull() | F.array_contains("present", field)


def effects(log: DataFrame, fields: Sequence[T.StructField], exists: Column, suffix: str = "") -> list[Column]:
    """Aggregates that reduce requests to their combined effect, latest by `code`, where `exists` tells whether the
    document of a request exists before it.

    `exists`: state left by the last full write, null without one; an upsert is one where there is no document. One
    struct per field: null when no request said anything about the field, else holding the value (which may be null).
    """
    effective, opens = takes_effect(log, exists), brings(log) & ~exists
    full = (F.col("action").isin(*S.FULL_WRITES) | opens) & effective
    # The place of the last full write, with what it leaves in the lowest bit.
    state = F.max(F.when(full, F.col("code") * 2 + (F.col("action") != "delete").cast("long")))
    out = [(state % 2 == 1).alias(f"exists{suffix}")]
    for f in fields:
        at = F.when(effective & (carries(log, f.name) | opens), F.col("code"))
        value = F.col("doc").getField(f.name)
        if "upsert" in log.columns:
            value = F.when(opens, F.col("upsert").getField(f.name)).otherwise(value)
        out.append(F.max_by(F.struct(value.alias("v")), at).alias(f"{f.name}{suffix}"))
    return out


def merge_effects(fields: Sequence[T.StructField], order: str, suffix: str = "") -> list[Column]:
    """Combine effects of consecutive chunks, latest by `order`."""
    names = ["exists", *[f.name for f in fields]]
    return [
        F.max_by(f"{n}{suffix}", F.when(F.col(f"{n}{suffix}").isNotNull(), F.col(order))).alias(f"{n}{suffix}")
        for n in names
    ]


def replay(
    log: DataFrame,
    base: DataFrame | None = None,
    keys: Sequence[str] = ("id",),
    hot: list[tuple] | None = None,
    chunk_bits: int = CHUNK_BITS,
) -> DataFrame:
    """Fold an ordered log of index, create, update and delete requests into the table of surviving documents.

    The rows are shuffled once, by key, or by (key, chunk) for keys in `hot` (looked for when None); the chunks of a
    hot key shrink to one row each before they meet.
    """
    fields = doc_fields(log)

    def fold(part: DataFrame, bits: int | None) -> DataFrame:
        rows = with_state(part, keys, bits)
        exists = F.coalesce("known", F.lit(False))
        if bits is None:
            return rows.groupBy(*keys).agg(*effects(rows, fields, exists))
        chunks = rows.groupBy(*keys, "chunk").agg(*effects(rows, fields, exists))
        return chunks.groupBy(*keys).agg(*merge_effects(fields, "chunk"))

    merged = by_heat(log, with_base(log, base, keys), keys, fold, hot, chunk_bits)
    return merged.where("exists").select(*keys, *[F.col(f.name).getField("v").alias(f.name) for f in fields])


def replay_writes(
    log: DataFrame, order: Sequence[str], base: DataFrame | None = None, keys: Sequence[str] = ("id",)
) -> DataFrame:
    """`replay` for a log of full writes only (index, delete): nothing can fail or merge, so the last row wins.

    One pass with map-side combine; `order` may be any columns that together order a key's rows.
    """
    fields = doc_fields(log)
    kept = F.when(F.col("action") != "delete", F.col("doc"))
    rows = log.select(*keys, F.struct(F.lit(1), *order).alias("at"), F.struct(kept.alias("doc")).alias("kept"))
    if base is not None:
        values = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
        first = F.struct(F.lit(0), *[F.lit(None).cast(log.schema[c].dataType).alias(c) for c in order])
        rows = rows.union(base.select(*keys, first.alias("at"), F.struct(values.alias("doc")).alias("kept")))
    last = rows.groupBy(*keys).agg(F.max_by("kept", "at").alias("kept"))
    return last.where("kept.doc is not null").select(*keys, "kept.doc.*")


def apply_index(reqs: DataFrame, base: DataFrame | None = None, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Write whole documents: insert, or replace what is there. Unreadable documents change nothing."""
    writes = reqs.where("action = 'index'").where(is_valid(reqs))
    return replay_writes(writes, ["seq", "item"], base, keys)


def apply_create(reqs: DataFrame, base: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Insert documents that do not exist yet; the first create of a key wins, later ones fail."""
    keys = list(keys)
    creates = reqs.where("action = 'create'").where(is_valid(reqs))
    first = creates.groupBy(*keys).agg(F.min_by("doc", F.struct("seq", "item")).alias("doc"))
    names = [f.name for f in doc_fields(reqs)]
    new = first.join(base.select(*keys), keys, "left_anti").select(*keys, "doc.*")
    return base.select(*keys, *names).unionByName(new)


def apply_update(reqs: DataFrame, base: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Merge patches into existing documents, field by field. Patches without a document fail, unless they bring one to
    insert."""
    keys = list(keys)
    fields = doc_fields(reqs)
    updates = reqs.where("action = 'update'").where(is_valid(reqs))
    at = F.struct("seq", "item")
    latest = [
        F.max_by(
            F.struct(F.col("doc").getField(f.name).alias("v")), F.when(carries(updates, f.name), at)
        ).alias(f"new_{f.name}")
        for f in fields
    ]
    patches = updates.groupBy(*keys).agg(*latest)
    merged = [
        F.when(F.col(f"new_{f.name}").isNotNull(), F.col(f"new_{f.name}").getField("v"))
        .otherwise(F.col(f.name).cast(f.dataType))
        .alias(f.name)
        for f in fields
    ]
    patched = base.join(patches, keys, "left").select(*keys, *merged)
    if "upsert" not in reqs.columns:
        return patched
    return patched.unionByName(replay(updates.join(base.select(*keys), keys, "left_anti"), keys=keys))


def apply_delete(reqs: DataFrame, base: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Remove documents; deleting one that is not there changes nothing."""
    keys = list(keys)
    gone = reqs.where("action = 'delete'").select(*keys).distinct()
    return base.join(gone, keys, "left_anti")


def state_at(
    log: DataFrame, position: int, base: DataFrame | None = None, keys: Sequence[str] = ("id",)
) -> DataFrame:
    """The table of a consumer standing at segment `position`: everything before it, by-query requests too, has been
    applied."""
    from doclog.operators.barriers import replay_with_queries

    before = log.where(F.col("segment_id") < position)
    return replay_with_queries(before, base, keys) if "query" in log.columns else replay(before, base, keys)
