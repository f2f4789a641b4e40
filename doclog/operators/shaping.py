"""Row-level shaping of requests. Everything here is a narrow projection: no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doclog import schema as S
from doclog.functions.requests import ack_fields, generated_id, render_single, segment_name
from doclog.operators.fold import brings, readable


def flatten_bulk(reqs: DataFrame) -> DataFrame:
    """One row per request that is applied: bulk items take their position as `item`, other requests keep theirs.

    A null or empty bulk contributes nothing.
    """
    names = [n for n in reqs.schema["items"].dataType.elementType.names if n in reqs.columns]
    rest = [c for c in reqs.columns if c not in names and c not in ("item", "items")]
    own = F.array(F.struct(F.col("item").alias("item"), *names))
    inner = F.transform(
        F.coalesce("items", F.array().cast(reqs.schema["items"].dataType)),
        lambda x, i: F.struct(i.alias("item"), *[x[n].alias(n) for n in names]),
    )
    rows = F.when(F.col("action") == "bulk", inner).otherwise(own)
    return reqs.select(*rest, F.inline(rows))


def log_rows(reqs: DataFrame) -> DataFrame:
    """Requests as the log stores them: bulk items as rows of their own, so every column can be read alone.

    `in_bulk` marks the items, `bytes` stays with the first of them, ids are complete, `valid` tells whether the
    document can be read, and `brings` whether an update brings one to insert. `gather_bulks` puts bulks together again.
    """
    in_bulk = F.col("action") == "bulk"
    rows = assign_ids(flatten_bulk(reqs.withColumn("in_bulk", in_bulk)))
    first = ~F.col("in_bulk") | (F.col("item") == 0)
    return rows.withColumns(
        {
            "bytes": F.when(first, F.col("bytes")).otherwise(F.lit(0).cast("long")),
            "valid": readable(rows),
            "brings": brings(rows),
        }
    )


def gather_bulks(rows: DataFrame) -> DataFrame:
    """The requests of stored rows: items with the same seq become one bulk again, in order."""
    names = S.ITEM.names
    kept = [c for c in rows.columns if c not in ("item", "in_bulk", "valid", "brings", "bytes", *names)]
    items = F.array_sort(
        F.collect_list(F.struct("item", *[n for n in names])), lambda a, b: a["item"] - b["item"]
    )
    bulks = rows.where("in_bulk").groupBy("segment_id", "seq").agg(
        *[F.first(c).alias(c) for c in kept if c not in ("segment_id", "seq")],
        F.sum("bytes").alias("bytes"),
        F.transform(items, lambda x: F.struct(*[x[n].alias(n) for n in names])).alias("items"),
    )
    bulks = bulks.withColumns({"action": F.lit("bulk"), "item": F.lit(0)})
    return rows.where("not in_bulk").drop("in_bulk", "valid", "brings").unionByName(bulks, allowMissingColumns=True)


def retarget(reqs: DataFrame, target: str | None) -> DataFrame:
    """Point every request, list of indices and bulk item at the consumer's table; None leaves them alone.

    A bulk item of a kind that cannot be replayed is an error.
    """
    if target is None:
        return reqs
    to = F.lit(target)
    changes = {"index": F.when(F.col("action").isin("bulk", *S.BY_QUERY), F.col("index")).otherwise(to)}
    if "indices" in reqs.columns:
        changes["indices"] = F.when(F.col("action").isin(*S.BY_QUERY), F.array(to)).otherwise(F.col("indices"))
    if "items" in reqs.columns:
        known = F.forall("items", lambda x: F.coalesce(x["action"].isin(*S.BULK_ITEM_ACTIONS), F.lit(False)))
        moved = F.transform("items", lambda x: x.withField("index", to))
        message = F.concat(F.lit("A bulk holds an item that cannot be replayed, seq "), F.col("seq").cast("string"))
        changes["items"] = F.when(F.col("items").isNull() | known, moved).otherwise(
            F.raise_error(message).cast(reqs.schema["items"].dataType)
        )
    return reqs.withColumns(changes)


def synthesize_ack(reqs: DataFrame) -> DataFrame:
    """The reply a caller gets while its request only goes to the log; bulks reply per item, in order."""
    single = ack_fields(F.col("action"), F.col("id"), F.col("version"))
    columns = [F.col(c) for c in ("seq", "item", "action", "index", "type")]
    columns += [c.alias(n) for n, c in single.items()]
    if "items" in reqs.columns:
        replies = F.transform(
            "items",
            lambda x, i: F.struct(
                i.alias("item"),
                x["action"].alias("action"),
                x["index"].alias("index"),
                x["type"].alias("type"),
                *[c.alias(n) for n, c in ack_fields(x["action"], x["id"], x["version"]).items()],
            ),
        )
        columns.append(F.when(F.col("action") == "bulk", replies).alias("items"))
    return reqs.select(*columns)


def assign_ids(reqs: DataFrame) -> DataFrame:
    """Give index and create requests without an id one that only depends on their place in the log."""
    made = generated_id(F.col("seq"), F.col("item"))
    needs = F.col("id").isNull() & F.col("action").isin("index", "create")
    return reqs.withColumn("id", F.when(needs, made).otherwise(F.col("id")))


def render_requests(reqs: DataFrame) -> DataFrame:
    """One text line per request of a segment: seq, item, line."""
    line = render_single(lambda n: F.col(n) if n in reqs.columns else F.lit(None))
    if "items" in reqs.columns:
        names = reqs.schema["items"].dataType.elementType.names

        def of_item(x):
            def part(n):
                if n == "indices":
                    return F.when(x["index"].isNotNull(), F.array(x["index"]))
                return x[n] if n in names else F.lit(None)

            return F.coalesce(render_single(part), F.lit("null"))

        inner = F.array_join(F.transform("items", of_item), ",")
        line = F.when(F.col("action") == "bulk", F.concat(F.lit("bulk ["), inner, F.lit("]"))).otherwise(line)
    return reqs.select("seq", "item", line.alias("line"))


def name_segments(segments: DataFrame, fmt: str = S.SEGMENT_NAME_FORMAT) -> DataFrame:
    return segments.withColumn("segment_name", segment_name(F.col("segment_id"), fmt))
