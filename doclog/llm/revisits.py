"""Not-modified revisits of a web archive, resolved against the responses that they confirm."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ROWS_PER_CHUNK, Scratch

#: Headers of a not-modified answer that must not replace stored ones, since they belong to its own body
#: or connection.
NOT_MERGED = (
    "connection",
    "content-encoding",
    "content-length",
    "content-range",
    "content-type",
    "keep-alive",
    "proxy-authenticate",
    "proxy-authorization",
    "te",
    "trailer",
    "transfer-encoding",
    "upgrade",
)


def canonical_url(url: Column) -> Column:
    """Host without case, user, leading www and the scheme's own port, then path and query without fragment; "/" for no path."""
    plain = F.regexp_replace(url, "#.*$", "")
    host = F.lower(F.regexp_extract(plain, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), "^www[0-9]*[.]", "")
    own_port = F.when(plain.rlike("^(?i)http://"), ":80$").when(plain.rlike("^(?i)https://"), ":443$").otherwise("$")
    host = F.regexp_replace(host, own_port, F.lit(""))
    path = F.regexp_extract(plain, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*(.*)$", 1)
    full = F.concat(host, F.when(path == "", "/").otherwise(path))
    return F.when(plain.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), full).otherwise(plain)


def _tag(headers: Column) -> Column:
    """Entity tag for weak comparison."""
    return F.regexp_replace(F.trim(headers["etag"]), "^W/", "")


def last_before(rows: DataFrame, scratch: Scratch, n_rows: int) -> DataFrame:
    """`rows` (key, date, id, kind, value, ...) with `found`: value of the last row of kind 0 before it in (date, id) order.

    Rows are range-partitioned by key and order, so a key of any size spans several partitions; windows see one
    partition's part of a key, and the last value of the parts before comes from a row per key and partition.
    """
    order = ["date", "id"]
    dealt = scratch.save(
        rows.repartitionByRange(n_rows // ROWS_PER_CHUNK + 1, "key", *order).withColumn("_part", F.spark_partition_id())
    )
    value = F.when(F.col("kind") == 0, F.col("value"))
    here = Window.partitionBy("key", "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = dealt.withColumn("_here", F.last(value, ignorenulls=True).over(here))
    parts = dealt.where("kind = 0").groupBy("key", "_part").agg(F.max_by("value", F.struct(*order)).alias("_last"))
    parts = dealt.select("key", "_part").distinct().join(parts, ["key", "_part"], "left")
    before = Window.partitionBy("key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.withColumn("_before", F.last("_last", ignorenulls=True).over(before)).drop("_last")
    joined = inside.join(carried, ["key", "_part"])
    return joined.withColumn("found", F.coalesce("_here", "_before")).drop("_part", "_here", "_before")


def resolve_revisits(records: DataFrame, with_payload: bool = False) -> DataFrame:
    """Each not-modified revisit of `records` with the latest earlier full response of its URL.

    `records`: record_id, type ("response" or "revisit"), url, date (any ordered type), status, headers (map with
    lower-case names), digest of the payload, and payload if asked for. Returns a row per revisit: record_id, url_key,
    date, outcome, response_id, digest, headers, and with `with_payload` the payload.

    Earlier is by (date, record_id) under the same canonical URL, full is status 200. The response must have the
    revisit's entity tag (weak comparison), or its last-modified where one of them has no tag. outcome is "resolved",
    "no response", "validator differs", "no validator" (neither can be compared) or "no key" (null URL or date); only
    resolved ones have a response, whose headers are replaced by those of the revisit but for NOT_MERGED ones.

    The as-of join moves ids, validators and headers only; a payload is joined by response id afterwards. Repeated
    record ids are resolved each; of equal (date, record_id) responses the one with the largest digest is taken. Other
    columns are ignored.
    """
    scratch = Scratch(records.sparkSession, "revisits")
    none = F.map_from_arrays(F.array(), F.array()).cast("map<string,string>")
    headers = F.coalesce("headers", none)
    full = (F.col("type") == "response") & (F.col("status") == 200)
    rows = scratch.save(
        records.where(full | (F.col("type") == "revisit")).select(
            canonical_url(F.col("url")).alias("key"),
            "date",
            F.col("record_id").alias("id"),
            F.when(full, 0).otherwise(1).alias("kind"),
            "digest",
            F.map_entries(headers).alias("entries"),
        )
    )
    keyed = F.col("key").isNotNull() & F.col("date").isNotNull()
    value = F.struct(F.col("id").alias("response_id"), "digest", "entries")
    known = rows.where(keyed).withColumn("value", F.when(F.col("kind") == 0, value))
    # Equal places of one URL: the largest digest comes last.
    order_id = Window.partitionBy("key", "date", "id", "kind").orderBy(F.desc("digest"))
    same = known.where("kind = 0").withColumn("_n", F.row_number().over(order_id)).where("_n = 1").drop("_n")
    known = same.unionByName(known.where("kind = 1"))
    found = last_before(known, scratch, rows.count()).where("kind = 1")
    found = found.unionByName(
        rows.where(~keyed).where("kind = 1").withColumns({"value": F.lit(None).cast(known.schema["value"].dataType), "found": F.lit(None).cast(known.schema["value"].dataType)})
    )
    mine, theirs = F.map_from_entries("entries"), F.map_from_entries("found.entries")
    tags, dates = (_tag(mine), _tag(theirs)), (mine["last-modified"], theirs["last-modified"])
    both = lambda pair: pair[0].isNotNull() & pair[1].isNotNull()
    outcome = (
        F.when(~keyed, "no key")
        .when(F.col("found").isNull(), "no response")
        .when(both(tags), F.when(tags[0] == tags[1], "resolved").otherwise("validator differs"))
        .when(both(dates), F.when(dates[0] == dates[1], "resolved").otherwise("validator differs"))
        .otherwise("no validator")
    )
    judged = found.withColumn("outcome", outcome)
    done = F.col("outcome") == "resolved"
    allowed = F.filter("entries", lambda e: ~e["key"].isin(*NOT_MERGED))
    names = F.transform(allowed, lambda e: e["key"])
    kept = F.filter("found.entries", lambda e: ~F.array_contains(names, e["key"]))
    out = judged.select(
        F.col("id").alias("record_id"),
        F.col("key").alias("url_key"),
        "date",
        "outcome",
        F.when(done, F.col("found.response_id")).alias("response_id"),
        F.when(done, F.col("found.digest")).alias("digest"),
        F.when(done, F.map_from_entries(F.array_sort(F.concat(kept, allowed)))).alias("headers"),
    )
    if with_payload:
        bodies = records.where(full).select(
            F.col("record_id").alias("response_id"), "digest", "payload"
        ).dropDuplicates(["response_id", "digest"])
        out = out.join(bodies, ["response_id", "digest"], "left").select(*out.columns, "payload")
    return out
