"""Which requests belong to the log: target tests, three-way routing, kind codes, segment-cut markers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doclog import schema as S
from doclog.functions.requests import admin_action, is_target, request_code, three_way

IN_LIST_LIMIT = 1000


def filter_targets(reqs: DataFrame, targets: Iterable[str] | DataFrame) -> DataFrame:
    """Keep requests whose index name is exactly one of the targets.

    A short list becomes a pushed-down IN; a long one, or a table with an `index` column, a semi join that Spark
    sizes itself.
    """
    if not isinstance(targets, DataFrame):
        targets = list(targets)
        if len(targets) <= IN_LIST_LIMIT:
            return reqs.where(F.col("index").isin(*targets))
        targets = reqs.sparkSession.createDataFrame([(t,) for t in targets], "index string")
    return reqs.join(targets.select("index").distinct(), "index", "left_semi").select(*reqs.columns)


def route_bulk(reqs: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Add `route`: pass when no item is aimed at a target, capture when all are, reject a mixture."""
    hits = F.array_size(F.filter("items", lambda x: is_target(x["index"], targets)))
    return reqs.withColumn("route", three_way(hits, F.array_size("items")))


def route_items(rows: DataFrame, targets: Sequence[str]) -> DataFrame:
    """`route_bulk` for flattened items: one row per bulk, from counts combined before the shuffle."""
    counts = rows.groupBy("request_id").agg(
        F.count_if(is_target(F.col("index"), targets)).alias("hits"), F.count("*").alias("items")
    )
    return counts.withColumn("route", three_way(F.col("hits"), F.col("items")))


def route_by_query(reqs: DataFrame, targets: Sequence[str]) -> DataFrame:
    """The same rule over the list of indices a by-query request names; an empty list passes."""
    hits = F.array_size(F.filter("indices", lambda x: is_target(x, targets)))
    return reqs.withColumn("route", three_way(hits, F.array_size("indices")))


def route_requests(reqs: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Route every kind at once: bulks by their items, by-query requests by their list, the rest by index name."""
    bulk = F.array_size(F.filter("items", lambda x: is_target(x["index"], targets)))
    listed = F.array_size(F.filter("indices", lambda x: is_target(x, targets)))
    one = is_target(F.col("index"), targets).cast("int")
    action = F.col("action")

    def by_kind(of_bulk: Column, of_list: Column, of_one: Column) -> Column:
        return F.when(action == "bulk", of_bulk).when(action.isin(*S.BY_QUERY), of_list).otherwise(of_one)

    route = three_way(by_kind(bulk, listed, one), by_kind(F.array_size("items"), F.array_size("indices"), F.lit(1)))
    return reqs.withColumn("route", route)


def classify_requests(reqs: DataFrame) -> DataFrame:
    """Add `code`, the record code of the request's kind; 0 marks kinds the log does not take."""
    return reqs.withColumn("code", request_code(F.col("action")))


def split_unknown(reqs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(requests that can be logged, requests of unknown kind)."""
    coded = classify_requests(reqs)
    return coded.where(f"code <> {S.CODE_UNKNOWN}"), coded.where(f"code = {S.CODE_UNKNOWN}")


def detect_renew(
    actions: DataFrame, targets: Sequence[str], renew_actions: Sequence[str] = S.RENEW_ACTIONS
) -> DataFrame:
    """Add `renew`: does this administrative action cut a segment?

    `name` is the full action name and `indices` what it is limited to: null for an action that names no indices,
    empty for all of them.
    """
    return actions.withColumn("renew", is_renew(F.col("name"), F.col("indices"), targets, renew_actions))


def is_renew(
    name: Column, indices: Column, targets: Sequence[str], renew_actions: Sequence[str] = S.RENEW_ACTIONS
) -> Column:
    cuts = [n if ":" in n else S.ADMIN_PREFIX + n for n in renew_actions]
    aimed = F.arrays_overlap(indices, F.array(*[F.lit(t) for t in targets]).cast("array<string>"))
    everywhere = indices.isNull() | (F.array_size(indices) == 0)
    return name.isin(*cuts) & (everywhere | F.coalesce(aimed, F.lit(False)))


def full_action_names(actions: DataFrame) -> DataFrame:
    return actions.withColumn("name", admin_action(F.col("name")))


def match_query(field: Column, kind: str, lo=None, hi=None) -> Column:
    """term: field = lo; range: lo <= field <= hi, either end open when None; match_all: every row."""
    if kind == "match_all":
        return F.lit(True)
    if kind == "term":
        return field == F.lit(lo)
    if kind == "range":
        low = F.lit(True) if lo is None else field >= F.lit(lo)
        high = F.lit(True) if hi is None else field <= F.lit(hi)
        return low & high
    raise ValueError(f"unknown query kind: {kind}")


def term_filter(df: DataFrame, field: str, value) -> DataFrame:
    return df.where(match_query(F.col(field), "term", value))


def range_filter(df: DataFrame, field: str, lo=None, hi=None) -> DataFrame:
    return df.where(match_query(F.col(field), "range", lo, hi))
