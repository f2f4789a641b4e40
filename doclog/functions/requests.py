"""Column expressions over single requests."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from doclog import schema as S


def request_code(action: Column) -> Column:
    """Record code of a request kind; 0 for a kind the log does not take."""
    codes = F.create_map(*[F.lit(v) for pair in S.ACTION_CODES.items() for v in pair])
    return F.coalesce(F.try_element_at(codes, action), F.lit(S.CODE_UNKNOWN))


def segment_name(segment_id: Column, fmt: str = S.SEGMENT_NAME_FORMAT) -> Column:
    return F.format_string(fmt, segment_id)


def parse_segment_name(name: Column) -> Column:
    return name.cast("long")


def next_position(position: Column) -> Column:
    """Successor of a log position: 1 after a negative one and after the largest."""
    return F.when((position < 0) | (position == S.MAX_LONG), F.lit(1).cast("long")).otherwise(position + 1)


def admin_action(name: Column) -> Column:
    """Full name of an administrative action given by its short name."""
    return F.when(F.instr(name, ":") > 0, name).otherwise(F.concat(F.lit(S.ADMIN_PREFIX), name))


def is_target(index: Column, targets: Iterable[str]) -> Column:
    """Exact name test; an index without a name is never a target."""
    return F.coalesce(index.isin(*targets), F.lit(False))


def three_way(hits: Column, total: Column) -> Column:
    """pass | capture | reject for a request of `total` parts with `hits` of them on targets."""
    hits, total = F.coalesce(hits, F.lit(0)), F.coalesce(total, F.lit(0))
    return F.when(hits == 0, "pass").when(hits == total, "capture").otherwise("reject")


def generated_id(seq: Column, item: Column) -> Column:
    """Id of an index request that came without one; the same on every replay."""
    return F.sha2(F.concat_ws("#", seq.cast("string"), item.cast("string")), 256)


def _target_of(r) -> Column:
    def part(name: str) -> Column:
        return F.coalesce(r(name), F.lit("null"))

    return F.concat(F.lit("{["), part("index"), F.lit("]["), part("type"), F.lit("]["), part("id"), F.lit("]"))


def _one_line(c: Column) -> Column:
    return F.regexp_replace(c, "\n", "")


def render_single(r) -> Column:
    """One text line for a non-bulk request; `r(name)` gives the request's columns."""
    doc = F.coalesce(r("doc"), F.lit("null"))
    query = _one_line(F.coalesce(F.to_json(r("query")), F.lit("{}")))
    action = r("action")
    line = (
        F.when(
            action.isin("index", "create"),
            F.concat(F.lit("index "), _target_of(r), F.lit(", source["), doc, F.lit("]}")),
        )
        .when(
            action == "update",
            F.concat(F.lit("update "), _target_of(r), F.lit(' source[{"doc":'), doc, F.lit("}]}")),
        )
        .when(action == "delete", F.concat(F.lit("delete "), _target_of(r), F.lit("}")))
    )
    names = F.concat(F.lit(" ["), F.array_join(r("indices"), ","), F.lit("] "))
    by_query = F.concat(action, F.coalesce(names, F.lit(" [] ")), query)
    assigns = F.coalesce(F.concat(F.lit(" set "), _one_line(F.to_json(r("set")))), F.lit(""))
    return line.when(action == "delete_by_query", by_query).when(
        action == "update_by_query", F.concat(by_query, assigns)
    )


def ack_fields(action: Column, request_id: Column, version: Column) -> dict[str, Column]:
    """The immediate reply to one request, by field."""
    keyed = action.isin("index", "create", "update", "delete")
    deleted = action == "delete"
    by_query = action.isin(*S.BY_QUERY)
    zero = F.when(by_query, F.lit(0).cast("long"))
    return {
        "ack_id": F.when(keyed, F.coalesce(request_id, F.lit(S.PLACEHOLDER_ID))),
        "version": F.when(keyed, version),
        "result": F.when(action.isin("index", "create", "update"), "created").when(deleted, "deleted"),
        "found": F.when(deleted, F.lit(True)),
        "shards_total": F.when(deleted, F.lit(1)),
        "shards_successful": F.when(deleted, F.lit(1)),
        "total": zero,
        "updated": zero,
        "deleted": zero,
    }
