"""The verification queries: every operator over logs derived from whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doclog import schema as S
from doclog.functions.scale import shared_dir
from doclog.operators import barriers, consumers, cuts, documents, failures, fold, ordering, routing, segments, shaping
from doclog.plans import derived_logs as D
from doclog.plans import jobs
from doclog.sources import layers, tables
from doclog.sources.dead_letters import read_dead_letters
from doclog.sources.log import WriterFenced, open_writer, scan_segments, write_segments
from doclog.sources.requests import read_requests, stream_requests
from doclog.streaming import capture_stream, replay_stream

ROLL_BYTES = 10_000
NOW = "2024-02-01 00:00:00"

DELETE_RULE = {"seq": 4999, "action": "delete_by_query", "query": {"kind": "range", "field": "k", "lo": 0, "hi": 49}}
UPDATE_RULE = {
    "seq": 7000, "action": "update_by_query", "query": {"kind": "term", "field": "k", "lo": 95}, "set": {"value": 0.0}
}
CLEAR_RULE = {"seq": 2999, "action": "delete_by_query", "query": {"kind": "match_all"}}

Query = Callable[[SparkSession, str], DataFrame]


def _scratch(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/doclog-run-{uuid.uuid4().hex}"


def _rolled(spark, sf):
    return ordering.roll_by_size(D.event_requests(spark, sf), ROLL_BYTES)


def _rolled_log(spark, sf):
    return ordering.roll_by_size(D.event_log(spark, sf), ROLL_BYTES)


def classify(spark, sf):
    """Clicks keep their own name, a kind the log does not take."""
    rows = D.event_requests(spark, sf, click="click").select("seq", "item", "action")
    bulks = D.bulk_requests(spark, sf).select("seq", "item", "action")
    return routing.classify_requests(rows.unionByName(bulks))


def filter_targets(spark, sf):
    return routing.filter_targets(D.event_requests(spark, sf), D.TARGETS).select("seq", "action", "index", "id")


def detect_renew(spark, sf):
    kind = F.col("event_type")
    name = (
        F.when(kind == "signup", "refresh").when(kind == "view", "flush").when(kind == "error", "forcemerge")
        .when(kind == "click", "indices:admin/upgrade").otherwise("close")
    )
    which = F.col("user_id") % 4
    limits = (
        F.when(which == 1, F.array().cast("array<string>")).when(which == 2, F.array(F.lit("sample")))
        .when(which == 3, F.array(F.lit("other")))
    )
    actions = D.table(spark, sf, "events").select(
        F.col("event_id").alias("seq"), name.alias("name"), limits.alias("indices")
    )
    return routing.detect_renew(routing.full_action_names(actions), D.TARGETS).select("seq", "name", "renew")


def ack(spark, sf):
    return shaping.synthesize_ack(D.requests_without_ids(spark, sf))


def ack_bulk(spark, sf):
    replies = shaping.synthesize_ack(D.bulk_requests(spark, sf))
    return replies.select(F.col("seq").alias("bulk_seq"), F.inline("items")).select(
        "bulk_seq", "item", "action", "index", "ack_id", "result", "found"
    )


def assign_ids(spark, sf):
    return shaping.assign_ids(D.requests_without_ids(spark, sf)).select("seq", "item", "action", "id")


def retarget(spark, sf):
    moved = shaping.retarget(D.bulk_requests(spark, sf), "sample1")
    return shaping.flatten_bulk(moved).select("request_id", "item", "action", "index", "id")


def render(spark, sf):
    return shaping.render_requests(D.event_requests(spark, sf))


def render_bulk(spark, sf):
    return shaping.render_requests(D.bulk_requests(spark, sf))


def segment_name(spark, sf):
    names = shaping.name_segments(_rolled(spark, sf).select("segment_id").distinct())
    return names.withColumn("parsed", F.col("segment_name").cast("long"))


def term_filter(spark, sf):
    return routing.term_filter(D.table(spark, sf, "events"), "event_type", "click").select(
        "event_id", "user_id", "value"
    )


def route_bulk(spark, sf):
    return routing.route_bulk(D.bulk_requests(spark, sf), D.TARGETS).select("request_id", "route")


def route_items(spark, sf):
    return routing.route_items(D.event_requests(spark, sf), D.TARGETS)


def route_by_query(spark, sf):
    deletes = F.transform(F.filter("items", lambda x: x["action"] == "delete"), lambda x: x["index"])
    reqs = D.bulk_requests(spark, sf).select("request_id", deletes.alias("indices"))
    return routing.route_by_query(reqs, D.TARGETS).select("request_id", "route")


def flatten_bulk(spark, sf):
    return shaping.flatten_bulk(D.bulk_requests(spark, sf)).select(
        "request_id", "item", "action", "index", "type", "id", "doc"
    )


def order_log(spark, sf):
    keys = [*D.LINE_ORDER, *D.LINE_KEY]
    lines = D.table(spark, sf, "lineitem")
    return ordering.order_log(lines, keys).select("seq", *D.LINE_KEY, "l_partkey", "l_suppkey")


def roll_size(spark, sf):
    return _rolled(spark, sf).select("seq", "segment_id")


def roll_counter(spark, sf):
    return cuts.roll_by_counter(D.event_requests(spark, sf), ROLL_BYTES).select("seq", "segment_id")


def roll_marker(spark, sf):
    return ordering.roll_by_marker(D.event_requests(spark, sf), max_bytes=ROLL_BYTES).select("seq", "segment_id")


def segment_stats(spark, sf):
    return segments.segment_stats(_rolled(spark, sf))


def segment_scan(spark, sf):
    path = _scratch(spark)
    write_segments(_rolled(spark, sf).drop("marker"), path, 0)
    return scan_segments(spark, path).select("segment_id", "seq", "item", "action", "id", "doc")


def read_back(spark, sf):
    path = _scratch(spark)
    D.event_requests(spark, sf).drop("marker").write.json(path)
    rows = routing.split_unknown(read_requests(spark, path))[0]
    return rows.select("seq", "item", "action", "index", "id", "doc", "code")


def page(spark, sf):
    return segments.page(D.event_requests(spark, sf), ["seq"], 20, 10).select("seq", "action", "id")


def count_hits(spark, sf):
    return segments.count_hits(D.event_requests(spark, sf))


def _positions(spark, sf):
    key = F.col("n_nationkey").cast("long")
    return D.table(spark, sf, "nation").select(
        F.col("n_name").alias("target"),
        F.when(F.col("n_regionkey") == 4, "other").otherwise("index").alias("doc_type"),
        F.when(F.col("n_regionkey") == 0, "").otherwise(F.concat(F.lit("node "), F.col("n_regionkey"))).alias(
            "node_name"
        ),
        (key - 2).alias("file_position"),
        (F.lit(NOW).cast("timestamp") - F.make_dt_interval(F.lit(0), F.lit(0), key)).alias("ts"),
    )


def _gapped(spark, sf):
    """Segments of the event log with two ids of every three left free."""
    stats = segments.segment_stats(_rolled(spark, sf))
    return stats.withColumn("segment_id", F.col("segment_id") * 3).withColumn(
        "finished_at", F.timestamp_seconds("max_seq")
    )


def next_segment(spark, sf):
    return segments.next_segment(_positions(spark, sf), _gapped(spark, sf), 10).select(
        "target", "file_position", "ready", "next_segment"
    )


def resolve_start(spark, sf):
    """Suppliers (not stored yet) and nations (stored) ask to start at positive, zero or negative positions."""
    requested = D.table(spark, sf, "supplier").select(
        F.col("s_name").alias("target"), (F.col("s_nationkey").cast("long") - 12).alias("requested")
    ).unionByName(
        D.table(spark, sf, "nation").select(
            F.col("n_name").alias("target"), (F.col("n_regionkey").cast("long") * 3 - 6).alias("requested")
        )
    )
    return consumers.resolve_start(_positions(spark, sf), requested)


_STATUS = ["target", "doc_type", "node_name", "file_position", "running", "finished", "writer_position", "lag"]


def _plain_status(df):
    return df.withColumn("finished", F.unix_timestamp("file_timestamp")).select(*_STATUS)


def status(spark, sf):
    now = F.lit(NOW).cast("timestamp")
    return _plain_status(consumers.consumer_status(_positions(spark, sf), _gapped(spark, sf), now))


def consumer_list(spark, sf):
    now = F.lit(NOW).cast("timestamp")
    return _plain_status(consumers.consumer_list(_positions(spark, sf), _gapped(spark, sf), now, 5, 10))


def apply_index(spark, sf):
    return fold.apply_index(D.event_log(spark, sf))


def apply_create(spark, sf):
    log = D.event_log(spark, sf)
    return fold.apply_create(log, fold.state_at(_rolled_log(spark, sf), 2))


def apply_update(spark, sf):
    log = D.event_log(spark, sf)
    return fold.apply_update(log, fold.apply_index(log))


def apply_delete(spark, sf):
    return fold.apply_delete(D.order_changes(spark, sf), D.customer_base(spark, sf))


def outcomes(spark, sf):
    return fold.request_outcomes(D.event_log(spark, sf)).select(
        "seq", "item", "action", "id", "exists_before", "failed", "result"
    )


def dead_letter(spark, sf):
    log = _rolled_log(spark, sf)
    failed = failures.split_failures(fold.request_outcomes(log))[1]
    return failures.dead_letters(log, failed, "sample1").select(
        "target", "segment_id", "position", "seq", "action", "id", "reason", "attempts"
    )


def replay(spark, sf):
    return fold.replay(D.event_log(spark, sf))


def upsert(spark, sf):
    return fold.replay(fold.parse_docs(D.upsert_requests(spark, sf), D.EVENT_DOC))


def upsert_outcomes(spark, sf):
    log = fold.parse_docs(D.upsert_requests(spark, sf), D.EVENT_DOC)
    return fold.request_outcomes(log).select("seq", "item", "id", "exists_before", "failed", "result")


def upsert_documents(spark, sf):
    return _event_fields(documents.replay_documents(D.upsert_requests(spark, sf)))


def _event_fields(docs):
    return docs.select("id", F.from_json("doc", D.EVENT_DOC).alias("d"), F.json_object_keys("doc").alias("names")).select(
        "id", "d.*", F.array_join(F.sort_array("names"), ",").alias("names")
    )


def replay_documents(spark, sf):
    return _event_fields(documents.replay_documents(D.event_requests(spark, sf)))


def replay_pages(spark, sf):
    docs = documents.replay_documents(D.page_requests(spark, sf))
    paths = {"url": "$.url", "chars": "$.html.chars", "tag": "$.html.tags[0]", "lang": "$.lang", "source": "$.source"}
    return docs.select("id", *[F.get_json_object("doc", p).alias(n) for n, p in paths.items()])


def documents_by_query(spark, sf):
    log = D.barrier_requests(spark, sf, [CLEAR_RULE, DELETE_RULE, UPDATE_RULE])
    return _event_fields(documents.replay_documents_with_queries(log)[0]).drop("names")


def replay_base(spark, sf):
    return fold.replay(D.order_changes(spark, sf), D.customer_base(spark, sf))


def replay_lineitem(spark, sf):
    return fold.replay_writes(D.line_writes(spark, sf), D.LINE_ORDER, keys=D.LINE_KEY)


def replay_conv(spark, sf):
    return fold.replay(D.turn_log(spark, sf))


def apply_bulk(spark, sf):
    return fold.replay(fold.parse_docs(shaping.flatten_bulk(D.bulk_requests(spark, sf)), D.EVENT_DOC))


def state_at(spark, sf):
    return fold.state_at(_rolled_log(spark, sf), 3)


def replay_targets(spark, sf):
    return consumers.replay_targets(_rolled_log(spark, sf), _positions(spark, sf))


THREE_RULES = [CLEAR_RULE, DELETE_RULE, UPDATE_RULE]


def _rolled_barriers(spark, sf):
    return ordering.roll_by_size(D.barrier_log(spark, sf, THREE_RULES), ROLL_BYTES)


def state_at_by_query(spark, sf):
    return fold.state_at(_rolled_barriers(spark, sf), 9)


def replay_targets_by_query(spark, sf):
    return consumers.replay_targets(_rolled_barriers(spark, sf), _positions(spark, sf))


def dead_letter_store(spark, sf):
    """Events whose documents are broken or ill-typed now and then, and some by-query requests of no known kind,
    through capture and replay; the letters as they are read back."""
    root, seq = _scratch(spark), F.col("seq")
    rules = [UPDATE_RULE, {"seq": 4999, "action": "delete_by_query", "query": {"kind": "exists", "field": "k"}}]
    broken = F.when(seq % 97 == 5, F.concat(F.lit("["), F.col("doc"))).when(
        seq % 89 == 7, F.replace("doc", F.lit('"value":'), F.lit('"value":"v","was":'))
    )
    reqs = D.barrier_requests(spark, sf, rules).drop("marker").withColumns(
        {
            "index": F.lit("sample"),
            "indices": F.array(F.lit("sample")),
            "id": F.when((F.col("action") == "delete") & (seq % 50 == 3), None).otherwise(F.col("id")),
            "doc": F.coalesce(broken, "doc"),
        }
    )
    blank = {f.name: F.lit(None).cast(f.dataType) for f in S.REQUEST.fields if f.name not in reqs.columns}
    reqs = reqs.withColumns(blank).select(*S.REQUEST.names)
    jobs.capture_batch(reqs, f"{root}/log", D.TARGETS, 0, max_bytes=ROLL_BYTES)
    jobs.replay_target(spark, f"{root}/log", f"{root}/sample1", D.EVENT_DOC, dead_letter_path=f"{root}/dead", buckets=8)
    return read_dead_letters(spark, f"{root}/dead").select(
        "target", "segment_id", "seq", "item", "action", "id", "doc", "reason", "attempts", F.col("query.kind").alias("kind")
    )


def skip_segments(spark, sf):
    """Every 1000th event is of unknown kind and stops its segment."""
    log = _rolled_log(spark, sf).withColumn("action", F.when(F.col("marker"), "noop").otherwise(F.col("action")))
    kept, _ = failures.apply_error_policy(log, failures.segment_errors(log))
    return fold.replay(kept)


def segment_errors(spark, sf):
    log = _rolled_log(spark, sf).withColumn("action", F.when(F.col("marker"), "noop").otherwise(F.col("action")))
    return failures.apply_error_policy(log, failures.segment_errors(log))[1]


def delete_by_query(spark, sf):
    return barriers.replay_with_queries(D.barrier_log(spark, sf, [DELETE_RULE]))


def update_by_query(spark, sf):
    return barriers.replay_with_queries(D.barrier_log(spark, sf, [CLEAR_RULE, DELETE_RULE, UPDATE_RULE]))


def outcomes_by_query(spark, sf):
    """Outcomes of the requests that name a document."""
    log = D.barrier_log(spark, sf, [CLEAR_RULE, DELETE_RULE, UPDATE_RULE])
    keyed = barriers.outcomes_with_queries(log).where(~F.col("action").isin(*S.BY_QUERY))
    return keyed.select("seq", "item", "action", "id", "exists_before", "failed")


def capture_replay(spark, sf):
    """Bulks through the whole path: routed, captured, cut, replayed, published, read."""
    root = _scratch(spark)
    jobs.capture_batch(D.bulk_requests(spark, sf), f"{root}/log", D.TARGETS, 0, max_bytes=ROLL_BYTES)
    jobs.replay_target(spark, f"{root}/log", f"{root}/sample1", D.EVENT_DOC, buckets=8)
    return tables.read_table(spark, f"{root}/sample1", _EVENT_TABLE)


def publish_conflict(spark, sf):
    """Two writers start from one commit; the table holds what the first of them committed."""
    path, base = _scratch(spark), D.customer_base(spark, sf)
    first = tables.publish_table(base, path, 1, buckets=8)
    tables.publish_table(base.withColumn("balance", F.col("balance") + 1), path, 2, base=first)
    try:
        tables.publish_table(base.withColumn("balance", F.col("balance") + 2), path, 2, base=first)
    except tables.CommitConflict:
        pass
    return tables.read_table(spark, path, base.schema)


def delta_publish(spark, sf):
    """Customers as the table, orders as six runs that add layers, with layers combined in between."""
    path, base, log = _scratch(spark), D.customer_base(spark, sf), D.order_changes(spark, sf)
    at = tables.publish_table(base, path, 1, buckets=8)
    part = log.agg(F.max("seq")).first()[0] // 6 + 1
    for n in range(6):
        run = log.where((F.col("seq") >= n * part) & (F.col("seq") < (n + 1) * part))
        at = layers.publish_layer(layers.effects_of(run), path, n + 2, at)
        at = layers.compact(spark, path, base.schema, at)
    return tables.read_table(spark, path, base.schema)


def replay_batches(spark, sf):
    """Events captured in four batches and replayed in runs of one segment."""
    root, reqs = _scratch(spark), D.event_requests(spark, sf).drop("marker").to(S.REQUEST)
    part = reqs.agg(F.max("seq")).first()[0] // 4 + 1
    for n in range(4):
        batch = reqs.where((F.col("seq") >= n * part) & (F.col("seq") < (n + 1) * part))
        jobs.capture_batch(batch, f"{root}/log", ["sample", "other"], n)
    jobs.replay_target(spark, f"{root}/log", f"{root}/t", D.EVENT_DOC, max_segments=1, buckets=8)
    return tables.read_table(spark, f"{root}/t", _EVENT_TABLE)


_EVENT_TABLE = T.StructType([T.StructField("id", T.StringType()), *D.EVENT_DOC.fields])


def _stream_log(spark, sf, root: str, targets):
    D.event_requests(spark, sf).drop("marker").write.json(f"{root}/in")
    query = capture_stream(
        stream_requests(spark, f"{root}/in"), f"{root}/log", targets, f"{root}/capture", max_bytes=ROLL_BYTES,
        available_now=True,
    )
    query.awaitTermination()


def stream_capture(spark, sf):
    root = _scratch(spark)
    _stream_log(spark, sf, root, D.TARGETS)
    return scan_segments(spark, f"{root}/log").select("seq", "item", "action", "index", "id", "doc")


def stream_capture_renew(spark, sf):
    """Every 1000th event is a refresh, which cuts the segment where it stands."""
    root = _scratch(spark)
    reqs = D.event_requests(spark, sf)
    reqs = reqs.withColumn("action", F.when(F.col("marker"), "refresh").otherwise(F.col("action"))).drop("marker")
    reqs.write.json(f"{root}/in")
    capture_stream(
        stream_requests(spark, f"{root}/in"), f"{root}/log", ["sample", "other"], f"{root}/capture",
        max_bytes=ROLL_BYTES, available_now=True,
    ).awaitTermination()
    return scan_segments(spark, f"{root}/log").select("seq", "segment_id")


def fenced_capture(spark, sf):
    """Two captures go on from one state of the log; of each pair only the later writer's batch is in the log, the
    first one's requests follow as a batch of their own."""
    path, reqs = f"{_scratch(spark)}/log", D.event_requests(spark, sf).drop("marker")
    blank = {f.name: F.lit(None).cast(f.dataType) for f in S.REQUEST.fields if f.name not in reqs.columns}
    reqs = reqs.withColumns(blank).select(*S.REQUEST.names)
    odd, even = (reqs.where(F.expr(f"seq div 1000 % 2 = {k}")) for k in (1, 0))
    first, second = open_writer(spark, path, "first"), open_writer(spark, path, "second")
    jobs.capture_batch(even, path, ["sample", "other"], 0, writer=second)
    try:
        jobs.capture_batch(odd, path, ["sample", "other"], 1, writer=first)
    except WriterFenced:
        jobs.capture_batch(odd, path, ["sample", "other"], 2, writer=open_writer(spark, path, "first"))
    return scan_segments(spark, path).select("segment_id", "action", "index", "id", "doc")


def stream_replay(spark, sf):
    root = _scratch(spark)
    _stream_log(spark, sf, root, ["sample", "other"])
    replay_stream(
        spark, f"{root}/log", f"{root}/sample1", D.EVENT_DOC, f"{root}/replay", available_now=True, buckets=8
    ).awaitTermination()
    return tables.read_table(spark, f"{root}/sample1", _EVENT_TABLE)


QUERIES: dict[str, Query] = {
    "q_classify": classify,
    "q_filter_targets": filter_targets,
    "q_detect_renew": detect_renew,
    "q_ack": ack,
    "q_ack_bulk": ack_bulk,
    "q_assign_ids": assign_ids,
    "q_retarget": retarget,
    "q_render": render,
    "q_render_bulk": render_bulk,
    "q_segment_name": segment_name,
    "q_term_filter": term_filter,
    "q_route_bulk": route_bulk,
    "q_route_items": route_items,
    "q_route_by_query": route_by_query,
    "q_flatten_bulk": flatten_bulk,
    "q_order_log": order_log,
    "q_roll_size": roll_size,
    "q_roll_counter": roll_counter,
    "q_roll_marker": roll_marker,
    "q_segment_stats": segment_stats,
    "q_segment_scan": segment_scan,
    "q_read_requests": read_back,
    "q_page": page,
    "q_count_hits": count_hits,
    "q_next_segment": next_segment,
    "q_resolve_start": resolve_start,
    "q_status": status,
    "q_consumer_list": consumer_list,
    "q_apply_index": apply_index,
    "q_apply_create": apply_create,
    "q_apply_update": apply_update,
    "q_apply_delete": apply_delete,
    "q_apply_bulk": apply_bulk,
    "q_outcomes": outcomes,
    "q_dead_letter": dead_letter,
    "q_replay": replay,
    "q_replay_documents": replay_documents,
    "q_upsert": upsert,
    "q_upsert_outcomes": upsert_outcomes,
    "q_upsert_documents": upsert_documents,
    "q_replay_pages": replay_pages,
    "q_documents_by_query": documents_by_query,
    "q_replay_base": replay_base,
    "q_replay_lineitem": replay_lineitem,
    "q_replay_conv": replay_conv,
    "q_state_at": state_at,
    "q_replay_targets": replay_targets,
    "q_state_at_by_query": state_at_by_query,
    "q_replay_targets_by_query": replay_targets_by_query,
    "q_dead_letter_store": dead_letter_store,
    "q_skip_segments": skip_segments,
    "q_segment_errors": segment_errors,
    "q_delete_by_query": delete_by_query,
    "q_update_by_query": update_by_query,
    "q_outcomes_by_query": outcomes_by_query,
    "q_capture_replay": capture_replay,
    "t_capture": stream_capture,
    "t_replay": stream_replay,
    "t_capture_renew": stream_capture_renew,
    "q_fenced_capture": fenced_capture,
    "q_publish_conflict": publish_conflict,
    "q_replay_batches": replay_batches,
    "q_delta_publish": delta_publish,
}
