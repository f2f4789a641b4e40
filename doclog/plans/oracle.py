"""The same queries in SQL, for comparison by another engine on the same tables."""

from __future__ import annotations

REQ = """
req AS (
  SELECT event_id AS seq, CAST(event_id % 10 AS INTEGER) AS item, event_id // 10 AS request_id,
    CASE event_type WHEN 'signup' THEN 'index' WHEN 'view' THEN 'create' WHEN 'error' THEN 'delete'
      ELSE 'update' END AS action,
    CASE WHEN (event_id // 10) % 3 = 0 THEN 'sample' WHEN (event_id // 10) % 3 = 1 THEN 'other'
      WHEN user_id % 2 = 0 THEN 'sample' ELSE 'other' END AS index,
    'doc' AS type, CAST(user_id AS VARCHAR) AS id, user_id, event_type, value,
    CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) AS k,
    event_type <> 'purchase' AS has_k,
    CAST(length(event_type) + length(props) AS BIGINT) AS bytes, event_id % 1000 = 999 AS marker
  FROM events)"""

DOCS = """
req_doc AS (
  SELECT *, CASE WHEN event_type = 'purchase' THEN '{"value":' || CAST(value AS VARCHAR) || '}'
    WHEN event_type <> 'error' THEN '{"value":' || CAST(value AS VARCHAR) || ',"k":' || CAST(k AS VARCHAR) || '}'
    END AS doc FROM req)"""

ROLLED = """
rolled AS (
  SELECT *, CAST(coalesce(sum(bytes) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    // 10000 + 1 AS BIGINT) AS segment_id FROM req)"""

ROUTES = """
routes AS (
  SELECT request_id, CASE WHEN count(*) FILTER (WHERE index = 'sample') = 0 THEN 'pass'
    WHEN count(*) FILTER (WHERE index = 'sample') = count(*) THEN 'capture' ELSE 'reject' END AS route,
    count(*) FILTER (WHERE index = 'sample') AS hits, count(*) AS items
  FROM req GROUP BY request_id)"""

POS = """
pos AS (
  SELECT n_name AS target, CASE WHEN n_regionkey = 4 THEN 'other' ELSE 'index' END AS doc_type,
    CASE WHEN n_regionkey = 0 THEN '' ELSE 'node ' || CAST(n_regionkey AS VARCHAR) END AS node_name,
    CAST(n_nationkey AS BIGINT) - 2 AS file_position, CAST(n_nationkey AS BIGINT) AS minutes
  FROM nation)"""

GAPPED = """
stats AS (
  SELECT segment_id, count(*) AS requests, CAST(sum(bytes) AS BIGINT) AS bytes, min(seq) AS min_seq,
    max(seq) AS max_seq FROM rolled GROUP BY segment_id),
gapped AS (SELECT segment_id * 3 AS segment_id, max_seq AS finished FROM stats)"""


def outcomes(source: str, name: str = "o", keys: str = "id") -> str:
    """Existence before each request, and whether it fails."""
    return f"""
{name}_seen AS (
  SELECT *, coalesce(last_value(CASE WHEN action IN ('index', 'create') THEN 1 WHEN action = 'delete' THEN 0 END
    IGNORE NULLS) OVER (PARTITION BY {keys} ORDER BY seq, item ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1
    AS exists_before FROM {source}),
{name} AS (
  SELECT *, (action = 'create' AND exists_before) OR (action = 'update' AND NOT exists_before) AS failed
  FROM {name}_seen)"""


def state(source: str, name: str, keys: str = "id") -> str:
    """Latest value of each field among the requests that did not fail; deleted documents dropped."""
    at = "seq * 1000 + item"
    return f"""
{name} AS (
  SELECT {keys}, arg_max_null(value, {at}) AS value, arg_max_null(k, {at}) FILTER (WHERE has_k) AS k
  FROM {source} WHERE NOT failed GROUP BY {keys}
  HAVING arg_max(action, {at}) FILTER (WHERE action <> 'update') <> 'delete')"""


UPSERTS = """
given AS (
  SELECT *, (event_type = 'click' AND user_id % 3 = 0) OR (event_type = 'purchase' AND user_id % 5 = 0) AS brings FROM req),
met AS (
  SELECT *, coalesce(last_value(CASE WHEN action IN ('index', 'create') OR brings THEN 1 WHEN action = 'delete' THEN 0 END
    IGNORE NULLS) OVER (PARTITION BY id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1
    AS exists_before FROM given),
judged AS (
  SELECT * REPLACE (CASE WHEN opens AND event_type = 'click' THEN value + 1 ELSE value END AS value,
      CASE WHEN opens AND event_type = 'click' THEN k + 100 WHEN has_k THEN k END AS k, has_k OR opens AS has_k)
  FROM (
    SELECT *, brings AND NOT exists_before AS opens, (action = 'create' AND exists_before)
      OR (action = 'update' AND NOT exists_before AND NOT brings) AS failed FROM met)),
inserted AS (
  SELECT id, arg_max_null(value, seq) AS value, arg_max_null(k, seq) FILTER (WHERE has_k) AS k,
    max(seq) FILTER (WHERE opens OR action <> 'update') AS opened
  FROM judged WHERE NOT failed GROUP BY id
  HAVING arg_max(action, seq) FILTER (WHERE opens OR action <> 'update') <> 'delete')"""


def seeded(rest: str, before: str, name: str) -> str:
    """The requests `rest` after a table `before`, whose rows come first as whole documents."""
    return f"""
{name} AS (
  SELECT seq, item, action, id, value, k, has_k FROM req WHERE {rest}
  UNION ALL SELECT -1, 0, 'index', id, value, k, true FROM {before})"""


def sql(*ctes: str, final: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + final


NO_IDS = """
no_ids AS (
  SELECT seq, item, action, index, type, CASE WHEN action = 'index' AND user_id % 2 = 1 THEN NULL ELSE id END AS id,
    CASE WHEN action = 'update' THEN user_id END AS version FROM req)"""

LINE = """'{[' || index || '][doc][' || id || ']'"""
RENDERED = f"""
lines AS (
  SELECT seq, item, request_id, CASE WHEN action IN ('index', 'create') THEN 'index ' || {LINE} || ', source[' || doc || ']}}'
    WHEN action = 'update' THEN 'update ' || {LINE} || ' source[{{"doc":' || doc || '}}]}}'
    ELSE 'delete ' || {LINE} || '}}' END AS line
  FROM req_doc)"""

STATUS = """
SELECT target, doc_type, node_name, file_position, node_name <> '' AND minutes < 10 AS running, g.finished,
  w.position AS writer_position, w.position - file_position AS lag
FROM {source} p LEFT JOIN gapped g ON g.segment_id = p.file_position - 1,
  (SELECT max(segment_id) + 1 AS position FROM gapped) w"""

_first = (
    seeded("seq < 2999", "(SELECT NULL AS id, NULL AS value, NULL AS k WHERE false)", "r1")
    + "," + outcomes("r1", "o1") + "," + state("o1", "s1")
)
# The table at 2999 is cleared when that request is there, else carried on.
_cleared = """
c1 AS (SELECT * FROM s1 WHERE NOT EXISTS (SELECT 1 FROM req WHERE seq = 2999))"""
_second = (
    seeded("seq > 2999 AND seq < 4999", "c1", "r2") + "," + outcomes("r2", "o2") + "," + state("o2", "s2")
)
_cut = """
c2 AS (SELECT * FROM s2 WHERE NOT (k BETWEEN 0 AND 49 AND EXISTS (SELECT 1 FROM req WHERE seq = 4999)))"""
_third = seeded("seq > 4999 AND seq < 7000", "c2", "r3") + "," + outcomes("r3", "o3") + "," + state("o3", "s3")
_set = """
c3 AS (SELECT id, CASE WHEN k = 95 AND EXISTS (SELECT 1 FROM req WHERE seq = 7000) THEN 0.0 ELSE value END AS value, k
  FROM s3)"""
_fourth = seeded("seq > 7000", "c3", "r4") + "," + outcomes("r4", "o4") + "," + state("o4", "s4")
THREE_RULES = (REQ, _first, _cleared, _second, _cut, _third, _set, _fourth)

def three_rules(log: str, keys: str = "id") -> tuple[str, ...]:
    """The three by-query requests over the requests of `log` (for each of `keys` but the id), ending in table z4."""
    by = keys.replace("id", "").strip(", ")
    also = f" AND r.{by} = s.{by}" if by else ""
    parts, before = [], f"(SELECT {', '.join('NULL AS ' + k for k in keys.split(', '))}, NULL AS value, NULL AS k WHERE false)"
    cuts = [-1, 2999, 4999, 7000, 1 << 62]
    there = f"EXISTS (SELECT 1 FROM {log} r WHERE r.seq = {{}}{also})"
    changes = [
        f"SELECT * FROM y1 s WHERE NOT {there.format(2999)}",
        f"SELECT * FROM y2 s WHERE NOT coalesce(k BETWEEN 0 AND 49 AND {there.format(4999)}, false)",
        f"SELECT {keys}, CASE WHEN k = 95 AND {there.format(7000)} THEN 0.0 ELSE value END AS value, k FROM y3 s",
        "SELECT * FROM y4 s",
    ]
    for n, change in enumerate(changes, 1):
        parts.append(f"""
x{n} AS (
  SELECT {keys}, seq, item, action, value, k, has_k FROM {log} WHERE seq > {cuts[n - 1]} AND seq < {cuts[n]}
  UNION ALL SELECT {keys}, -1, 0, 'index', value, k, true FROM {before})""")
        parts += [outcomes(f"x{n}", f"u{n}", keys), state(f"u{n}", f"y{n}", keys), f"\nz{n} AS ({change})"]
        before = f"z{n}"
    return tuple(parts)


BAD = """
noop AS (SELECT * REPLACE (CASE WHEN marker THEN 'noop' ELSE action END AS action) FROM rolled),
bad AS (SELECT segment_id, min(seq) AS seq FROM noop WHERE action = 'noop' GROUP BY segment_id)"""

MARKED = """
m1 AS (
  SELECT seq, marker, bytes,
    coalesce(sum(CASE WHEN marker THEN 0 ELSE bytes END) OVER w, 0) AS before,
    coalesce(count(*) FILTER (WHERE marker) OVER w, 0) AS epoch
  FROM req WINDOW w AS (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
m2 AS (
  SELECT seq, epoch, (before - min(before) OVER (PARTITION BY epoch)) // 10000 AS bucket FROM m1 WHERE NOT marker)"""

_ORD = """
changes AS (
  SELECT o_orderkey AS seq, 0 AS item, CASE o_orderstatus WHEN 'F' THEN 'update' WHEN 'O' THEN 'index' ELSE 'delete'
    END AS action, o_custkey AS id, o_totalprice AS balance FROM orders
  UNION ALL SELECT -1, 0, 'index', c_custkey, c_acctbal FROM customer)"""

_TURNS = """
turns AS (
  SELECT turn AS seq, 0 AS item, CASE role WHEN 'system' THEN 'index' ELSE 'update' END AS action, conv_id AS id, text
  FROM conversations)"""

_LAST_LINE = "l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus"

ORACLE: dict[str, str] = {
    "q_classify": sql(REQ, final="""
        SELECT seq, item, CASE WHEN event_type = 'click' THEN 'click' ELSE action END AS action,
          CASE WHEN event_type = 'click' THEN 0 WHEN action = 'delete' THEN 1 WHEN action = 'update' THEN 4 ELSE 3 END
          AS code FROM req
        UNION ALL SELECT min(seq), 0, 'bulk', 99 FROM req GROUP BY request_id"""),
    "q_filter_targets": sql(REQ, final="SELECT seq, action, index, id FROM req WHERE index = 'sample'"),
    "q_detect_renew": sql(REQ, final="""
        SELECT seq, CASE event_type WHEN 'signup' THEN 'indices:admin/refresh' WHEN 'view' THEN 'indices:admin/flush'
            WHEN 'error' THEN 'indices:admin/forcemerge' WHEN 'click' THEN 'indices:admin/upgrade'
            ELSE 'indices:admin/close' END AS name,
          event_type <> 'purchase' AND user_id % 4 <> 3 AS renew
        FROM req"""),
    "q_ack": sql(REQ, NO_IDS, final="""
        SELECT seq, item, action, index, type, coalesce(id, 'idxproxy') AS ack_id, version,
          CASE WHEN action = 'delete' THEN 'deleted' ELSE 'created' END AS result,
          CASE WHEN action = 'delete' THEN true END AS found,
          CAST(CASE WHEN action = 'delete' THEN 1 END AS INTEGER) AS shards_total,
          CAST(CASE WHEN action = 'delete' THEN 1 END AS INTEGER) AS shards_successful,
          CAST(NULL AS BIGINT) AS total, CAST(NULL AS BIGINT) AS updated, CAST(NULL AS BIGINT) AS deleted
        FROM no_ids"""),
    "q_ack_bulk": sql(REQ, final="""
        SELECT request_id * 10 AS bulk_seq, item, action, index, id AS ack_id,
          CASE WHEN action = 'delete' THEN 'deleted' ELSE 'created' END AS result,
          CASE WHEN action = 'delete' THEN true END AS found FROM req"""),
    "q_assign_ids": sql(REQ, NO_IDS, final="""
        SELECT seq, item, action,
          coalesce(id, sha256(CAST(seq AS VARCHAR) || '#' || CAST(item AS VARCHAR))) AS id FROM no_ids"""),
    "q_retarget": sql(REQ, final="SELECT request_id, item, action, 'sample1' AS index, id FROM req"),
    "q_render": sql(REQ, DOCS, RENDERED, final="SELECT seq, item, line FROM lines"),
    "q_render_bulk": sql(REQ, DOCS, RENDERED, final="""
        SELECT min(seq) AS seq, 0 AS item, 'bulk [' || string_agg(line, ',' ORDER BY item) || ']' AS line
        FROM lines GROUP BY request_id"""),
    "q_segment_name": sql(REQ, ROLLED, final="""
        SELECT DISTINCT segment_id, lpad(CAST(segment_id AS VARCHAR), 19, '0') AS segment_name, segment_id AS parsed
        FROM rolled"""),
    "q_term_filter": "SELECT event_id, user_id, value FROM events WHERE event_type = 'click'",
    "q_route_bulk": sql(REQ, ROUTES, final="SELECT request_id, route FROM routes"),
    "q_route_items": sql(REQ, ROUTES, final="SELECT request_id, hits, items, route FROM routes"),
    "q_route_by_query": sql(REQ, final="""
        SELECT request_id, CASE WHEN count(*) FILTER (WHERE action = 'delete' AND index = 'sample') = 0 THEN 'pass'
          WHEN count(*) FILTER (WHERE action = 'delete' AND index = 'sample')
            = count(*) FILTER (WHERE action = 'delete') THEN 'capture' ELSE 'reject' END AS route
        FROM req GROUP BY request_id"""),
    "q_flatten_bulk": sql(REQ, DOCS, final="SELECT request_id, item, action, index, type, id, doc FROM req_doc"),
    "q_order_log": f"""
        SELECT row_number() OVER (ORDER BY {_LAST_LINE}, l_orderkey, l_linenumber) - 1 AS seq, l_orderkey, l_linenumber,
          l_partkey, l_suppkey FROM lineitem""",
    "q_roll_size": sql(REQ, ROLLED, final="SELECT seq, segment_id FROM rolled"),
    "q_roll_counter": sql(REQ, """
        offsets AS (
          SELECT seq, CAST(coalesce(sum(bytes) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            AS BIGINT) AS b FROM req)""", """
        starts AS (
          SELECT min(b) AS s FROM offsets
          UNION ALL SELECT min(b) FROM starts JOIN offsets ON b > s + 10000 HAVING min(b) IS NOT NULL)""", """
        ranked AS (SELECT s, row_number() OVER (ORDER BY s) AS segment_id FROM starts)""", final="""
        SELECT seq, segment_id FROM offsets ASOF JOIN ranked ON b >= s""").replace("WITH", "WITH RECURSIVE", 1),
    "q_roll_marker": sql(REQ, MARKED, final="""
        SELECT seq, dense_rank() OVER (ORDER BY epoch, bucket) AS segment_id FROM m2"""),
    "q_segment_stats": sql(REQ, ROLLED, GAPPED, final="SELECT * FROM stats"),
    "q_segment_scan": sql(REQ, DOCS, ROLLED, final="""
        SELECT segment_id, seq, item, action, id, doc FROM rolled JOIN (SELECT seq, doc FROM req_doc) USING (seq)"""),
    "q_read_requests": sql(REQ, DOCS, final="""
        SELECT seq, item, action, index, id, doc,
          CASE action WHEN 'delete' THEN 1 WHEN 'update' THEN 4 ELSE 3 END AS code FROM req_doc"""),
    "q_page": sql(REQ, final="SELECT seq, action, id FROM req ORDER BY seq LIMIT 10 OFFSET 20"),
    "q_count_hits": "SELECT count(*) AS total FROM events",
    "q_next_segment": sql(REQ, ROLLED, GAPPED, POS, final="""
        SELECT target, file_position, coalesce(bool_or(g.segment_id = file_position), false) AS ready,
          min(g.segment_id) AS next_segment
        FROM pos LEFT JOIN gapped g ON g.segment_id BETWEEN file_position AND CASE WHEN file_position < 0 THEN 10
          ELSE file_position + 10 END GROUP BY target, file_position"""),
    "q_resolve_start": sql(POS, final="""
        SELECT r.target, requested, file_position AS stored,
          CASE WHEN requested > 0 THEN requested ELSE coalesce(file_position, 1) END AS start
        FROM (SELECT s_name AS target, CAST(s_nationkey AS BIGINT) - 12 AS requested FROM supplier
              UNION ALL SELECT n_name, CAST(n_regionkey AS BIGINT) * 3 - 6 FROM nation) r
        LEFT JOIN pos ON pos.target = r.target"""),
    "q_status": sql(REQ, ROLLED, GAPPED, POS, final=STATUS.format(source="pos")),
    "q_consumer_list": sql(REQ, ROLLED, GAPPED, POS, final=STATUS.format(
        source="(SELECT * FROM pos WHERE doc_type = 'index' ORDER BY target LIMIT 10 OFFSET 5)")),
    "q_apply_index": sql(REQ, final="""
        SELECT id, arg_max_null(value, seq) AS value, arg_max_null(k, seq) AS k FROM req WHERE action = 'index'
        GROUP BY id"""),
    "q_apply_create": sql(REQ, ROLLED, "early AS (SELECT * FROM rolled WHERE segment_id < 2)", outcomes("early"),
        state("o", "s"), final="""
        SELECT id, value, k FROM s
        UNION ALL SELECT id, arg_min_null(value, seq), arg_min_null(k, seq) FROM req
          WHERE action = 'create' AND id NOT IN (SELECT id FROM s) GROUP BY id"""),
    "q_apply_update": sql(REQ, """
        b AS (SELECT id, arg_max_null(value, seq) AS value, arg_max_null(k, seq) AS k FROM req WHERE action = 'index'
          GROUP BY id),
        u AS (SELECT id, arg_max_null(value, seq) AS v, count(*) FILTER (WHERE has_k) AS n,
          arg_max_null(k, seq) FILTER (WHERE has_k) AS uk FROM req WHERE action = 'update' GROUP BY id)""", final="""
        SELECT b.id, CASE WHEN u.id IS NULL THEN value ELSE v END AS value,
          CASE WHEN coalesce(n, 0) = 0 THEN k ELSE uk END AS k FROM b LEFT JOIN u ON u.id = b.id"""),
    "q_apply_delete": """
        SELECT c_custkey AS id, c_acctbal AS balance FROM customer
        WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""",
    "q_apply_bulk": sql(REQ, outcomes("req"), state("o", "s"), final="SELECT * FROM s"),
    "q_outcomes": sql(REQ, outcomes("req"), final="""
        SELECT seq, item, action, id, exists_before, failed, CASE WHEN failed THEN 'failed'
          WHEN action = 'delete' THEN CASE WHEN exists_before THEN 'deleted' ELSE 'not_found' END
          WHEN action = 'update' OR (action = 'index' AND exists_before) THEN 'updated' ELSE 'created' END AS result
        FROM o"""),
    "q_dead_letter": sql(REQ, ROLLED, outcomes("rolled"), final="""
        SELECT 'sample1' AS target, segment_id, CAST(position AS INTEGER) AS position, seq, action, id,
          CASE action WHEN 'create' THEN 'document exists' ELSE 'document missing' END AS reason, 1 AS attempts
        FROM (SELECT *, row_number() OVER (PARTITION BY segment_id ORDER BY seq) AS position FROM o) WHERE failed"""),
    "q_replay": sql(REQ, outcomes("req"), state("o", "s"), final="SELECT * FROM s"),
    "q_replay_documents": sql(REQ, outcomes("req"), final="""
        SELECT id, arg_max_null(value, seq) AS value, arg_max_null(k, seq) FILTER (WHERE has_k) AS k, 'k,value' AS names
        FROM o WHERE NOT failed GROUP BY id HAVING arg_max(action, seq) FILTER (WHERE action <> 'update') <> 'delete'"""),
    "q_upsert": sql(REQ, UPSERTS, final="SELECT id, value, k FROM inserted"),
    "q_upsert_outcomes": sql(REQ, UPSERTS, final="""
        SELECT seq, item, id, exists_before, failed, CASE WHEN failed THEN 'failed'
          WHEN action = 'delete' THEN CASE WHEN exists_before THEN 'deleted' ELSE 'not_found' END
          WHEN exists_before THEN 'updated' ELSE 'created' END AS result FROM judged"""),
    "q_upsert_documents": sql(REQ, UPSERTS, final="""
        SELECT id, any_value(i.value) AS value, any_value(i.k) AS k,
          CASE WHEN bool_or(event_type <> 'purchase' AND event_type <> 'error') THEN 'k,value' ELSE 'value' END AS names
        FROM inserted AS i JOIN judged AS j USING (id) WHERE NOT failed AND j.seq >= opened GROUP BY id"""),
    "q_replay_pages": """
        SELECT page_id AS id, url, CAST(CASE WHEN lang IS NULL OR lang = 'en' THEN length(html) ELSE n_chars END AS VARCHAR)
            AS chars, url AS tag, lang,
          CASE WHEN lang = 'en' THEN source END AS source
        FROM pages LEFT JOIN documents ON doc_id = page_id WHERE n_chars IS NULL OR n_chars >= 100""",
    "q_documents_by_query": sql(*THREE_RULES, final="SELECT * FROM s4"),
    "q_replay_base": sql(_ORD, outcomes("changes"), final="""
        SELECT id, arg_max_null(balance, seq) AS balance FROM o WHERE NOT failed GROUP BY id
        HAVING arg_max(action, seq) FILTER (WHERE action <> 'update') <> 'delete'"""),
    "q_replay_lineitem": f"""
        SELECT l_orderkey, l_linenumber, {_LAST_LINE} FROM (
          SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {", ".join(
              c + " DESC" for c in _LAST_LINE.split(", "))}) AS n FROM lineitem) WHERE n = 1""",
    "q_replay_conv": sql(_TURNS, outcomes("turns"), final="""
        SELECT id, arg_max_null(text, seq) AS text FROM o WHERE NOT failed GROUP BY id"""),
    "q_state_at": sql(REQ, ROLLED, "early AS (SELECT * FROM rolled WHERE segment_id < 3)", outcomes("early"),
        state("o", "s"), final="SELECT * FROM s"),
    "q_replay_targets": sql(REQ, ROLLED, POS, """
        per AS (SELECT target, rolled.* FROM rolled JOIN pos ON segment_id >= file_position)""",
        outcomes("per", keys="target, id"), state("o", "s", keys="target, id"), final="SELECT * FROM s"),
    "q_state_at_by_query": sql(REQ, ROLLED, "early AS (SELECT * FROM rolled WHERE segment_id < 9)", *three_rules("early"),
        final="SELECT * FROM z4"),
    "q_replay_targets_by_query": sql(REQ, ROLLED, POS, """
        per AS (SELECT target, rolled.* FROM rolled JOIN pos ON segment_id >= file_position)""",
        *three_rules("per", "target, id"), final="SELECT * FROM z4"),
    "q_dead_letter_store": sql(REQ, DOCS, ROLLED, """
        bad AS (
          SELECT rolled.* REPLACE (
              CASE WHEN seq IN (4999, 7000) OR (action = 'delete' AND seq % 50 = 3) THEN NULL ELSE id END AS id,
              CASE seq WHEN 4999 THEN 'delete_by_query' WHEN 7000 THEN 'update_by_query' ELSE action END AS action),
            CASE WHEN seq IN (4999, 7000) THEN NULL WHEN seq % 97 = 5 THEN '[' || doc
              WHEN seq % 89 = 7 THEN replace(doc, '"value":', '"value":"v","was":') ELSE doc END AS doc
          FROM rolled JOIN (SELECT seq, doc FROM req_doc) USING (seq)),
        fate AS (
          SELECT *, CASE WHEN seq = 4999 THEN 'kind of query not known' WHEN id IS NULL AND action = 'delete' THEN 'no id'
            WHEN action <> 'delete' AND seq % 97 = 5 THEN 'unreadable document'
            WHEN action <> 'delete' AND seq % 89 = 7 THEN 'document does not fit the fields' END AS early
          FROM bad),
        good AS (SELECT * FROM fate WHERE early IS NULL AND seq <> 7000)""", outcomes("good"), final="""
        SELECT 'sample1' AS target, segment_id, seq, item, action, id, doc, reason, CAST(1 AS INTEGER) AS attempts,
          CASE seq WHEN 4999 THEN 'exists' END AS kind
        FROM (
          SELECT segment_id, seq, item, action, id, doc, early AS reason FROM fate WHERE early IS NOT NULL
          UNION ALL SELECT segment_id, seq, item, action, id, doc,
            CASE action WHEN 'create' THEN 'document exists' ELSE 'document missing' END FROM o WHERE failed)"""),
    "q_skip_segments": sql(REQ, ROLLED, BAD, """
        kept AS (SELECT noop.* FROM noop LEFT JOIN bad USING (segment_id) WHERE bad.seq IS NULL OR noop.seq < bad.seq)""",
        outcomes("kept"), state("o", "s"), final="SELECT * FROM s"),
    "q_segment_errors": sql(REQ, ROLLED, BAD, final="""
        SELECT segment_id, seq, 'kind of request not known' AS reason, 1 AS tries, true AS skipped FROM bad"""),
    "q_delete_by_query": sql(REQ,
        seeded("seq < 4999", "(SELECT NULL AS id, NULL AS value, NULL AS k WHERE false)", "r1"),
        outcomes("r1", "o1"), state("o1", "s2"), _cut,
        seeded("seq > 4999", "c2", "r3"), outcomes("r3", "o3"), state("o3", "s3"), final="SELECT * FROM s3"),
    "q_update_by_query": sql(*THREE_RULES, final="SELECT * FROM s4"),
    "q_outcomes_by_query": sql(*THREE_RULES, final="""
        SELECT seq, item, action, id, exists_before, failed FROM (
          SELECT * FROM o1 UNION ALL SELECT * FROM o2 UNION ALL SELECT * FROM o3 UNION ALL SELECT * FROM o4)
        WHERE seq >= 0"""),
    "q_capture_replay": sql(REQ, ROUTES, """
        taken AS (SELECT req.* FROM req JOIN routes USING (request_id) WHERE route = 'capture')""",
        outcomes("taken"), state("o", "s"), final="SELECT * FROM s"),
    "t_capture": sql(REQ, DOCS, final="SELECT seq, item, action, index, id, doc FROM req_doc WHERE index = 'sample'"),
    "t_replay": sql(REQ, outcomes("req"), state("o", "s"), final="SELECT * FROM s"),
    "t_capture_renew": sql(REQ, MARKED, final="""
        SELECT seq, dense_rank() OVER (ORDER BY epoch, bucket) AS segment_id FROM m2"""),
    "q_fenced_capture": sql(REQ, DOCS, final="""
        SELECT CAST(1 AS BIGINT) AS segment_id, action, index, id, doc FROM req_doc WHERE (seq // 1000) % 2 = 0 UNION ALL
        SELECT 2, action, index, id, doc FROM req_doc WHERE (seq // 1000) % 2 = 1"""),
    "q_publish_conflict": "SELECT c_custkey AS id, c_acctbal + 1 AS balance FROM customer",
    "q_delta_publish": sql(_ORD, outcomes("changes"), final="""
        SELECT id, arg_max_null(balance, seq) AS balance FROM o WHERE NOT failed GROUP BY id
        HAVING arg_max(action, seq) FILTER (WHERE action <> 'update') <> 'delete'"""),
    "q_replay_batches": sql(REQ, outcomes("req"), state("o", "s"), final="SELECT * FROM s"),
}
