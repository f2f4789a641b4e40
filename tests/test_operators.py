import datetime

import pytest
from pyspark.sql import functions as F

from doclog import schema as S
from doclog.functions.requests import next_position, parse_segment_name, segment_name
from doclog.operators import consumers, failures, ordering, routing, segments, shaping
from doclog.plans.jobs import due_segments
from helpers import doc, item, request, request_frame

MAX = S.MAX_LONG


def test_next_position(spark):
    rows = spark.createDataFrame([(-1,), (0,), (1,), (MAX - 1,), (MAX,)], "p long")
    assert [r[0] for r in rows.select(next_position(F.col("p"))).collect()] == [1, 1, 2, MAX, 1]


def test_segment_names(spark):
    row = spark.range(1, 2).select(segment_name(F.col("id")).alias("n")).select(
        "n", parse_segment_name(F.col("n")).alias("p"))
    assert tuple(row.first()) == ("0000000000000000001", 1)


def test_codes(spark):
    kinds = ["bulk", "index", "create", "update", "delete", "delete_by_query", "update_by_query", "get", None]
    rows = spark.createDataFrame([(k,) for k in kinds], "action string")
    got = {r.action: r.code for r in routing.classify_requests(rows).collect()}
    assert got == dict(zip(kinds, [99, 3, 3, 4, 1, 2, 5, 0, 0]))


def test_renew(spark):
    name = "indices:admin/"
    rows = spark.createDataFrame(
        [(1, "refresh", None), (2, "flush", []), (3, "flush", ["sample"]), (4, "flush", ["other"]), (5, "close", None),
         (6, "indices:admin/upgrade", ["other", "sample"])],
        "n int, name string, indices array<string>",
    )
    rows = routing.full_action_names(rows)
    assert all(r.name.startswith(name) for r in rows.collect())
    all_cut = routing.detect_renew(rows, ["sample"]).where("renew").collect()
    assert {r.n for r in all_cut} == {1, 2, 3, 6}
    only_flush = routing.detect_renew(rows, ["sample"], ["flush"]).where("renew").collect()
    assert {r.n for r in only_flush} == {2, 3}


def test_routes(spark):
    rows = [
        request(1, "bulk", index=None, items=[item("index", 1, doc(1)), item("delete", 2)]),
        request(2, "bulk", index=None, items=[item("index", 1, doc(1)), item("delete", 2) | {"index": "other"}]),
        request(3, "bulk", index=None, items=[]),
        request(4, "delete_by_query", index=None, indices=["sample"]),
        request(5, "update_by_query", index=None, indices=["sample", "other"]),
        request(6, "delete_by_query", index=None, indices=[]),
        request(7, "delete_by_query", index=None, indices=None),
        request(8, "index", id="1"),
        request(9, "index", index="other", id="1"),
        request(10, "index", index=None, id="1"),
    ]
    got = {r.seq: r.route for r in routing.route_requests(request_frame(spark, rows), ["sample"]).collect()}
    assert got == {1: "capture", 2: "reject", 3: "pass", 4: "capture", 5: "reject", 6: "pass", 7: "pass",
                   8: "capture", 9: "pass", 10: "pass"}
    bulks = routing.route_bulk(request_frame(spark, rows[:3]), ["sample"]).collect()
    assert [r.route for r in sorted(bulks)] == ["capture", "reject", "pass"]
    long_list = ["sample"] + [f"i{n}" for n in range(2000)]
    assert {r.seq for r in routing.filter_targets(request_frame(spark, rows), long_list).collect()} == {8}


def test_flatten_and_retarget(spark):
    rows = [request(3, "bulk", index=None, items=[item("create", 5, doc(5)), item("delete", 7)]),
            request(4, "index", id="1", doc=doc(1)),
            request(5, "delete_by_query", index=None, indices=["sample", "old"])]
    flat = shaping.flatten_bulk(request_frame(spark, rows)).orderBy("seq", "item").collect()
    assert [(r.seq, r.item, r.action, r.id) for r in flat] == [
        (3, 0, "create", "5"), (3, 1, "delete", "7"), (4, 0, "index", "1"), (5, 0, "delete_by_query", None)]
    moved = shaping.retarget(request_frame(spark, rows), "t1").orderBy("seq").collect()
    assert [x["index"] for x in moved[0]["items"]] == ["t1", "t1"]
    assert (moved[1]["index"], moved[2]["index"], moved[2]["indices"]) == ("t1", None, ["t1"])
    frame = request_frame(spark, rows)
    assert shaping.retarget(frame, None) is frame
    bad = request_frame(spark, [request(1, "bulk", items=[item("get", 1)])])
    with pytest.raises(Exception, match="item that cannot be replayed"):
        shaping.retarget(bad, "t1").collect()


def test_acks(spark):
    rows = [request(1, "index", id=None, version=-3), request(2, "delete", id="7"), request(3, "update", id="7"),
            request(4, "delete_by_query", index=None, indices=["sample"]),
            request(5, "bulk", index=None, items=[item("index", 1, doc(1)), item("delete", 2)])]
    got = {r.seq: r for r in shaping.synthesize_ack(request_frame(spark, rows)).collect()}
    assert (got[1].ack_id, got[1].result, got[1].version) == (S.PLACEHOLDER_ID, "created", -3)
    assert (got[2].found, got[2].shards_total, got[2].shards_successful) == (True, 1, 1)
    assert got[3].result == "created"
    assert (got[4].total, got[4].updated, got[4].deleted, got[4].ack_id) == (0, 0, 0, None)
    assert [(x["item"], x["ack_id"], x["result"]) for x in got[5]["items"]] == [(0, "1", "created"), (1, "2", "deleted")]


def test_render(spark):
    query = {"kind": "term", "field": "msg", "lo": "a\nb", "hi": None}
    rows = [
        request(1, "index", id="1", doc='{"a":1}'),
        request(2, "update", id="1", doc='{"a":2}'),
        request(3, "delete", id="1"),
        request(4, "delete_by_query", index=None, indices=["sample", "x"], query=query),
        request(5, "bulk", index=None, items=[item("update", 1, '{"a":3}'), item("delete", 2)]),
        request(6, "index", id=None, doc='{"a":1}'),
    ]
    lines = [r.line for r in shaping.render_requests(request_frame(spark, rows)).orderBy("seq").collect()]
    assert lines[0] == 'index {[sample][doc][1], source[{"a":1}]}'
    assert lines[1] == 'update {[sample][doc][1] source[{"doc":{"a":2}}]}'
    assert lines[2] == "delete {[sample][doc][1]}"
    assert lines[3].startswith("delete_by_query [sample,x] {") and "\n" not in lines[3]
    assert lines[4] == 'bulk [update {[sample][doc][1] source[{"doc":{"a":3}}]},delete {[sample][doc][2]}]'
    assert lines[5] == 'index {[sample][doc][null], source[{"a":1}]}'


def test_renew_set_decides_cuts(spark):
    """With flush alone a refresh does not cut a segment, a flush does; an empty segment is not cut."""
    rows = [(0, 10, None), (1, 0, "refresh"), (2, 10, None), (3, 0, "flush"), (4, 0, "flush"), (5, 10, None)]
    log = spark.createDataFrame(rows, "seq long, bytes long, name string").withColumn("item", F.lit(0))
    for cuts, want in [(["flush"], [1, 1, 2]), (["flush", "refresh"], [1, 2, 3]), ([], [1, 1, 1])]:
        marked = log.withColumn("marker", F.coalesce(F.col("name").isin(*cuts), F.lit(False)))
        rolled = ordering.roll_by_marker(marked.where("name is null or marker"), chunk_bits=1)
        got = {r.seq: r.segment_id for r in rolled.collect()}
        assert [got[s] for s in (0, 2, 5)] == want


def test_items_of_one_request_stay_together(spark):
    rows = [(s, i, 40) for s in range(60) for i in range(s % 4 + 1)]
    log = spark.createDataFrame(rows, "seq long, item int, bytes long")
    for bits in (2, 18):
        rolled = ordering.roll_by_size(log, 100, bits).groupBy("seq").agg(F.count_distinct("segment_id").alias("n"))
        assert {r.n for r in rolled.collect()} == {1}


def test_order_log_is_dense_with_ties(spark):
    rows = spark.range(5000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    got = ordering.order_log(rows, ["k"], start=100).orderBy("seq").collect()
    assert [r.seq for r in got] == list(range(100, 5100))
    assert [r.k for r in got] == sorted(r.k for r in got)


def test_next_segment(spark):
    ids = [1, 4, 30, 55]
    segs = spark.createDataFrame([(i,) for i in ids], "segment_id long")
    where = list(range(-3, 62)) + [MAX]
    positions = spark.createDataFrame([(f"t{p}", p) for p in where], "target string, file_position long")
    for lookup in (1, 7, 1000):
        got = {r.file_position: r.next_segment for r in segments.next_segment(positions, segs, lookup).collect()}
        for p in where:
            first = 1 if p < 0 or p == MAX else p + 1
            found = [i for i in ids if first <= i < first + lookup]
            assert got[p] == (p if p in ids else min(found, default=None)), (p, lookup)
    assert due_segments(segs, 2, 1000, 10) == [4, 30, 55]


def test_resolve_start(spark):
    stored = spark.createDataFrame([("a", 3), ("b", 3)], "target string, file_position long")
    asked = spark.createDataFrame([("a", 0), ("b", 7), ("c", 0), ("d", 7)], "target string, requested long")
    got = {r.target: r.start for r in consumers.resolve_start(stored, asked).collect()}
    assert got == {"a": 3, "b": 7, "c": 1, "d": 7}


def positions_frame(spark):
    now = datetime.datetime(2024, 1, 1, 12, 0)
    rows = [("a", "index", "n1", 3, now), ("b", "index", "", 2, now),
            ("c", "index", "n2", 9, now - datetime.timedelta(hours=1)), ("file_id", "file_id", "n1", None, now)]
    return spark.createDataFrame(rows, S.POSITIONS), F.lit(now)


def test_status_and_listing(spark):
    positions, now = positions_frame(spark)
    when = datetime.datetime(2024, 1, 1, 11, 0)
    segs = spark.createDataFrame([(1, when), (2, when + datetime.timedelta(minutes=1))],
                                 "segment_id long, finished_at timestamp")
    got = {r.target: r for r in consumers.consumer_list(positions, segs, now).collect()}
    assert set(got) == {"a", "b", "c"}
    assert [got[t].running for t in "abc"] == [True, False, False]
    assert got["a"].file_timestamp == when + datetime.timedelta(minutes=1) and got["b"].file_timestamp == when
    assert (got["a"].writer_position, got["a"].lag, got["c"].file_timestamp) == (3, 0, None)
    assert [r.target for r in consumers.consumer_list(positions, segs, now, 1, 1).collect()] == ["b"]
    one = consumers.target_status(positions, segs, "zzz", now).first()
    assert one.found is False and one.file_position is None
    assert consumers.target_status(positions, segs, "a", now).first().found is True
    empty = segs.where("segment_id < 0")
    assert consumers.consumer_status(positions, empty, now).first().writer_position == 1


def test_start_and_stop(spark):
    positions, now = positions_frame(spark)
    assert consumers.start_consumer(positions, "b", "n9", now).first().file_position == 2
    assert consumers.start_consumer(positions, "b", "n9", now, 5).first().file_position == 5
    assert consumers.start_consumer(positions, "new", "n9", now).first().file_position == 1
    with pytest.raises(Exception, match="Another node replays this target: n1"):
        consumers.start_consumer(positions, "a", "n9", now).collect()
    stop = lambda t, n: tuple(consumers.stop_consumer(positions, t, n).first())[1:]
    assert stop("a", "n1") == (True, True, "n1")
    assert stop("a", "n9") == (True, False, "n1")
    assert stop("b", "n9") == (True, False, "")
    assert stop("zzz", "n9") == (False, False, "")
    left = {r.target: (r.node_name, r.file_position) for r in consumers.release(positions, "a", "n1", now).collect()}
    assert left["a"] == ("", 3) and left["c"] == ("n2", 9)


def test_error_policy(spark):
    rows = [(1, 1, "index"), (1, 2, "noop"), (1, 3, "index"), (2, 4, "index"), (3, 5, "noop"), (3, 6, "index")]
    log = spark.createDataFrame(rows, "segment_id long, seq long, action string").withColumn("item", F.lit(0))
    errors = failures.segment_errors(log)
    kept, report = failures.apply_error_policy(log, errors)
    assert sorted(r.seq for r in kept.collect()) == [1, 4]
    assert sorted((r.segment_id, r.seq, r.tries) for r in report.collect()) == [(1, 2, 1), (3, 5, 1)]
    kept, report = failures.apply_error_policy(log, errors, skip_error=False)
    assert sorted(r.seq for r in kept.collect()) == [1]
    assert [(r.segment_id, r.skipped) for r in report.collect()] == [(1, False)]
    clean = log.where("action = 'index'")
    kept, _ = failures.apply_error_policy(clean, failures.segment_errors(clean), skip_error=False)
    assert kept.count() == 4
