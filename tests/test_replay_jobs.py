import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doclog import schema as S
from doclog.operators.barriers import Rule, replay_by_epochs, replay_with_queries
from doclog.operators.fold import parse_docs
from doclog.operators.shaping import flatten_bulk, gather_bulks, log_rows, render_requests
from doclog.plans.jobs import SegmentError, capture_batch, due_segments, replay_target
from doclog.sources import tables
from doclog.sources.dead_letters import read_dead_letters, read_segment_errors
from doclog.sources.log import read_manifest, scan_segments, write_segments
from doclog.sources.requests import read_requests, stream_requests
from doclog.streaming import capture_stream, replay_stream
from helpers import DOC, doc, golden, request, request_frame, scenario

# The document repeats its key as a field; the table keeps the key as `id`, so the field is left out here.
BODY = T.StructType([T.StructField("msg", T.StringType())])


def messages(df):
    return {r["id"]: r["msg"] for r in df.collect()}


def read(spark, path):
    return tables.read_table(spark, path, T.StructType([T.StructField("id", T.StringType()), *BODY.fields]))


def test_scenario_by_rounds_and_by_epochs(spark):
    log = parse_docs(flatten_bulk(request_frame(spark, scenario(1000))), BODY)
    assert messages(replay_with_queries(log)) == golden(1000)
    assert messages(replay_with_queries(log, size=1)) == golden(1000)
    assert messages(replay_with_queries(log, hot=[("1006",), ("1002",)], chunk_bits=1)) == golden(1000)
    rules = [
        Rule(7, 0, "delete_by_query", where="id = '1004'"),
        Rule(11, 0, "update_by_query", where="id = '1002'", assign={"msg": "'test 1202'"}),
    ]
    assert messages(replay_by_epochs(log, rules)) == golden(1000)


def test_capture_replay_two_targets(spark, tmp_path):
    log, t1, t2 = str(tmp_path / "log"), str(tmp_path / "t/sample1"), str(tmp_path / "t/sample2")
    capture_batch(request_frame(spark, scenario(1000, 1)), log, ["sample"], 0)
    assert read_manifest(spark, log).count() == 1
    assert replay_target(spark, log, t1, BODY) == 2
    assert messages(read(spark, t1)) == golden(1000)
    capture_batch(request_frame(spark, scenario(2000, 13)), log, ["sample"], 1)
    assert replay_target(spark, log, t1, BODY) == 3
    assert replay_target(spark, log, t1, BODY) == 3
    assert messages(read(spark, t1)) == golden(1000) | golden(2000)
    # A second target starts from the beginning; the first stands still meanwhile.
    capture_batch(request_frame(spark, scenario(3000, 25)), log, ["sample"], 2)
    assert replay_target(spark, log, t2, BODY, position=1) == 4
    assert messages(read(spark, t2)) == golden(1000) | golden(2000) | golden(3000)
    assert len(messages(read(spark, t1))) == 10
    stand = {r.target: r.file_position for r in tables.read_positions(spark, str(tmp_path / "t")).collect()}
    assert stand == {"sample1": 3, "sample2": 4}
    # The same batch again changes nothing.
    capture_batch(request_frame(spark, scenario(3000, 25)), log, ["sample"], 2)
    assert read_manifest(spark, log).count() == 3


def test_captured_segment_as_text(spark, tmp_path):
    log = str(tmp_path / "log")
    got = capture_batch(request_frame(spark, scenario(1000)), log, ["sample"], 0)
    assert [(r.requests, r.bytes) for r in got.segments.collect()] == [(12, 600)]
    stored = scan_segments(spark, log, 1, 1)
    assert stored.count() == 14
    lines = [r.line for r in render_requests(gather_bulks(stored)).orderBy("seq").collect()]
    assert len(lines) == 12
    assert lines[2] == (
        'bulk [index {[sample][doc][1005], source[{"id": 1005, "msg": "test 1005"}]},'
        'update {[sample][doc][1006] source[{"doc":{"msg": "test 1306"}}]},delete {[sample][doc][1007]}]'
    )
    assert scan_segments(spark, log, 2, 9).count() == 0


def test_same_id_over_restarts(spark, tmp_path):
    log, t = str(tmp_path / "log"), str(tmp_path / "t")
    for batch, (n, docs) in enumerate([(1000, 1), (1000, 1), (1001, 2)]):
        capture_batch(request_frame(spark, [request(batch, "index", id=str(n), doc=doc(n))]), log, ["sample"], batch)
        assert replay_target(spark, log, t, BODY) == batch + 2
        assert read(spark, t).count() == docs


def test_publish_rewrites_only_touched_buckets(spark, tmp_path):
    log, t = str(tmp_path / "log"), str(tmp_path / "t")
    rows = [request(i, "index", id=str(i), doc=doc(i)) for i in range(200)]
    capture_batch(request_frame(spark, rows), log, ["sample"], 0)
    replay_target(spark, log, t, BODY, buckets=16)
    capture_batch(request_frame(spark, [request(200, "delete", id="7")]), log, ["sample"], 1)
    replay_target(spark, log, t, BODY)
    last = tables.last_commit(spark, t)
    assert sum(p.startswith("v=2.") for p in last.parts.values()) <= 1 and len(last.parts) == 16
    assert read(spark, t).count() == 199


def test_crash_before_commit_is_repeated(spark, tmp_path, monkeypatch):
    log, t = str(tmp_path / "log"), str(tmp_path / "t")
    capture_batch(request_frame(spark, scenario(1000)), log, ["sample"], 0)

    def broken(*a, **k):
        raise KeyboardInterrupt

    monkeypatch.setattr(tables, "commit", broken)
    with pytest.raises(KeyboardInterrupt):
        replay_target(spark, log, t, BODY)
    monkeypatch.undo()
    assert read(spark, t).count() == 0 and tables.last_commit(spark, t) is None
    assert replay_target(spark, log, t, BODY) == 2
    assert messages(read(spark, t)) == golden(1000)


def test_gap_and_explicit_position(spark, tmp_path):
    rows = [(1,), (4,), (2000,)]
    manifest = spark.createDataFrame(rows, "segment_id long")
    assert due_segments(manifest, 2, 1000, 100) == [4]
    assert due_segments(manifest, 1, 1000, 100) == [1, 4]
    assert due_segments(manifest, 2, 1, 100) == []
    assert due_segments(manifest, 1, 5000, 2) == [1, 4]


def test_capture_numbers_by_arrival_and_cuts_at_markers(spark, tmp_path):
    log = str(tmp_path / "log")
    for batch in range(2):
        rows = [request(None, "index", id=str(i), doc=doc(i)) for i in range(20)] + [request(None, "refresh")]
        frame = request_frame(spark, rows).withColumn("n", F.monotonically_increasing_id())
        frame = frame.withColumns({
            "marker": F.col("action") == "refresh",
            "at": F.when(F.col("action") == "refresh", 7.5).otherwise(F.col("id").cast("double")),
        }).orderBy(F.rand(3))
        capture_batch(frame, log, ["sample"], batch, order_by=["at"])
    got = scan_segments(spark, log).orderBy("seq").collect()
    assert [int(r.id) for r in got] == list(range(20)) * 2
    assert [r.segment_id for r in got] == [1] * 8 + [2] * 12 + [3] * 8 + [4] * 12
    assert len({r.seq for r in got}) == 40


def test_rejected_and_passed(spark, tmp_path):
    mixed = [{"action": "delete", "index": i, "type": "doc", "id": "1", "doc": None} for i in ("sample", "other")]
    rows = [
        request(1, "bulk", index=None, items=mixed),
        request(2, "index", id="1", doc=doc(1)),
        request(3, "index", index="other", id="1", doc=doc(1)),
        request(4, "get", id="1"),
        request(5, "delete_by_query", index=None, indices=["sample", "other"], query=term_query()),
        request(6, "bulk", index=None, items=[]),
    ]
    got = capture_batch(request_frame(spark, rows), str(tmp_path / "log"), ["sample"], 0)
    assert {r.seq for r in got.rejected.collect()} == {1, 5}
    assert {r.seq for r in got.passed.collect()} == {3, 4, 6}
    assert [r.requests for r in got.segments.collect()] == [1]


def term_query():
    return {"kind": "match_all", "field": None, "lo": None, "hi": None}


def test_dead_letters_and_bad_segments(spark, tmp_path):
    log, t, dead = str(tmp_path / "log"), str(tmp_path / "t"), str(tmp_path / "dead")
    rows = [
        request(1, "index", id="1", doc=doc(1)),
        request(2, "update", id="9", doc='{"msg": "x"}'),
        request(3, "index", id="2", doc="not json"),
        request(4, "index", id=None, doc=doc(4)),
    ]
    capture_batch(request_frame(spark, rows), log, ["sample"], 0)
    assert replay_target(spark, log, t, BODY, dead_letter_path=dead) == 2
    letters = {(r.position, r.reason, r.attempts) for r in read_dead_letters(spark, dead).collect()}
    assert letters == {(2, "document missing", 1), (3, "unreadable document", 1)}
    state = messages(read(spark, t))
    assert len(state) == 2 and state["1"] == "test 1"

    # A request of unknown kind in the log stops its segment; what precedes it has taken effect.
    bad = request_frame(spark, [request(5, "index", id="5", doc=doc(5)), request(6, "noop", id="5"),
                                request(7, "delete", id="1")]).withColumn("segment_id", F.lit(2).cast("long"))
    write_segments(log_rows(bad), log, 1)
    capture_batch(request_frame(spark, [request(8, "index", id="8", doc=doc(8))]), log, ["sample"], 2)
    with pytest.raises(Exception, match="does not know this kind"):
        scan_segments(spark, log).collect()
    stop = str(tmp_path / "stop")
    with pytest.raises(SegmentError):
        replay_target(spark, log, stop, BODY, skip_error=False)
    assert tables.last_commit(spark, stop).position == 2
    assert {"1", "5"} <= set(messages(read(spark, stop)))
    assert replay_target(spark, log, t, BODY) == 4
    assert {"1", "5", "8"} <= set(messages(read(spark, t)))
    assert [tuple(r) for r in read_segment_errors(spark, t).collect()] == [(2, 6, "kind of request not known", 1, True)]


def test_failures_without_dead_letters_end_their_segment(spark, tmp_path):
    log, t = str(tmp_path / "log"), str(tmp_path / "t")
    first = [request(1, "index", id="1", doc=doc(1)), request(2, "create", id="1", doc=doc(1)),
             request(3, "delete", id="1")]
    capture_batch(request_frame(spark, first), log, ["sample"], 0)
    capture_batch(request_frame(spark, [request(4, "update", id="1", doc='{"msg": "a"}')]), log, ["sample"], 1)
    assert replay_target(spark, log, t, BODY, request_retry=-1) == 3
    assert messages(read(spark, t)) == {"1": "a"}
    assert [tuple(r) for r in read_segment_errors(spark, t).collect()] == [(1, 2, "document exists", 1, True)]


def test_unreadable_segment_is_tried_alone_then_skipped(spark, tmp_path):
    log, t = str(tmp_path / "log"), str(tmp_path / "t")
    for n in range(3):
        rows = [request(n, "index", id=str(n), doc=doc(n))]
        capture_batch(request_frame(spark, rows), log, ["sample"], n)
    (folder,) = tmp_path.glob("log/data/batch_id=1/epoch=*/segment_id=2")
    (folder / "part-broken.parquet").write_bytes(b"PAR1 not a table PAR1")
    with pytest.raises(SegmentError):
        replay_target(spark, log, str(tmp_path / "stop"), BODY, retry=1, skip_error=False, retry_wait=0)
    assert replay_target(spark, log, t, BODY, retry=1, retry_wait=0) == 4
    assert messages(read(spark, t)) == {"0": "test 0", "2": "test 2"}
    assert [(r.segment_id, r.tries, r.skipped) for r in read_segment_errors(spark, t).collect()] == [(2, 2, True)]


def write_json(path, rows):
    path.mkdir(exist_ok=True)
    return lambda name: (path / name).write_text("\n".join(json.dumps(r) for r in rows))


def test_streams_follow_and_rerun(spark, tmp_path):
    src = tmp_path / "in"
    log, t = str(tmp_path / "log"), str(tmp_path / "t")

    def as_json(rows):
        return [{n: v for n, v in zip(S.REQUEST.names, r) if v is not None} for r in rows]

    def run():
        requests = stream_requests(spark, str(src), max_files=1)
        q = capture_stream(requests, log, ["sample"], str(tmp_path / "c1"), available_now=True)
        q.awaitTermination()
        q = replay_stream(spark, log, t, BODY, str(tmp_path / "c2"), available_now=True)
        q.awaitTermination()

    write_json(src, as_json(scenario(1000, 1)))("a.json")
    run()
    assert messages(read(spark, t)) == golden(1000)
    run()
    assert tables.last_commit(spark, t).position == 2
    write_json(src, as_json(scenario(2000, 13)))("b.json")
    run()
    assert messages(read(spark, t)) == golden(1000) | golden(2000)
    assert tables.last_commit(spark, t).position == 3
    assert read_requests(spark, str(src)).count() == 24


def test_documents_of_any_shape(spark, tmp_path):
    log, t = str(tmp_path / "log"), str(tmp_path / "t")
    capture_batch(request_frame(spark, scenario(1000)), log, ["sample"], 0)
    odd = [request(13, "index", id="a", doc='{"x": {"y": [1, 2]}, "z": null}'),
           request(14, "update", id="a", doc='{"w": 1}'), request(15, "update", id="b", doc="{}")]
    capture_batch(request_frame(spark, odd), log, ["sample"], 1)
    dead = str(tmp_path / "dead")
    assert replay_target(spark, log, t, None, dead_letter_path=dead) == 3
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("doc", T.StringType())])
    got = {r["id"]: json.loads(r["doc"]) for r in tables.read_table(spark, t, schema).collect()}
    assert {k: d["msg"] for k, d in got.items() if k != "a"} == golden(1000)
    assert got["1005"] == {"id": 1005, "msg": "test 1005"}
    assert got["a"] == {"x": {"y": [1, 2]}, "z": None, "w": 1}
    assert [(r.seq, r.position) for r in read_dead_letters(spark, dead).collect()] == [(15, 3)]
