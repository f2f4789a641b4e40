import pytest
from pyspark.sql import functions as F

from doclog import schema as S
from doclog.plans.jobs import capture_batch
from doclog.sources import log as L
from doclog.sources.dead_letters import read_dead_letters, write_dead_letter
from doclog.sources.log import SegmentsTaken, WriterFenced, last_written, open_writer, read_manifest, scan_segments
from helpers import doc, request, request_frame


def frame(spark, *seqs, **kw):
    return request_frame(spark, [request(n, "index", id=str(n), doc=doc(n), **kw) for n in seqs])


def ids(spark, path):
    return sorted((r.segment_id, r.id) for r in scan_segments(spark, path).collect())


def test_a_later_writer_ends_an_earlier_one(spark, tmp_path):
    path = str(tmp_path / "log")
    old = open_writer(spark, path, "a")
    new = open_writer(spark, path, "b")
    with pytest.raises(WriterFenced):
        capture_batch(frame(spark, 1), path, ["sample"], 0, writer=old)
    assert read_manifest(spark, path).count() == 0 and last_written(spark, path) == (0, -1, -1)
    capture_batch(frame(spark, 2), path, ["sample"], 0, writer=new)
    assert ids(spark, path) == [(1, "2")]
    # The one that was ended may start over, and the same batch is not written twice.
    again = open_writer(spark, path, "a")
    assert capture_batch(frame(spark, 2), path, ["sample"], 0, writer=again).segments.count() == 1
    capture_batch(frame(spark, 3), path, ["sample"], 1, writer=again)
    assert ids(spark, path) == [(1, "2"), (2, "3")] and last_written(spark, path)[0] == 2


def test_of_two_captures_from_one_state_one_becomes_visible(spark, tmp_path, monkeypatch):
    """Both pass the check of their epoch and both see an empty log; the commit's name decides."""
    path = str(tmp_path / "log")
    first, second = open_writer(spark, path, "a"), open_writer(spark, path, "b")
    monkeypatch.setattr(L, "check_writer", lambda *_: None)
    capture_batch(frame(spark, 1), path, ["sample"], 0, writer=first)
    monkeypatch.setattr("doclog.plans.jobs.last_written", lambda *_: (0, -1, -1))
    monkeypatch.setattr(L, "last_commit", lambda *_: None)
    with pytest.raises(SegmentsTaken):
        capture_batch(frame(spark, 2), path, ["sample"], 1, writer=second)
    monkeypatch.undo()
    assert ids(spark, path) == [(1, "1")]
    assert [r.segment_id for r in read_manifest(spark, path).collect()] == [1]


def test_a_run_lost_before_its_commit_leaves_nothing_visible(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")

    def crash(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(L, "_commit", crash)
    with pytest.raises(KeyboardInterrupt):
        capture_batch(frame(spark, 1), path, ["sample"], 0)
    monkeypatch.undo()
    assert scan_segments(spark, path).count() == 0 and read_manifest(spark, path).count() == 0
    capture_batch(frame(spark, 1), path, ["sample"], 0)
    assert ids(spark, path) == [(1, "1")]
    assert [f.rsplit("/", 2)[1:] for f in L.vacuum_log(spark, path)] == [["batch_id=0", "epoch=1"]]
    assert ids(spark, path) == [(1, "1")] and L.vacuum_log(spark, path) == []


def test_a_segment_is_one_file(spark, tmp_path):
    path = tmp_path / "log"
    rows = [request(n << 10, "index", id=str(n), doc=doc(n), bytes=10) for n in range(200)]
    capture_batch(request_frame(spark, rows), str(path), ["sample"], 0, max_bytes=500)
    folders = list(path.glob("data/*/*/segment_id=*"))
    assert len(folders) == 4 and all(len(list(f.glob("*.parquet"))) == 1 for f in folders)


def test_a_refresh_cuts_the_segment(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = [
        request(1, "refresh"),  # nothing to cut yet
        request(2, "index", id="a", doc=doc(1)),
        request(3, "refresh"),
        request(4, "index", id="b", doc=doc(2)),
        request(5, "refresh", index="elsewhere"),
        request(6, "indices:admin/flush", index=None),
        request(7, "index", id="c", doc=doc(3)),
        request(8, "refresh", index=None, indices=["x", "sample"]),
    ]
    got = capture_batch(request_frame(spark, rows), path, ["sample"], 0)
    assert ids(spark, path) == [(1, "a"), (2, "b"), (3, "c")]
    assert sorted(r.seq for r in got.passed.collect()) == [1, 3, 5, 6, 8]


def test_dead_letters_of_a_segment_are_one_file(spark, tmp_path):
    names = [f.name for f in S.LETTERS.fields if f.name not in ("seq", "target", "segment_id")]
    letters = spark.range(0, 400, 1, 8).select(
        F.col("id").alias("seq"),
        *[F.lit(None).cast(S.LETTERS[n].dataType).alias(n) for n in names],
        F.lit("t").alias("target"),
        (F.col("id") % 5).alias("segment_id"),
    )
    write_dead_letter(letters, str(tmp_path / "dead"))
    assert len(list(tmp_path.glob("dead/*/*/*.parquet"))) == 5
    assert sorted(r.seq for r in read_dead_letters(spark, str(tmp_path / "dead")).collect()) == list(range(400))


def test_a_task_writes_a_bounded_part_of_a_segment(spark, tmp_path):
    """Requests may declare few bytes or none; their number does not land in one task."""
    path, n = tmp_path / "log", 600_000
    blank = {f.name: F.lit(None).cast(f.dataType) for f in S.REQUEST.fields if f.name != "seq"}
    log = spark.range(n).select(F.col("id").alias("seq"), *[c.alias(k) for k, c in blank.items()], F.lit(1).cast("long").alias("segment_id"))
    log = log.withColumns({"item": F.lit(0), "action": F.lit("delete"), "bytes": F.lit(0).cast("long")})
    (segment,) = L.write_segments(log, str(path), 0).collect()
    assert (segment.requests, segment.min_seq, segment.max_seq) == (n, 0, n - 1)
    files = spark.read.parquet(str(path / "data")).groupBy(F.input_file_name()).count().collect()
    assert sum(f["count"] for f in files) == n and max(f["count"] for f in files) < n / 2


def test_a_capture_reads_its_requests_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = [request(n, "refresh" if n % 50 == 49 else "index", id=str(n), doc=doc(n)) for n in range(200)]
    reqs = request_frame(spark, rows)
    got = capture_batch(reqs.mapInArrow(count, reqs.schema), str(tmp_path / "log"), ["sample"], 0, max_bytes=1000)
    assert seen.value == 200 and sum(r.requests for r in got.segments.collect()) == 196
    # Stored columns are known from one segment, also when its files are lost.
    for file in tmp_path.glob("log/data/*/*/segment_id=1/*"):
        file.unlink()
    assert scan_segments(spark, str(tmp_path / "log"), lo=2).where("segment_id > 2").count() < 196
    assert L._stored_schema(spark, str(tmp_path / "log/data"), "batch_id=0/epoch=1", 1)["doc"].dataType.typeName() == "string"
