import pytest
from pyspark.sql import types as T

from doclog.plans.jobs import capture_batch, replay_target
from doclog.sources import files, tables
from doclog.streaming import replay_stream
from helpers import doc, request, request_frame
from test_replay_jobs import BODY, messages, read

TABLE = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.LongType())])


def state(spark, v):
    return spark.createDataFrame([("a", v)], TABLE)


def test_the_loser_of_two_writers_changes_nothing(spark, tmp_path):
    t = str(tmp_path / "t")
    base = tables.publish_table(state(spark, 1), t, 2)
    tables.publish_table(state(spark, 2), t, 3, base=base)
    with pytest.raises(tables.CommitConflict):
        tables.publish_table(state(spark, 99), t, 3, base=base)
    with pytest.raises(tables.CommitConflict):
        tables.move_position(spark, t, 9, base=base)
    assert [r.v for r in tables.read_table(spark, t, TABLE).collect()] == [2]
    assert tables.last_commit(spark, t).position == 3
    assert sum(n.startswith("v=") for n in files.names(spark, t)) == 2


def test_a_torn_commit_file_is_passed_over(spark, tmp_path):
    t = str(tmp_path / "t")
    tables.publish_table(state(spark, 1), t, 2)
    (tmp_path / "t/_commits/000000000002.json").write_text("")
    assert tables.last_commit(spark, t).position == 2
    tables.publish_table(state(spark, 5), t, 3)
    assert [r.v for r in tables.read_table(spark, t, TABLE).collect()] == [5]


def test_errors_other_than_unreadable_segments_are_raised(spark, tmp_path):
    log, t = str(tmp_path / "log"), str(tmp_path / "t")
    rows = [request(1, "index", id="1", doc=doc(1)), request(2, "create", id="1", doc=doc(1))]
    capture_batch(request_frame(spark, rows), log, ["sample"], 0)
    (tmp_path / "dead").write_text("a file where a folder should be")
    with pytest.raises(Exception):
        replay_target(spark, log, t, BODY, dead_letter_path=str(tmp_path / "dead"), retry=2, retry_wait=0)
    assert tables.last_commit(spark, t) is None
    assert replay_target(spark, log, t, BODY) == 2
    assert messages(read(spark, t)) == {"1": "test 1"}


@pytest.mark.parametrize("size", [1, 10])
def test_a_batch_that_goes_back_is_applied_last_in_any_grouping(spark, tmp_path, size):
    log, t = str(tmp_path / "log"), str(tmp_path / "t")
    for batch, (seq, msg) in enumerate([(10, 1), (5, 2), (5, 3)]):
        rows = [request(seq, "index", id="a", doc=doc(msg))]
        capture_batch(request_frame(spark, rows), log, ["sample"], batch)
    assert replay_target(spark, log, t, BODY, max_segments=size) == 4
    assert messages(read(spark, t)) == {"a": "test 3"}


def test_a_stream_takes_its_position_once(spark, tmp_path):
    log, t, seen = str(tmp_path / "log"), str(tmp_path / "t"), str(tmp_path / "checkpoint")
    for batch in range(2):
        rows = [request(batch, "index", id=str(batch), doc=doc(batch))]
        capture_batch(request_frame(spark, rows), log, ["sample"], batch)
        query = replay_stream(spark, log, t, BODY, seen, available_now=True, position=1)
        assert query.awaitTermination(120)
        assert query.exception() is None
    assert tables.last_commit(spark, t).version == 2
    assert len(messages(read(spark, t))) == 2
