import time

import pytest
from pyspark.sql import types as T

from doclog.plans import control, jobs
from doclog.plans.jobs import capture_batch, replay_target
from doclog.sources import leases, tables
from helpers import doc, request, request_frame

BODY = T.StructType([T.StructField("msg", T.StringType())])


def owner(spark, root, target="t"):
    return tables.last_commit(spark, f"{root}/{target}").node


def test_a_lost_owner_is_replaced_once(spark, tmp_path):
    root = str(tmp_path)
    tables.move_position(spark, f"{root}/t", 5, "n1", time.time() - 100)
    assert control.take_over_lost(spark, root, "n2", alive_seconds=1000) == []
    assert control.take_over_lost(spark, root, "n1", alive_seconds=10) == []  # its own
    leases.beat(spark, f"{root}/t", "n3", time.time())  # a sign of somebody else does not count
    assert control.take_over_lost(spark, root, "n2", alive_seconds=10) == ["t"]
    assert control.take_over_lost(spark, root, "n3", alive_seconds=10) == []
    assert (owner(spark, root), tables.last_commit(spark, f"{root}/t").position) == ("n2", 5)


def test_of_two_that_judge_by_one_commit_one_takes_over(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    stale = tables.move_position(spark, f"{root}/t", 5, "n1", 0.0)
    monkeypatch.setattr(tables, "last_commit", lambda *_: stale)
    assert [leases.take_over(spark, root, "t", n, 10) for n in ("n2", "n3")] == [True, False]
    with pytest.raises(tables.CommitConflict):
        tables.move_position(spark, f"{root}/t", 6, "n1", base=stale)  # the slow owner
    monkeypatch.undo()
    assert owner(spark, root) == "n2"


def test_signs_of_life_count(spark, tmp_path):
    root = str(tmp_path)
    tables.move_position(spark, f"{root}/t", 5, "n1", time.time() - 100)
    leases.beat(spark, f"{root}/t", "n1", time.time())
    assert control.take_over_lost(spark, root, "n2", alive_seconds=50) == []
    row = control.status(spark, f"{root}/log", root, "t", alive_seconds=50).first()
    assert row.running and row.node_name == "n1"
    # Stopped targets are nobody's to take.
    control.stop_target(spark, root, "t", "n1")
    assert control.take_over_lost(spark, root, "n2", alive_seconds=0) == []


def test_a_run_longer_than_the_alive_time_stays_running(spark, tmp_path, monkeypatch):
    log, root = str(tmp_path / "log"), str(tmp_path / "tables")
    capture_batch(request_frame(spark, [request(1, "index", id="1", doc=doc(1))]), log, ["sample"], 0)
    tables.move_position(spark, f"{root}/t", 1, "n1", time.time() - 100)
    seen, run = [], jobs._replay_run

    def slow(*args):
        time.sleep(1.5)
        seen.append(control.status(spark, log, root, "t", alive_seconds=50).first().running)
        seen.append(control.take_over_lost(spark, root, "n2", alive_seconds=50))
        run(*args)

    monkeypatch.setattr(jobs, "_replay_run", slow)
    assert replay_target(spark, log, f"{root}/t", BODY, node="n1", beat_seconds=0.2) == 2
    assert seen == [True, []] and len(list((tmp_path / "tables/t/_beats").glob("*.json"))) == 1


def test_an_owner_that_was_replaced_publishes_nothing(spark, tmp_path, monkeypatch):
    log, root = str(tmp_path / "log"), str(tmp_path / "tables")
    capture_batch(request_frame(spark, [request(1, "index", id="1", doc=doc(1))]), log, ["sample"], 0)
    tables.move_position(spark, f"{root}/t", 1, "n1", 0.0)
    run = jobs._replay_run

    def lost(*args):
        assert leases.take_over(spark, root, "t", "n2", 0)
        run(*args)

    monkeypatch.setattr(jobs, "_replay_run", lost)
    with pytest.raises(tables.CommitConflict):
        replay_target(spark, log, f"{root}/t", BODY, node="n1")
    monkeypatch.undo()
    assert replay_target(spark, log, f"{root}/t", BODY, node="n1") == 1
    assert replay_target(spark, log, f"{root}/t", BODY, node="n2") == 2
