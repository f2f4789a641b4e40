import pytest
from pyspark.sql import types as T

from doclog.plans.control import dump_segment, start_target, status, stop_target
from doclog.plans.jobs import capture_batch, replay_target
from doclog.sources import tables
from helpers import request_frame, scenario

BODY = T.StructType([T.StructField("msg", T.StringType())])


def test_a_consumer_from_start_to_stop(spark, tmp_path):
    log, root = str(tmp_path / "log"), str(tmp_path / "tables")
    capture_batch(request_frame(spark, scenario(1000, 1)), log, ["sample"], 0)
    assert status(spark, log, root, "sample1").first().found is False
    assert start_target(spark, root, "sample1", "n1") == {"node_name": "n1", "file_position": 1, "doc_type": "index"}
    with pytest.raises(Exception, match="Another node replays this target: n1"):
        start_target(spark, root, "sample1", "n2")
    assert replay_target(spark, log, f"{root}/sample1", BODY, node="n1") == 2
    row = status(spark, log, root, "sample1").first()
    assert (row.found, row.running, row.file_position, row.writer_position, row.lag) == (True, True, 2, 2, 0)
    assert row.file_timestamp is not None

    assert stop_target(spark, root, "sample1", "n2") == {"found": True, "stop": False, "working": "n1"}
    assert stop_target(spark, root, "sample1", "n1") == {"found": True, "stop": True, "working": "n1"}
    assert stop_target(spark, root, "sample1", "n1") == {"found": True, "stop": False, "working": ""}
    assert stop_target(spark, root, "other", "n1") == {"found": False, "stop": False, "working": ""}

    # Stopped, it stands still; another node goes on where it stood.
    capture_batch(request_frame(spark, scenario(2000, 13)), log, ["sample"], 1)
    assert replay_target(spark, log, f"{root}/sample1", BODY, node="n1") == 2
    row = status(spark, log, root, "sample1").first()
    assert (row.running, row.lag) == (False, 1)
    assert start_target(spark, root, "sample1", "n2")["file_position"] == 2
    assert replay_target(spark, log, f"{root}/sample1", BODY, node="n2") == 3
    assert tables.read_table(spark, f"{root}/sample1", T.StructType([T.StructField("id", T.StringType()),
                                                                    *BODY.fields])).count() == 10
    start_target(spark, root, "sample2", "n1", position=2)
    listed = {r.target: (r.file_position, r.node_name) for r in status(spark, log, root).collect()}
    assert listed == {"sample1": (3, "n2"), "sample2": (2, "n1")}
    assert status(spark, log, root, start=1, size=1).first().target == "sample2"

    assert dump_segment(spark, log, 1).count() == 12
    with pytest.raises(FileNotFoundError):
        dump_segment(spark, log, 9)
