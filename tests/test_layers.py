"""Delta layers: what a run writes, what readers see, and how layers are combined."""

import random

import pytest
from pyspark.sql import types as T

from doclog.operators.fold import parse_docs
from doclog.plans.jobs import capture_batch, replay_target
from doclog.sources import files, layers, tables
from helpers import FIELDS, dict_fold, random_log, request, request_frame, typed

TABLE = T.StructType([T.StructField("id", T.StringType()), *FIELDS.fields])


def rows_of(spark, path, at=None):
    got = tables.read_table(spark, path, TABLE, at).collect()
    assert len({r.id for r in got}) == len(got)
    return {r.id: (r.a, r.b) for r in got}


@pytest.fixture
def started(spark, tmp_path):
    path = str(tmp_path / "t")
    base = {str(i): {"a": i, "b": "base"} for i in range(40)}
    frame = spark.createDataFrame([(k, d["a"], d["b"]) for k, d in base.items()], TABLE)
    return path, base, tables.publish_table(frame, path, 1, buckets=4)


def test_layers_equal_the_whole_log(spark, started):
    path, state, at = started
    rng = random.Random(1)
    rows = random_log(rng, 250, 30)
    for k in range(10):
        part = rows[25 * k : 25 * (k + 1)]
        state, _ = dict_fold(part, state)
        effects = layers.effects_of(parse_docs(request_frame(spark, part), FIELDS), hot=[("0",)] if k % 2 else [])
        at = layers.publish_layer(effects, path, k + 2, at)
        assert rows_of(spark, path) == typed(state) and at.position == k + 2
        if k % 3 == 2:
            at = layers.compact(spark, path, TABLE, at)
            assert rows_of(spark, path) == typed(state)
            assert len(at.layers) <= layers.FAN + 2


def test_levels(spark, started, monkeypatch):
    monkeypatch.setattr(layers, "FOLD_SHARE", 100)
    path, state, at = started
    sizes = []
    for k in range(17):
        part = [request(k, "update", id=str(k % 5), doc='{"a": %d}' % (k % 10))]
        state, _ = dict_fold(part, state)
        at = layers.publish_layer(layers.effects_of(parse_docs(request_frame(spark, part), FIELDS), hot=[]), path, k + 2, at)
        at = layers.compact(spark, path, TABLE, at)
        levels = [layer["level"] for layer in at.layers]
        assert levels == sorted(levels, reverse=True)
        sizes.append(len(levels))
    assert max(sizes) <= 3 * (layers.FAN - 1) + 1 and [layer["level"] for layer in at.layers] == [2, 0]
    assert rows_of(spark, path) == typed(state)


def test_a_run_writes_the_keys_that_it_touches(spark, tmp_path):
    log, t = str(tmp_path / "log"), str(tmp_path / "t")
    rows = [request(i, "index", id=str(i), doc='{"a": 1, "b": "x"}') for i in range(400)]
    capture_batch(request_frame(spark, rows), log, ["sample"], 0)
    replay_target(spark, log, t, FIELDS, buckets=8)
    first = tables.last_commit(spark, t)
    some = [request(400, "update", id="7", doc='{"a": 5}'), request(401, "delete", id="8"), request(402, "create", id="new", doc="{}")]
    some += [request(403 + k, "update", id="7", doc='{"b": "%d"}' % k) for k in range(20)]
    capture_batch(request_frame(spark, some), log, ["sample"], 1)
    assert replay_target(spark, log, t, FIELDS) == 3
    last = tables.last_commit(spark, t)
    assert last.parts == first.parts and [sum(x["rows"].values()) for x in last.layers] == [3]
    got = rows_of(spark, t)
    assert len(got) == 400 and got["7"] == (5, "19") and "8" not in got and got["new"] == (None, None)
    # A by-query request reads and writes the whole table, and takes the layers in.
    query = {"kind": "term", "field": "a", "lo": "5", "hi": None}
    capture_batch(request_frame(spark, [request(500, "delete_by_query", index=None, indices=["sample"], query=query)]), log, ["sample"], 2)
    replay_target(spark, log, t, FIELDS)
    last = tables.last_commit(spark, t)
    assert not last.layers and len(rows_of(spark, t)) == 399


def test_dead_letters_of_a_run_that_writes_a_layer(spark, tmp_path):
    from doclog.sources.dead_letters import read_dead_letters

    log, t, dead = str(tmp_path / "log"), str(tmp_path / "t"), str(tmp_path / "dead")
    rows = [request(i, "index", id=str(i), doc='{"a": 1, "b": "x"}') for i in range(100)]
    for batch, part in enumerate([rows, [request(100, "create", id="3", doc="{}"), request(101, "delete", id="4")],
                                  [request(102, "update", id="4", doc='{"a": 2}'), request(103, "create", id="4", doc='{"a": 9}')]]):
        capture_batch(request_frame(spark, part), log, ["sample"], batch)
        replay_target(spark, log, t, FIELDS, dead_letter_path=dead, buckets=4)
    assert sorted((r.seq, r.reason, r.doc) for r in read_dead_letters(spark, dead).collect()) == [
        (100, "document exists", "{}"), (102, "document missing", '{"a": 2}')
    ]
    assert rows_of(spark, t)["4"] == (9, None) and len(tables.last_commit(spark, t).layers) == 2


def test_changed_buckets_leave_the_layers_of_the_others(spark, started):
    path, state, at = started
    part = [request(k, "update", id=str(k), doc='{"a": 9}') for k in range(40)]
    state, _ = dict_fold(part, state)
    at = layers.publish_layer(layers.effects_of(parse_docs(request_frame(spark, part), FIELDS), hot=[]), path, 2, at)
    now = tables.read_table(spark, path, TABLE, at, [0, 1])
    at = tables.publish_table(now, path, 3, changed=[0, 1], base=at)
    assert sorted(at.layers[0]["rows"]) == ["2", "3"] and rows_of(spark, path) == typed(state)


def test_losing_writer_and_old_folders(spark, started):
    path, state, at = started
    part = [request(1, "delete", id="1")]
    effects = layers.effects_of(parse_docs(request_frame(spark, part), FIELDS), hot=[])
    won = layers.publish_layer(effects, path, 2, at)
    before = set(files.names(spark, path))
    with pytest.raises(tables.CommitConflict):
        layers.publish_layer(effects, path, 2, at)
    assert set(files.names(spark, path)) == before and len(rows_of(spark, path)) == 39
    for k in range(4):
        won = layers.publish_layer(effects, path, 3 + k, won)
    won = layers.compact(spark, path, TABLE, won)
    gone = layers.vacuum(spark, path, keep=1)
    assert len(gone) >= 4 and len(rows_of(spark, path)) == 39
    assert layers.vacuum(spark, path, keep=1) == []
