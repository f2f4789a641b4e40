"""By-query requests at every position, strict kinds, and an outcome for every request."""

import random

import pytest
from pyspark.sql import functions as F

from doclog.functions.scale import materialize
from doclog.operators import positions as P
from doclog.operators.barriers import outcomes_with_queries, replay_with_queries
from doclog.operators.consumers import replay_targets
from doclog.operators.documents import replay_documents_with_queries
from doclog.operators.fold import parse_docs, replay, request_outcomes, state_at
from doclog.operators.ordering import roll_by_size
from doclog.operators.positions import replay_targets_with_queries
from helpers import FIELDS, dict_fold, random_log, request, request_frame, typed


def segment_of(row):
    return row[0] * 50 // 1000 + 1


def rolled(spark, rows):
    return materialize(roll_by_size(parse_docs(request_frame(spark, rows), FIELDS), 1000), "rolled")


def by_target(df):
    out = {}
    for r in df.collect():
        assert r.id not in out.setdefault(r.target, {})
        out[r.target][r.id] = (r.a, r.b)
    return out


@pytest.mark.parametrize("seed,size", [(0, 64), (1, 3), (3, 7)])
def test_targets_with_by_query_requests(spark, seed, size):
    rng = random.Random(400 + seed)
    rows = random_log(rng, 300, 9, by_query={20, 21, 70, 139, 140, 200, 299})
    positions = {f"t{k}": p for k, p in enumerate([1, 3, 3, 8, 8, 11, 15, 16, 1000])} | {"none": None}
    base = {
        t: {str(k): {"a": rng.randint(0, 9), "b": rng.choice(["x", "mine"])} for k in rng.sample(range(14), 6)}
        for t in list(positions)[1::2]
    }
    log = rolled(spark, rows)
    where = spark.createDataFrame(list(positions.items()), "target string, file_position long")
    held = [(t, k, d["a"], d["b"]) for t, docs in base.items() for k, d in docs.items()]
    frame = spark.createDataFrame(held, "target string, id string, a int, b string")

    def want(state):
        folds = {t: typed(dict_fold([r for r in rows if segment_of(r) >= p], state.get(t))[0]) for t, p in positions.items() if p}
        return {t: docs for t, docs in folds.items() if docs}

    assert by_target(replay_targets_with_queries(log, where, size=size, hot=[("0",)], chunk_bits=4)) == want({})
    with_base = {t: d for t, d in base.items() if positions[t]}
    assert by_target(replay_targets_with_queries(log, where, frame, size=size, hot=[])) == want(with_base)
    if size == 64:
        assert by_target(replay_targets(log, where, frame)) == want(with_base)


def test_state_at_with_by_query_requests(spark):
    rows = random_log(random.Random(12), 200, 10, by_query={40, 90, 91, 150})
    base = spark.createDataFrame([("5", 1, "x"), ("99", 2, "x")], "id string, a int, b string")
    for position in (1, 4, 6, 100):
        want, _ = dict_fold([r for r in rows if segment_of(r) < position], {"5": {"a": 1, "b": "x"}, "99": {"a": 2, "b": "x"}})
        got = {r.id: (r.a, r.b) for r in state_at(rolled(spark, rows), position, base).collect()}
        assert got == typed(want)


def odd_rows():
    some = lambda kind: {"kind": kind, "field": "a", "lo": "1", "hi": None}
    return [
        request(1, "index", id="1", doc='{"a": 1, "b": "x"}'),
        request(2, "index", id="2", doc='{"a": "abc", "b": "x"}'),
        request(3, "update", id=None, doc='{"a": 2}'),
        request(4, "delete", id=None),
        request(5, "delete_by_query", index=None, indices=["sample"], query=some("exists")),
        request(6, "update_by_query", index=None, indices=["sample"], query=None, set={"b": "no"}),
        request(7, "update", id="1", doc='{"b": 7}'),
        request(8, "update", id="9", doc='{"b": "y"}'),
        request(9, "update", id="1", doc="[1]"),
        request(10, "update", id="1", doc='{"a": {"deep": 1}}'),
        request(11, "delete_by_query", index=None, indices=["sample"], query=some("term") | {"lo": "77"}),
    ]


REASONS = {
    2: "document does not fit the fields",
    3: "no id",
    4: "no id",
    5: "kind of query not known",
    6: "kind of query not known",
    8: "document missing",
    9: "unreadable document",
    10: "document does not fit the fields",
}


def test_every_request_has_one_outcome(spark):
    rows = odd_rows()
    log = parse_docs(request_frame(spark, rows), FIELDS, strict=True)
    got = outcomes_with_queries(log, hot=[]).collect()
    assert sorted(r.seq for r in got) == list(range(1, 12))
    assert {r.seq: r.reason for r in got if r.failed} == REASONS
    assert {r.id: (r.a, r.b) for r in replay_with_queries(log).collect()} == {"1": (1, "7")}


def test_documents_refuse_queries_of_unknown_kind(spark):
    frame = request_frame(spark, odd_rows())
    state, outcomes = replay_documents_with_queries(frame)
    assert {r.id for r in state.collect()} == {"1", "2"}
    got = outcomes.collect()
    assert sorted(r.seq for r in got) == list(range(1, 12))
    reasons = {k: v for k, v in REASONS.items() if v != "document does not fit the fields"}
    assert {r.seq: r.reason for r in got if r.failed} == reasons


def test_replay_refuses_what_it_cannot_apply(spark):
    log = parse_docs(request_frame(spark, random_log(random.Random(3), 60, 5, by_query={30})), FIELDS)
    with pytest.raises(Exception, match="replay cannot apply"):
        replay(log, hot=[]).collect()
    unknown = log.where("seq <> 30").withColumn("action", F.when(F.col("seq") == 7, "noop").otherwise(F.col("action")))
    with pytest.raises(Exception, match="replay cannot apply"):
        request_outcomes(unknown, hot=[]).collect()


def test_rounds_share_the_rest_of_the_work(spark, monkeypatch):
    """After a whole write all earlier positions are one lane."""
    seen = []
    real = P.materialize
    monkeypatch.setattr(P, "materialize", lambda df, name: seen.append(real(df, name)) or seen[-1])
    rows = [request(k, "index", id="1", doc='{"a": %d, "b": "x"}' % (k % 10)) for k in range(200)]
    rows[100] = request(100, "delete_by_query", index=None, indices=["sample"], query={"kind": "term", "field": "b", "lo": "q", "hi": None})
    where = spark.createDataFrame([(f"t{k}", k) for k in range(1, 10)], "target string, file_position long")
    got = by_target(replay_targets_with_queries(rolled(spark, rows), where, size=4, hot=[]))
    assert got == {f"t{k}": {"1": (9, "x")} for k in range(1, 10)}
    assert all(len(r.lanes) <= 2 for df in seen for r in df.collect())
