import json
import random

import pytest

from doclog.operators.barriers import Rule, outcomes_with_queries, replay_by_epochs, replay_with_queries
from doclog.operators.consumers import replay_targets
from doclog.operators.documents import replay_documents, replay_documents_with_queries
from doclog.operators.fold import parse_docs, replay, request_outcomes, state_at
from doclog.operators.ordering import roll_by_size
from doclog.operators.shaping import flatten_bulk
from helpers import FIELDS, dict_fold, random_log, request_frame, typed


def table(df):
    return {r["id"]: (r["a"], r["b"]) for r in df.collect()}


def as_sql(row):
    seq, action, query, sets = row[0], row[3], row[10], row[11]
    f, lo, hi = query["field"], query["lo"], query["hi"]
    if query["kind"] == "term":
        where = f"{f} = '{lo}'"
    else:
        where = " and ".join([f"{f} >= {lo}"] * (lo is not None) + [f"{f} <= {hi}"] * (hi is not None))
    return Rule(seq, 0, action, where=where, assign={k: f"'{v}'" for k, v in (sets or {}).items()})


@pytest.mark.parametrize("seed", range(3))
def test_keyed_log_with_a_hot_key(spark, seed):
    rng = random.Random(seed)
    rows = random_log(rng, 400, 12)
    want, failed = dict_fold(rows)
    log = parse_docs(request_frame(spark, rows), FIELDS)
    # No key, the hot key, or every key cut into narrow chunks.
    for hot in ([], [("0",)], [(str(i),) for i in range(13)]):
        assert table(replay(log, hot=hot, chunk_bits=3)) == typed(want)
        got = request_outcomes(log, hot=hot, chunk_bits=3).where("failed").select("seq").collect()
        assert sorted(r.seq for r in got) == failed


@pytest.mark.parametrize("seed", range(2))
def test_base_table(spark, seed):
    rng = random.Random(100 + seed)
    rows = random_log(rng, 200, 12)
    base = {str(i): {"a": i, "b": "base"} for i in range(6, 20)}
    want, failed = dict_fold(rows, base)
    log = parse_docs(request_frame(spark, rows), FIELDS)
    frame = spark.createDataFrame([(k, d["a"], d["b"]) for k, d in base.items()], "id string, a int, b string")
    assert table(replay(log, frame, hot=[("0",), ("7",)], chunk_bits=4)) == typed(want)
    got = request_outcomes(log, frame, hot=[("0",)], chunk_bits=4).where("failed").collect()
    assert sorted(r.seq for r in got) == failed


@pytest.mark.parametrize("seed", range(2))
def test_by_query_rounds_and_epochs_agree(spark, seed):
    rng = random.Random(200 + seed)
    rows = random_log(rng, 200, 8, by_query={40, 90, 91, 150})
    base = {str(i): {"a": i, "b": "x"} for i in range(5, 12)}
    want, failed = dict_fold(rows, base)
    log = parse_docs(flatten_bulk(request_frame(spark, rows)), FIELDS)
    frame = spark.createDataFrame([(k, d["a"], d["b"]) for k, d in base.items()], "id string, a int, b string")
    assert table(replay_with_queries(log, frame, hot=[("0",)], chunk_bits=4)) == typed(want)
    assert table(replay_with_queries(log, frame, size=3)) == typed(want)
    rules = [as_sql(r) for r in rows if r[3].endswith("_by_query")]
    assert table(replay_by_epochs(log, rules, frame)) == typed(want)
    for size in (3, 64):
        got = outcomes_with_queries(log, frame, size=size, hot=[("0",)], chunk_bits=4).where("failed").collect()
        assert sorted(r.seq for r in got) == failed


def test_many_targets_equal_their_own_replays(spark):
    rng = random.Random(7)
    rows = random_log(rng, 300, 10)
    log = roll_by_size(parse_docs(request_frame(spark, rows), FIELDS), 1000)
    positions = spark.createDataFrame(
        [("t1", 1), ("t2", 4), ("t3", 9), ("t4", 4), ("t5", 1000), ("t6", None)], "target string, file_position long"
    )
    base = spark.createDataFrame([("t2", "0", 5, "mine"), ("t5", "z", 1, "kept")],
                                 "target string, id string, a int, b string")
    got = {}
    for r in replay_targets(log, positions, base, hot=[("0",)], chunk_bits=4).collect():
        got.setdefault(r.target, {})[r.id] = (r.a, r.b)
    alone = replay_targets(log, positions).collect()
    for target, start, state in [("t1", 1, {}), ("t2", 4, {"0": {"a": 5, "b": "mine"}}), ("t3", 9, {}), ("t4", 4, {})]:
        after = [r for r in rows if r[0] * 50 // 1000 + 1 >= start]
        assert got[target] == typed(dict_fold(after, state)[0])
        if not state:
            assert {r.id: (r.a, r.b) for r in alone if r.target == target} == typed(dict_fold(after)[0])
    assert got["t5"] == {"z": (1, "kept")} and "t6" not in got


def test_state_at_a_position(spark):
    rows = random_log(random.Random(9), 200, 10)
    log = roll_by_size(parse_docs(request_frame(spark, rows), FIELDS), 1000)
    assert table(state_at(log, 4)) == typed(dict_fold([r for r in rows if r[0] * 50 // 1000 + 1 < 4])[0])


def docs_of(df):
    return {r["id"]: json.loads(r["doc"]) for r in df.collect()}


@pytest.mark.parametrize("seed", range(2))
def test_documents_without_a_schema(spark, seed):
    rng = random.Random(300 + seed)
    rows = random_log(rng, 250, 8)
    base = {str(i): {"deep": {"x": [i, None, "é\""]}, "n": 1.5} for i in range(5, 12)}
    want, _ = dict_fold(rows, base)
    frame = spark.createDataFrame([(k, json.dumps(d)) for k, d in base.items()], "id string, doc string")
    assert docs_of(replay_documents(request_frame(spark, rows), frame, hot=[("0",)], chunk_bits=3)) == want


def test_documents_with_by_query_requests(spark):
    rows = random_log(random.Random(5), 150, 8, by_query={40, 90, 91})
    want, failed = dict_fold(rows)
    state, outcomes = replay_documents_with_queries(request_frame(spark, rows))
    assert docs_of(state) == want
    assert sorted(r.seq for r in outcomes.where("failed").collect()) == failed
