"""Updates that insert where there is no document, and patches that merge at every level."""

import json
import random

import pytest
from pyspark.sql import types as T

from doclog import schema as S
from doclog.operators.barriers import outcomes_with_queries, replay_with_queries
from doclog.operators.consumers import replay_targets
from doclog.operators.documents import MAX_DEPTH, replay_documents, replay_documents_with_queries
from doclog.operators.fold import apply_update, parse_docs, replay, request_outcomes
from doclog.operators.ordering import roll_by_size
from doclog.plans.jobs import capture_batch, replay_target
from doclog.sources import tables
from doclog.sources.dead_letters import read_dead_letters
from helpers import FIELDS, dict_fold, random_log, request, request_frame, typed

NAMES = S.REQUEST.names


def merge(old, new):
    """`new` into `old`: objects field by field, everything else replaced."""
    if not (isinstance(old, dict) and isinstance(new, dict)):
        return new
    return old | {k: merge(old[k], v) if k in old else v for k, v in new.items()}


def fold(rows, state=None):
    """(documents, {seq: result}) of the log applied one request after another; no by-query requests."""
    docs, results = dict(state or {}), {}
    for row in rows:
        r = dict(zip(NAMES, row))
        key, action, seq = r["id"], r["action"], r["seq"]
        if action == "delete":
            results[seq] = "deleted" if docs.pop(key, None) is not None else "not_found"
            continue
        try:
            body = json.loads(r["doc"])
            given = r["doc"] if r["doc_as_upsert"] else r["upsert"]
            first = None if action != "update" or given is None else json.loads(given)
        except ValueError:
            results[seq] = "failed"
            continue
        there = key in docs
        if action == "index" or (action == "create" and not there):
            docs[key] = body
        elif action == "update" and there:
            docs[key] = merge(docs[key], body)
        elif first is not None:
            docs[key] = first
        else:
            results[seq] = "failed"
            continue
        results[seq] = "updated" if there else "created"
    return docs, results


def with_upserts(rng, rows, document):
    """The log with documents to insert on some of its updates, a few of them unreadable."""
    out = []
    for row in rows:
        r = dict(zip(NAMES, row))
        if r["action"] == "update" and rng.random() < 0.3:
            r["upsert"] = "[1" if rng.random() < 0.1 else json.dumps(document())
        elif r["action"] == "update" and rng.random() < 0.1:
            r["doc_as_upsert"] = True
        out.append(tuple(r[n] for n in NAMES))
    return out


def upsert_log(seed, n=300, ids=10, by_query=()):
    rng = random.Random(seed)
    rows = random_log(rng, n, ids, by_query)
    return with_upserts(rng, rows, lambda: {"a": rng.choice([None, rng.randint(0, 9)]), "b": rng.choice(["x", "y"])})


def table(df):
    return {r["id"]: (r["a"], r["b"]) for r in df.collect()}


def results(df):
    return {r.seq: r.result for r in df.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_upserts_equal_a_plain_fold(spark, seed):
    rows = upsert_log(seed)
    base = {str(i): {"a": i, "b": "base"} for i in range(6, 14)}
    frame = spark.createDataFrame([(k, d["a"], d["b"]) for k, d in base.items()], "id string, a int, b string")
    log = parse_docs(request_frame(spark, rows), FIELDS)
    for hot in ([], [("0",)], [(str(i),) for i in range(13)]):
        assert table(replay(log, hot=hot, chunk_bits=3)) == typed(fold(rows)[0])
        assert table(replay(log, frame, hot=hot, chunk_bits=3)) == typed(fold(rows, base)[0])
        assert results(request_outcomes(log, frame, hot=hot, chunk_bits=3)) == fold(rows, base)[1]
    strict = parse_docs(request_frame(spark, rows), FIELDS, strict=True)
    assert table(replay(strict, frame)) == typed(fold(rows, base)[0])


def test_upsert_of_other_types_fails(spark):
    rows = [
        request(0, "update", id="1", doc='{"a": 1}', upsert='{"a": "no"}'),
        request(1, "update", id="2", doc='{"a": "no"}', upsert='{"a": 1}'),
        request(2, "update", id="3", doc='{"a": 1}', upsert='{"a": 2}'),
    ]
    log = parse_docs(request_frame(spark, rows), FIELDS, strict=True)
    assert results(request_outcomes(log)) == {0: "failed", 1: "failed", 2: "created"}
    assert table(replay(log)) == {"3": (2, None)}


def test_only_updates(spark):
    rows = [r for r in upsert_log(11) if r[NAMES.index("action")] == "update"]
    base = {str(i): {"a": i, "b": "base"} for i in range(5)}
    frame = spark.createDataFrame([(k, d["a"], d["b"]) for k, d in base.items()], "id string, a int, b string")
    got = apply_update(parse_docs(request_frame(spark, rows), FIELDS), frame)
    assert table(got) == typed(fold(rows, base)[0])


def test_upserts_among_by_query_requests(spark):
    """Rounds of three requests, one round, and rows taken one after another agree."""
    rows = upsert_log(21, 200, 8, by_query={40, 90, 91, 150})
    log = parse_docs(request_frame(spark, rows), FIELDS)
    at = [i for i, r in enumerate(rows) if r[NAMES.index("action")] in S.BY_QUERY]
    state, cut = {}, 0
    for i in [*at, len(rows)]:
        state = fold(rows[cut:i], state)[0]
        if i < len(rows):
            state = dict_fold([rows[i]], state)[0]
        cut = i + 1
    assert table(replay_with_queries(log, hot=[("0",)], chunk_bits=4)) == typed(state)
    assert table(replay_with_queries(log, size=3)) == typed(state)
    one, many = (results(outcomes_with_queries(log, size=n)) for n in (2, 64))
    assert one == many and "created" in one.values()
    docs, _ = replay_documents_with_queries(request_frame(spark, rows))
    assert {r.id: json.loads(r.doc) for r in docs.collect()} == state


def test_upserts_for_many_targets(spark):
    rows = upsert_log(31)
    log = roll_by_size(parse_docs(request_frame(spark, rows), FIELDS), 1000)
    positions = spark.createDataFrame([("t1", 1), ("t2", 4), ("t3", 9)], "target string, file_position long")
    got = {}
    for r in replay_targets(log, positions, hot=[("0",)], chunk_bits=4).collect():
        got.setdefault(r.target, {})[r.id] = (r.a, r.b)
    for target, start in [("t1", 1), ("t2", 4), ("t3", 9)]:
        assert got[target] == typed(fold([r for r in rows if r[0] * 50 // 1000 + 1 >= start])[0])


@pytest.mark.parametrize("declared", [True, False])
def test_upserts_through_the_jobs(spark, tmp_path, declared):
    """Captured in batches, replayed run by run (declared documents: as layers), with dead letters as logged."""
    rows = upsert_log(41, 240, 40)
    log, out, letters = (f"{tmp_path}/{n}" for n in ("log", "sample1", "dead"))
    kind = FIELDS if declared else None
    for n, part in enumerate((rows[:200], rows[200:220], rows[220:])):
        capture_batch(request_frame(spark, part), log, ["sample"], n, max_bytes=2000)
        replay_target(spark, log, out, kind, dead_letter_path=letters, buckets=4)
    fields = FIELDS.fields if declared else [T.StructField("doc", T.StringType())]
    got = tables.read_table(spark, out, T.StructType([T.StructField("id", T.StringType()), *fields]))
    want, outcome = fold(rows)
    if declared:
        assert table(got) == typed(want)
    else:
        assert {r.id: json.loads(r.doc) for r in got.collect()} == want
    kept = {r.seq: (r.doc, r.upsert, r.doc_as_upsert) for r in read_dead_letters(spark, letters).collect()}
    at = [NAMES.index(n) for n in ("doc", "upsert", "doc_as_upsert")]
    assert kept == {r[0]: tuple(r[i] for i in at) for r in rows if outcome[r[0]] == "failed"}


def nested(rng, depth=0):
    """A random object; its fields are scalars, arrays or objects, by turns."""
    out = {}
    for name in rng.sample(["a", "b", "c", 'q"\\', "é"], rng.randint(0, 3)):
        kind = rng.random()
        if kind < 0.5 and depth < 4:
            out[name] = nested(rng, depth + 1)
        else:
            out[name] = rng.choice([None, 1, "x", 2.5, True, [], [{"a": 1}, None], "", {}])
    return out


@pytest.mark.parametrize("seed", range(3))
def test_patches_merge_at_every_level(spark, seed):
    rng = random.Random(500 + seed)
    rows = []
    for seq in range(300):
        action = rng.choice(["index", "create", "delete", *["update"] * 9])
        body = None if action == "delete" else json.dumps(nested(rng))
        key = "0" if rng.random() < 0.5 else str(rng.randint(1, 12))
        rows.append(request(seq, action, id=key, doc=body))
    rows = with_upserts(rng, rows, lambda: nested(rng))
    base = {str(i): nested(rng) for i in range(6, 16)}
    frame = spark.createDataFrame([(k, json.dumps(d)) for k, d in base.items()], "id string, doc string")
    want, _ = fold(rows, base)
    for hot in ([], [("0",), ("7",)]):
        got = replay_documents(request_frame(spark, rows), frame, hot=hot, chunk_bits=3)
        assert {r.id: json.loads(r.doc) for r in got.collect()} == want


def test_objects_below_the_last_level_are_values(spark):
    def deep(n, value):
        return value if n == 0 else {"k": deep(n - 1, value)}

    rows = [request(0, "index", id="1", doc=json.dumps(deep(MAX_DEPTH - 1, {"x": 1}))),
            request(1, "update", id="1", doc=json.dumps(deep(MAX_DEPTH - 1, {"y": 2}))),
            request(2, "index", id="2", doc=json.dumps(deep(MAX_DEPTH + 3, {"x": 1}))),
            request(3, "update", id="2", doc=json.dumps(deep(MAX_DEPTH + 3, {"y": 2})))]
    got = {r.id: json.loads(r.doc) for r in replay_documents(request_frame(spark, rows)).collect()}
    assert got == {"1": deep(MAX_DEPTH - 1, {"x": 1, "y": 2}), "2": deep(MAX_DEPTH + 3, {"y": 2})}
