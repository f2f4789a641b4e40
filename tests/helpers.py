"""Small logs for tests, and a plain dictionary fold to compare with."""

from __future__ import annotations

from pyspark.sql import types as T

from doclog import schema as S

DOC = T.StructType([T.StructField("id", T.LongType()), T.StructField("msg", T.StringType())])


def request(seq, action, **kw):
    row = {"seq": seq, "item": 0, "request_id": seq, "action": action, "index": "sample", "type": "doc", "bytes": 50}
    row.update(kw)
    return tuple(row.get(n) for n in S.REQUEST.names)


def doc(n, text=None):
    return f'{{"id": {n}, "msg": "test {text or n}"}}'


def item(action, n, body=None):
    return {"action": action, "index": "sample", "type": "doc", "id": str(n), "doc": body}


def term(n):
    return {"kind": "term", "field": "id", "lo": str(n), "hi": None}


def scenario(b, first=1):
    """The golden scenario around base `b`: every kind of request once, in a fixed order."""
    patch = lambda n: f'{{"msg": "test {n}"}}'
    steps = [
        ("index", dict(id=str(b + 6), doc=doc(b + 6))),
        ("index", dict(id=str(b + 7), doc=doc(b + 7))),
        ("bulk", dict(index=None, type=None, items=[
            item("create", b + 5, doc(b + 5)), item("update", b + 6, patch(b + 306)), item("delete", b + 7)])),
        ("index", dict(id=str(b + 3), doc=doc(b + 3))),
        ("delete", dict(id=str(b + 3))),
        ("index", dict(id=str(b + 4), doc=doc(b + 4))),
        ("delete_by_query", dict(index=None, indices=["sample"], query=term(b + 4))),
        ("index", dict(id=str(b + 1), doc=doc(b + 1))),
        ("update", dict(id=str(b + 1), doc=patch(b + 101))),
        ("index", dict(id=str(b + 2), doc=doc(b + 2))),
        ("update_by_query", dict(index=None, indices=["sample"], query=term(b + 2), set={"msg": f"test {b + 202}"})),
        ("index", dict(id=str(b), doc=doc(b))),
    ]
    return [request(first + i, action, **kw) for i, (action, kw) in enumerate(steps)]


def golden(b):
    return {str(b): f"test {b}", str(b + 1): f"test {b + 101}", str(b + 2): f"test {b + 202}",
            str(b + 5): f"test {b + 5}", str(b + 6): f"test {b + 306}"}


def request_frame(spark, rows):
    return spark.createDataFrame(rows, S.REQUEST)


FIELDS = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])


def random_log(rng, n, ids, by_query=()):
    """`n` random requests; half of them on one id. By-query requests sit at the given places."""
    rows = []
    for seq in range(n):
        if seq in by_query:
            lo = rng.randint(0, 9)
            action = rng.choice(["delete_by_query", "update_by_query"])
            query = rng.choice([
                {"kind": "range", "field": "a", "lo": str(lo), "hi": str(lo + 2)},
                {"kind": "term", "field": "b", "lo": "x", "hi": None},
                {"kind": "term", "field": "id", "lo": "0", "hi": None},
                {"kind": "range", "field": "a", "lo": None, "hi": "1"},
            ])
            sets = {"b": "x"} if action == "update_by_query" else None
            rows.append(request(seq, action, index=None, indices=["sample"], query=query, set=sets))
            continue
        key = "0" if rng.random() < 0.5 else str(rng.randint(1, ids))
        action = rng.choice(["index", "create", "update", "update", "update", "delete"])
        body = {"a": rng.choice(["null", str(rng.randint(0, 9))]), "b": rng.choice(["null", '"x"', '"y"'])}
        if action != "index":
            body = {k: v for k, v in body.items() if rng.random() < 0.6}
        text = "{" + ", ".join(f'"{k}": {v}' for k, v in body.items()) + "}"
        if rng.random() < 0.03:
            text = "{broken"
        rows.append(request(seq, action, id=key, doc=None if action == "delete" else text))
    return rows


def dict_fold(rows, state=None):
    """The log applied one request after another: (documents by id, seqs of failed requests)."""
    import json

    docs, failed = dict(state or {}), []
    at = {n: i for i, n in enumerate(S.REQUEST.names)}
    for row in rows:
        get = lambda n: row[at[n]]
        action, key = get("action"), get("id")
        if action in ("delete_by_query", "update_by_query"):
            q = get("query")
            for k, d in list(docs.items()):
                v = k if q["field"] == "id" else d.get(q["field"])
                if v is None:
                    continue
                conv = (lambda x: x) if isinstance(v, str) else int
                if q["kind"] == "term":
                    hit = v == conv(q["lo"])
                else:
                    hit = (q["lo"] is None or v >= conv(q["lo"])) and (q["hi"] is None or v <= conv(q["hi"]))
                if hit and action == "delete_by_query":
                    del docs[k]
                elif hit:
                    docs[k] = d | get("set")
            continue
        if action == "delete":
            docs.pop(key, None)
            continue
        try:
            body = json.loads(get("doc"))
        except ValueError:
            failed.append(get("seq"))
            continue
        if action == "index" or (action == "create" and key not in docs):
            docs[key] = body
        elif action == "update" and key in docs:
            docs[key] = docs[key] | body
        else:
            failed.append(get("seq"))
    return docs, failed


def typed(docs):
    return {k: (d.get("a"), d.get("b")) for k, d in docs.items()}
