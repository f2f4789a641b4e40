import os
import sys
import zlib
from collections import Counter

import pytest

sys.path.insert(0, os.path.dirname(__file__))
sys.path.insert(0, os.path.dirname(os.path.dirname(__file__)))

from compare import connect, difference  # noqa: E402
from conftest import SF  # noqa: E402
from llm_data import PROSE, docs, near_links, normal  # noqa: E402

import corpus_pipeline  # noqa: E402
from doclog.llm import queries, sql, toxicity  # noqa: E402
from doclog.llm.vocab import open_tokenizer  # noqa: E402

SMALL = SF.replace("0.01", "0.001")


@pytest.mark.parametrize("name", sorted(sql.ORACLE))
def test_query_equals_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SF), connect(SF), sql.ORACLE[name]) is None


def test_line_rules_stay_in_the_jvm(spark):
    plan = queries.QUERIES["op7_line_rules"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not [n for n in ("Python", "InPandas", "InArrow", "CartesianProduct", "NestedLoop") if n in plan]


def texts(spark, sf):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def test_bpe_and_counts_equal_the_library(spark):
    tok = open_tokenizer("byte_bpe_50k.json")
    want = {i: len(tok.encode(t, add_special_tokens=False).ids) for i, t in texts(spark, SMALL).items()}
    assert {r.doc_id: r.n_tokens for r in queries.op3_bpe(spark, SMALL).collect()} == want
    assert {r.doc_id: r.n_tokens for r in queries.op4_token_counts(spark, SMALL).collect()} == want


def test_near_duplicates_find_all_links(spark):
    known = texts(spark, SF)
    ids = list(known)
    links = near_links(list(known.values()))
    got = {r.doc_id: r.n_links for r in queries.op6_ngram_join(spark, SF).collect()}
    assert got == {i: len(n) for i, n in zip(ids, links)}


def test_toxicity_on_held_out_documents(spark):
    sf = SF.replace("0.01", "0.1")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [r for r in queries.op5_toxicity(spark, sf).collect() if r.held_out and r.doc_id in labels]
    table = Counter((labels[r.doc_id], r.predicted) for r in got)
    assert table[1, 1] >= 0.8 * (table[1, 0] + table[1, 1])
    assert table[0, 1] <= 0.02 * (table[0, 0] + table[0, 1])


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    left = {r.doc_id: r.text for r in docs.collect()}
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name == "toxicity":
            model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            left = {i: t for i, t in left.items() if model.score(t) < 0.5}
        elif name == "exact dedup":
            first = {}
            for i in sorted(left):
                first.setdefault(normal(left[i]), i)
            left = {i: left[i] for i in first.values()}
        elif name == "n-gram Jaccard join":
            ids = sorted(left)
            links = near_links([left[i] for i in ids])
            root = list(range(len(ids)))
            for _ in range(20):
                root = [min([root[k], *(root[j] for j in links[k])]) for k in range(len(ids))]
            left = {i: left[i] for k, i in enumerate(ids) if root[k] == k}
        if name == "best-fit packing":
            assert {r.doc_id for r in out.collect()} == set(left)
            break
        assert out.columns == names
        path = f"{spark.conf.get('spark.checkpoint.dir')}/{zlib.crc32(name.encode())}"
        out.write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        got = {r.doc_id: r.text for r in docs.collect()}
        if name == "PII":
            assert set(got) == set(left) and any("<EMAIL>" in t for t in got.values())
            left = got
        assert got == left


def test_rows_of_one_id_whose_texts_are_equal_but_for_white_space(spark):
    rows = [(1, "a  b"), (1, "a b"), (2, "a b"), (1, "other"), (None, None), (None, "")]
    out = corpus_pipeline.exact(spark, docs(spark, rows), SMALL)
    assert out.columns == docs(spark, rows).columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == [(1, "a  b"), (1, "other"), (None, None)]


def test_stages_keep_clean_rows_with_nulls_and_repeats(spark):
    rows = [(1, PROSE), (1, PROSE), (1, "another text of the same id, which is kept as it is"), (2, PROSE + " again")]
    rows += [(None, PROSE + " and"), (None, "a clean text without an id"), (3, None), (4, ""), (5, "a  b"), (6, "a b")]
    table = docs(spark, rows)
    out = corpus_pipeline.exact(spark, table, SMALL)
    assert out.columns == table.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted(
        {x for x in rows if x not in [(4, ""), (6, "a b")]}, key=repr
    )
    out = corpus_pipeline.near(spark, out, SMALL)
    left = [(1, PROSE), (1, "another text of the same id, which is kept as it is"), (None, "a clean text without an id")]
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted([*left, (3, None), (5, "a  b")], key=repr)
    out = corpus_pipeline.private(spark, out, SMALL)
    assert out.columns == table.columns and out.count() == 5
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs(spark, []), SMALL).count() == 0
