"""What the plans must and must not hold, whatever the size of the data."""

from pyspark.sql import functions as F

from doclog.operators.barriers import replay_with_queries
from doclog.functions.scale import hot_keys
from doclog.operators.fold import parse_docs, replay, replay_writes, with_state
from doclog.operators.documents import replay_documents
from doclog.operators.routing import route_requests
from doclog.plans import derived_logs as D
from doclog.plans.jobs import capture_batch
from doclog.sources.log import scan_segments
from conftest import SF
from helpers import request, request_frame


def plan(df):
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def scans(text):
    return [line for line in text.split("\n") if "FileScan" in line]


def test_stored_log_is_pruned_by_segment_and_column(spark, tmp_path):
    log = str(tmp_path / "log")
    capture_batch(D.bulk_requests(spark, SF), log, ["sample"], 0, max_bytes=10_000)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        stored = parse_docs(scan_segments(spark, log, 2, 3), D.EVENT_DOC)
        cold, mixed = plan(replay(stored, hot=[])), plan(replay(stored, hot=[("1",)]))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    for text, count in ((cold, 1), (mixed, 3)):
        found = scans(text)
        assert len(found) == count
        assert all("segment_id" in line.split("PartitionFilters")[1].split("PushedFilters")[0] for line in found)
        reads = [line.split("ReadSchema")[1] for line in found]
        # What decides existence in hot keys is read without documents; nothing reads columns replay does not use.
        assert sum("doc:" not in r for r in reads) == (count == 3)
        assert not any("request_id" in r or "index:" in r for r in reads)


def test_replay_shuffles_rows_once(spark):
    text = plan(replay(D.order_changes(spark, SF), D.customer_base(spark, SF)))
    # One shuffle by key and one sort serve both the window and the aggregation.
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count(" Sort ") == 1


def test_hot_keys_shuffle_rows_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(replay(D.order_changes(spark, SF), hot=[(1,)]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Small keys once by key. Hot ones: rows by (key, chunk); flags by (key, chunk), by key and back; reduced rows.
    assert text.count("Exchange hashpartitioning") == 1 + 5
    # The hot rows are sorted for the window, and the join takes them in that order.
    between = text[text.index("SortMergeJoin"):]
    assert "Sort " not in between[:between.index("Window")]


def test_last_write_combines_before_the_shuffle(spark):
    text = plan(replay_writes(D.line_writes(spark, SF), D.LINE_ORDER, keys=D.LINE_KEY))
    below = text[text.index("Exchange"):]
    assert "partial_max_by" in below and text.count("Exchange hashpartitioning") == 1


def test_a_hot_key_does_not_meet_in_one_group(spark):
    """Half of the log on one key: no group of rows that must sit in one task holds more than a chunk of it."""
    log = spark.range(40_000).select(
        F.col("id").alias("seq"),
        F.lit(0).alias("item"),
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("id"),
        F.when(F.col("id") % 5 == 0, "index").when(F.col("id") % 5 == 1, "delete").otherwise("update").alias("action"),
        F.struct(F.col("id").alias("v")).alias("doc"),
    )
    assert hot_keys(log, ["id"]) == []
    groups = with_state(log, ["id"], 10).groupBy("id", "chunk").count()
    assert groups.agg(F.max("count")).first()[0] <= 1 << 10
    cut = replay(log, hot=[(0,)], chunk_bits=10)
    assert cut.exceptAll(replay(log, hot=[])).count() == 0
    assert cut.count() == replay(log, hot=[]).count()


def test_hot_keys_are_found(spark):
    log = spark.range(0, 1_000_000, 1, 8).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("id"))
    assert hot_keys(log, ["id"]) == [(-1,)]


def test_no_query_request_means_no_round(spark):
    log = D.barrier_log(spark, SF, [])
    assert "epoch" not in plan(replay_with_queries(log))


def test_documents_are_shuffled_once(spark):
    text = plan(replay_documents(D.event_requests(spark, SF), hot=[]))
    assert text.count("Exchange hashpartitioning") == 1


def test_without_ansi_mode(spark):
    """Sizes of missing arrays and bad casts must not change results in sessions that are lenient about them."""
    rows = [
        request(1, "bulk", index=None, items=None),
        request(2, "delete_by_query", index=None, indices=None),
        request(3, "index", id="1", doc='{"msg": "a"}'),
    ]
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        got = {r.seq: r.route for r in route_requests(request_frame(spark, rows), ["sample"]).collect()}
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert got == {1: "pass", 2: "pass", 3: "capture"}
