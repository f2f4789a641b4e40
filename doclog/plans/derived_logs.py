"""Change logs derived from the given tables, for the verification queries and the bench."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doclog import schema as S
from doclog.operators.fold import parse_docs

EVENT_DOC = T.StructType([T.StructField("value", T.DoubleType()), T.StructField("k", T.IntegerType())])
TARGETS = ["sample"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_requests(spark: SparkSession, sf_dir: str, click: str = "update") -> DataFrame:
    """One keyed request per event: signup indexes, view creates, error deletes, click and purchase update."""
    events = table(spark, sf_dir, "events")
    kind, seq = F.col("event_type"), F.col("event_id")
    action = (
        F.when(kind == "signup", "index").when(kind == "view", "create").when(kind == "error", "delete")
        .when(kind == "click", click).otherwise("update")
    )
    k = F.get_json_object("props", "$.k").cast("int").alias("k")
    full, patch = F.to_json(F.struct("value", k)), F.to_json(F.struct("value"))
    request = F.expr("event_id div 10")
    index = (
        F.when(request % 3 == 0, "sample").when(request % 3 == 1, "other")
        .otherwise(F.when(F.col("user_id") % 2 == 0, "sample").otherwise("other"))
    )
    return events.select(
        seq.alias("seq"),
        (seq % 10).cast("int").alias("item"),
        request.alias("request_id"),
        action.alias("action"),
        index.alias("index"),
        F.lit("doc").alias("type"),
        F.col("user_id").cast("string").alias("id"),
        F.lit(None).cast("long").alias("version"),
        F.when(kind == "purchase", patch).when(kind != "error", full).alias("doc"),
        (F.length("event_type") + F.length("props")).cast("long").alias("bytes"),
        (seq % 1000 == 999).alias("marker"),
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_docs(event_requests(spark, sf_dir), EVENT_DOC)


def upsert_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same requests, where clicks of every third user bring a document to insert, and purchases of every fifth
    insert their patch."""
    kind, user = F.col("event_type"), F.col("user_id")
    given = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.when(
            (kind == "click") & (user % 3 == 0),
            F.to_json(
                F.struct((F.col("value") + 1).alias("value"), (F.get_json_object("props", "$.k").cast("int") + 100).alias("k"))
            ),
        ).alias("upsert"),
        ((kind == "purchase") & (user % 5 == 0)).alias("doc_as_upsert"),
    )
    return event_requests(spark, sf_dir).join(given, "seq")


def requests_without_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same requests, where index requests of odd users leave the id to be made and updates carry a version."""
    action, user = F.col("action"), F.col("id").cast("long")
    return event_requests(spark, sf_dir).withColumns(
        {
            "version": F.when(action == "update", user),
            "id": F.when((action == "index") & (user % 2 == 1), F.lit(None)).otherwise(F.col("id")),
        }
    )


def bulk_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events, ten to a bulk request, items in order."""
    rows = event_requests(spark, sf_dir)
    blank = {f.name: F.lit(None).cast(f.dataType) for f in S.REQUEST.fields}
    names = S.ITEM.names
    item = F.struct("item", *[(F.col(n) if n in rows.columns else blank[n]).alias(n) for n in names])
    items = F.transform(
        F.array_sort(F.collect_list(item), lambda a, b: a["item"] - b["item"]),
        lambda x: F.struct(*[x[n].alias(n) for n in names]),
    )
    bulks = rows.groupBy("request_id").agg(
        F.min("seq").alias("seq"), items.alias("items"), F.sum("bytes").alias("bytes")
    )
    bulks = bulks.withColumns({"item": F.lit(0), "action": F.lit("bulk")})
    return bulks.select(*[(F.col(n) if n in bulks.columns else blank[n]).alias(n) for n in S.REQUEST.names])


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as changes to customers: open ones write, fulfilled ones patch the balance, pending ones delete."""
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("seq"),
        F.lit(0).alias("item"),
        F.when(status == "F", "update").when(status == "O", "index").otherwise("delete").alias("action"),
        F.col("o_custkey").alias("id"),
        F.struct(F.col("o_totalprice").alias("balance")).alias("doc"),
    )


def customer_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))


LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag",
    "l_linestatus",
]


def line_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as whole-row writes keyed by order and line; the key repeats, the last shipped row wins."""
    return table(spark, sf_dir, "lineitem").select(
        *LINE_KEY, F.lit("index").alias("action"), F.struct(*LINE_ORDER).alias("doc"), *LINE_ORDER
    )


def turn_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns: a system turn opens the document, every other turn replaces its text."""
    return table(spark, sf_dir, "conversations").select(
        F.col("turn").alias("seq"),
        F.lit(0).alias("item"),
        F.when(F.col("role") == "system", "index").otherwise("update").alias("action"),
        F.col("conv_id").alias("id"),
        F.struct(F.col("text").alias("text")).alias("doc"),
    )


def page_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as documents with nested and repeated values, patched or (by short ones) deleted by the documents of
    the same number."""
    pages, docs = table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents")
    html = F.struct(F.length("html").alias("chars"), F.array("url").alias("tags"))
    body = F.struct("url", html.alias("html"))
    opened = pages.select(
        F.col("page_id").alias("seq"), F.lit("index").alias("action"), F.col("page_id").alias("id"),
        F.to_json(body).alias("doc"),
    )
    patch = F.when(F.col("lang") == "en", F.to_json(F.struct("lang", "source"))).otherwise(
        F.to_json(F.struct("lang", F.struct(F.col("n_chars").alias("chars")).alias("html")))
    )
    short = F.col("n_chars") < 100
    patched = docs.select(
        (F.col("doc_id") + (1 << 40)).alias("seq"),
        F.when(short, "delete").otherwise("update").alias("action"),
        F.col("doc_id").alias("id"),
        F.when(~short, patch).alias("doc"),
    )
    return opened.unionByName(patched).withColumn("item", F.lit(0))


def barrier_log(spark: SparkSession, sf_dir: str, barriers: list[dict]) -> DataFrame:
    """The event log with by-query requests in place of the events at their positions."""
    return parse_docs(barrier_requests(spark, sf_dir, barriers), EVENT_DOC)


def barrier_requests(spark: SparkSession, sf_dir: str, barriers: list[dict]) -> DataFrame:
    rows = event_requests(spark, sf_dir)
    taken = [b["seq"] for b in barriers]
    keyed = rows.where(~F.col("seq").isin(*taken)).withColumns(
        {"query": F.lit(None).cast(S.QUERY), "set": F.lit(None).cast(S.SET)}
    )

    def pick(cases):
        out = F.lit(None)
        for seq, value in cases:
            out = F.when(F.col("seq") == seq, value).otherwise(out)
        return out

    def query_of(q: dict):
        return F.struct(*[F.lit(q.get(f.name)).cast("string").alias(f.name) for f in S.QUERY.fields])

    def set_of(assign: dict | None):
        if not assign:
            return F.lit(None).cast(S.SET)
        return F.create_map(*[F.lit(str(v)) for kv in assign.items() for v in kv])

    by_query = (
        rows.where(F.col("seq").isin(*taken))
        .withColumn("action", pick((b["seq"], F.lit(b["action"])) for b in barriers))
        .withColumn("query", pick((b["seq"], query_of(b["query"])) for b in barriers).cast(S.QUERY))
        .withColumn("set", pick((b["seq"], set_of(b.get("set"))) for b in barriers).cast(S.SET))
        .withColumn("id", F.lit(None).cast("string"))
        .withColumn("doc", F.lit(None).cast("string"))
    )
    return keyed.unionByName(by_query)
