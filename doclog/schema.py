"""Row schemas and the fixed values every part of the package agrees on."""

from __future__ import annotations

from pyspark.sql import types as T

# Request kinds and their record codes.
CODE_DELETE = 1
CODE_DELETE_BY_QUERY = 2
CODE_INDEX = 3
CODE_UPDATE = 4
CODE_UPDATE_BY_QUERY = 5
CODE_BULK = 99
CODE_UNKNOWN = 0

# A bulk "create" item is an index request with another op type, so it shares the index code.
ACTION_CODES = {
    "delete": CODE_DELETE,
    "delete_by_query": CODE_DELETE_BY_QUERY,
    "index": CODE_INDEX,
    "create": CODE_INDEX,
    "update": CODE_UPDATE,
    "update_by_query": CODE_UPDATE_BY_QUERY,
    "bulk": CODE_BULK,
}

# Fixed value: the id an immediate reply carries when the request has none.
PLACEHOLDER_ID = "idxproxy"

# The actions that cut a segment, and the prefix of short action names.
ADMIN_PREFIX = "indices:admin/"
RENEW_ACTIONS = ("flush", "forcemerge", "refresh", "upgrade")

# Defaults of the tunable limits.
SEGMENT_NAME_FORMAT = "%019d"
SEGMENT_BYTES = 100 * 1024 * 1024
SEGMENT_RETRIES = 10
REQUEST_RETRIES = 3
LOOKUP_SEGMENTS = 1000
ALIVE_SECONDS = 600
POLL_SECONDS = 30
PAGE_SIZE = 10

MAX_LONG = 9223372036854775807
MIN_LONG = -9223372036854775808

FULL_WRITES = ("index", "create", "delete")
DOC_WRITES = ("index", "create", "update")
KEYED = FULL_WRITES + ("update",)
BY_QUERY = ("delete_by_query", "update_by_query")
QUERY_KINDS = ("term", "range", "match_all")
BULK_ITEM_ACTIONS = ("index", "create", "update", "delete") + BY_QUERY

QUERY = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("field", T.StringType()),
        T.StructField("lo", T.StringType()),
        T.StructField("hi", T.StringType()),
    ]
)

SET = T.MapType(T.StringType(), T.StringType())

ITEM = T.StructType(
    [
        T.StructField("action", T.StringType()),
        T.StructField("index", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("doc", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("query", QUERY),
        T.StructField("set", SET),
        T.StructField("upsert", T.StringType()),
        T.StructField("doc_as_upsert", T.BooleanType()),
    ]
)
"""An update inserts `upsert` where there is no document, or its patch with `doc_as_upsert`."""

REQUEST = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("item", T.IntegerType()),
        T.StructField("request_id", T.LongType()),
        T.StructField("action", T.StringType()),
        T.StructField("index", T.StringType()),
        T.StructField("indices", T.ArrayType(T.StringType())),
        T.StructField("type", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("doc", T.StringType()),
        T.StructField("query", QUERY),
        T.StructField("set", SET),
        T.StructField("items", T.ArrayType(ITEM)),
        T.StructField("bytes", T.LongType()),
        T.StructField("upsert", T.StringType()),
        T.StructField("doc_as_upsert", T.BooleanType()),
    ]
)

SEGMENTS = T.StructType(
    [
        T.StructField("segment_id", T.LongType()),
        T.StructField("requests", T.LongType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("min_seq", T.LongType()),
        T.StructField("max_seq", T.LongType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

LETTERS = T.StructType(
    [
        *REQUEST.fields,
        T.StructField("position", T.IntegerType()),
        T.StructField("reason", T.StringType()),
        T.StructField("attempts", T.IntegerType()),
        T.StructField("target", T.StringType()),
        T.StructField("segment_id", T.LongType()),
    ]
)
"""A dead letter: the request as it was logged, its place, and why it failed."""

POSITIONS = T.StructType(
    [
        T.StructField("target", T.StringType()),
        T.StructField("doc_type", T.StringType()),
        T.StructField("node_name", T.StringType()),
        T.StructField("file_position", T.LongType()),
        T.StructField("ts", T.TimestampType()),
    ]
)
