"""Token counts: batches balanced by bytes, lengths only."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship
from .vocab import open_tokenizer, pieces

#: Bytes of text that are encoded together, and pieces whose lengths are remembered.
BATCH_BYTES, REMEMBERED = 1 << 20, 1 << 18
_STATE: dict[str, tuple[dict, dict]] = {}


def _batches(texts: list[str], most: int = BATCH_BYTES) -> Iterator[list[tuple[int, list[str]]]]:
    """Lists of (text number, pieces) of about `most` bytes: short texts share one, long texts are spread over several."""
    batch, size = [], 0
    for n, text in enumerate(texts):
        first, *rest = pieces(text)
        parts = [first, *(" " + p for p in rest)]
        at = 0
        while at < len(parts):
            room = max(1, (most - size) * len(parts) // max(1, len(text)))
            take = parts[at : at + room]
            batch.append((n, take))
            size += sum(map(len, take))
            at += room
            if size >= most:
                yield batch
                batch, size = [], 0
    if batch:
        yield batch


def _lengths(texts: list[str], name: str) -> list[int]:
    tokenizer = open_tokenizer(name)
    young, old = _STATE.setdefault(name, ({}, {}))
    counts = [0] * len(texts)
    for batch in _batches(texts):
        unseen = set().union(*(p for _, p in batch)).difference(young)
        for p in [p for p in unseen if p in old]:
            young[p] = old[p]
            unseen.discard(p)
        new = sorted(unseen)
        for p, e in zip(new, tokenizer.encode_batch_fast(new, add_special_tokens=False)):
            young[p] = len(e)
        for n, parts in batch:
            counts[n] += sum(map(young.__getitem__, parts))
        if len(young) > REMEMBERED:
            young, old = {}, young
            _STATE[name] = (young, old)
    return counts


def token_lengths(text: Column, tokenizer: str = "byte_bpe_50k.json") -> Column:
    """Number of tokens that `tokenizer` gives for `text`, without added special tokens.

    An Arrow function: texts arrive in batches, are cut where no pretoken or special token crosses (before single
    spaces), and dealt into batches of about BATCH_BYTES, so that one long text is as good as many short ones. Pieces
    are encoded by the library in one call a batch, each piece once; lengths only are kept and returned. Null counts as
    empty: 0 tokens.
    """

    @F.arrow_udf(T.LongType())
    def lengths(texts: pa.Array) -> pa.Array:
        return pa.array(_lengths([t or "" for t in texts.to_pylist()], tokenizer), pa.int64())

    return lengths(text)


def count_tokens(
    docs: DataFrame, limit: int = 512, tokenizer: str = "byte_bpe_50k.json", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`id_col`, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > `limit`); a row per row of `docs`.

    Null texts count as empty. Ids may be null or repeat; each row depends on itself only and nothing is shuffled. Other
    columns are ignored.
    """
    ship(docs.sparkSession)
    counted = docs.select(
        id_col,
        F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_bytes"),
        token_lengths(F.col(text_col), tokenizer).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
