"""Packing of tokenized documents into sequences by bulk-synchronous best fit."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache, reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ROWS_PER_CHUNK, Scratch, number_rows, ship
from .transducer import byte_symbols
from .vocab import Memo, open_tokenizer

#: Pieces of at most capacity / SMALL tokens are put in bundles of up to twice that before they are placed.
SMALL = 64

_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-įı-ſ]+")
#: Special tokens begin like this; the separators are white space to Python but not to the tokenizer.
_WHOLE = re.compile(r"<\||[\x1c-\x1f]")


class WordIds:
    """Token ids of texts whose white space the tokenizer drops, as little-endian unsigned 32-bit numbers."""

    def __init__(self, name: str) -> None:
        self._tokenizer = open_tokenizer(name)
        self._model = self._tokenizer.model
        self._symbols = {b: c for b, c in enumerate(byte_symbols())}
        self._pieces, self._words = Memo(self._piece), Memo(self._word)

    def ids(self, text: str) -> bytes:
        if _WHOLE.search(text):
            return self._any(text)
        words = text.split()
        out = []
        for at in range(0, len(words), 1 << 14):
            out.append(b"".join(map(self._pieces.__getitem__, words[at : at + (1 << 14)])))
            self._pieces.trim()
            self._words.trim()
        return b"".join(out)

    def _any(self, text: str) -> bytes:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        if piece[-1] in ",." and _LETTERS.fullmatch(piece, 0, len(piece) - 1):
            return self._words[piece[:-1].lower()] + self._words[piece[-1]]
        if _LETTERS.fullmatch(piece):
            return self._words[piece.lower()]
        return self._any(unicodedata.normalize("NFC", piece))

    def _word(self, word: str) -> bytes:
        symbols = word.encode().decode("latin-1").translate(self._symbols)
        return np.array([t.id for t in self._model.tokenize(symbols)], "<u4").tobytes()


@lru_cache(maxsize=None)
def _words(name: str) -> WordIds:
    return WordIds(name)


def token_pieces(
    docs: DataFrame,
    capacity: int,
    tokenizer: str = "word_bpe_49k.json",
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Documents as token ids with `end_id` behind them, longer ones cut into pieces of `capacity` ids.

    Returns a row per piece: `id_col`, piece, start, length, ids_crc32, and with `with_ids` the ids as little-endian
    unsigned 32-bit numbers. Null texts count as empty and give one piece of one id.
    """
    ship(docs.sparkSession)
    fields = [
        docs.schema[id_col],
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        *([T.StructField("ids", T.BinaryType())] if with_ids else []),
    ]
    schema = T.StructType(fields)
    step = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, words, end = to_arrow_schema(schema), _words(tokenizer), np.array([end_id], "<u4").tobytes()
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                from_row, piece, start, length, crc, kept = [], [], [], [], [], []
                for n, text in enumerate(batch.column("_text").to_pylist()):
                    ids = words.ids(text or "") + end
                    for k, b in enumerate(range(0, len(ids), step)):
                        cut = ids[b : b + step]
                        from_row.append(n)
                        piece.append(k)
                        start.append(b // 4)
                        length.append(len(cut) // 4)
                        crc.append(crc32(cut))
                        if with_ids:
                            kept.append(cut)
                columns = [piece, start, length, crc, *([kept] if with_ids else [])]
                arrays = [batch.column(id_col).take(pa.array(from_row, pa.int64()))]
                arrays += [pa.array(c, f.type) for c, f in zip(columns, list(arrow)[1:])]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return docs.select(id_col, F.col(text_col).alias("_text")).mapInArrow(run, schema)


def sequences_needed(sizes: dict[int, int], capacity: int) -> int:
    """At least so many sequences hold the pieces `sizes` (size: number): by their sum, and by how many of the larger
    ones fit in one sequence."""
    need = -(-sum(s * n for s, n in sizes.items()) // capacity)
    for k in range(1, 9):
        need = max(need, -(-sum(n for s, n in sizes.items() if s * (k + 1) > capacity) // k))
    return need


_SWEPT = "kind int, id long, size long, pid int, at long, height long, low long, docs long"
_FAR = 1 << 60


def _local_sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each row of a sorted partition: gaps less documents before it, the least such number, documents before it."""
    pid, at, height, low, docs = TaskContext.get().partitionId(), 0, 0, _FAR, 0
    for b in batches:
        kind = b.column("kind").to_numpy(zero_copy_only=False).astype(np.int64)
        n = len(kind)
        if not n:
            continue
        after = height + np.cumsum(1 - 2 * kind)
        lows = np.minimum.accumulate(np.minimum(after, low))
        seen = docs + np.cumsum(kind)
        columns = [
            *(b.column(c) for c in ("kind", "id", "size")),
            pa.array(np.full(n, pid, np.int32)),
            pa.array(np.arange(at, at + n)),
            pa.array(np.concatenate(([height], after[:-1]))),
            pa.array(np.concatenate(([low], lows[:-1]))),
            pa.array(seen - kind),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["kind", "id", "size", "pid", "at", "height", "low", "docs"])
        at, height, low, docs = at + n, int(after[-1]), int(lows[-1]), int(seen[-1])


def _sweep(scratch: Scratch, live: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """Gaps and documents from the largest to the smallest, dealt over tasks by range, with what is open before each.

    Returns the stored partitions, and the rows with `level` and `rank`. Going down in size, a gap is put on a stack
    and a document takes the top one, which is the smallest that is large enough. `level` is the height of the stack at
    which a gap lies or from which a document takes; null for a document that finds the stack empty. `rank` counts the
    documents before.
    """
    order = [F.desc("size"), F.asc("kind"), F.asc("id")]
    dealt = live.repartitionByRange(rows // ROWS_PER_CHUNK + 1, *order).sortWithinPartitions(*order)
    local = scratch.save(dealt.mapInArrow(_local_sweep, _SWEPT))
    step = F.lit(1) - 2 * F.col("kind")
    parts = local.groupBy("pid").agg(
        F.sum(step).alias("rise"), F.min(F.col("height") + step).alias("least"), F.sum("kind").alias("n")
    )
    # A row per task.
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("base", F.coalesce(F.sum("rise").over(before), F.lit(0)))
    parts = parts.select(
        "pid",
        "base",
        F.least(F.lit(0), F.coalesce(F.min(F.col("base") + F.col("least")).over(before), F.lit(0))).alias("base_low"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base_docs"),
    )
    open_before = F.col("base") + F.col("height") - F.least("base_low", F.col("base") + F.col("low"))
    level = F.when(F.col("kind") == 0, open_before + 1).when(open_before > 0, open_before)
    return local, local.join(F.broadcast(parts), "pid").select(
        "kind", "id", "size", "pid", "at", level.alias("level"), (F.col("base_docs") + F.col("docs")).alias("rank")
    )


_OUT = "array<struct<kind:int,id:long,size:long,seq:long>>"


def _round(scratch: Scratch, live: DataFrame, rows: int, opened: int, capacity: int) -> DataFrame:
    """One superstep: every gap takes one document at most, the `opened` largest documents without a gap open sequences.

    Returns rows (kind, id, size, seq): 0 what is left of a gap, 1 a document that waits, 2 a document in its sequence.
    The match of a document is the gap before it on its level; a level has no more rows than there are sizes, twice.
    """
    local, swept = _sweep(scratch, live, rows)
    near = Window.partitionBy(F.coalesce("level", -1 - F.col("id"))).orderBy("pid", "at")
    seen = swept.select(
        "*", F.lag(F.struct("id", "size")).over(near).alias("gap"), F.lead("kind").over(near).alias("taker")
    )

    def row(kind, id_, size_, seq):
        return F.struct(
            F.lit(kind).alias("kind"), id_.alias("id"), size_.cast("long").alias("size"), seq.cast("long").alias("seq")
        )

    none, id_, size, gap = F.lit(None), F.col("id"), F.col("size"), F.col("gap")
    is_gap = F.col("kind") == 0
    out = (
        F.when(is_gap & (F.col("taker") == 1), F.array().cast(_OUT))
        .when(is_gap, F.array(row(0, id_, size, none)))
        .when(
            F.col("level").isNotNull(),
            F.array(row(2, id_, size, gap["id"]), row(0, gap["id"], gap["size"] - size, none)),
        )
        .when(F.col("rank") < opened, F.array(row(2, id_, size, id_), row(0, id_, F.lit(capacity) - size, none)))
        .otherwise(F.array(row(1, id_, size, none)))
    )
    done = scratch.save(seen.select(F.inline(out)), "kind")
    scratch.drop(local)
    return done


def best_fit_sequences(items: DataFrame, capacity: int, size_col: str = "length") -> DataFrame:
    """`items` with sequence_id and offset: sequences of at most `capacity`, as few as best fit needs, without gaps.

    Bulk-synchronous best fit. The sequences' gaps and the documents are range-sorted together by size; a sweep from
    the largest gives every document the smallest gap that is large enough and not yet taken. The sweep is a running
    sum per task plus the sums of the tasks before, so no task sees more than its range; documents that want the same
    gap are ranked by their place in the order, the next one taking the next larger gap. Gaps are updated and the sweep
    repeats until all are placed. A gap that could hold several of the largest waiting documents enters the sweep as
    so many equal parts. Documents larger than every gap open sequences from the largest, as many as are needed for
    sure. Every round reads and writes narrow rows in the shared folder, and the rows that are placed leave.

    `size_col` must be between 1 and `capacity`; null ids, repeated rows and ties get places of their own. Only sizes
    and counts per size (at most `capacity` of them) reach the driver. Columns named sequence_id or offset are replaced.
    """
    spark = items.sparkSession
    scratch = Scratch(spark, "packing")
    kept = [c for c in items.columns if c not in ("sequence_id", "offset")]
    rows = scratch.save(items.select(*kept).withColumn("_uid", F.monotonically_increasing_id()))
    size = F.col(size_col).cast("long")

    # Small pieces of one length form bundles; a bundle is placed like a piece.
    small = capacity // SMALL
    waiting = rows.where(size > small).select(F.col("_uid").alias("id"), size.alias("size"))
    tiny = scratch.save(rows.where(size <= small).select("_uid", size.alias("_len")))
    n_tiny = tiny.count()
    bundles = None
    if n_tiny:
        per = f"({2 * small} div _len)"
        bundle = F.expr(f"-1 - ((_n div {per}) * {2 * small + 1} + _len)")
        bundles = scratch.save(
            number_rows(tiny, n_tiny, ["_len"], ["_uid"], "_n").select("_uid", "_len", bundle.alias("_bundle"))
        )
        waiting = waiting.unionByName(bundles.groupBy(F.col("_bundle").alias("id")).agg(F.sum("_len").alias("size")))

    # More than half a sequence: nothing but its own sequence can take it.
    opens = F.col("size") * 2 > capacity
    left = F.when(opens, F.lit(capacity) - F.col("size")).otherwise(F.col("size"))
    state = scratch.save(
        waiting.select(F.when(opens, 0).otherwise(1).alias("kind"), "id", left.alias("size")), "kind"
    )
    placed = [state.where("kind = 0").select("id", F.col("id").alias("seq"))]
    current = state
    while True:
        # Parts of a gap come together again.
        gaps = current.where("kind = 0").groupBy("id").agg(F.sum("size").alias("size"))
        docs = current.where("kind = 1").select("id", "size")
        gaps, docs = (t.withColumn("kind", F.lit(k)).select("kind", "id", "size") for k, t in enumerate((gaps, docs)))
        counted = gaps.unionByName(docs).groupBy("kind", "size").count().collect()
        waits = {r["size"]: r["count"] for r in counted if r["kind"] == 1}
        if not waits:
            break
        least, most = min(waits), max(waits)
        room = {r["size"]: r["count"] for r in counted if r["kind"] == 0 and r["size"] >= least}
        stuck = {s: n for s, n in waits.items() if s > max(room, default=0)}
        parts = F.greatest(F.lit(1), F.expr(f"size div {most}")).cast("int")
        slots = gaps.where(f"size >= {least}").select(
            "kind", "id", F.posexplode(F.array_repeat("size", parts)).alias("part", "whole"), parts.alias("parts")
        )
        share = F.expr("whole div parts + IF(part < whole % parts, 1, 0)").cast("long")
        live = slots.select("kind", "id", share.alias("size")).unionByName(docs)
        n = sum(waits.values()) + sum(c * max(1, s // most) for s, c in room.items())
        done = _round(scratch, live, n, sequences_needed(stuck, capacity), capacity)
        placed.append(done.where("kind = 2").select("id", "seq"))
        if current is not state:
            for part in ("kind=0", "kind=1"):
                scratch.drop(current, part)
        current = done

    found = reduce(DataFrame.unionByName, placed)
    if bundles is not None:
        many = bundles.join(found.where("id < 0"), F.col("_bundle") == F.col("id"))
        found = found.where("id >= 0").unionByName(many.select(F.col("_uid").alias("id"), "seq"))
    # A sequence holds at most `capacity` rows.
    inside = Window.partitionBy("seq").orderBy("_uid").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(size).over(inside), F.lit(0)).cast("long")
    joined = rows.join(found, rows["_uid"] == found["id"])
    return joined.select(*(rows[c] for c in kept), F.col("seq").alias("sequence_id"), offset.alias("offset"))


def pack_documents(
    docs: DataFrame,
    capacity: int = 2048,
    tokenizer: str = "word_bpe_49k.json",
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """`token_pieces` of `docs` with their places by `best_fit_sequences`; a row per piece.

    Null texts count as empty; rows that repeat are packed each; null ids are allowed. Other columns are ignored. An
    empty table gives no rows.
    """
    pieces = token_pieces(docs, capacity, tokenizer, end_id, id_col, text_col, with_ids)
    return best_fit_sequences(pieces, capacity)
