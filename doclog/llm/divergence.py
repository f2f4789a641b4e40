"""How far the sources of a language differ in their words, from bitmaps of the terms that have each count."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doclog.functions.scale import broadcast_if_small

from .common import Scratch

#: Documents of a language that hold a term at least; ranks of the terms of a source; the unit of the shares.
MIN_DOCS, TOP, UNIT = 3, 200, 1_000_000_000
#: Different terms that a task counts before it hands them on, and bytes of a text that it splits at a time.
COUNTED, STRETCH = 1 << 18, 1 << 20
#: Sources of a block: a task compares two blocks over one chunk of the terms.
SOURCES = 32
#: Bitmap cells that are worked on at a time.
CELLS = 1 << 20

#: Letters in lower case and every byte of longer characters stay, all else separates terms.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a text in UTF-8, a stretch at a time."""
    at = 0
    while at < len(text):
        end = at + STRETCH
        part = text[at:end].translate(_TABLE)
        if end < len(text):
            cut = part.rfind(b" ")
            while cut < 0 and end < len(text):  # a term longer than a stretch
                part += text[end : end + STRETCH].translate(_TABLE)
                end += STRETCH
                cut = part.rfind(b" ")
            if cut >= 0:
                part = part[: cut + 1]
        at += len(part)
        yield part.split()


_COUNTS = "lang string, source string, term string, n long, docs long"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term, and a row with an empty term for each group."""
    found: dict[tuple, tuple[Counter, Counter]] = {}
    entries = 0

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in found.items():
            terms = [b"", *n]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(terms), pa.string()),
                    pa.array([source] * len(terms), pa.string()),
                    pa.array(terms, pa.binary()).cast(pa.string()),
                    pa.array([0, *n.values()], pa.int64()),
                    pa.array([0, *(docs[t] for t in n)], pa.int64()),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )

    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts):
            n, docs = found.setdefault((lang, source), (Counter(), Counter()))
            before = len(n)
            seen: set[bytes] = set()
            for part in terms_of(text.as_py()):
                n.update(part)
                seen.update(part)
            docs.update(seen)
            entries += len(n) - before
            if entries > COUNTED:
                yield from out()
                found, entries = {}, 0
    yield from out()


def term_counts(docs: DataFrame, text_col: str, lang_col: str, source_col: str, min_docs: int) -> DataFrame:
    """lang, source, term, n of the terms that `min_docs` documents of the language hold, with n over the language
    (lang_n) and whether the row is the term's first of its language; and a row with an empty term for each group.

    One shuffle by (lang, term), of rows that tasks have added up: a term has a row per task and source at most.
    """

    def plain(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    rows = docs.select(plain(lang_col).alias("lang"), plain(source_col).alias("source"), plain(text_col).alias("text"))
    counted = rows.mapInArrow(_count, _COUNTS).repartition("lang", "term")
    added = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    return (
        added.withColumns(
            {
                "lang_n": F.sum("n").over(term),
                "lang_docs": F.sum("docs").over(term),
                "first": F.row_number().over(term.orderBy("source")) == 1,
            }
        )
        .where((F.col("lang_docs") >= min_docs) | (F.col("term") == ""))
        .drop("lang_docs")
    )


def share(count: Column | str, total: Column | str, kept: Column | str) -> Column:
    """1 + floor(UNIT * (count + 1) / (total + kept))."""
    return F.expr(f"1 + (cast({UNIT} as decimal(10,0)) * cast({count} + 1 as decimal(20,0))) div ({total} + {kept})")


_FIGURES = "lang string, chunk long, size int, source string, total long, kept long, n long, bits binary"


def _bitmaps(rows: pa.Table) -> pa.Table:
    """A row for each count that a source has in this chunk: the bitmap of its terms."""
    source = rows.column("source").combine_chunks().dictionary_encode()
    code = source.indices.to_numpy().astype(np.int64)
    n, at = rows.column("n").to_numpy(), rows.column("at").to_numpy()
    size = rows.column("size")[0].as_py()
    levels, place = np.unique(np.stack([code, n]), axis=1, return_inverse=True)
    bits = np.zeros((levels.shape[1], -(-size // 64) * 64), bool)
    bits[place.reshape(-1), at] = True
    packed = np.packbits(bits, axis=1, bitorder="little")
    names, count = source.dictionary.to_pylist(), levels.shape[1]
    one = {c: rows.column(c)[0].as_py() for c in ("lang", "chunk", "size")}
    return pa.table(
        {
            "lang": pa.array([one["lang"]] * count, pa.string()),
            "chunk": pa.array([one["chunk"]] * count, pa.int64()),
            "size": pa.array([size] * count, pa.int32()),
            "source": pa.array([names[c] for c in levels[0]], pa.string()),
            "total": pa.nulls(count, pa.int64()),
            "kept": pa.nulls(count, pa.int64()),
            "n": pa.array(levels[1], pa.int64()),
            "bits": pa.array([p.tobytes() for p in packed], pa.binary()),
        }
    )


def joint_values(size: int, left: tuple, right: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Sum over `size` terms of floor((p - q)^2 / q) between a source and others, and the other way round, as high and
    low halves of 32 bits: two arrays of shape (2, other sources).

    A side holds bitmaps, the shares p of their counts, the share of a count of zero, and for the right side where each
    source's bitmaps begin. Bitmaps ANDed and counted give the terms with each pair of counts; terms with a count of
    zero on one side or both are what is left.
    """
    bits, p, zero = left
    other, q, zeros, starts = right
    owner = np.repeat(np.arange(len(zeros)), np.diff(starts))
    both = np.zeros((len(bits), len(other)), np.int64)
    words = bits.shape[1]
    step = max(1, CELLS // max(1, len(other) * words))
    for at in range(0, len(bits), step):
        both[at : at + step] = np.bitwise_count(bits[at : at + step, None, :] & other[None, :, :]).sum(axis=2)
    ones, others = np.bitwise_count(bits).sum(axis=1, dtype=np.int64), np.bitwise_count(other).sum(axis=1, dtype=np.int64)
    bounds = starts[:-1]
    # Columns of zero for sources without any bitmap here.
    by_source = np.add.reduceat(np.pad(both, ((0, 0), (0, 1))), np.append(bounds, len(owner)), axis=1)[:, :-1]
    by_source[:, np.diff(starts) == 0] = 0
    left_only = ones[:, None] - by_source
    right_only = others - both.sum(axis=0)
    held = np.bincount(owner, weights=others, minlength=len(zeros)).astype(np.int64)
    neither = size - ones.sum() - held + by_source.sum(axis=0)

    def add(of, out: np.ndarray) -> None:
        """`of(p, q)` at each cell, times its terms."""
        for cells, value, where in (
            (both, of(p[:, None], q[None, :]), owner),
            (left_only, of(p[:, None], zeros[None, :]), np.arange(len(zeros))),
            (right_only[None, :], of(np.array([[zero]]), q[None, :]), owner),
            (neither[None, :], of(np.array([[zero]]), zeros[None, :]), np.arange(len(zeros))),
        ):
            for k, half in enumerate((value >> 32, value & 0xFFFFFFFF)):
                np.add.at(out[k], where, (cells * half).sum(axis=0))

    there, back = np.zeros((2, len(zeros)), np.int64), np.zeros((2, len(zeros)), np.int64)
    add(lambda a, b: (a - b) ** 2 // b, there)
    add(lambda a, b: (a - b) ** 2 // a, back)
    return there, back


def _shares(n: np.ndarray, total: int, kept: int) -> np.ndarray:
    return np.array([1 + UNIT * (int(c) + 1) // max(1, total + kept) for c in n], np.int64)


def _compare(rows: pa.Table) -> pa.Table:
    """Sums over one chunk for each ordered pair of a source of one block and one of another, or of one block."""
    first, second = rows.column("one")[0].as_py(), rows.column("two")[0].as_py()
    lang, size = rows.column("lang")[0].as_py(), rows.column("size")[0].as_py()
    rows = rows.select(["block", "source", "total", "kept", "n", "bits"]).sort_by([("block", "ascending"), ("source", "ascending")])
    figures: dict[tuple, tuple] = {}
    levels: dict[tuple, list] = {}
    for block, source, total, kept, n, bits in zip(*(c.to_pylist() for c in rows.columns)):
        if bits is None:
            figures[block, source] = (total, kept)
        else:
            levels.setdefault((block, source), []).append((n, np.frombuffer(bits, "<u8")))
    words = -(-size // 64)
    sides = {}
    for key, (total, kept) in figures.items():
        own = levels.get(key, [])
        bits = np.stack([b for _, b in own]) if own else np.zeros((0, words), "<u8")
        sides[key] = (bits, _shares(np.array([n for n, _ in own]), total, kept), int(_shares([0], total, kept)[0]))
    out = []
    for key in (k for k in sides if k[0] == first):
        right = [k for k in sides if k[0] == second and (first != second or k[1] > key[1])]
        if not right:
            continue
        starts = np.concatenate(([0], np.cumsum([len(sides[k][1]) for k in right]))).astype(np.int64)
        other = (
            np.concatenate([sides[k][0] for k in right]),
            np.concatenate([sides[k][1] for k in right]),
            np.array([sides[k][2] for k in right], np.int64),
            starts,
        )
        there, back = joint_values(size, sides[key], other)
        for k, name in enumerate(right):
            out.append((lang, key[1], name[1], int(there[0, k]), int(there[1, k])))
            out.append((lang, name[1], key[1], int(back[0, k]), int(back[1, k])))
    columns = list(zip(*out)) if out else [[]] * 5
    kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
    names = ("lang", "source", "item", "high", "low")
    return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, kinds)})


def _chunk_size(order: Column) -> Column:
    """Terms of a chunk, by the order of magnitude of their count: rare terms have few counts, so wide bitmaps pay."""
    return F.greatest(F.lit(64.0), F.pow(F.lit(2.0), 14 - order)).cast("int")


def _pairs(scratch: Scratch, kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (another source), value."""
    order = F.floor(F.log2(F.col("lang_n").cast("double"))).cast("int")
    terms = kept.where("term <> ''").withColumn("order", order)
    # Per language and order of magnitude: how many chunks its terms are dealt over. No more than 63 rows a language.
    dealt = (
        terms.where("first")
        .groupBy("lang", "order")
        .agg(F.count("*").alias("terms"))
        .select("lang", "order", F.ceil(F.col("terms") / _chunk_size(F.col("order"))).cast("long").alias("chunks"))
    )
    blocks = groups.groupBy("lang").agg(F.ceil(F.count("*") / SOURCES).cast("long").alias("blocks"))
    known = broadcast_if_small(dealt.join(blocks, "lang"))
    hashed = F.pmod(F.xxhash64("term"), F.col("chunks"))
    block = F.pmod(F.xxhash64("source"), F.col("blocks"))
    placed = terms.join(known, ["lang", "order"]).select(
        "lang", "source", "term", "n", "blocks", ((F.col("order").cast("long") * (1 << 40)) + hashed).alias("chunk"), block.alias("block")
    )
    # Places in the bitmaps. A chunk has about its size of terms, so its place of the last one tells how wide it is.
    inside = Window.partitionBy("lang", "chunk")
    numbered = placed.withColumn("at", (F.dense_rank().over(inside.orderBy("term")) - 1).cast("int")).withColumn(
        "size", (F.max("at").over(inside) + 1).cast("int")
    )
    levels = scratch.save(
        numbered.groupBy("lang", "chunk", "block", "blocks").applyInArrow(
            _with_block(_bitmaps), f"{_FIGURES}, block long, blocks long"
        )
    )
    chunks = levels.select("lang", "chunk", "size").distinct()
    # Every source takes part in every chunk of its language, with or without terms there; one without any chunk in one.
    own = groups.join(blocks, "lang").withColumn("block", block)
    heads = own.join(chunks, "lang", "left").select(
        "lang",
        F.coalesce("chunk", F.lit(-1).cast("long")).alias("chunk"),
        F.coalesce("size", F.lit(0)).alias("size"),
        "source",
        "total",
        "kept",
        F.lit(None).cast("long").alias("n"),
        F.lit(None).cast("binary").alias("bits"),
        "block",
        "blocks",
    )
    both = levels.unionByName(heads).withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt_out = both.select(
        *(c for c in both.columns if c not in ("with", "blocks")),
        F.least("block", "with").alias("one"),
        F.greatest("block", "with").alias("two"),
    )
    parts = dealt_out.groupBy("lang", "chunk", "one", "two").applyInArrow(
        _compare, "lang string, source string, item string, high long, low long"
    )
    value = F.expr(
        "try_cast(sum(cast(high as decimal(38,0))) * cast(4294967296 as decimal(10,0)) + sum(cast(low as decimal(38,0)))"
        " as bigint)"
    )
    return parts.groupBy("lang", "source", "item").agg(value.alias("value"))


def _with_block(make):
    def run(rows: pa.Table) -> pa.Table:
        out = make(rows)
        for name in ("block", "blocks"):
            out = out.append_column(name, pa.array([rows.column(name)[0].as_py()] * out.num_rows, pa.int64()))
        return out

    return run


def source_divergence(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_docs: int = MIN_DOCS,
    top: int = TOP,
) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source is from the others of its language (part `pair`), and
    which terms it uses more than the language does (part `term`, the first `top`).

    Terms are runs of letters and of characters beyond ASCII, A-Z in lower case; a language keeps those that `min_docs` of
    its documents hold. A source's share of a term is p = 1 + floor(UNIT * (count + 1) / (occurrences + kept terms)), and the
    divergence of p from q is floor((p - q)^2 / q). A pair's value adds it over all kept terms; the items of `pair` are
    ranked all, by value and then name.

    Shares depend on the count alone. For each source and count there is a bitmap of the terms that have it; two bitmaps
    ANDed tell how many terms have this pair of counts, each of which brings the same divergence. Terms that one
    side or both do not have are counted by complement. Terms are dealt over chunks by their order of magnitude, sources
    over blocks, and a task compares two blocks over a chunk, so no task grows with the corpus.

    Texts are counted where they are read; only sums move. Null texts, languages and sources count as empty strings; a
    group without terms has its rows with the others' counts. A language with one source has no pairs. Rows that repeat
    count each. Other columns are ignored; an empty table gives no rows. A sum that no long holds is null.
    """
    scratch = Scratch(docs.sparkSession, "divergence")
    kept = scratch.save(term_counts(docs, text_col, lang_col, source_col, min_docs))
    totals = kept.groupBy("lang").agg(
        F.sum(F.when(F.col("first"), F.col("lang_n")).otherwise(0)).alias("lang_total"),
        F.count_if(F.col("first") & (F.col("term") != "")).alias("kept"),
    )
    groups = scratch.save(
        kept.groupBy("lang", "source").agg(F.sum("n").alias("total")).join(broadcast_if_small(totals), "lang")
    )
    pairs = _pairs(scratch, kept, groups).select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    shares = kept.where("n > 0 AND term <> ''").join(broadcast_if_small(groups), ["lang", "source"])
    shares = shares.withColumns({"p": share("n", "total", "kept"), "q": share("lang_n", "lang_total", "kept")}).where("p > q")
    words = shares.select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value")
    )
    # Each kind is ranked by itself: only the best `top` of a task move for the terms.
    by = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = words.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(by)).unionByName(ranked)
