"""Near-duplicate documents: Jaccard join on word n-grams by MinHash banding, verified on the full n-gram sets."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .components import components

N, THRESHOLD = 5, 0.8
#: Share of pairs at the threshold that meet in a band, and hashes that may be spent on it.
RECALL, HASHES = 0.9995, 128
#: Share of pairs at the threshold that the estimate from their signatures may lose before the verification.
LOST_BY_ESTIMATE = 1e-6
#: Classes that a block of a band bucket holds on average at most.
BUCKET_CLASSES = 1024
#: Documents, and n-grams, that a block of a group holds on average at most.
BLOCK_DOCS, BLOCK_GRAMS = 384, 1 << 20

#: Bytes of a text whose words are hashed together.
STRETCH = 1 << 20

_U = np.uint64
_P, _Q = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)
_P_INVERSE = _U(pow(int(_P), -1, 1 << 64))
_RANDOM = np.random.default_rng(20)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=_U) * _U(2) + _U(1)
_FACTOR = _RANDOM.integers(1, 1 << 63, HASHES, dtype=_U) * _U(2) + _U(1)
_SHIFT = _RANDOM.integers(1, 1 << 63, HASHES, dtype=_U)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def choose_bands(threshold: float, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """(bands, rows): the longest bands with which a pair at `threshold` shares one with probability `recall`."""
    best = None
    for rows in range(1, hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows > hashes:
            break
        best = bands, rows
    if best is None:
        raise ValueError("too few hashes for this recall")
    return best


def least_agreement(threshold: float, hashes: int, lost: float = LOST_BY_ESTIMATE) -> int:
    """The most places, of `hashes`, in which a pair at `threshold` agrees but for a share `lost` of such pairs.

    Places agree independently with the probability of the similarity, so their number is binomial.
    """
    below = 0.0
    for agree in range(hashes + 1):
        below += math.comb(hashes, agree) * threshold**agree * (1 - threshold) ** (hashes - agree)
        if below > lost:
            return agree
    return hashes


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


class _Powers:
    """Powers of the byte position's factor and of its inverse, as many as the longest text so far needs."""

    up = down = np.ones(1, _U)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 2 * len(cls.up), 1 << 14)
            ones = np.full(size, _P)
            ones[0] = _U(1)
            cls.up = np.cumprod(ones)
            ones[1:] = _P_INVERSE
            cls.down = np.cumprod(ones)
        return cls.up[:n], cls.down[:n]


def _word_hashes(data: np.ndarray) -> np.ndarray:
    space = _SPACE[data]
    edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.zeros(0, _U)
    up, down = _Powers.of(len(data))
    running = np.concatenate((np.zeros(1, _U), np.cumsum(_BYTE[data] * up)))
    return _mixed((running[ends] - running[starts]) * down[starts] + (ends - starts).astype(_U))


def shingles(text: str, n: int = N) -> np.ndarray:
    """The set of 64-bit hashes of `n` successive words, sorted; of all words where there are fewer."""
    data = np.frombuffer(text.encode(), np.uint8)
    hashes, at = [], 0
    while at < len(data):  # a stretch at a time, cut at white space
        end = at + STRETCH
        while end < len(data) and not (cut := np.flatnonzero(_SPACE[data[end : end + STRETCH]])).size:
            end += STRETCH
        end = end + int(cut[0]) if end < len(data) else len(data)
        hashes.append(_word_hashes(data[at:end]))
        at = end
    words = np.concatenate(hashes) if hashes else np.zeros(0, _U)
    if not len(words):
        return words
    width = min(n, len(words))
    grams = np.zeros(len(words) - width + 1, _U)
    for k in range(width):
        grams = grams * _Q + words[k : len(words) - width + 1 + k]
    return np.unique(_mixed(grams))


def signature(grams: np.ndarray, hashes: int) -> np.ndarray:
    out = np.full(hashes, np.iinfo(_U).max, _U)
    for at in range(0, len(grams), 1 << 12):
        part = grams[at : at + (1 << 12)]
        for k in range(hashes):
            out[k] = min(out[k], (part * _FACTOR[k] + _SHIFT[k]).min())
    return (out >> _U(32)).astype(np.uint32)


def _band_hashes(signature_: np.ndarray, bands: int, rows: int) -> np.ndarray:
    h = _mixed(np.arange(1, bands + 1, dtype=_U) * _P)
    for k in range(rows):
        h = _mixed(h * _Q + signature_[k : bands * rows : rows].astype(_U))
    return h.view(np.int64)


_SIGNED = "digest binary, grams int, signature array<int>, bands array<long>"


def _signed(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """Of each (_id, _text): a hash and digest of its n-gram set, the set's size, its signature and band hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                made = []
                for text in batch.column("_text").to_pylist():
                    grams = shingles(text, n)
                    if not len(grams):
                        made.append((None, 0, [], []))
                        continue
                    s = signature(grams, bands * rows)
                    digest = hashlib.blake2b(grams.tobytes(), digest_size=16).digest()
                    made.append((digest, len(grams), s.view(np.int32), _band_hashes(s, bands, rows)))
                digest, grams, sign, band = zip(*made)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_id"),
                        batch.column("_same"),
                        pa.array(digest, pa.binary()),
                        pa.array(grams, pa.int32()),
                        pa.array(sign, pa.list_(pa.int32())),
                        pa.array(band, pa.list_(pa.int64())),
                    ],
                    names=["_id", "_same", "digest", "grams", "signature", "bands"],
                )

    kind = docs.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, _same long, {_SIGNED}"
    return docs.select("_id", "_same", "_text").mapInArrow(run, schema)


def _intersections(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the common parts of `sets[left]` and `sets[right]`, in slices of n-grams that bound the memory."""
    grams = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]
    new = np.concatenate(([True], grams[1:] != grams[:-1]))
    column = np.cumsum(new) - 1
    shared = np.bincount(column) > 1
    keep = shared[column]
    column, owner = (np.cumsum(shared) - 1)[column[keep]], owner[keep]
    out = np.zeros((len(left), len(right)), np.float32)
    width = min(max(256, (1 << 22) // len(sets)), int(shared.sum()) + 1)
    cuts = np.searchsorted(column, np.arange(0, (column[-1] if len(column) else 0) + width + 1, width))
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if a < b:
            there = np.zeros((len(sets), width), np.float32)
            there[owner[a:b], column[a:b] - k * width] = 1
            out += there[left] @ there[right].T
    return out.astype(np.int64)


def _roots(linked: np.ndarray) -> np.ndarray:
    """The first place that can be reached, of each place of a symmetric matrix of links."""
    root, seen = np.arange(len(linked)), np.zeros(len(linked), bool)
    for k in range(len(linked)):
        if not seen[k]:
            front = np.array([k])
            seen[k] = True
            while len(front):
                root[front] = k
                front = np.flatnonzero(linked[front].any(axis=0) & ~seen)
                seen[front] = True
    return root


def _cell(rows: list[tuple], numerator: int, denominator: int) -> tuple[list[int], list[int], list[int]]:
    """Links and the smallest class that can be reached, of each class of a block or of two blocks against each other."""
    known = {}
    for row in rows:
        known.setdefault(row[0], row)
    rows = [known[c] for c in sorted(known)]
    ids = np.array([r[0] for r in rows])
    weight = np.array([r[1] for r in rows], np.int64)
    block = np.array([r[2] for r in rows])
    sets = [r[3] for r in rows]
    sizes = np.array([len(s) for s in sets], np.int64)
    one_block = block.min() == block.max() and rows[0][4]
    left = np.arange(len(rows)) if one_block else np.flatnonzero(block == block.min())
    right = left if one_block else np.flatnonzero(block != block.min())
    links, root = np.zeros(len(rows), np.int64), np.arange(len(rows))
    if len(left) and len(right) and len(rows) > 1:
        common = _intersections(sets, left, right)
        either = sizes[left][:, None] + sizes[right][None, :] - common
        near = common * denominator >= numerator * either
        if one_block:
            np.fill_diagonal(near, False)
        links[left] += near @ weight[right]
        if not one_block:
            links[right] += weight[left] @ near
        linked = np.zeros((len(rows), len(rows)), bool)
        linked[np.ix_(left, right)] = near
        linked |= linked.T
        root = _roots(linked)
    return ids.tolist(), links.tolist(), ids[root].tolist()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, threshold: float = THRESHOLD
) -> DataFrame:
    """A row per row of `docs`: `id_col`, class_id, n_links, rep_id, n_copies, text_hash, kept.

    Two documents are linked when the Jaccard similarity of their sets of `n` successive words is `threshold` or more.
    class_id is the smallest id that can be reached over links; n_links counts the documents linked to this one; rep_id
    is the smallest id with the same n-gram set, of which there are n_copies. text_hash (64 bits) tells rows of one id
    apart; kept marks the document of class_id, or all that are linked to nothing.

    1. Each text gives its set, a MinHash signature and band hashes; `choose_bands` takes bands and rows for the recall.
    2. Documents of the same set become one class, with partial aggregation, so copies cost nothing from here on.
    3. Band hashes are shuffled with the signatures. A large bucket is cut in blocks, and each pair of blocks is a task
       of bounded size. Every pair of a bucket is compared; those whose signatures agree enough make groups, of which
       only a spanning forest leaves the task.
    4. The sets of the classes that have a partner are built again and shuffled once, by group. A large group is cut in
       blocks, and each pair of blocks is a task of bounded size. Every pair of a group is verified on the full sets,
       but only link counts and a spanning forest leave the task.

    A set is compared by 64-bit hashes of its n-grams. A text of fewer than `n` words is one n-gram of all its words;
    null, empty and blank texts have none, are linked to nothing and are classes of their own. Rows that repeat are
    copies; rows of one id and different texts are told apart. Null ids count as larger than all others. Other columns
    are ignored.
    """
    scratch = Scratch(docs.sparkSession, "ngrams")
    bands, rows = choose_bands(threshold)
    agree = least_agreement(threshold, bands * rows)
    texts = docs.select(
        F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")
    ).withColumn("_same", F.xxhash64("_text"))
    signed = scratch.save(_signed(texts, n, bands, rows))
    first = F.struct(F.col("_id").isNull().alias("none"), "_id", "_same")
    classes = scratch.save(
        signed.where("grams > 0")
        .groupBy("digest")
        .agg(
            F.min(first).alias("first"),
            F.count("*").alias("copies"),
            F.max("grams").alias("grams"),
            F.max(F.struct("signature", "bands")).alias("s"),
        )
        .select(
            F.monotonically_increasing_id().alias("cls"),
            "digest",
            "copies",
            "grams",
            F.col("first._id").alias("rep"),
            F.col("first._same").alias("rep_same"),
            F.col("s.signature").alias("signature"),
            F.col("s.bands").alias("bands"),
        )
    )

    banded = classes.select("cls", F.explode("bands").alias("band"))
    groups = components(scratch, _likely(banded, classes.select("cls", "signature"), agree))

    members = scratch.save(
        classes.select("cls", "copies", "grams", "rep", "rep_same").join(
            groups.select(F.col("id").alias("cls"), F.col("root").alias("grp")), "cls"
        )
    )
    sizes = members.groupBy("grp").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_DOCS), F.ceil(F.sum("grams") / BLOCK_GRAMS)).cast("int").alias("blocks")
    )
    dealt = members.join(sizes, "grp").withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    sets = _verified_input(texts, dealt, n)
    verified = scratch.save(_verified(sets, threshold))
    links = verified.groupBy("cls").agg(F.sum("links").alias("links"))
    roots = components(scratch, verified.select(F.col("root").alias("a"), F.col("cls").alias("b")))

    known = classes.select("cls", "digest", "copies", "rep", "rep_same").join(links, "cls", "left").join(
        roots.select(F.col("id").alias("cls"), "root"), "cls", "left"
    ).withColumn("root", F.coalesce("root", "cls"))
    known = scratch.save(known)
    least = known.groupBy("root").agg(
        F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "rep_same")).alias("least")
    )
    least = least.select("root", F.col("least.rep").alias("class_id"), F.col("least.rep_same").alias("class_same"))
    labelled = known.join(least, "root").select("digest", "copies", "rep", "class_id", "class_same", "links")
    out = signed.select("_id", "_same", "digest").join(labelled, "digest", "left")
    none = F.col("digest").isNull()
    return out.select(
        F.col("_id").alias(id_col),
        F.when(none, F.col("_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce(F.coalesce("links", F.lit(0)) + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
        F.when(none, F.col("_id")).otherwise(F.col("rep")).alias("rep_id"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
        F.col("_same").alias("text_hash"),
        (none | F.col("_id").eqNullSafe(F.col("class_id")) & (F.col("_same") == F.col("class_same"))).alias("kept"),
    )


def _alike(cls: np.ndarray, block: np.ndarray, signs: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Edges (a, b) that span the classes, of a block or of two blocks against each other, whose signatures agree in
    `least` places."""
    if len(cls) == 2:
        return (cls[:1], cls[1:]) if (signs[0] == signs[1]).sum() >= least else (cls[:0], cls[:0])
    left, right = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
    agree = np.zeros((len(left), len(right)), np.int16)
    for x, y in zip(signs[left].T, signs[right].T):
        agree += x[:, None] == y[None, :]
    linked = np.zeros((len(cls), len(cls)), bool)
    linked[np.ix_(left, right)] = agree >= least
    linked |= linked.T
    root = _roots(linked)
    to = np.flatnonzero(root != np.arange(len(root)))
    return cls[root[to]], cls[to]


def _likely(banded: DataFrame, signs: DataFrame, least: float) -> DataFrame:
    """(a, b): edges that span the classes of which each pair shares a bucket and agrees in `least` places at least."""
    sizes = banded.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BUCKET_CLASSES).cast("int")
    met = banded.join(sizes.select("band", blocks.alias("blocks")), "band")
    dealt = met.withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    cells = dealt.join(signs, "cls").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = cells.select(
        "band",
        F.least("block", "other").alias("x"),
        F.greatest("block", "other").alias("y"),
        "cls",
        "block",
        "signature",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # rows of the last cell, which may go on in the next batch

        def edges(found: list) -> pa.RecordBatch:
            a, b = (np.concatenate([np.zeros(0, np.int64), *side]) for side in (zip(*found) if found else ((), ())))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            part = [batch.column(c).to_numpy() for c in ("band", "x", "y", "cls", "block")]
            part.append(batch.column("signature").flatten().to_numpy().reshape(batch.num_rows, -1))
            if rest is not None:
                part = [np.concatenate(both) for both in zip(rest, part)]
            key = np.stack(part[:3])
            starts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist()]
            yield edges([_alike(*(c[i:j] for c in part[3:]), least) for i, j in zip(starts, starts[1:]) if j - i > 1])
            rest = [c[starts[-1] :].copy() for c in part]
        if rest is not None and len(rest[0]) > 1:
            yield edges([_alike(*rest[3:], least)])

    sorted_cells = cells.repartition("band", "x", "y").sortWithinPartitions("band", "x", "y")
    return sorted_cells.mapInArrow(run, "a long, b long").distinct()


def _verified_input(texts: DataFrame, dealt: DataFrame, n: int) -> DataFrame:
    """(grp, x, y, cls, copies, block, grams): the set of each class, once for every pair of blocks it belongs to."""
    at = (texts["_id"].eqNullSafe(dealt["rep"])) & (texts["_same"] == dealt["rep_same"])
    # A sort-merge join at every size, so that the disk it needs follows the input.
    found = texts.join(dealt.hint("merge"), at).select("grp", "cls", "copies", "block", "blocks", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                grams = [shingles(t, n).view(np.int64) for t in batch.column("_text").to_pylist()]
                columns = [batch.column(c) for c in ("grp", "cls", "copies", "block", "blocks")]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(grams, pa.list_(pa.int64()))],
                    names=["grp", "cls", "copies", "block", "blocks", "grams"],
                )

    made = found.mapInArrow(run, "grp long, cls long, copies long, block int, blocks int, grams array<long>")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return made.withColumn("other", other).select(
        "grp",
        F.least("block", "other").alias("x"),
        F.greatest("block", "other").alias("y"),
        "cls",
        "copies",
        "block",
        "grams",
    )


def _verified(sets: DataFrame, threshold: float) -> DataFrame:
    """(cls, links, root) of every pair of blocks; a task holds one such pair at a time."""
    ratio = Fraction(str(threshold)).as_integer_ratio()  # as it is written: 0.7 is 7 of 10

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, out = None, [], ([], [], [])

        def close():
            for into, values in zip(out, _cell(rows, *ratio)):
                into.extend(values)

        def made():
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["cls", "links", "root"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("grp", "x", "y", "cls", "copies", "block")]
            grams = batch.column("grams")
            flat, offsets = grams.flatten().to_numpy(), np.cumsum([0, *grams.value_lengths().to_pylist()])
            for k, (grp, x, y, cls, copies, block) in enumerate(zip(*columns)):
                if (grp, x, y) != key:
                    if rows:
                        close()
                    key, rows = (grp, x, y), []
                rows.append((cls, copies, block, flat[offsets[k] : offsets[k + 1]].copy(), x == y))
            if len(out[0]) > 1 << 14:
                yield made()
                out = ([], [], [])
        if rows:
            close()
        yield made()

    return (
        sets.repartition("grp", "x", "y")
        .sortWithinPartitions("grp", "x", "y")
        .mapInArrow(run, "cls long, links long, root long")
    )
