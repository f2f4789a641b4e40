"""Centroid clustering of integer vectors over dictionaries of distinct subvectors."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch

#: Components are multiplied by SCALE and cut to integers below LARGEST, so a squared distance of 64 of them is a long.
SCALE, DIMS, LARGEST = 64, 64, 1 << 27
CLUSTERS, ROUNDS = 16, 3
#: Components of a block, the widest first whose dictionary has at most MAX_ENTRIES entries for certain.
WIDTHS, MAX_ENTRIES = (8, 4, 2, 1), 1 << 17
#: Vectors that share a dictionary of their own when the values are too many for one of all.
SLICE = 4096

_DECIMAL = "decimal(38,0)"


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """`_id` and `_v`, the integers floor(scale * x), of vectors with `dims` finite components."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    message = f"a component times {scale} does not lie between -{LARGEST} and {LARGEST}"

    def floor(v: Column) -> Column:
        return F.when(F.abs(v * scale) < LARGEST, F.floor(v * scale)).otherwise(F.raise_error(message).cast("long"))

    kept = vectors.where(F.col(vector_col).isNotNull() & (F.size(vector_col) == dims)).where(finite)
    return kept.select(F.col(id_col).alias("_id"), F.transform(x, floor).alias("_v"))


def combinations(values: list[np.ndarray], width: int) -> list[int]:
    """How many subvectors of each block of `width` components there can be at most."""
    return [math.prod(map(len, values[d : d + width])) for d in range(0, len(values), width)]


class Dictionary:
    """Distinct subvectors of each block of components, and which number stands for each.

    `values` holds the distinct integers of every component. A subvector's raw number is its place among all
    combinations of its components' values, counted over all blocks; `used` lists the raw numbers that occur.
    """

    def __init__(self, values: list[np.ndarray], width: int) -> None:
        self.values, self.width = values, width
        self.blocks = len(values) // width
        self.starts = np.cumsum([0, *combinations(values, width)])

    def raw(self, v: np.ndarray) -> np.ndarray:
        """Raw numbers of the blocks of each row of `v`."""
        out = np.empty((len(v), self.blocks), np.int32)
        for b in range(self.blocks):
            n = np.zeros(len(v), np.int64)
            for d in range(b * self.width, (b + 1) * self.width):
                n = n * len(self.values[d]) + np.searchsorted(self.values[d], v[:, d])
            out[:, b] = n + self.starts[b]
        return out

    def keep(self, used: np.ndarray) -> None:
        self.used = np.sort(used)
        self.dense = np.zeros(self.starts[-1], np.int32)
        self.dense[self.used] = np.arange(len(self.used))

    def subvectors(self) -> tuple[np.ndarray, np.ndarray]:
        """(block, components) of each entry in use."""
        block = np.searchsorted(self.starts, self.used, side="right") - 1
        rest = self.used - self.starts[block]
        sub = np.empty((len(self.used), self.width), np.int64)
        for b in range(self.blocks):
            here = block == b
            n = rest[here]
            for k in range(self.width - 1, -1, -1):
                of = self.values[b * self.width + k]
                sub[here, k] = of[n % len(of)]
                n = n // len(of)
        return block, sub


def partial_distances(block: np.ndarray, sub: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distance of each entry to its block of each centroid."""
    width = sub.shape[1]
    parts = centroids.reshape(len(centroids), -1, width)
    out = np.zeros((len(sub), len(centroids)), np.int64)
    for k in range(width):
        out += (sub[:, k, None] - parts[:, block, k].T) ** 2
    return out


def _local(v: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, block, subvectors) of a dictionary of these rows alone."""
    codes = np.empty((len(v), v.shape[1] // width), np.int64)
    blocks, subs, n = [], [], 0
    for b in range(codes.shape[1]):
        sub, code = np.unique(v[:, b * width : (b + 1) * width], axis=0, return_inverse=True)
        codes[:, b] = code.reshape(-1) + n
        blocks.append(np.full(len(sub), b))
        subs.append(sub)
        n += len(sub)
    return codes, np.concatenate(blocks), np.concatenate(subs)


def _sum_by_code(codes: np.ndarray, partial: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest centroid, its squared distance) of each row; of equal ones the smallest number."""
    total = np.zeros((len(codes), partial.shape[1]), np.int64)
    for b in range(codes.shape[1]):
        total += partial[codes[:, b]]
    nearest = total.argmin(axis=1)
    return nearest, total[np.arange(len(total)), nearest]


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


class _Plan:
    """What a task needs to assign rows of the stored table: the dictionary of all, or none, and the centroids."""

    def __init__(self, dictionary: Dictionary | None, dims: int) -> None:
        self.dictionary, self.dims = dictionary, dims
        if dictionary is not None:
            self.block, self.sub = dictionary.subvectors()

    def move(self, centroids: np.ndarray) -> None:
        self.centroids = centroids
        if self.dictionary is not None:
            self.partial = partial_distances(self.block, self.sub, centroids)

    def slices(self, batches: Iterator[pa.RecordBatch]):
        """(ids, codes, block, subvectors, nearest, distance) of some rows at a time."""
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                if self.dictionary is not None:
                    raw = np.frombuffer(b"".join(batch.column("_v").to_pylist()), "<i4")
                    codes = self.dictionary.dense[raw.reshape(batch.num_rows, -1)]
                    block, sub, partial = self.block, self.sub, self.partial
                else:
                    codes, block, sub = _local(_matrix(batch.column("_v"), self.dims), 1)
                    partial = partial_distances(block, sub, self.centroids)
                yield batch.column("_id"), codes, block, sub, *_sum_by_code(codes, partial)

    def sums(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per centroid and component the sum over its vectors, from how often each centroid has each code."""
        k = len(self.centroids)
        total, n = np.zeros((k, self.dims), np.int64), np.zeros(k, np.int64)
        width = 1 if self.dictionary is None else self.dictionary.width
        for _, codes, block, sub, nearest, _ in self.slices(batches):
            n += np.bincount(nearest, minlength=k)
            for c in np.unique(nearest):
                often = np.bincount(codes[nearest == c].reshape(-1), minlength=len(sub))
                for j in range(width):
                    np.add.at(total[c], block * width + j, often * sub[:, j])
        rows = [(c, d, int(n[c]), int(total[c, d])) for c in np.flatnonzero(n) for d in range(self.dims)]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32())]
                + [pa.array([r[i] for r in rows], pa.int64()) for i in (2, 3)],
                names=["cluster", "dim", "n", "total"],
            )

    def nearest(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, _, _, nearest, distance in self.slices(batches):
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(nearest, pa.int32()), pa.array(distance, pa.int64())], names=["_id", "cluster", "distance"]
            )


def _dictionary(scratch: Scratch, rows: DataFrame, dims: int) -> tuple[Dictionary | None, DataFrame]:
    """(a dictionary of all subvectors with the rows as codes), or (None, rows) when it might be too large to send."""
    values = rows.select(F.posexplode("_v").alias("d", "x")).distinct().limit(MAX_ENTRIES + 1).toArrow()
    if values.num_rows > MAX_ENTRIES:
        return None, rows
    d, x = (values.column(c).to_numpy() for c in ("d", "x"))
    each = [np.sort(x[d == k]) for k in range(dims)]
    width = next(w for w in WIDTHS if dims % w == 0 and sum(combinations(each, w)) <= MAX_ENTRIES)
    found = Dictionary(each, width)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = found.raw(_matrix(batch.column("_v"), dims)) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array([r.tobytes() for r in raw], pa.binary())], names=["_id", "_v"]
            )

    def occurring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(found.starts[-1], bool)
        for batch in batches:
            seen[np.frombuffer(b"".join(batch.column("_v").to_pylist()), "<i4")] = True
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(seen), pa.int64())], names=["code"])

    schema = T.StructType([rows.schema["_id"], T.StructField("_v", T.BinaryType())])
    coded = scratch.save(rows.mapInArrow(encode, schema))
    # At most as many rows as the dictionary has entries.
    found.keep(coded.mapInArrow(occurring, "code long").distinct().toArrow().column("code").to_numpy())
    return found, coded


def cluster_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dims: int = DIMS,
    scale: int = SCALE,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """A row per vector of `dims` finite components: `id_col`, cluster, distance (squared), cluster_inertia, inertia,
    centroid_sha256.

    Components become integers floor(scale * x). Centroids start as the vectors with the smallest sha256 of `1:<id>`. In
    each round every vector goes to the nearest centroid (the smaller number of equal ones) and each centroid that has
    vectors becomes the floor of their mean; then vectors are assigned once more. All arithmetic is exact.

    Blocks of components are dictionary-encoded without loss: the distinct values of each component bound how many
    distinct subvectors a block width can give, and the widest with at most MAX_ENTRIES is taken. The vectors are stored
    as codes. A round computes the distances of the distinct subvectors to the centroids once; a vector's distance is the
    sum over its codes, and a centroid's new place the sum over how often it has each code, so a task returns one row
    per centroid and component. With more distinct values each SLICE of vectors gets a dictionary of its own, which is
    not sent; the result is the same.

    Vectors that are null, of another length, or hold nulls, NaN or infinities are left out. A null id counts as empty
    in the hash; rows that repeat are vectors of their own, and equal hashes start in the order of the vectors. With
    fewer vectors than `clusters` each starts a centroid. A component beyond LARGEST is an error; an inertia that no long holds is null. Other
    columns are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "centroids")
    rows = scratch.save(whole_vectors(vectors, id_col, vector_col, dims, scale))
    start = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("_id").cast("string"), F.lit(""))), 256)
    first = rows.select(start.alias("at"), "_v").orderBy("at", "_v").limit(clusters).collect()
    kind = vectors.schema[id_col].dataType
    if not first:
        empty = T.StructType([T.StructField(id_col, kind), T.StructField("cluster", T.IntegerType())])
        for name in ("distance", "cluster_inertia", "inertia"):
            empty.add(name, T.LongType())
        return spark.createDataFrame([], empty.add("centroid_sha256", T.StringType()))
    centroids = np.array([r["_v"] for r in first], np.int64)
    dictionary, stored = _dictionary(scratch, rows, dims)
    plan = _Plan(dictionary, dims)
    for _ in range(rounds):
        plan.move(centroids)
        sums = (
            stored.mapInArrow(plan.sums, "cluster int, dim int, n long, total long")
            .groupBy("cluster", "dim")
            .agg(F.sum(F.col("n").cast(_DECIMAL)).alias("n"), F.sum(F.col("total").cast(_DECIMAL)).alias("total"))
        )
        centroids = centroids.copy()
        for r in sums.collect():
            centroids[r.cluster, r.dim] = int(r.total) // int(r.n)
    plan.move(centroids)
    schema = T.StructType(
        [T.StructField("_id", kind), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())]
    )
    placed = scratch.save(stored.mapInArrow(plan.nearest, schema))
    found = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast(_DECIMAL)).alias("sum")).collect()
    inertia = {r.cluster: int(r["sum"]) for r in found}

    def long(value: int | None) -> Column:
        return F.lit(None if value is None or value >= 1 << 63 else value).cast("long")

    return placed.select(
        F.col("_id").alias(id_col),
        "cluster",
        "distance",
        F.get(F.array(*(long(inertia.get(c)) for c in range(len(centroids)))), F.col("cluster")).alias("cluster_inertia"),
        long(sum(inertia.values())).alias("inertia"),
        F.get(
            F.array(*(F.sha2(F.lit(",".join(map(str, c))), 256) for c in centroids.tolist())), F.col("cluster")
        ).alias("centroid_sha256"),
    )
