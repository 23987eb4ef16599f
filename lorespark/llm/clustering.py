"""Centroid clustering in exact integers: block norms screen the centroids, and what they leave gets exact distances."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import reread

SEGMENT = 8
#: Components reach from -LARGEST to LARGEST, so that a squared distance over 64 of them fits in a long.
LARGEST = 1 << 27
#: Vectors whose screen is held in memory at once.
AT_ONCE = 8192


def compressed(x: np.ndarray) -> np.ndarray:
    """Two numbers for each segment of SEGMENT components: its sum by the square root of its length, and the norm of what
    its mean leaves. The squared distance of two vectors is at least that of their compressed forms: exactly the first
    numbers' part, and by Cauchy and Schwarz at least the second ones'."""
    n, dim = x.shape
    width = -(-dim // SEGMENT)
    wide = np.zeros((n, width * SEGMENT))
    wide[:, :dim] = x
    wide = wide.reshape(n, width, SEGMENT)
    mean = wide.mean(2, keepdims=True)
    return np.concatenate([mean[:, :, 0] * np.sqrt(SEGMENT), np.sqrt(((wide - mean) ** 2).sum(2))], axis=1)


def nearest_centroid(x: np.ndarray, small: np.ndarray, centroids: np.ndarray, small_centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For each row of `x` the smallest number of a nearest centroid, the exact squared distance, and how many exact
    distances all rows together took.

    The centroid with the least bound is measured first; a further one only where its bound, less what rounding can have
    added, does not exceed the least distance so far.
    """
    low = (small * small).sum(1)[:, None] + (small_centroids * small_centroids).sum(1) - 2 * (small @ small_centroids.T)
    # Rounding of the three sums and of the compressed numbers, generously.
    low -= 1e-9 * ((small * small).sum(1)[:, None] + (small_centroids * small_centroids).sum(1)) + 1
    cluster = low.argmin(1)
    best = ((x - centroids[cluster]) ** 2).sum(1)
    first, took = cluster.copy(), len(x)
    for j in range(len(centroids)):
        at = np.flatnonzero((low[:, j] <= best) & (first != j))
        if len(at):
            d = ((x[at] - centroids[j]) ** 2).sum(1)
            took += len(at)
            nearer = (d < best[at]) | ((d == best[at]) & (j < cluster[at]))
            cluster[at[nearer]], best[at[nearer]] = j, d[nearer]
    return cluster, best, took


def quantised(vectors: DataFrame, dim: int, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """The vectors that take part, as integers in one binary column, with their compressed forms, written once."""
    v = F.col("v")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    rows = rows.where(v.isNotNull() & (F.size(v) == dim)).where(fine)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(1).flatten().to_numpy().reshape(-1, dim)
                with np.errstate(over="ignore"):
                    x = np.clip(np.floor(scale * x), -LARGEST, LARGEST).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0), binary(x), binary(compressed(x))], ["vec_id", "x", "small"])

    kind = dict(rows.dtypes)["vec_id"]
    return reread(rows.mapInArrow(encode, f"vec_id {kind}, x binary, small binary"))


def binary(x: np.ndarray) -> pa.Array:
    """Each row of a matrix as one binary value."""
    width = x.shape[1] * x.dtype.itemsize
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer((np.arange(len(x) + 1) * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(x))])


def matrix(column: pa.Array, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def first_centroids(rows: DataFrame, k: int, dim: int, salt: str) -> np.ndarray:
    """The k vectors whose ids have the smallest hashes: a bounded top-k, the only vectors that reach the driver. A null
    id is hashed as no characters; of equal hashes the smaller bytes of the vector come first."""
    name = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    chosen = rows.select(name.alias("h"), "x").orderBy("h", "x").limit(k).collect()
    return np.array([np.frombuffer(r["x"], np.int32) for r in chosen], np.int64).reshape(-1, dim)


def assigned(rows: DataFrame, centroids: np.ndarray, dim: int) -> DataFrame:
    """(vec_id, cluster, distance) of every row."""
    small_centroids, kind = compressed(centroids), dict(rows.dtypes)["vec_id"]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x, small in _blocks(batches, dim):
            cluster, distance, _ = nearest_centroid(x, small, centroids, small_centroids)
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"])

    return rows.mapInArrow(assign, f"vec_id {kind}, cluster int, distance long")


def moved(rows: DataFrame, centroids: np.ndarray, dim: int) -> np.ndarray:
    """Every non-empty centroid replaced by the floor of its vectors' mean. Tasks send one sum for each cluster and
    component they have seen; at most one for each centroid and component comes to the driver."""
    small_centroids = compressed(centroids)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((len(centroids), dim), object), np.zeros(len(centroids), np.int64)
        for _, x, small in _blocks(batches, dim):
            cluster, _, _ = nearest_centroid(x, small, centroids, small_centroids)
            order = np.argsort(cluster, kind="stable")
            present, start = np.unique(cluster[order], return_index=True)
            total[present] += np.add.reduceat(x[order], start, axis=0).astype(object)
            count += np.bincount(cluster, minlength=len(centroids))
        for c in np.flatnonzero(count).tolist():
            texts = pa.array([str(t) for t in total[c]])
            yield pa.RecordBatch.from_arrays([pa.array([c] * dim, pa.int32()), pa.array(range(dim), pa.int32()), texts, pa.array([int(count[c])] * dim)], ["cluster", "at", "total", "n"])

    parts = rows.mapInArrow(sums, "cluster int, at int, total string, n long")
    out = centroids.copy()
    for r in parts.groupBy("cluster", "at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect():
        out[r["cluster"], r["at"]] = int(r["total"]) // r["n"]
    return out


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    width = 2 * -(-dim // SEGMENT)
    for batch in batches:
        for i in range(0, batch.num_rows, AT_ONCE):
            part = batch.slice(i, AT_ONCE)
            yield part.column(0), matrix(part.column(1), np.int32, dim).astype(np.int64), matrix(part.column(2), np.float64, width)


def cluster_vectors(vectors: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256, salt: str = "2:") -> tuple[DataFrame, np.ndarray]:
    """Every vector's nearest of k centroids after `rounds` rounds of Lloyd's method, and the final centroids.

    Vectors of exactly `dim` components, none null or non-finite, take part; each component x becomes floor(scale * x),
    held within LARGEST. Ids may be null or shared, and rows may be repeated: every row is a vector of its own. Fewer than
    k vectors give as many centroids; none give no rows. Extra columns are left out.

    Integers and compressed forms are written once and read in each round. Centroids (k rows, whatever the table's size)
    go to the tasks; of each round only k x dim sums come back. Returns vec_id, cluster, distance (squared).
    """
    rows = quantised(vectors, dim, id_col, vector_col, scale)
    centroids = first_centroids(rows, k, dim, salt)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(rows, centroids, dim)
    if not len(centroids):
        return rows.selectExpr("vec_id", "cast(null as int) cluster", "cast(null as bigint) distance").limit(0), centroids
    return assigned(rows, centroids, dim), centroids


def with_inertia(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Add cluster_inertia, inertia (distance summed over the cluster and over all) and centroid_sha256."""
    found = reread(found)
    spark = found.sparkSession
    texts = [(c, ",".join(map(str, row))) for c, row in enumerate(centroids.tolist())]
    names = spark.createDataFrame(texts, "cluster int, components string").select("cluster", F.sha2(F.col("components").cast("binary"), 256).alias("centroid_sha256"))
    sums = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    whole = sums.agg(F.sum("cluster_inertia").alias("inertia"))
    # One row for each centroid: at most k.
    per_cluster = sums.join(F.broadcast(names), "cluster").join(F.broadcast(whole))
    return found.join(F.broadcast(per_cluster), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
