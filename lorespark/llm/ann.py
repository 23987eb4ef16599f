"""Nearest neighbours by collision counting: query-centred windows on sorted single projections, virtually rehashed."""

from __future__ import annotations

from collections.abc import Iterator
from math import erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions

QUERY_BLOCK = 512
SHARD_ROWS = 8192


def axes(dim: int, m: int, seed: int) -> np.ndarray:
    """m random projections in orthogonal groups of at most `dim`, each of variance 1 for a unit vector in expectation.

    Inside a group the squared projections of a difference add up to its squared length, so the number of collisions
    says more about the distance than with independent projections.
    """
    rng = np.random.default_rng(seed)
    groups = [np.linalg.qr(rng.standard_normal((dim, min(dim, m - i))))[0] * sqrt(dim) for i in range(0, m, dim)]
    return np.concatenate(groups, axis=1)


class CollisionIndex:
    """Sorted arrays of m random projections over one block of vectors.

    At radius R an entry collides with the query on a projection if it lies within half_width * R of it; a vector at
    distance R does so with probability p = P(|N(0, 1)| <= half_width). Vectors with at least `share` of the m p
    collisions expected at distance R are verified by exact distance. R grows by `growth` (windows only widen, nothing
    is rehashed), but not beyond the k-th verified distance, until that distance is at most R or every window covers
    the block. `verified` counts the exact distances taken so far.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, m: int = 128, half_width: float = 1.3, share: float = 0.96, growth: float = 1.1, seed: int = 10):
        self.ids, self.x = ids, vectors
        self.m, self.half_width, self.growth = m, half_width, growth
        self.needed = max(1, int(share * m * erf(half_width / sqrt(2))))
        self.axes = axes(vectors.shape[1], m, seed)
        p = vectors @ self.axes
        order = np.argsort(p, axis=0)
        # One sorted array per projection, all in one, each projection on a stretch of its own.
        self.stretch = 4 * (float(np.abs(p).max(initial=0.0)) + 1)
        self.shift = np.arange(m) * self.stretch
        self.sorted = (np.take_along_axis(p, order, 0) + self.shift).T.ravel()
        self.order = order.T.astype(np.int32).ravel()
        self.verified = 0

    def search(self, q: np.ndarray, own: int, k: int) -> list[tuple[float, int]]:
        """The k nearest found, as (distance, id), nearest first, ties to the smaller id; one row that equals the query
        in id and vector is left out."""
        n, first = len(self.ids), np.arange(self.m) * len(self.ids)
        # A query far outside the block's range stands at its edge; what lies beyond has no entries.
        centre = np.clip(q @ self.axes, -self.stretch / 4, self.stretch / 4)
        at = np.clip(np.searchsorted(self.sorted, centre + self.shift), first, first + n - 1)
        # While windows hold a small share of the entries, few vectors can have `needed` collisions: begin at a quarter.
        far = np.maximum(np.abs(self.sorted[np.minimum(at + n // 8 + k, first + n - 1)] - self.shift - centre), np.abs(self.sorted[np.maximum(at - n // 8 - k, first)] - self.shift - centre))
        radius = max(float(np.median(far)) / self.half_width, 1e-12)
        lo, hi, count = at.copy(), at.copy(), np.zeros(n, np.int64)
        seen = np.zeros(n, bool)
        mine = np.flatnonzero(self.ids == own)
        seen[mine[(self.x[mine] == q).all(1)][:1]] = True
        found_d, found_i = np.zeros(0), np.zeros(0, np.int64)
        while True:
            reach = min(self.half_width * radius, self.stretch / 2.001)
            a = np.minimum(np.maximum(np.searchsorted(self.sorted, centre + self.shift - reach), first), lo)
            b = np.maximum(np.minimum(np.searchsorted(self.sorted, centre + self.shift + reach, "right"), first + n), hi)
            new = [self.order[x:y] for x, y in zip(a.tolist(), lo.tolist())] + [self.order[x:y] for x, y in zip(hi.tolist(), b.tolist())]
            lo, hi = a, b
            count += np.bincount(np.concatenate(new), minlength=n)
            fresh = np.flatnonzero((count >= self.needed) & ~seen)
            if len(fresh):
                seen[fresh] = True
                self.verified += len(fresh)
                d = np.sqrt(((self.x[fresh] - q) ** 2).sum(1))
                found_d, found_i = np.concatenate([found_d, d]), np.concatenate([found_i, self.ids[fresh]])
                best = np.lexsort((found_i, found_d))[:k]
                found_d, found_i = found_d[best], found_i[best]
            if (len(found_d) == k and found_d[-1] <= radius) or (hi - lo).min() == n:
                return list(zip(found_d.tolist(), found_i.tolist()))
            radius *= self.growth
            if len(found_d) == k:
                radius = min(radius, max(found_d[-1], radius / self.growth))


def nearest(vectors: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k nearest rows (Euclidean, double precision) found for each row whose id is divisible by `every`.

    Rows with null ids, and vectors that are null, empty, zero or hold null or non-finite components, take no part. Only
    vectors of the query's length are candidates, and of those every row but the query's own: other rows that share its
    id, its vector or both count. Repeated query rows are asked once; one id with several vectors is asked for each of
    them. Fewer than k candidates are all returned; an empty table gives no rows.

    Vectors are dealt at random into blocks of at most about SHARD_ROWS, each with an index of its own, and queries into
    blocks of about QUERY_BLOCK. The stated queries meet all rows in blocks: a pair of blocks is a row of its own, dealt
    by both numbers, so no key is larger than one block of each side. The k best of each visit are merged per query by a
    top-k window that Spark also applies before the shuffle.
    Returns query_id, rank (from 1), vec_id, score.
    """
    v, key = F.col("v"), ["dim", "shard", "qblock"]
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    fine = F.exists(v, lambda x: x != 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where("id is not null and v is not null and size(v) > 0").where(fine).withColumn("dim", F.size(v)).withColumn("row", F.monotonically_increasing_id())
    asking = rows.where(F.col("id") % every == 0).dropDuplicates(["id", "v"])
    n_all, n_asking = (x.groupBy("dim").agg(F.count(F.lit(1)).alias(name)) for x, name in ((rows, "n"), (asking, "q")))
    sizes = n_all.join(n_asking, "dim").collect()  # one row per vector length
    parallel = shuffle_partitions(spark)
    blocks = [(r["dim"], max(-(-r["n"] // SHARD_ROWS), min(parallel, r["n"] // 1024), 1), -(-r["q"] // QUERY_BLOCK)) for r in sizes]
    visits = sum(s * q for _, s, q in blocks)
    blocks = spark.createDataFrame(blocks or [(0, 1, 1)], "dim int, shards int, qblocks int")

    def pack(t: pa.Table) -> pa.Table:
        x = np.array(t.column("v").to_pylist(), np.float64)
        names = [n for n in t.column_names if n in key]
        return pa.table({**{n: t.column(n)[:1] for n in names}, "ids": pa.array([t.column("id").to_numpy().tobytes()], pa.binary()), "body": pa.array([x.tobytes()], pa.binary())})

    def every_one(of: str, count: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1)).alias(of)

    shards = rows.join(F.broadcast(blocks), "dim").withColumn("shard", F.pmod(F.xxhash64("row", F.lit(1)), F.col("shards")).cast("int"))
    shards = shards.select("dim", "shard", "id", "v").groupBy("dim", "shard").applyInArrow(pack, "dim int, shard int, ids binary, body binary")
    asked = asking.join(F.broadcast(blocks), "dim").withColumn("qblock", F.pmod(F.xxhash64("id", "v", F.lit(2)), F.col("qblocks")).cast("int"))
    asked = asked.select("dim", "qblock", "id", "v").groupBy("dim", "qblock").applyInArrow(pack, "dim int, qblock int, ids binary, body binary")
    tasks = max(parallel, -(-visits // 16))
    left = shards.join(F.broadcast(blocks), "dim").select("dim", "shard", every_one("qblock", "qblocks"), "ids", "body").repartition(tasks, *key)
    right = asked.join(F.broadcast(blocks), "dim").select("dim", every_one("shard", "shards"), "qblock", F.col("ids").alias("q_ids"), F.col("body").alias("q_body")).repartition(tasks, *key)
    met = left.join(right.hint("merge"), key)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, index = None, None
        for batch in batches:
            for r in batch.to_pylist():
                if last != (r["dim"], r["shard"]):
                    last, index = (r["dim"], r["shard"]), CollisionIndex(np.frombuffer(r["ids"], np.int64), np.frombuffer(r["body"], np.float64).reshape(-1, r["dim"]))
                out = []
                for own, q in zip(np.frombuffer(r["q_ids"], np.int64).tolist(), np.frombuffer(r["q_body"], np.float64).reshape(-1, r["dim"])):
                    out += [(own, int(q.view(np.int64).sum()), i, d) for d, i in index.search(q, own, k)]
                yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.float64()))], ["query_id", "q", "vec_id", "score"])

    found = met.mapInArrow(visit, "query_id long, q long, vec_id long, score double")
    w = Window.partitionBy("query_id", "q").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
