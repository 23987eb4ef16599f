"""An inverted-file index of vectors: cells around trained centres, as Parquet by cell, of which a search reads a few."""

from __future__ import annotations

import json
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows or queries that are compared at once.
BLOCK = 4096
#: Queries that are copied to their cells, or compared with a block, at once.
STEP = 256
#: Copies of queries that leave a worker together.
COPIES = 16_384


class VectorIndex(NamedTuple):
    """`rows` (cell, id, v: unit vector) below `folder`, by cell; centres of the cells, and how many cells a search probes.

    Vectors are compared by cosine, so they are stored at length 1.
    """

    spark: SparkSession
    folder: str
    centres: np.ndarray
    probes: int

    def rows(self, cells: list[int] | None = None) -> DataFrame:
        """The stored rows of some cells; others are not read."""
        d = self.spark.read.parquet(f"{self.folder}/rows")
        return d if cells is None else d.where(F.col("cell").isin(cells))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def trained(x: np.ndarray, cells: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Centres of unit vectors by Lloyd's method; an empty cell takes a vector that is far from its centre."""
    centres = x[np.random.default_rng(seed).permutation(len(x))[:cells]].copy()
    for _ in range(rounds):
        best = (x @ centres.T).argmax(1)
        near = (x * centres[best]).sum(1)
        total = np.zeros_like(centres)
        np.add.at(total, best, x)
        empty = np.flatnonzero(np.bincount(best, minlength=len(centres)) == 0)
        total[empty] = x[np.argsort(near)[: len(empty)]]
        centres = _unit(total)
    return centres


def calibrated(x: np.ndarray, centres: np.ndarray, k: int, recall: float, queries: int = 256) -> int:
    """The fewest probes that find this share of the true k nearest of some of the sample's vectors among the sample."""
    q = x[: min(queries, len(x))]
    own = (x @ centres.T).argmax(1)
    true = np.argsort(-(q @ x.T), axis=1)[:, 1 : k + 1]
    order = np.argsort(-(q @ centres.T), axis=1)
    place = np.argsort(order, axis=1)
    needed = np.take_along_axis(place, own[true], axis=1)  # at which probe each neighbour comes
    for probes in range(1, len(centres) + 1):
        if (needed < probes).mean() >= recall:
            return probes
    return len(centres)


def built(vectors: DataFrame, folder: str, cells: int | None = None, k: int = 10, recall: float = 0.95, sample: int = 20_000, id_col: str = "id", vector_col: str = "embedding") -> VectorIndex:
    """Write the index of vectors (id, embedding) below `folder`.

    Centres and the number of probes are fitted to at most `sample` vectors, those with the smallest hashes of their ids;
    every row is indexed. Without `cells` there are as many as the square root of the rows, at most an eighth of the
    sample. Vectors that are null, zero, not finite or not of the commonest length are left out.
    """
    v = F.col("v")
    fine = v.isNotNull() & (F.size(v) > 0) & F.exists(v, lambda x: x != 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    d = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(fine)
    spark = vectors.sparkSession
    sizes = d.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    if not sizes:
        raise ValueError("no vectors to index")
    dim, n = sizes[0]["dim"], sizes[0]["count"]
    d = d.where(F.size("v") == dim)
    x = _unit(np.array([r["v"] for r in d.orderBy(F.xxhash64("id"), "id").limit(sample).select("v").collect()], np.float64))
    centres = trained(x, min(cells or max(1, int(n**0.5)), max(1, len(x) // 8)))

    def assign(frames):
        for f in frames:
            u = _unit(np.stack(f["v"].to_numpy()))
            yield pd.DataFrame({"cell": (u @ centres.T).argmax(1).astype(np.int32), "id": f["id"], "v": list(u)})

    kind = dict(d.dtypes)["id"]
    rows = d.mapInPandas(assign, f"cell int, id {kind}, v array<double>")
    rows.repartition("cell", F.pmod(F.xxhash64("id"), F.lit(max(1, n // (64 * BLOCK * len(centres)) + 1)))).sortWithinPartitions("cell").write.partitionBy("cell").parquet(f"{folder}/rows")
    probes = calibrated(x, centres, k, recall)
    facts = json.dumps({"centres": centres.tolist(), "probes": probes})
    spark.createDataFrame([(facts,)], "value string").coalesce(1).write.text(f"{folder}/centres")
    return VectorIndex(spark, folder, centres, probes)


def opened(spark: SparkSession, folder: str) -> VectorIndex:
    """An index that is there; centres are as many as cells."""
    facts = json.loads(spark.read.text(f"{folder}/centres", wholetext=True).first()[0])
    return VectorIndex(spark, folder, np.array(facts["centres"]), facts["probes"])


def nearest(index: VectorIndex, queries: DataFrame, k: int, probes: int | None = None) -> DataFrame:
    """(query_id, rank, id, distance): the k nearest by cosine distance found for queries (query_id, embedding) in the cells
    whose centres are nearest to them, ties to the smaller id.

    Rows and queries of one cell meet in blocks, dealt by cell and both blocks' numbers, so a cell of any size is no task of
    its own; blocks pass on the k nearest. Cells that no query probes are not read. Queries without a direction find nothing.
    """
    centres, wanted = index.centres, min(probes or index.probes, len(index.centres))
    kind = dict(queries.dtypes)["query_id"]
    v = F.col("q")
    q = queries.select("query_id", F.col("embedding").cast("array<double>").alias("q"))
    q = q.where(v.isNotNull() & (F.size(v) == centres.shape[1]) & F.exists(v, lambda x: x != 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))

    def probe(frames):
        for f in frames:
            for first in range(0, len(f), STEP):
                ids, u = f["query_id"].to_numpy()[first : first + STEP], _unit(np.stack(f["q"].to_numpy()[first : first + STEP]))
                near = np.argsort(-(u @ centres.T), axis=1, kind="stable")[:, :wanted].astype(np.int32)
                own = np.repeat(np.arange(len(u)), wanted)
                for at in range(0, len(own), COPIES):
                    i = own[at : at + COPIES]
                    yield pd.DataFrame({"query_id": ids[i], "q": list(u[i]), "cell": near.ravel()[at : at + COPIES]})

    asked = q.mapInPandas(probe, f"query_id {kind}, q array<double>, cell int")
    cells = sorted(r["cell"] for r in asked.select("cell").distinct().collect())  # no more than there are centres
    rows = index.rows(cells)
    blocks = rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("rn")).join(asked.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("qn")), "cell")
    blocks = F.broadcast(blocks)  # a row for each probed cell
    seq = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = rows.join(blocks, "cell").withColumn("rb", F.pmod(F.xxhash64("id"), "rn").cast("int")).withColumn("qb", seq("qn")).select("cell", "rb", "qb", "id", "v")
    right = asked.join(blocks, "cell").withColumn("qb", F.pmod(F.xxhash64("query_id"), "qn").cast("int")).withColumn("rb", seq("rn")).select("cell", "rb", "qb", "query_id", "q")
    id_kind = dict(rows.dtypes)["id"]

    def meet(r: pd.DataFrame, s: pd.DataFrame) -> pd.DataFrame:
        if not len(r) or not len(s):
            return pd.DataFrame({"query_id": [], "id": [], "distance": []})
        r = r.sort_values("id", kind="stable")
        x, ids, q, names, out = np.stack(r["v"].to_numpy()), r["id"].to_numpy(), s["q"].to_numpy(), s["query_id"].to_numpy(), []
        for first in range(0, len(q), STEP):
            d = 1 - np.stack(q[first : first + STEP]) @ x.T
            best = np.argsort(np.round(d, 12), axis=1, kind="stable")[:, :k]
            out.append(pd.DataFrame({"query_id": np.repeat(names[first : first + STEP], best.shape[1]), "id": ids[best].ravel(), "distance": np.take_along_axis(d, best, 1).ravel()}))
        return pd.concat(out, ignore_index=True)

    keys = ["cell", "rb", "qb"]
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(meet, f"query_id {kind}, id {id_kind}, distance double")
    w = Window.partitionBy("query_id").orderBy(F.round("distance", 12), "id")
    return met.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "id", "distance")
