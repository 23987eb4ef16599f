"""The vector index against exact search."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from lorespark.operators import search, vector_index

TABLE = "/root/testdata/sf0.1/embeddings.parquet"


@pytest.mark.skipif(not os.path.exists(TABLE), reason="no test tables here")
def test_recall_on_the_real_table_and_cells_read(spark, tmp_path):
    v = spark.read.parquet(TABLE).select(F.col("vec_id").alias("id"), "embedding")
    vector_index.built(v, str(tmp_path / "i"))
    index = vector_index.opened(spark, str(tmp_path / "i"))
    assert index.rows().count() == v.count() and 1 <= index.probes <= len(index.centres)
    rows = [(r.id, np.array(r.embedding, np.float64)) for r in v.orderBy("id").collect()]
    x = vector_index._unit(np.stack([r[1] for r in rows]))
    asked = [i for i, _ in rows if i % 40 == 0]
    got = {}
    for r in vector_index.nearest(index, v.where("id % 40 = 0").select(F.col("id").alias("query_id"), "embedding"), 10).collect():
        got.setdefault(r.query_id, {})[r.id] = r.distance
    at = {i: n for n, (i, _) in enumerate(rows)}
    hits = 0
    for i in asked:
        d = 1 - x @ x[at[i]]
        true = sorted(range(len(rows)), key=lambda n: (round(d[n], 12), rows[n][0]))[:10]
        hits += sum(rows[n][0] in got[i] for n in true)
        assert all(abs(d[at[j]] - e) < 1e-9 for j, e in got[i].items())
    assert hits >= 0.9 * 10 * len(asked)
    plan = index.rows([0, 1])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan or "cell#" in plan.split("PartitionFilters")[1][:80]


def test_awkward_vectors(spark, tmp_path):
    rows = [(i, [float(i % 7), 1.0, float(i % 3)]) for i in range(50)] + [(60, None), (61, []), (62, [0.0] * 3), (63, [float("nan")] * 3), (64, [1.0]), (65, [None, 1.0, 1.0])]
    v = spark.createDataFrame(rows, "id long, embedding array<double>")
    index = vector_index.built(v, str(tmp_path / "i"), cells=4)
    assert index.rows().count() == 50
    q = spark.createDataFrame([(1, [1.0, 1.0, 1.0]), (2, None), (3, [0.0] * 3), (4, [1.0])], "query_id long, embedding array<double>")
    got = vector_index.nearest(index, q, 3, probes=4).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.id) for r in got] == [(1, 1, 1), (1, 2, 22), (1, 3, 43)]  # equal vectors, by id
    with pytest.raises(ValueError):
        vector_index.built(v.where("id >= 60 and id < 64"), str(tmp_path / "j"))


def test_more_queries_than_one_step(spark, tmp_path):
    """Queries are copied to cells and compared a bounded number at a time; every one of one large partition is answered."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(700, 8))
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, embedding array<double>").coalesce(1)
    q = d.select(F.col("id").alias("query_id"), "embedding")
    index = vector_index.built(d, str(tmp_path / "ix"))
    assert vector_index.STEP < 700 and vector_index.STEP * len(index.centres) <= vector_index.COPIES
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = {(i, r + 1): int(j) for i, row in enumerate(np.argsort(-(u @ u.T), axis=1, kind="stable")[:, :2]) for r, j in enumerate(row)}
    assert {(r.query_id, r["rank"]): r.id for r in vector_index.nearest(index, q, 2, len(index.centres)).collect()} == want
    assert search.STEP < 700 and search.STEP * search.ROW_BLOCK * 8 <= 8 << 20
    assert {(r.query_id, r["rank"]): r.id for r in search.vector_topk(d, q, 2).collect()} == want
