"""Greedy near-duplicate removal inside sources."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.shared import rewritten


def near_pairs(rows: DataFrame, threshold: float, block: int = 2048) -> DataFrame:
    """(a, b): rows of one source (source_file, place, v) closer than `threshold` in cosine distance, a before b by place.
    A source is cut in blocks of consecutive places, and pairs of blocks meet; none is larger than `block` rows."""
    size = rows.groupBy("source_file").agg((F.floor((F.max("place") - 1) / block) + 1).cast("int").alias("blocks"))
    r = rows.withColumn("blk", F.floor((F.col("place") - 1) / block).cast("int")).join(size, "source_file")
    r = r.select("source_file", "place", "v", "blk", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o"))
    r = r.select("source_file", "place", "v", "blk", F.least("blk", "o").alias("i"), F.greatest("blk", "o").alias("j"))

    def close(f: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(f["v"].to_numpy())
        x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
        one, two = np.flatnonzero(f["blk"] == f["i"].iloc[0]), np.flatnonzero(f["blk"] == f["j"].iloc[0])
        i, j = np.nonzero(1 - x[one] @ x[two].T < threshold)
        a, b = f["place"].to_numpy()[one[i]], f["place"].to_numpy()[two[j]]
        return pd.DataFrame({"source_file": f["source_file"].iloc[0], "a": a[a < b], "b": b[a < b]})

    return r.groupBy("source_file", "i", "j").applyInPandas(close, "source_file string, a int, b int")


def greedy_dedup(chunks: DataFrame, threshold: float = 0.15, least_length: int = 20) -> DataFrame:
    """(id, source_file, kept): in each source, longest first (then by id), a chunk goes if one kept before it is closer
    than `threshold` in cosine distance, or if it is shorter than `least_length`. chunks: id, source_file, document,
    embedding (of one length, without nulls).

    Only the first of equal vectors can stay, so one of each goes on. Close pairs are found in blocks; then all chunks
    without an undecided closer one before them are kept, and what is close to a kept one goes, round by round, until
    all are decided: the same as going through each source in order, without one task per source.
    """
    n = F.coalesce(F.length("document"), F.lit(0))
    order = Window.partitionBy("source_file").orderBy(F.desc("n"), "id")
    d = chunks.select("id", "source_file", n.alias("n"), F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    same = Window.partitionBy("source_file", "v").orderBy(F.desc("n"), "id")
    d = d.withColumn("first", (F.row_number().over(same) == 1) & (F.col("n") >= least_length))
    live = rewritten(d.where("first").withColumn("place", F.row_number().over(order)))
    pairs = rewritten(near_pairs(live.select("source_file", "place", "v"), threshold))
    state = rewritten(live.select("source_file", "place", F.lit(None).cast("boolean").alias("kept")))
    while True:
        open_ = state.where("kept is null").select("source_file", F.col("place").alias("a"))
        waits = pairs.join(open_, ["source_file", "a"]).select("source_file", F.col("b").alias("place"), F.lit(True).alias("waits")).distinct()
        now = rewritten(state.join(waits, ["source_file", "place"], "left").withColumn("kept", F.when(F.col("kept").isNull() & F.col("waits").isNull(), True).otherwise(F.col("kept"))).drop("waits"), state)
        gone = pairs.join(now.where("kept").select("source_file", F.col("place").alias("a")), ["source_file", "a"]).select("source_file", F.col("b").alias("place"), F.lit(True).alias("gone")).distinct()
        state = rewritten(now.join(gone, ["source_file", "place"], "left").withColumn("kept", F.when(F.col("gone"), False).otherwise(F.col("kept"))).drop("gone"), now)
        if state.where("kept is null").isEmpty():
            break
    told = live.select("id", "source_file", "place").join(state, ["source_file", "place"]).select("id", "source_file", "kept")
    return told.unionByName(d.where("not first").select("id", "source_file", F.lit(False).alias("kept")))


def dedup_totals(flags: DataFrame) -> DataFrame:
    """(source_file, chunks, kept, deleted) of `greedy_dedup`."""
    return flags.groupBy("source_file").agg(F.count(F.lit(1)).alias("chunks"), F.count_if("kept").alias("kept"), F.count_if(~F.col("kept")).alias("deleted"))
