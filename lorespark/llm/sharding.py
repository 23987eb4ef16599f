"""Sharding by global byte-size prefix sums: contiguous shards in document order with near-equal sizes (native)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, shuffle_partitions


def shard_documents(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Assign every row of `docs` to one of `shards` contiguous shards of near-equal bytes, law `bytes`.

    Rows are ordered by (id, text checksum, size); a row's size is its UTF-8 bytes plus 1. With B bytes in all and b
    bytes before a row of size s, the row goes to shard floor(shards * (b + s / 2) / B): no shard is further from
    B / shards than one row. Steps: one range shuffle of (id, size, checksum), the totals of each range partition,
    their prefix sums (one row per partition), and running sums inside each partition.

    Null text counts as empty (size 1, checksum 0); null ids come first; repeated rows are all kept, in a fixed order;
    an empty table gives no rows; other columns are ignored. Returns id, size, text_crc32, shard, slot (from 0,
    gapless in each shard).
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("salt"),
    )
    # The salt spreads rows that share an id over range partitions. The written copy fixes partition ids for good.
    n = shuffle_partitions(docs.sparkSession)
    keys = ["id", "text_crc32", "size", "salt"]
    rows = cut_lineage(rows.repartitionByRange(n, *keys).withColumn("part", F.spark_partition_id()))
    totals = rows.groupBy("part").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range partition
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = totals.select(
        "part",
        F.coalesce(F.sum("b").over(before), F.lit(0)).alias("b0"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"),
        F.sum("b").over(everything).alias("all_b"),
    )
    inner = Window.partitionBy("part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        rows.withColumn("run", F.sum("size").over(inner))
        .withColumn("nth", F.row_number().over(Window.partitionBy("part").orderBy(*keys)))
        .join(F.broadcast(totals), "part")  # bounded: as many rows as shuffle partitions
        .withColumn("middle", 2 * (F.col("b0") + F.col("run")) - F.col("size"))
        .select(
            "id", "size", "text_crc32", (F.col("n0") + F.col("nth") - 1).alias("g"),
            F.least(F.lit(shards - 1), F.expr(f"middle * {shards} div (2 * all_b)")).cast("int").alias("shard"),
        )
    )
    starts = placed.groupBy("shard").agg(F.min("g").alias("g0"))  # at most `shards` rows
    return placed.join(F.broadcast(starts), "shard").select(
        F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("g") - F.col("g0")).cast("long").alias("slot")
    )
