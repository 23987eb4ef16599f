"""Helpers that several training-data operators share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named parquet table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that driver and executors share.

    A cluster names it in `spark.checkpoint.dir`. Where it is unset, a local session takes a temporary folder; a session
    with executors elsewhere is refused, since they could not recover from one.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(shared or os.path.join(tempfile.gettempdir(), "lorespark-checkpoints"))
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` to the reliable checkpoint directory and go on from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def reread(df: DataFrame) -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back."""
    path = f"{shared_folder(df.sparkSession)}/tables/{uuid.uuid4().hex}.parquet"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def modest_batches(spark: SparkSession, most: int = 4 << 20) -> None:
    """Hand rows to workers in batches of at most `most` bytes, unless the session has a bound below Spark's own 64 MB:
    a batch stands in the executor's and in the worker's memory at once, and stages follow each other in one executor.
    A session that never set the bound has Spark's own, which `get` without a default would name."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, "64m") in ("67108864b", "67108864", "64m", "64MB"):
        spark.conf.set(key, most)


def unused(names: list[str], wish: str) -> str:
    """`wish`, lengthened until no column has that name in any case."""
    taken = {n.lower() for n in names}
    while wish.lower() in taken:
        wish += "_"
    return wish


def only(df: DataFrame, *names: str) -> DataFrame:
    """Just these columns, so that extra ones never clash with an operator's own names."""
    return df.select(*[F.col(f"`{n}`") for n in names])
