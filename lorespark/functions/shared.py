"""The folder that the driver and all executors share, and tables that are small enough to go to all of them."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most rows of names or other short keys that travel to every task; a table of more is shuffled.
SMALL_ROWS = 100_000


def is_small(df: DataFrame) -> bool:
    return df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS


def small(df: DataFrame) -> DataFrame:
    """`df`, marked for a broadcast if it has at most SMALL_ROWS rows (counted first): a table made in the session has no
    size estimate, and a join with it would shuffle the other side."""
    return F.broadcast(df) if is_small(df) else df


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder: `spark.checkpoint.dir` on a cluster; only a local session may fall back to a temporary one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or os.path.join(tempfile.gettempdir(), "lorespark-checkpoints"))
    return sc.getCheckpointDir()


def new_folder(spark: SparkSession, kind: str) -> str:
    """A name, not used before, for a folder below the shared one."""
    return f"{shared_folder(spark)}/{kind}/{uuid.uuid4().hex}"


def rewritten(df: DataFrame, *old: DataFrame) -> DataFrame:
    """`df`, written as Parquet in the shared folder and read back; the tables `old`, which came from here and nothing
    reads any more, are deleted then. Rounds go on from what this returns: unlike a checkpoint, a table's size estimate
    is that of its files, and doesn't grow with the number of rounds."""
    spark = df.sparkSession
    path = new_folder(spark, "tables")
    df.write.parquet(path)
    for o in old:
        for folder in {f.rsplit("/", 1)[0] for f in o.inputFiles()}:
            where = spark._jvm.org.apache.hadoop.fs.Path(folder)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return spark.read.schema(df.schema).parquet(path)
