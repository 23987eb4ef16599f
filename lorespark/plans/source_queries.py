"""Queries of the data source of session messages, with DuckDB twins. Session files are written from `conversations`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.shared import new_folder
from ..sources import plugin
from .registry import query, t


def _session_files(turns: DataFrame) -> str:
    """Every turn as a JSON line, those of even numbers with their text in a block beside one of a tool."""
    tool = F.struct(F.lit("tool_use").alias("type"), F.lit(None).cast("string").alias("text"), F.lit("find").alias("name"))
    said = F.struct(F.lit("text").alias("type"), F.col("text"), F.lit(None).cast("string").alias("name"))
    head = [F.col("role").alias("type"), F.col("conv_id").cast("string").alias("sessionId"), F.col("turn").cast("string").alias("uuid"), F.lpad(F.col("turn").cast("string"), 9, "0").alias("timestamp")]
    plain, blocks = (F.to_json(F.struct(*head, F.struct(c.alias("content")).alias("message"))) for c in (F.col("text"), F.array(said, tool)))
    folder = new_folder(turns.sparkSession, "sessions")
    turns.select(F.when(F.col("turn") % 2 == 0, blocks).otherwise(plain).alias("value")).write.option("maxRecordsPerFile", 20_000).text(folder)
    return folder


_SAID = r"""SELECT CAST(conv_id AS VARCHAR) AS session_id, CAST(turn AS VARCHAR) AS message_uuid, role, md5(said) AS digest FROM
(SELECT *, CASE WHEN turn % 2 = 0 THEN concat_ws(chr(10), text, '{"type":"tool_use","name":"find"}') ELSE text END AS said FROM conversations) WHERE role IN ('user', 'assistant') AND regexp_matches(said, '\S')"""


def _digests(messages: DataFrame) -> DataFrame:
    return messages.select("session_id", "message_uuid", "role", F.md5("text").alias("digest"))


@query(_SAID)
def source_messages(spark, sf_dir):
    plugin.register(spark)
    folder = _session_files(t(spark, sf_dir, "conversations"))
    return _digests(spark.read.format(plugin.resolved()).option("suffix", ".txt").load(folder))


@query(_SAID)
def source_stream(spark, sf_dir):
    """The same through the stream, whose sink is a table beside the files."""
    plugin.register(spark)
    folder = _session_files(t(spark, sf_dir, "conversations"))
    out = new_folder(spark, "streamed")
    messages = _digests(spark.readStream.format(plugin.resolved()).option("suffix", ".txt").option("settle", 0).load(folder))
    run = messages.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-offsets").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema(messages.schema).parquet(out)
