"""Readers of chat transcripts: JSON lines and exports, to turns (path, pos, role, text)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = "type string, text string, name string, input string, content string"
LINE = f"type string, timestamp string, sessionId string, uuid string, message struct<role:string, content:string>"


def session_messages(spark: SparkSession, path: str) -> DataFrame:
    """`messages` of the session files of JSON lines below a path."""
    return messages(spark.read.option("recursiveFileLookup", "true").text(path))


def session_message_stream(spark: SparkSession, path: str, files: int | None = None) -> DataFrame:
    """`messages` of session files as they come, at most `files` a batch. Spark's own file source keeps track of what was
    read, so a query goes on from its checkpoint, and reads any path that Spark's readers can. A file is read once: one
    that grows is written under another name, or taken by the idempotent sweep."""
    reader = spark.readStream.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.jsonl")
    return messages((reader.option("maxFilesPerTrigger", files) if files else reader).text(path))


def messages(lines: DataFrame) -> DataFrame:
    """User and assistant messages of JSON lines (value): session_id, message_uuid, timestamp, role, text.

    Lines that don't parse, lack an id or a time, or say nothing are left out. Content is text or a list of blocks;
    text blocks give their text, others their JSON in full.
    """
    lines = lines.select(F.from_json("value", LINE).alias("m"), "value")
    raw = F.get_json_object("value", "$.message.content")
    blocks = F.from_json(raw, "array<string>")
    text_of = F.array_join(F.transform(blocks, lambda b: F.when(F.get_json_object(b, "$.type") == "text", F.get_json_object(b, "$.text")).otherwise(b)), "\n")
    content = F.when(F.substring(F.ltrim(raw), 1, 1) == "[", text_of).otherwise(raw)
    out = lines.select(F.col("m.sessionId").alias("session_id"), F.col("m.uuid").alias("message_uuid"), F.col("m.timestamp").alias("timestamp"), F.coalesce("m.message.role", "m.type").alias("role"), content.alias("text"))
    present = F.col("session_id").isNotNull() & F.col("message_uuid").isNotNull() & F.col("timestamp").isNotNull()
    return out.where(present & F.col("role").isin("user", "assistant") & F.col("text").rlike(r"\S"))
