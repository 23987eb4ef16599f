"""Message sweeps and session counters as Structured Streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.mutate import sweep_split


def _before(spark, path: str, schema, batch_id: int) -> DataFrame:
    """What earlier batches wrote; nothing where none did."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], schema)
    kept = spark.read.schema(f"{schema_ddl(schema)}, batch_id long").option("basePath", path).parquet(path)
    return kept.where(F.col("batch_id") < batch_id).drop("batch_id")


def schema_ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def sweep(messages: DataFrame, target: str, checkpoint: str):
    """Append new messages of a stream to a parquet folder, batch by batch; a rerun adds nothing.

    What lies before a session's last stored timestamp is skipped; equal timestamps are tried again and ids that are
    stored are left out. Each batch writes its own folders, `target/batch_id=n`, and beside the target its sessions'
    last messages (`target.edges`) and its verdicts (`target.report`: added, present, skipped). It reads the edges of
    earlier batches alone, not the target, and one that died half-way is written anew and judged without its own rows.
    """
    schema = messages.schema
    edge = messages.select("session_id", "message_uuid", "timestamp").schema

    def put(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stored = _before(spark, f"{target}.edges", edge, batch_id)
        last = F.max("timestamp").over(Window.partitionBy("session_id"))
        stored = stored.withColumn("last", last).where("timestamp = last").drop("last")
        judged = sweep_split(batch.dropDuplicates(["session_id", "message_uuid"]), stored).persist()
        judged.groupBy("verdict").agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{target}.report/batch_id={batch_id}")
        new = judged.where("verdict = 'added'").drop("verdict")
        new.select(edge.names).withColumn("last", last).where("timestamp = last").drop("last").write.mode("overwrite").parquet(f"{target}.edges/batch_id={batch_id}")
        new.select(schema.names).write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")
        judged.unpersist()

    return messages.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def diary_changes(files: DataFrame, state: DataFrame) -> DataFrame:
    """(source_file, date, mode, entry, header, document): what daily files (source_file, text) bring beyond `state`
    (source_file, size, hash, entries). A file of unchanged content brings nothing, one that only grew its new entries
    (mode tail), a new or changed one all (mode new, rebuild). The date stands in the file's name; files without one are
    left out. Entries begin with a line `## header`."""
    date = F.regexp_extract(F.element_at(F.split("source_file", "/"), -1), r"(\d{4}-\d{2}-\d{2})", 1)
    parts = F.slice(F.split(F.concat(F.lit("\n"), "text"), r"\n## "), 2, 1 << 30)
    f = files.select("source_file", date.alias("date"), F.col("text"), parts.alias("parts"), F.sha2("text", 256).alias("now")).where("date <> ''")
    f = f.join(state.select("source_file", "size", "hash", "entries"), "source_file", "left")
    grew = F.sha2(F.substr("text", F.lit(1), F.col("size")), 256) == F.col("hash")
    mode = F.when(F.col("hash").isNull(), "new").when(F.col("hash") == F.col("now"), "same").when(grew, "tail").otherwise("rebuild")
    f = f.withColumn("mode", mode).where("mode <> 'same'").select("source_file", "date", "mode", "entries", F.posexplode("parts").alias("entry", "part"))
    f = f.where((F.col("mode") != "tail") | (F.col("entry") >= F.col("entries")))
    return f.select("source_file", "date", "mode", "entry", F.regexp_extract("part", r"^([^\n]*)", 1).alias("header"), F.trim(F.regexp_replace("part", r"^[^\n]*\n?", "")).alias("document"))


def diary_state(files: DataFrame) -> DataFrame:
    """The state after these files: source_file, size, hash, entries."""
    n = F.size(F.split(F.concat(F.lit("\n"), "text"), r"\n## ")) - 1
    return files.select("source_file", F.length("text").alias("size"), F.sha2("text", 256).alias("hash"), n.alias("entries"))


def due_for_save(counts: DataFrame, saved: DataFrame, every: int = 15) -> DataFrame:
    """Sessions (conv_id, n) with at least `every` human messages more than when they were last saved (conv_id, n)."""
    s = saved.select("conv_id", F.col("n").alias("had"))
    return counts.join(s, "conv_id", "left").where(F.col("n") - F.coalesce("had", F.lit(0)) >= every).select("conv_id", "n")


def windowed_counts(events: DataFrame, width: str = "1 day", lateness: str = "1 day") -> DataFrame:
    """Counts and sums by event type and window, with a watermark; `ts` may be without time zone."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
    w = F.window("ts", width)
    return e.groupBy(w.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Event counts by user and session window."""
    return events.groupBy("user_id", F.session_window("ts", gap).alias("s")).agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("s.start").alias("start"), "n")
