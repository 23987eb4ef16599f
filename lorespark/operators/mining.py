"""Mining: files and transcripts into stored chunks and index lines, each source replaced as a whole or left alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import best_label, bound, hex_id, strip
from ..sources.store import LINES, MemoryStore
from . import chunks, entities, memories

#: The version of normalised text; sources stored with a smaller one are read again.
VERSION = 3
#: Characters in which names and the hall are looked for.
NAMES_WINDOW, HALL_WINDOW = 5000, 3000


def outdated(files: DataFrame, store: MemoryStore, mode: str, by_time: bool) -> DataFrame:
    """The files (source_file, mtime) of which the store has nothing current: nothing of this mode (any mode, for
    `files`), an older version, or, with `by_time`, another time by a thousandth of a second or more."""
    have = store.sources()
    if mode != "files":
        have = have.where(F.col("mode") == mode)
    have = have.groupBy("source_file").agg(F.max("normalize_version").alias("v__"), F.max_by("source_mtime", "run").alias("m__"))
    same = F.col("v__") >= VERSION
    if by_time:
        same = same & F.coalesce(F.abs(F.col("mtime") - F.col("m__")) < 0.001, F.lit(False))
    return files.join(have, "source_file", "left").where(~F.coalesce(same, F.lit(False))).drop("v__", "m__")


def hall_of(document: Column) -> Column:
    return best_label(F.lower(F.substring(document, 1, HALL_WINDOW)), chunks.HALLS, "general")


def names_of(document: Column, known: tuple[str, ...]) -> Column:
    """Names for a chunk's metadata: known ones anywhere, others in its beginning."""
    return bound(entities.names_in(F.substring(document, 1, NAMES_WINDOW)), lambda found: entities.metadata_names(document, found, known))


def _described(rows: DataFrame, key: Column, mode: str, ingest: str | None, known: tuple[str, ...]) -> DataFrame:
    """(source_file, chunk_index, document, wing, room, mtime) as stored chunks."""
    name = F.concat(F.lit("drawer_"), F.col("wing"), F.lit("_"), F.col("room"), F.lit("_"), hex_id(key))
    names = F.nullif(names_of(F.col("document"), known), F.lit("")) if mode == "files" else F.lit(None).cast("string")
    return rows.select(
        name.alias("id"), "source_file", F.lit(mode).alias("mode"), "chunk_index", "document", "wing", "room", hall_of(F.col("document")).alias("hall"),
        names.alias("entities"), F.lit(ingest).cast("string").alias("ingest_mode"), F.col("mtime").alias("source_mtime"), F.lit(VERSION).alias("normalize_version"),
        F.current_timestamp().alias("filed_at"),
    )


def index_documents(sources: DataFrame, known: tuple[str, ...] = ()) -> DataFrame:
    """(id, source_file, mode, document, wing, room, chunks, entities, normalize_version): the index lines of each source
    (source_file, wing, room, ids, chunks, document), packed into documents that are numbered from 01."""
    d = entities.index_lines(sources.withColumn("document", strip(F.col("document"))))
    packed = d.groupBy("source_file").agg(F.sort_array(F.collect_list(F.struct("line_no", "line"))).alias("ls"))  # at most 15 lines
    packed = packed.select("source_file", F.posexplode(entities.packed_lines(F.transform("ls", lambda x: x["line"]))).alias("n", "packed"))
    out = packed.join(sources, "source_file")
    number = F.lpad((F.col("n") + 1).cast("string"), 2, "0")
    name = F.concat_ws("_", F.lit("closet"), "wing", "room", hex_id(F.col("source_file")), number)
    names = F.nullif(names_of(F.col("document"), known), F.lit(""))
    return out.select(name.alias("id"), "source_file", F.lit("files").alias("mode"), F.col("packed").alias("document"), "wing", "room", "chunks", names.alias("entities"), F.lit(VERSION).alias("normalize_version"))


def mine_files(
    store: MemoryStore,
    files: DataFrame,
    wing: str,
    rooms: dict[str, list[str]],
    known: tuple[str, ...] = (),
    size: int = 800,
    overlap: int = 100,
    least: int = 50,
    most: int = 500,
    root: str = "",
) -> str | None:
    """Read files (source_file, mtime, document) into the store and return the run's name (none if nothing changed).

    Files that the store has at their time and version are left alone. The others are cut into overlapping chunks, get
    the room that their path below `root`, or their text, tells, and replace all that the store has of them. Files of
    fewer than `least` stripped characters, without chunks or with more than `most` are passed over: what is stored of
    them stays. Null texts count as empty; of repeated paths the latest time, then the largest text, is read.
    """
    latest = files.groupBy("source_file").agg(F.max(F.struct("mtime", F.coalesce("document", F.lit("")).alias("document"))).alias("x")).select("source_file", "x.*")
    todo = outdated(latest, store, "files", by_time=True).withColumn("document", strip(F.col("document"))).where(F.length("document") >= least)
    below = F.when(F.col("source_file").startswith(root + "/"), F.substr("source_file", F.lit(len(root) + 2))).otherwise(F.col("source_file")) if root else F.col("source_file")
    todo = todo.withColumn("wing", F.lit(wing)).withColumn("room", chunks.room_of(below, F.col("document"), rooms))

    def stage(put) -> None:
        cut = chunks.chunk_overlap(todo.select(F.col("source_file").alias("id"), "document"), size, overlap, least, most)
        met = cut.withColumnRenamed("id", "source_file").join(todo.select("source_file", "wing", "room", "mtime"), "source_file")
        put("chunks", _described(met, F.concat("source_file", F.col("chunk_index").cast("string")), "files", None, known))
        _finish(store, put, "files", todo, known)

    return store.write(stage)


def _finish(store: MemoryStore, put, mode: str, todo: DataFrame, known: tuple[str, ...]) -> None:
    """Sources and index lines of the chunks that this run has written."""
    written = put.written["chunks"]
    told = written.groupBy("source_file").agg(
        F.first("source_mtime").alias("source_mtime"), F.count_if(F.col("ingest_mode").isNull() | (F.col("ingest_mode") != "registry")).alias("chunks"), F.first("wing").alias("wing"), F.first("room").alias("room"),
        F.transform(F.sort_array(F.collect_list(F.when(F.col("chunk_index") < 3, F.struct("chunk_index", "id")))), lambda x: x["id"]).alias("ids"),
    )
    if mode == "files":
        put("lines", index_documents(told.join(todo.select("source_file", "document"), "source_file"), known))
    else:
        put("lines", store.spark.createDataFrame([], LINES))
    put("sources", told.select("source_file", F.lit(mode).alias("mode"), "source_mtime", F.lit(VERSION).alias("normalize_version"), "chunks"))


def mine_transcripts(store: MemoryStore, files: DataFrame, wing: str, mode: str = "exchange", least: int = 30, size: int = 800, separator: str | None = None, rebuild: bool = False) -> str | None:
    """Read normalised transcripts (source_file, document) into the store, by exchanges or, with mode `general`, by the
    memories in them, and return the run's name.

    Transcripts don't change: one that the store has in this mode and version is left alone, unless `rebuild`. The rooms
    are the chunks' topics, or the kinds of memories. A transcript may hold several threads, told apart by `separator`;
    chunks are numbered through. One without chunks is remembered by a registry row. Chunks of other modes stay.
    """
    if mode not in ("exchange", "general"):
        raise ValueError("mode is exchange or general")
    latest = files.groupBy("source_file").agg(F.max(F.coalesce("document", F.lit(""))).alias("document"))
    todo = (latest if rebuild else outdated(latest, store, mode, by_time=False)).withColumn("mtime", F.lit(None).cast("double"))
    parts = F.split("document", F.lit("\\Q" + separator + "\\E")) if separator else F.array("document")
    threads = todo.where(F.length(strip(F.col("document"))) >= least).select("source_file", F.posexplode(F.filter(F.transform(parts, strip), lambda x: x != "")).alias("thread", "document"))
    threads = threads.select(F.struct("source_file", "thread").alias("id"), "document")
    found = chunks.transcript_chunks(threads, size, least) if mode == "exchange" else memories.memories(threads)
    room = chunks.topic_room(F.col("document")) if mode == "exchange" else F.col("memory_type")
    # Threads are few to a file; chunks are numbered within threads, then threads follow each other.
    sizes = found.groupBy("id").agg(F.count(F.lit(1)).alias("n")).groupBy("id.source_file").agg(F.sort_array(F.collect_list(F.struct("id.thread", "n"))).alias("ns"))
    before = F.aggregate(F.filter("ns", lambda x: x["thread"] < F.col("id.thread")), F.lit(0).cast("long"), lambda a, x: a + x["n"])
    numbered = found.withColumn("source_file", F.col("id.source_file")).join(sizes, "source_file")
    numbered = numbered.select("source_file", (F.col("chunk_index") + before).cast("int").alias("chunk_index"), "document", F.lit(wing).alias("wing"), room.alias("room"), F.lit(None).cast("double").alias("mtime"))

    def stage(put) -> None:
        key = F.concat("source_file", F.lit(f":{mode}:"), F.col("chunk_index").cast("string"))
        rows = _described(numbered, key, mode, "convos", ())
        empty = todo.select("source_file").join(numbered.select("source_file").distinct(), "source_file", "left_anti")
        mark = F.concat(F.lit("_reg_"), hex_id(F.concat("source_file", F.lit(f":{mode}"))))
        registry = empty.select(
            mark.alias("id"), "source_file", F.lit(mode).alias("mode"), F.lit(0).alias("chunk_index"), F.concat(F.lit("[registry] "), "source_file").alias("document"), F.lit(wing).alias("wing"),
            F.lit("_registry").alias("room"), F.lit(None).cast("string").alias("hall"), F.lit(None).cast("string").alias("entities"), F.lit("registry").alias("ingest_mode"),
            F.lit(None).cast("double").alias("source_mtime"), F.lit(VERSION).alias("normalize_version"), F.current_timestamp().alias("filed_at"),
        )
        put("chunks", rows.unionByName(registry))
        _finish(store, put, mode, todo, ())

    return store.write(stage)
