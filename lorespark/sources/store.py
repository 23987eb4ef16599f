"""The stored chunks and index lines: runs of a mine, which count once they are committed."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNKS = (
    "id string, source_file string, mode string, chunk_index int, document string, wing string, room string, hall string, entities string, "
    "ingest_mode string, source_mtime double, normalize_version int, filed_at timestamp"
)
LINES = "id string, source_file string, mode string, document string, wing string, room string, chunks long, entities string, normalize_version int"
SOURCES = "source_file string, mode string, source_mtime double, normalize_version int, chunks long"
COMMITS = "run string, added long"
TABLES = {"chunks": CHUNKS, "lines": LINES, "sources": SOURCES}
#: What a source was read for: a mine of files replaces all that is known of it, a mine of transcripts only its own mode.
MODES = ("files", "exchange", "general")


class MemoryStore:
    """Chunks, index lines and sources below one folder, as Parquet by run.

    A run stages its three tables under its own name and then adds one row to `commits`; readers take committed runs
    alone, and of each source the latest run that replaces it. So a source changes as a whole, a run that dies leaves
    everything as it was, and what it staged is never read. Nothing is rewritten in place. Of two runs that commit at the
    same time, both count, and the one with the larger name wins the sources that both replace.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def runs(self) -> list[str]:
        """The committed runs in order: one short name for each mine."""
        try:
            rows = self.spark.read.schema(COMMITS).parquet(f"{self.folder}/commits").select("run").collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted(r["run"] for r in rows)

    def _all(self, table: str, runs: list[str]) -> DataFrame:
        schema = f"{TABLES[table]}, run string"
        if not runs:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.folder}/{table}/run={r}" for r in runs]
        return self.spark.read.schema(schema).option("basePath", f"{self.folder}/{table}").parquet(*paths)

    def sources(self, runs: list[str] | None = None) -> DataFrame:
        """(source_file, mode, source_mtime, normalize_version, chunks, run): what is current of each source, one row a mode."""
        runs = self.runs() if runs is None else runs
        last = [F.max(F.when(F.col("mode") == m, F.struct("run", "source_mtime", "normalize_version", "chunks"))).alias(m) for m in MODES]
        by = self._all("sources", runs).groupBy("source_file").agg(*last)
        kept = [F.when(F.lit(m == "files") | F.col("files").isNull() | (F.col(f"{m}.run") > F.col("files.run")), F.struct(F.lit(m).alias("mode"), f"{m}.*")) for m in MODES]
        one = by.select("source_file", F.explode(F.array(*kept)).alias("x")).where("x.run is not null")
        return one.select("source_file", "x.mode", "x.source_mtime", "x.normalize_version", "x.chunks", "x.run")

    def _current(self, table: str) -> DataFrame:
        runs = self.runs()
        live = self.sources(runs).select("source_file", "mode", "run")
        return self._all(table, runs).join(live, ["source_file", "mode", "run"], "left_semi")

    def chunks(self) -> DataFrame:
        return self._current("chunks")

    def lines(self) -> DataFrame:
        return self._current("lines")

    def write(self, stage: Callable[[Callable[[str, DataFrame], DataFrame]], None]) -> str | None:
        """Let `stage` put the tables of a new run, then commit it; returns its name, or nothing if no source changed.

        `stage` gets a function put(table, rows) that writes one of the tables and returns it as written; put.written has
        those that are.
        """
        known = self.runs()
        run = f"{int(known[-1].split('-')[0]) + 1 if known else 1:09d}-{uuid.uuid4().hex[:12]}"

        def put(table: str, rows: DataFrame) -> DataFrame:
            path = f"{self.folder}/{table}/run={run}"
            schema = self.spark.createDataFrame([], TABLES[table]).schema
            rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]).write.parquet(path)
            put.written[table] = self.spark.read.schema(schema).parquet(path)
            return put.written[table]

        put.written = {}
        stage(put)
        added = self.spark.read.schema(SOURCES).parquet(f"{self.folder}/sources/run={run}").count()
        if not added:
            return None
        self.spark.createDataFrame([(run, added)], COMMITS).coalesce(1).write.mode("append").parquet(f"{self.folder}/commits")
        return run
