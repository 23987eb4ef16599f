"""Sources as Spark data sources, found by name: an explicit choice, then a configured one, then the default."""

from __future__ import annotations

import io
import json
import time
from collections.abc import Iterator

import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

DEFAULT = "session_messages"


class FilesPart(InputPartition):
    """Whole files that one task reads, one after the other."""

    def __init__(self, paths: list[str]):
        super().__init__(tuple(paths))
        self.paths = paths


def flat(content: object) -> str:
    """The text of a message: itself, or that of its blocks by line, blocks of other types as their JSON in full."""
    if isinstance(content, list):
        text = lambda b: b.get("text") if isinstance(b, dict) and b.get("type") == "text" else json.dumps(b, ensure_ascii=False, separators=(",", ":"))
        return "\n".join(t for t in map(text, content) if isinstance(t, str))
    return content if isinstance(content, str) else ""


class Messages:
    """Plain messages of JSON lines below a path of any file system that Arrow knows (`file:`, `hdfs:`, `s3:`, ...).

    Options: `suffix` of the files (`.jsonl`), `since` (seconds; older files are left out), `bytes` (64 MB: small files are
    dealt to one task up to that many) and, of the stream, `settle`.
    """

    def __init__(self, options: dict):
        self.root, self.suffix = options["path"], options.get("suffix", ".jsonl")
        self.since, self.bytes, self.settle = float(options.get("since", 0)), int(options.get("bytes", 64 << 20)), float(options.get("settle", 2))

    def files(self) -> list[tuple[int, str, int]]:
        """(time in ns, path, bytes) of the files, by time and path."""
        system, root = pafs.FileSystem.from_uri(self.root)
        here = system.get_file_info(root)
        found = [here] if here.is_file else [f for f in system.get_file_info(pafs.FileSelector(root, recursive=True)) if f.is_file and f.path.endswith(self.suffix)]
        return sorted((f.mtime_ns, f.path, f.size) for f in found if f.mtime_ns >= self.since * 1e9)

    def dealt(self, files: list[tuple[int, str, int]]) -> list[FilesPart]:
        parts, room = [], 0
        for _, path, size in files:
            if not parts or size > room:
                parts.append([])
                room = self.bytes
            parts[-1].append(path)
            room -= size
        return [FilesPart(p) for p in parts]

    def read(self, partition: FilesPart | None) -> Iterator[tuple]:
        system, _ = pafs.FileSystem.from_uri(self.root)
        for path in getattr(partition, "paths", ()):
            with system.open_input_stream(path) as f:
                for pos, line in enumerate(io.TextIOWrapper(f, encoding="utf-8", errors="replace")):
                    try:
                        m = json.loads(line)
                        content = flat(m["message"]["content"])
                        if m["type"] in ("user", "assistant") and content.strip():
                            yield path, pos, m["sessionId"], m["uuid"], m["timestamp"], m["type"], content
                    except (ValueError, KeyError, TypeError):
                        continue


class MessageReader(Messages, DataSourceReader):
    def partitions(self) -> list[FilesPart]:
        return self.dealt(self.files())


class MessageStream(Messages, DataSourceStreamReader):
    """Files as they come. An offset is the time and path of the last file taken, so its size doesn't grow with the files,
    and a query that starts again goes on from its checkpoint. A file that is written again has a new time and is read
    again whole: drop its known messages by `message_uuid`, as the sweep does. Files younger than `settle` seconds (2) wait,
    so that none turns up behind the offset; a file that is moved in must not keep an older time."""

    def initialOffset(self) -> dict:
        return {"ns": -1, "path": ""}

    def latestOffset(self) -> dict:
        settled = [f for f in self.files() if f[0] <= (time.time() - self.settle) * 1e9]
        return {"ns": settled[-1][0], "path": settled[-1][1]} if settled else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[FilesPart]:
        low, high = ((o["ns"], o["path"]) for o in (start, end))
        return self.dealt([f for f in self.files() if low < f[:2] <= high])


class SessionMessages(DataSource):
    """`spark.read.format("session_messages").load(folder)`: messages of session files below a folder, as a table
    or, by `spark.readStream`, as a stream. The driver and all executors must see the folder."""

    @classmethod
    def name(cls) -> str:
        return "session_messages"

    def schema(self) -> str:
        return "path string, pos int, session_id string, message_uuid string, timestamp string, role string, text string"

    def reader(self, schema) -> MessageReader:
        return MessageReader(self.options)

    def streamReader(self, schema) -> MessageStream:
        return MessageStream(self.options)


SOURCES: dict[str, type[DataSource]] = {SessionMessages.name(): SessionMessages}


def register(spark: SparkSession, *sources: type[DataSource]) -> None:
    """Make sources known by name to this session, the built-in ones without arguments."""
    for s in sources or tuple(SOURCES.values()):
        SOURCES[s.name()] = s
        spark.dataSource.register(s)


def resolved(explicit: str | None = None, configured: str | None = None) -> str:
    """The source's name to use; one that nobody registered is an error."""
    name = explicit or configured or DEFAULT
    if name not in SOURCES:
        raise ValueError(f"no source is called {name}; known: {', '.join(sorted(SOURCES))}")
    return name
