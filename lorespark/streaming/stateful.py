"""Streams with a state of their own for each key: saves every so many messages, and entries of growing diaries."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

DATE = re.compile(r"(\d{4}-\d{2}-\d{2})")


def save_triggers(messages: DataFrame, every: int = 15) -> DataFrame:
    """(session_id, nth, messages): one row each time a session's human messages reach another multiple of `every`.

    messages: a stream of session_id, role, text. Messages of the user count unless they are blank or commands. The state
    of a session is its count, so a trigger comes once, whatever the batches and restarts. Tasks count before the
    shuffle: a session with a third of all messages sends one row a task. Rows without a session are left out.
    """
    human = (F.col("role") == "user") & F.col("text").rlike(r"\S") & ~F.contains("text", F.lit("<command-message>"))

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for f in frames:
            here = f.groupby("session_id").size()
            total = here if total is None else total.add(here, fill_value=0)
            if len(total) > 100_000:
                yield total.astype("int64").rename("n").rename_axis("session_id").reset_index()
                total = None
        if total is not None:
            yield total.astype("int64").rename("n").rename_axis("session_id").reset_index()

    def fire(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        before = state.get[0] if state.exists else 0
        now = before + sum(int(f["n"].sum()) for f in frames)
        state.update((now,))
        nth = list(range(before // every + 1, now // every + 1))
        yield pd.DataFrame({"session_id": [key[0]] * len(nth), "nth": nth, "messages": [n * every for n in nth]})

    said = messages.where("session_id is not null").where(human).select("session_id")
    kind = dict(messages.dtypes)["session_id"]
    counts = said.mapInPandas(counted, f"session_id {kind}, n long")
    return counts.groupBy("session_id").applyInPandasWithState(fire, f"session_id {kind}, nth long, messages long", "n long", "append", GroupStateTimeout.NoTimeout)


def split_entries(text: str) -> list[tuple[str, str]]:
    """The entries of a day's file: (header, body) of each part that begins with a line `## header`."""
    parts = ("\n" + text).split("\n## ")[1:]
    return [(p.split("\n", 1)[0], p.split("\n", 1)[1].strip() if "\n" in p else "") for p in parts]


def diary_entries(files: DataFrame) -> DataFrame:
    """(source_file, date, mode, entry, header, document): what each version of a day's file brings beyond the last one.

    files: a stream of source_file, mtime, text. A file of unchanged content brings nothing, one that only grew its new
    entries (mode tail), a first or changed one all of them (mode new, rebuild: readers replace what they had). Versions
    that come in one batch are taken by time. The state of a file is its length, hash and number of entries, never its
    text. The date stands in the file's name; files without one are left out, and a null text counts as empty.
    """

    def changed(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        size, known, had = state.get if state.exists else (0, "", 0)
        rows: list[tuple[Any, ...]] = []
        name = DATE.search(key[0].rsplit("/", 1)[-1])
        versions = sorted(((m, t or "") for f in frames for m, t in zip(f["mtime"], f["text"])), key=lambda x: (x[0] is not None and x[0] == x[0], x[0] or 0)) if name else []
        for _, text in versions:
            now = hashlib.sha256(text.encode()).hexdigest()
            if now == known:
                continue
            mode = "new" if not known else "tail" if hashlib.sha256(text[:size].encode()).hexdigest() == known else "rebuild"
            entries = split_entries(text)
            rows += [(key[0], name[1], mode, n, *e) for n, e in enumerate(entries) if mode != "tail" or n >= had]
            size, known, had = len(text), now, len(entries)
        state.update((size, known, had))
        yield pd.DataFrame(rows, columns=["source_file", "date", "mode", "entry", "header", "document"])

    out = "source_file string, date string, mode string, entry long, header string, document string"
    f = files.where("source_file is not null").select("source_file", F.col("mtime").cast("double").alias("mtime"), "text")
    return f.groupBy("source_file").applyInPandasWithState(changed, out, "size long, hash string, entries long", "append", GroupStateTimeout.NoTimeout)
