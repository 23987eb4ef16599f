"""Packing token streams into fixed-length sequences: first-fit decreasing with a tournament tree per random group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, shuffle_partitions
from .tokens import crc32_of, default_vocabulary, encoded

END_ID = 1


class CapacityTree:
    """A tournament tree whose leaves are bins, in order of opening, and whose inner nodes hold the largest room below.

    `place(n)` finds the first bin with room for n in O(log bins): unopened bins count as having full room, so the
    search also opens new ones.
    """

    def __init__(self, bins: int, capacity: int):
        self.size = 1
        while self.size < max(1, bins):
            self.size *= 2
        self.room = [capacity] * (2 * self.size)
        self.capacity = capacity

    def place(self, n: int) -> tuple[int, int]:
        """(bin, offset inside it) for a piece of n items, 1 <= n <= capacity."""
        room, i = self.room, 1
        while i < self.size:
            i *= 2
            if room[i] < n:
                i += 1
        bin_, offset = i - self.size, self.capacity - room[i]
        room[i] -= n
        i //= 2
        while i:
            best = max(room[2 * i], room[2 * i + 1])
            if room[i] == best:
                break
            room[i] = best
            i //= 2
        return bin_, offset


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; longest first, ties by position."""
    order = np.argsort(-lengths, kind="stable")
    tree = CapacityTree(len(lengths), capacity)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in order.tolist():
        bins[i], offsets[i] = tree.place(int(lengths[i]))
    return bins, offsets


def pack(
    docs: DataFrame,
    sequence_length: int = 2048,
    vocabulary: str | None = None,
    payload: str = "ids",
    group_pieces: int = 8192,
    seed: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pack every document, ended by id 1, into sequences of at most `sequence_length` ids.

    A document is cut at multiples of `sequence_length`; whole pieces fill a sequence each, outside all groups, and the rest is packed
    first-fit decreasing inside random groups of about `group_pieces` pieces. The pieces are written once, so that their
    number, and with it the number of groups, is known whatever Spark's settings; each then draws its group, so copies
    and neighbours spread. A task holds one group at a time and groups are independent.

    payload: "ids" returns the pieces' ids (array<int>), "crc32" only their checksum, made before the shuffle.
    Null text counts as empty: one piece with the end id alone. Repeated rows are packed as often as they occur; null
    ids are kept; an empty table gives no rows; other columns are ignored.
    Returns id, start, length, ids | ids_crc32, doc_tokens, sequence_id, offset, sequence_tokens.
    """
    if payload not in ("ids", "crc32"):
        raise ValueError("payload is ids or crc32")
    path, raw = vocabulary or default_vocabulary(), payload == "ids"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, all_ids in encoded(batches, path, "text"):
            doc, start, length, crc, total, body = [], [], [], [], [], []
            for i, ids in zip(batch.column("id").to_pylist(), all_ids):
                a = np.array([*ids, END_ID], np.uint32)
                for s in range(0, len(a), sequence_length):
                    piece = a[s : s + sequence_length]
                    doc.append(i), start.append(s), length.append(len(piece)), crc.append(crc32_of(piece)), total.append(len(a))
                    if raw:
                        body.append(piece.astype(np.int32))
            columns = [pa.array(x, pa.int64()) for x in (doc, start, length, crc, total)] + [pa.array(body, pa.list_(pa.int32()))] * raw
            yield pa.RecordBatch.from_arrays(columns, ["id", "start", "length", "crc", "total", *["body"] * raw])

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            g = b.column("g").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(g)) + 1).tolist(), b.num_rows] if b.num_rows else []
            for i, j in zip(cuts, cuts[1:]):
                if held and held[-1].column("g")[0].as_py() != int(g[i]):
                    yield held[-1].column("g")[0].as_py(), pa.Table.from_batches(held)
                    held = []
                held.append(b.slice(i, j - i))
        if held:
            yield held[-1].column("g")[0].as_py(), pa.Table.from_batches(held)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g, t in groups(batches):
            lengths = t.column("length").to_numpy()
            bins, offsets = first_fit_decreasing(lengths, sequence_length)
            used = np.bincount(bins, weights=lengths).astype(np.int64)
            out = [t.column(c) for c in ("id", "start", "length")] + [t.column("body" if raw else "crc")]
            out += [t.column("total"), pa.array(bins + (g << 32)), pa.array(offsets), pa.array(used[bins])]
            yield from pa.table(out, ["id", "start", "length", "load", "doc_tokens", "sequence_id", "offset", "sequence_tokens"]).to_batches(2048)

    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    pieces = d.mapInArrow(cut, "id long, start long, length long, crc long, total long" + ", body array<int>" * raw)
    pieces = cut_lineage(pieces)
    partial = pieces.where(F.col("length") < sequence_length)
    full = pieces.where(F.col("length") == sequence_length)
    n_groups = max(1, -(-partial.count() // group_pieces))
    tasks = max(1, min(n_groups, max(shuffle_partitions(docs.sparkSession), -(-n_groups // 64))))
    # Drawn on the written pieces, the group of a row stays the same when its task runs again.
    dealt = partial.withColumn("g", F.floor(F.rand(seed) * n_groups))
    dealt = dealt.repartition(tasks, "g").sortWithinPartitions("g", "id", "start", "crc", "total")
    load = "array<int>" if raw else "long"
    placed = dealt.mapInArrow(place, f"id long, start long, length long, load {load}, doc_tokens long, sequence_id long, offset long, sequence_tokens long")
    # A whole piece is a sequence of its own, numbered beyond all groups: no task gathers them.
    own = F.monotonically_increasing_id().bitwiseOR(F.lit(1 << 62))
    alone = full.select("id", "start", "length", F.col("body" if raw else "crc").alias("load"), F.col("total").alias("doc_tokens"), own.alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.col("length").alias("sequence_tokens"))
    placed = placed.unionByName(alone)
    return placed.withColumnsRenamed({"id": id_col, "load": "ids" if raw else "ids_crc32"})
