"""Exact repeated-passage removal on words, with difference-cover anchors.

A difference cover D modulo v has, for any residues a and b, a shift d < v with a + d and b + d both in D. Two equal
runs of at least w + v - 1 words, wherever they stand, therefore both have an anchor (a window of w words that starts
at a position in D modulo v) at the same distance from their start. So only anchors are compared over the whole corpus,
and only the windows around an anchor that occurs in two documents are looked at in full: by 96 bits, of two independent hashes of their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import M2, U, inside, member, pieces, row_of, runs, span_hashes, texts, window_hashes, word_spans
from .exchange import ANSWER, MESSAGE, MESSAGE_SCHEMA, answer_arrays, by_shard, each_shard, gather, ids_of, known_already, numbered, packed, passed_on, per_batch, shard_count, shared_keys, shards_of, tags


def difference_cover(v: int) -> tuple[int, ...]:
    """A smallest difference cover modulo v, by search in increasing size."""
    from itertools import combinations

    for n in range(1, v + 1):
        for d in combinations(range(v), n):
            if len({(a - b) % v for a in d for b in d}) == v:
                return d
    raise AssertionError


def _words(b: np.ndarray, off: np.ndarray):
    s, e, first = word_spans(b, off)
    return s, e, first, span_hashes(b, s, e)


def _anchors(first: np.ndarray, h: np.ndarray, v: int, w: int, cover: tuple[int, ...], window: int):
    """Position and hash of the anchors that some whole window of their row can hold."""
    n = len(h)
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, U), np.zeros(0, np.int64)
    row = row_of(first, n)
    place = np.arange(n) - first[row]
    ok = np.isin(place % v, cover)[: n - w + 1] & inside(first, n, w) & (np.diff(first)[row] >= window)[: n - w + 1]
    at = np.flatnonzero(ok)
    return at, window_hashes(h, w)[at], row[at]


def repeated_words(docs: DataFrame, window: int = 13, period: int = 7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row, the word positions covered by a `window`-word passage that also starts in a smaller id.

    Words are runs of bytes other than space and tab to carriage return, unchanged. Passages never cross documents and
    are judged on the input. Null text has no words; null ids neither lose words nor make others lose any; rows that
    share an id judge each other as one document would; texts of fewer than `window` words lose nothing.
    Returns the id, text, n_words (long), removed (array<int>: word positions, ascending) and kept (binary, UTF-8:
    remaining words joined by one space).
    """
    v, w = period, window - period + 1
    if not 1 <= period < window:
        raise ValueError("period must be at least 1 and less than window")
    cover = difference_cover(v)
    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    shards = shard_count(d)

    def anchor_keys(b: np.ndarray, off: np.ndarray):
        _, _, first, h = _words(b, off)
        _, key, row = _anchors(first, h, v, w, cover, window)
        return row, key

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The full windows around each shared anchor: the smallest id of the batch asks, larger ones have their answer."""
        for number, batch in numbered(batches):
            ids, _ = ids_of(batch)
            b, off = texts(batch.column("text"))
            s, e, first, h = _words(b, off)
            at, key, row = _anchors(first, h, v, w, cover, window)
            if not len(at):
                continue
            tag, hit = tags(key, shards), np.zeros(len(at), bool)
            bounds = np.searchsorted(row, np.arange(batch.num_rows + 1))
            for r, found in enumerate(answer_arrays(batch)):
                hit[bounds[r] : bounds[r + 1]] = member(tag[bounds[r] : bounds[r + 1]], np.unique(found))
            starts = np.zeros(len(h), bool)
            for shift in range(v):
                p = at[hit] - shift
                starts[p[p >= first[row[hit]]]] = True
            ok = inside(first, len(h), window)
            at = np.flatnonzero(starts[: len(ok)] & ok)
            if not len(at):
                continue
            second = (window_hashes(span_hashes(b, s, e, M2, np.uint32), window) >> U(32)).astype(np.uint32)
            yield _ask_smallest(number, ids[row_of(first, len(h))[at]], window_hashes(h, window)[at], second[at], shards)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            b, off = texts(batch.column("text"))
            s, e, first, h = _words(b, off)
            full, ok = window_hashes(h, window), inside(first, len(h), window)
            gone = np.zeros(len(h) + 1, np.int64)
            for r, found in enumerate(answer_arrays(batch)):
                if len(found):
                    i, j = first[r], max(first[r], first[r + 1] - window + 1)
                    p = i + np.flatnonzero(member(full[i:j], np.unique(found)) & ok[i:j])
                    np.add.at(gone, p, 1)
                    np.add.at(gone, p + window, -1)
            gone = np.cumsum(gone)[:-1] > 0
            data, removed, kept = b.tobytes(), [], []
            for r in range(batch.num_rows):
                i, j = first[r], first[r + 1]
                g = gone[i:j]
                removed.append(np.flatnonzero(g).astype(np.int32))
                k = i + np.flatnonzero(~g)
                kept.append(b" ".join([data[x:y] for x, y in zip(s[k].tolist(), e[k].tolist())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text"), pa.array(np.diff(first), pa.int64()), pa.array(removed, pa.list_(pa.int32())), pa.array(kept, pa.binary())],
                ["doc_id", "text", "n_words", "removed", "kept"],
            )

    # Both joins read the same shuffle of the texts; rows with null ids go past them.
    known = d.where("doc_id is not null")
    anchored = known.join(gather(shared_keys(known, anchor_keys, shards)), "doc_id")
    found = gather(smallest_owner(anchored.mapInArrow(extend, MESSAGE), shards))
    schema = "doc_id long, text string, n_words long, removed array<int>, kept binary"
    out = known.join(found, "doc_id", "left").mapInArrow(cut, schema)
    lost = d.where("doc_id is null").withColumn("answers", F.array().cast("array<binary>")).mapInArrow(cut, schema)
    return out.unionByName(lost).withColumnsRenamed({"doc_id": id_col, "text": text_col})


def _ask_smallest(number: int, doc: np.ndarray, key: np.ndarray, second: np.ndarray, shards: int) -> pa.RecordBatch:
    """Each window once per document, under two hashes; answers name it by the first, which only has to tell a
    document's own windows apart."""
    order = np.lexsort((doc, second, key))
    doc, key, second = doc[order], key[order], second[order]
    change = np.ones(len(key), bool)
    change[1:] = (key[1:] != key[:-1]) | (second[1:] != second[:-1])
    new = change.copy()
    new[1:] |= doc[1:] != doc[:-1]
    doc, key, second, asks = doc[new], key[new], second[new], change[new]
    rows = []
    for s, x in packed(shards_of(key[asks], shards), [(doc[asks], "docs"), (key[asks], "keys"), (second[asks], "known")]):
        names, idx = np.unique(np.frombuffer(x["docs"], np.int64), return_inverse=True)
        x["docs"], x["idx"] = names.tobytes(), idx.astype(np.uint16 if len(names) < 1 << 16 else np.uint32).tobytes()
        rows.append({"shard": s, "batch": number, **x})
    rows += known_already(number, doc[~asks], key[~asks], shards)  # a smaller id of this batch holds the window
    return pa.RecordBatch.from_pylist(rows, MESSAGE_SCHEMA)


def smallest_owner(asked: DataFrame, shards: int) -> DataFrame:
    """Answers for those windows that a smaller doc_id holds too."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in each_shard(batches):
            if shard < 0:
                yield passed_on(rows)
                continue
            key, second = (np.concatenate([np.frombuffer(r[x], t) for r in rows]) for x, t in (("keys", U), ("known", np.uint32)))
            blob = np.repeat(np.arange(len(rows)), [len(r["keys"]) // 8 for r in rows])
            doc = np.concatenate([np.frombuffer(r["docs"], np.int64)[np.frombuffer(r["idx"], np.uint16 if 4 * len(r["idx"]) == len(r["keys"]) else np.uint32)] for r in rows])
            order = np.lexsort((doc, second, key))
            doc, key, second, blob = doc[order], key[order], second[order], blob[order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (second[1:] != second[:-1])
            first = np.flatnonzero(new)
            late = doc > np.repeat(doc[first], np.diff(np.append(first, len(key))))
            yield per_batch(blob[late], doc[late], key[late], [r["batch"] for r in rows])

    return by_shard(asked, shards).mapInArrow(meet, ANSWER)
