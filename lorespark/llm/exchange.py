"""A packed shuffle for "which other documents hold this key?": two questions asked of all keys of a corpus.

Every map batch sends, per shard, one row with packed arrays instead of one row per key; keys that several documents
of a batch share are combined before they are sent, so a key that a third of all documents hold arrives once per map
batch. Answers come back as one packed row per shard and map batch, and are dealt out to the documents from there, so
the number of rows grows with that of map batches and not with documents times shards.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import U, binary_rows, pieces, runs, texts
from .common import shuffle_partitions

MESSAGE = "shard int, batch long, docs binary, idx binary, keys binary, known binary"
MESSAGE_SCHEMA = pa.schema([("shard", pa.int32()), ("batch", pa.int64()), *((k, pa.binary()) for k in ("docs", "idx", "keys", "known"))])
ANSWER = "batch long, docs binary, keys binary"
#: Bytes of text a shard: a task holds what its shard is sent, so the number of shards follows from the texts.
SHARD_BYTES = 32 << 20


def shard_count(df: DataFrame) -> int:
    """Shards for these texts (text): as many as the session has shuffle partitions, or more for a large table."""
    size = df.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return max(shuffle_partitions(df.sparkSession), -(-size // SHARD_BYTES))


def shards_of(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> U(32)) % U(shards)).astype(np.int64)


def tags(h: np.ndarray, shards: int) -> np.ndarray:
    """A hash as (shard, low 32 bits): the form in which `shared_keys` asks and answers.

    A shard holds about as many keys at every corpus size, so the rate of chance collisions stays the same; they only
    add candidates.
    """
    return (shards_of(h, shards).astype(U) << U(32)) | (h & U(0xFFFFFFFF))


def by_shard(df: DataFrame, shards: int) -> DataFrame:
    return df.repartition(max(1, shards), "shard").sortWithinPartitions("shard")


def each_shard(batches: Iterator[pa.RecordBatch], key: str = "shard") -> Iterator[tuple[int, list[dict]]]:
    """The rows of one shard (or other key) after the other; input is sorted by it."""
    now, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row[key] != now and rows:
                yield now, rows
                rows = []
            now = row[key]
            rows.append(row)
    if rows:
        yield now, rows


def answers(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Answer rows: a map batch, and parallel arrays of document ids and keys (which may have several columns)."""
    rows = [r for r in rows if len(r[1])]
    columns = [pa.array([r[0] for r in rows], pa.int64()), *(pa.array([np.ascontiguousarray(r[i]).tobytes() for r in rows], pa.binary()) for i in (1, 2))]
    return pa.RecordBatch.from_arrays(columns, ["batch", "docs", "keys"])


def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Map batches with a number that no other task uses, and that a repeated task gives again."""
    from pyspark import TaskContext

    start = TaskContext.get().partitionId() << 32
    for i, batch in enumerate(pieces(batches, "text")):
        yield start + i, batch


def known_already(batch: int, docs: np.ndarray, keys: np.ndarray, shards: int) -> list[dict]:
    """Answers found inside a map batch travel along with its messages, to some task, as shard -1 - n."""
    return [{"shard": -1 - batch % shards, "batch": batch, "docs": docs.tobytes(), "keys": np.ascontiguousarray(keys).tobytes()}] if len(docs) else []


def passed_on(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r["batch"] for r in rows], pa.int64()), *(pa.array([r[k] for r in rows], pa.binary()) for k in ("docs", "keys"))], ["batch", "docs", "keys"])


def per_batch(blob: np.ndarray, docs: np.ndarray, keys: np.ndarray, numbers: list[int]) -> pa.RecordBatch:
    """Answers to entries that came in blobs (`blob`: ascending or not), one row for each blob with any."""
    order = np.argsort(blob, kind="stable")
    blob, docs, keys = blob[order], docs[order], keys[order]
    cuts = np.searchsorted(blob, np.arange(len(numbers) + 1))
    return answers([(n, docs[i:j], keys[i:j]) for n, i, j in zip(numbers, cuts[:-1], cuts[1:])])


def packed(shard: np.ndarray, columns: list[tuple[np.ndarray, str]]) -> Iterator[tuple[int, dict[str, bytes]]]:
    """Split parallel arrays by shard."""
    order = np.argsort(shard, kind="stable")
    shard = shard[order]
    columns = [(a[order], n) for a, n in columns]
    first = runs(shard)
    for i, j in zip(first.tolist(), [*first[1:].tolist(), len(shard)]):
        yield int(shard[i]), {n: np.ascontiguousarray(a[i:j]).tobytes() for a, n in columns}


def ids_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Document ids (0 where null) and which are not null."""
    c = batch.column("doc_id")
    return c.fill_null(0).to_numpy(zero_copy_only=False), c.is_valid().to_numpy(zero_copy_only=False)


def shared_keys(docs: DataFrame, keys_of: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]], shards: int) -> DataFrame:
    """For every document, those of its keys that another document holds too, as tags.

    docs: doc_id, text. keys_of(bytes, offsets) gives (row, hash) arrays. A few chance matches may be among the
    answers, and a doc_id that occurs twice counts as two documents; both only add candidates. Null ids take no part.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in numbered(batches):
            ids, valid = ids_of(batch)
            row, h = keys_of(*texts(batch.column("text")))
            keep = valid[row]
            tag, row = tags(h[keep], shards), row[keep]
            order = np.lexsort((row, tag))
            tag, row = tag[order], row[order]
            new = np.ones(len(tag), bool)
            new[1:] = (tag[1:] != tag[:-1]) | (row[1:] != row[:-1])
            tag, row = tag[new], row[new]
            first = runs(tag)
            many = np.diff(np.append(first, len(tag))) > 1
            repeated = np.repeat(many, np.diff(np.append(first, len(tag))))
            rows = messages(ids, row[~repeated], tag[~repeated], tag[first[many]])
            rows = [{**r, "batch": number} for r in rows] + known_already(number, ids[row[repeated]], tag[repeated], shards)
            if rows:
                yield pa.RecordBatch.from_pylist(rows, MESSAGE_SCHEMA)

    def messages(ids: np.ndarray, row: np.ndarray, tag: np.ndarray, known: np.ndarray) -> list[dict]:
        out = {}
        for s, x in packed((tag >> U(32)).astype(np.int64), [(row.astype(np.uint32), "idx"), ((tag & U(0xFFFFFFFF)).astype(np.uint32), "keys")]):
            used = np.frombuffer(x["idx"], np.uint32)
            rows, again = np.unique(used, return_inverse=True)
            x["docs"], x["idx"] = ids[rows].tobytes(), again.astype(np.uint16 if len(rows) < 1 << 16 else np.uint32).tobytes()
            out[s] = x
        for s, x in packed((known >> U(32)).astype(np.int64), [((known & U(0xFFFFFFFF)).astype(np.uint32), "known")]):
            out.setdefault(s, {}).update(x)
        return [{"shard": s, **x} for s, x in out.items()]

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in each_shard(batches):
            if shard < 0:
                yield passed_on(rows)
                continue
            docs, keys, blob, known = [], [], [], []
            for i, r in enumerate(rows):
                known.append(np.frombuffer(r["known"] or b"", np.uint32))
                k = np.frombuffer(r["keys"] or b"", np.uint32)
                if len(k):
                    wide = np.uint16 if len(r["idx"]) == 2 * len(k) else np.uint32
                    docs.append(np.frombuffer(r["docs"], np.int64)[np.frombuffer(r["idx"], wide)])
                    keys.append(k)
                    blob.append(np.full(len(k), i, np.int32))
            if not keys:
                continue
            docs, keys, blob, known = np.concatenate(docs), np.concatenate(keys), np.concatenate(blob), np.unique(np.concatenate(known))
            order = np.argsort(keys, kind="stable")
            k = keys[order]
            same = np.zeros(len(k), bool)
            same[1:] = k[1:] == k[:-1]
            same[:-1] |= same[1:]
            if len(known):
                p = np.minimum(np.searchsorted(known, k), len(known) - 1)
                same |= known[p] == k
            hit = order[same]
            yield per_batch(blob[hit], docs[hit], keys[hit].astype(U) | (U(shard) << U(32)), [r["batch"] for r in rows])

    asked = docs.mapInArrow(ask, MESSAGE)
    return by_shard(asked, shards).mapInArrow(meet, ANSWER)


def gather(found: DataFrame, width: int = 1) -> DataFrame:
    """(doc_id, answers): one row per document that has any, with all its answers, packed (`width` numbers each).

    All answers to a map batch meet in one task, which holds no more than that batch's documents; the last grouping
    only joins rows of documents that were read in more than one batch.
    """

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in each_shard(batches, "batch"):
            docs = np.concatenate([np.frombuffer(r["docs"], np.int64) for r in rows])
            keys = np.concatenate([np.frombuffer(r["keys"], U).reshape(-1, width) for r in rows])
            order = np.argsort(docs, kind="stable")
            docs, keys = docs[order], keys[order]
            first = runs(docs)
            lengths = np.diff(np.append(first, len(docs)))
            yield pa.RecordBatch.from_arrays([pa.array(docs[first], pa.int64()), binary_rows(keys, lengths)], ["doc_id", "answer"])

    n = shuffle_partitions(found.sparkSession)
    dealt = found.repartition(n, "batch").sortWithinPartitions("batch").mapInArrow(unpack, "doc_id long, answer binary")
    return dealt.groupBy("doc_id").agg(F.collect_list("answer").alias("answers"))


def answer_arrays(batch: pa.RecordBatch, dtype=U, width: int = 1, column: str = "answers") -> list[np.ndarray]:
    out = []
    for parts in batch.column(column).to_pylist():
        a = np.frombuffer(b"".join(parts or []), dtype)
        out.append(a.reshape(-1, width) if width > 1 else a)
    return out
