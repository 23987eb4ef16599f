"""Exact repeated-substring removal on bytes, with logarithmic families of suffix arrays.

Every `width`-byte window has one minimiser: the k-byte string inside it with the smallest hash (the leftmost of equal
ones). Equal windows have equal minimisers, so windows are dealt to shards by minimiser: windows that share a minimiser
position travel together as one segment of text. First, only hashes of segments meet: a segment that a smaller document
holds too is removed as a whole, and segments whose minimiser has no other text are done. Of each other text, the
smallest document with it sends the bytes. In each shard these segments come in document order; each batch of them gets
its own suffix array (sorted windows), is scanned against the existing levels for matches with smaller documents, and
joins the family, where two levels of about equal size merge into one. `SuffixIndex` keeps such a family on disk and takes
new batches of documents against all earlier ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrays import U, M, binary_rows, member, mix, pieces, powers, runs, texts
from .common import cut_lineage, reread, shuffle_partitions
from .exchange import ANSWER, answer_arrays, by_shard, each_shard, gather, ids_of, known_already, numbered, packed, passed_on, per_batch, shard_count, shards_of

SEGMENTS = "shard int, batch long, docs binary, keys binary, lens binary, body binary"
SEGMENT_SCHEMA = pa.schema([("shard", pa.int32()), ("batch", pa.int64()), *((k, pa.binary()) for k in ("docs", "keys", "lens", "body"))])
#: Marks in answers about a segment's key: a smaller document holds all of it; its bytes are asked for.
WHOLE, SEND = U(1 << 63), U(1 << 62)
#: In answers a segment is named by the other bits of its content hash; they only tell a document's own segments apart.
KEY = U((1 << 62) - 1)
TAG = U(0xFFFFFF)


#: Bytes of whole rows that are hashed at once, so that temporaries stay in a core's cache.
BLOCK = 1 << 17
LOW = U(0xFFFFFFFF)


def gram_hashes(b: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k bytes from each position."""
    n = len(b) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    c, down = prefix_sums(b)
    return mix((c[k:] - c[:n]) * down[:n])


def prefix_sums(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums c of the bytes, plus 1, times powers of M, and the inverse powers: (c[j] - c[i]) * down[i] is a hash of the bytes
    from i to j that is the same wherever they stand."""
    up, down = powers(len(b), M, U)
    c = np.zeros(len(b) + 1, U)
    np.cumsum((b.astype(U) + U(1)) * up, out=c[1:])
    return c, down


def window_minima(h: np.ndarray, w: int) -> np.ndarray:
    """For each window of w hashes, the high half of the smallest with its position below (the leftmost of equal halves)."""
    best = (h & ~LOW) | np.arange(len(h), dtype=U)
    size = 1
    while 2 * size <= w:
        best = np.minimum(best[size:], best[:-size])
        size *= 2
    rest = w - size
    return np.minimum(best[rest:], best[: len(best) - rest]) if rest else best


def segments(b: np.ndarray, off: np.ndarray, width: int, k: int):
    """Row, first window, number of windows, minimiser hash and content hash of each run of windows with one minimiser
    position. The content hash is of the run's first and last windows (which cover it) and its length, whatever its
    minimiser, so that the many texts around one minimiser are told apart by all of them."""
    found, r = [], 0
    while r < len(off) - 1:
        lo, first = off[r], r
        r = max(r + 1, int(np.searchsorted(off, lo + BLOCK, "right")) - 1)
        here, x = off[first : r + 1] - lo, b[lo : off[r]]
        fits = here[:-1][np.diff(here) >= width]
        if not len(fits):
            continue
        c, down = prefix_sums(x)
        n = len(x) - k + 1
        h = mix((c[k:] - c[:n]) * down[:n])
        best = window_minima(h, width - k + 1)
        change = np.ones(len(best), bool)
        change[1:] = best[1:] != best[:-1]
        change[fits] = True
        start = np.flatnonzero(change)
        row = np.searchsorted(here, start, "right") - 1
        end = np.minimum(np.append(start[1:], len(best)), here[row + 1] - width + 1)
        some = start < end  # other windows reach over a row's end
        start, row, end = start[some], row[some], end[some]
        last = end - 1
        key = mix((c[start + width] - c[start]) * down[start]) * U(0x9FB21C651E98DF25) + mix((c[last + width] - c[last]) * down[last])
        count = end - start
        found.append((row + first, start + lo, count, h[(best[start] & LOW).astype(np.int64)], mix(key + count.astype(U))))
    if not found:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, U), np.zeros(0, U)
    return tuple(np.concatenate(x) for x in zip(*found))


def flattened(answers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The rows' answers one after the other, and the row of each."""
    return np.repeat(np.arange(len(answers)), [len(a) for a in answers]), np.concatenate(answers)


def told_masks(row: np.ndarray, key: np.ndarray, of: np.ndarray, keys: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """For each segment (row, key) the bits of all masks that its row (`of`) was told for its key."""
    out = np.zeros(len(row), U)
    if not len(row) or not len(of):
        return out
    known = np.unique(keys)
    pair = of * len(known) + np.searchsorted(known, keys)
    order = np.argsort(pair, kind="stable")
    first = runs(pair[order])
    pair, masks = pair[order][first], np.bitwise_or.reduceat(masks[order], first)
    at = np.minimum(np.searchsorted(known, key), len(known) - 1)
    mine = np.flatnonzero(known[at] == key)
    want = row[mine] * len(known) + at[mine]
    at = np.minimum(np.searchsorted(pair, want), len(pair) - 1)
    out[mine] = np.where(pair[at] == want, masks[at], U(0))
    return out


def covered(n: int, start: np.ndarray, count: np.ndarray, mask: np.ndarray, width: int) -> np.ndarray:
    """Which of n bytes are in a window that a segment's mask marks."""
    gone = np.zeros(n + 1, np.int32)
    every = (U(1) << count.astype(U)) - U(1)
    mask = mask & every
    whole, some = mask == every, (mask > 0) & (mask < every)
    gone[start[whole]] += 1  # segments don't share a start, nor an end
    gone[start[whole] + count[whole] + width - 1] -= 1
    start, count, mask = start[some], count[some], mask[some]
    for bit in range(int(count.max()) if len(count) else 0):
        s = start[((mask >> U(bit)) & U(1)).astype(bool)] + bit
        gone[s] += 1  # windows are distinct, so are their starts
        gone[s + width] -= 1
    return np.cumsum(gone[:-1], dtype=np.int32) > 0


class Level:
    """A suffix array cut at `width`: distinct windows of a text, as their places in it in the order of their bytes."""

    def __init__(self, body: np.ndarray, at: np.ndarray, width: int, keys: np.ndarray | None = None):
        self.body, self.at, self.width = body, at, width
        self.keys = keys if keys is not None else windows(body, at, width)

    def __len__(self) -> int:
        return len(self.at)

    def merged(self, other: Level) -> Level:
        """One level of both, which share no window."""
        body, at = np.concatenate([self.body, other.body]), np.concatenate([self.at, other.at + len(self.body)])
        keys = np.concatenate([self.keys, other.keys])
        order = np.argsort(keys, kind="stable")  # two sorted runs
        return Level(body, at[order], self.width, keys[order])


def windows(body: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """The strings of `width` bytes at these places."""
    if not len(at):
        return np.zeros(0, f"S{width}")
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(body, width)[at]).view(f"S{width}").ravel()


class LogarithmicFamily:
    """Levels of geometric sizes that share no window."""

    def __init__(self, width: int, levels: list[Level] | None = None):
        self.width, self.levels = width, list(levels or [])

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """Which keys (sorted) some level holds."""
        hit = np.zeros(len(keys), bool)
        for level in self.levels:
            hit |= member(keys, level.keys)
        return hit

    def add(self, level: Level) -> None:
        """Add a level of windows that no other holds; merge while the last two are about equal in size."""
        if not len(level):
            return
        self.levels.append(level)
        while len(self.levels) > 1 and 2 * len(self.levels[-1]) > len(self.levels[-2]):
            b, a = self.levels.pop(), self.levels.pop()
            self.levels.append(a.merged(b))


def matched_windows(body: np.ndarray, lens: np.ndarray, docs: np.ndarray, width: int, batch_windows: int = 1 << 16, family: LogarithmicFamily | None = None) -> np.ndarray:
    """For each window of each segment (in order), whether the family or a segment of a smaller document holds the same
    bytes. Segments are in document order; batches end between documents, and join the family one after the other.
    """
    ends = np.cumsum(lens)
    starts = ends - lens
    count = lens - width + 1
    total = np.cumsum(count)
    out = np.zeros(int(total[-1]), bool)
    new_doc = np.append(runs(docs), len(docs))
    family, i = family or LogarithmicFamily(width), 0
    while i < len(new_doc) - 1:
        a = new_doc[i]
        base = total[a] - count[a]
        j = max(i + 1, int(np.searchsorted(total[new_doc[1:] - 1], base + batch_windows)))
        z = new_doc[j]
        n = count[a:z]
        offsets = np.repeat(starts[a:z] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        lo = starts[a]
        out[base : base + len(offsets)] = scanned(family, body[lo : ends[z - 1]], offsets - lo, np.repeat(docs[a:z], n), width)
        i = j
    return out


def scanned(family: LogarithmicFamily, body: np.ndarray, offsets: np.ndarray, owner: np.ndarray, width: int, with_text: bool = True) -> np.ndarray:
    """Whether the family or a smaller owner holds the same bytes as each of these windows, which then join the family.
    Owners are ascending; without its text, a level still answers which strings it holds."""
    keys = windows(body, offsets, width)
    order = np.argsort(keys, kind="stable")  # the batch's suffix array; equal strings stay in document order
    k, o = keys[order], owner[order]
    first = runs(k)
    size = np.diff(np.append(first, len(k)))
    old = family.holds(k[first])
    hit = np.empty(len(keys), bool)
    hit[order] = np.repeat(old, size) | (o > np.repeat(o[first], size))
    fresh = first[~old]
    family.add(Level(body if with_text else body[:0], offsets[order][fresh], width, k[fresh]))
    return hit


def matched_in_groups(body: np.ndarray, starts: np.ndarray, lens: np.ndarray, docs: np.ndarray, width: int, most: int = 1 << 20, batch_windows: int = 1 << 16) -> np.ndarray:
    """As `matched_windows` with a new family, for segments at `starts` in document order, but with levels of about `most`
    windows at a time: windows go to groups by a hash of their bytes, so equal ones share a group, and one group after the
    other gets its family. Beside the text that takes five bytes a window."""
    count = lens - width + 1
    total = np.cumsum(count)
    n = int(total[-1])
    groups = min(-(-n // most), (1 << 16) - 1)
    group = np.zeros(n, np.uint16)
    out = np.zeros(n, bool)
    seg = 0
    while groups > 1 and seg < len(lens):
        z = max(seg + 1, int(np.searchsorted(total, total[seg] - count[seg] + batch_windows)))
        x, w = np.repeat(starts[seg:z] - (np.cumsum(lens[seg:z]) - lens[seg:z]), lens[seg:z]), count[seg:z]
        c, down = prefix_sums(body[x + np.arange(len(x))])
        at = np.repeat(np.cumsum(lens[seg:z]) - lens[seg:z] - (np.cumsum(w) - w), w) + np.arange(int(w.sum()))
        h = mix((c[at + width] - c[at]) * down[at])
        group[total[seg] - count[seg] : total[z - 1]] = (h >> U(32)) % U(groups)
        seg = z
    sizes = np.bincount(group, minlength=groups)
    order = np.arange(n, dtype=np.uint32 if n < 1 << 32 else np.int64)
    if groups > 1:
        order = order[np.argsort(group, kind="stable")]
    for end, size in zip(np.cumsum(sizes).tolist(), sizes.tolist()):
        family, mine, i = LogarithmicFamily(width), order[end - size : end].astype(np.int64), 0
        while i < size:
            j = min(size, i + batch_windows)
            of = int(docs[np.searchsorted(total, mine[j - 1], "right")])  # batches end between documents
            after = int(np.searchsorted(docs, of, "right"))
            j = int(np.searchsorted(mine, total[after - 1]))
            w = mine[i:j]
            s = np.searchsorted(total, w, "right")
            out[w] = scanned(family, body, starts[s] + w - (total[s] - count[s]), docs[s], width, with_text=False)
            i = j
    return out


def masks_of(hit: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The hits among each segment's windows as bits, lowest first."""
    mask, first = np.zeros(len(count), U), np.cumsum(count) - count
    for bit in range(int(count.max()) if len(count) else 0):
        some = np.flatnonzero(count > bit)
        mask[some] |= hit[first[some] + bit].astype(U) << U(bit)
    return mask


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def spans_of(gone: np.ndarray, off: np.ndarray) -> pa.Array:
    """Per row, the maximal runs of marked bytes."""
    before, after = np.zeros(len(gone), bool), np.zeros(len(gone), bool)
    before[1:], after[:-1] = gone[:-1], gone[1:]
    full = np.diff(off) > 0
    before[off[:-1][full]] = False
    after[off[1:][full] - 1] = False
    s, e = np.flatnonzero(gone & ~before), np.flatnonzero(gone & ~after) + 1
    cuts = np.searchsorted(s, off)
    base = np.repeat(off[:-1], np.diff(cuts))
    of = pa.StructArray.from_arrays([pa.array(s - base, pa.int64()), pa.array(e - base, pa.int64())], fields=list(SPANS.value_type))
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), of, type=SPANS)


#: Rows of a shard: segments of new documents (level null), answers to them, or a level of the index.
SHARD = "shard int, level long, batch long, docs binary, keys binary, lens binary, body binary"
SHARD_SCHEMA = pa.schema([("shard", pa.int32()), ("level", pa.int64()), ("batch", pa.int64()), *((k, pa.binary()) for k in ("docs", "keys", "lens", "body"))])


def repeated_bytes(docs: DataFrame, width: int = 50, k: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row, the byte spans covered by a `width`-byte string that also starts in a smaller id.

    Texts are UTF-8 bytes; strings never cross documents and are judged on the input. Null text is empty; null ids
    neither lose bytes nor make others lose any; rows that share an id judge each other as one document would; texts
    shorter than `width` lose nothing.
    Returns the id, n_bytes (long), spans (array<struct<start,end>>, maximal removed runs) and kept (binary).
    """
    if not 8 <= k <= width or width - k + 1 > 62:
        raise ValueError("k must be at least 8 and at least width - 61, and at most width")
    if width > 2000:
        raise ValueError("width must be at most 2000")
    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    shards = shard_count(d)

    def cut_up(b: np.ndarray, off: np.ndarray):
        row, start, count, h, key = segments(b, off, width, k)
        return row, start, count, shards_of(h, shards), h & TAG, key

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in numbered(batches):
            ids, _ = ids_of(batch)
            row, _, _, shard, tag, key = cut_up(*texts(batch.column("text")))
            doc, place = ids[row], np.unique(ids, return_inverse=True)[1].reshape(-1)[row]
            order = np.argsort(key)
            doc, place, key, shard, tag = (x[order] for x in (doc, place, key, shard, tag))
            first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (shard[1:] != shard[:-1]))) if len(key) else row
            least = np.minimum.reduceat(place, first) if len(key) else place
            late = place > np.repeat(least, np.diff(np.append(first, len(key))))
            rows, names = [], np.unique(ids)
            order = np.argsort(shard[first] << 32 | least)  # a shard's segments by document
            sent = ((shard[first][order]), [(names[least[order]], "docs"), (key[first][order], "keys"), (tag[first][order].astype(np.uint32), "tags")])
            for s, x in packed(*sent):
                d, m = np.frombuffer(x["docs"], np.int64), np.frombuffer(x["tags"], np.uint32)
                at = runs(d)
                body = (m & 0xFFFF).astype(np.uint16).tobytes() + (m >> 16).astype(np.uint8).tobytes()
                lens = np.diff(np.append(at, len(d))).astype(np.uint32)
                rows.append({"shard": s, "batch": number, "docs": d[at].tobytes(), "keys": x["keys"], "lens": lens.tobytes(), "body": body})
            known_docs, known_keys = doc[late], key[late] & KEY
            order = np.lexsort((known_docs, known_keys))
            known_docs, known_keys = known_docs[order], known_keys[order]
            once = np.ones(len(order), bool)
            once[1:] = (known_docs[1:] != known_docs[:-1]) | (known_keys[1:] != known_keys[:-1])
            rows += known_already(number, known_docs[once], known_keys[once] | WHOLE, shards)
            if rows:
                yield pa.RecordBatch.from_pylist(rows, SEGMENT_SCHEMA)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each text the smallest document; others match whole, and it is asked for if its minimiser has more texts."""
        for shard, rows in each_shard(batches):
            if shard < 0:
                yield passed_on(rows)
                continue
            docs, keys, minimisers = [], [], []
            for r in rows:
                n = len(r["keys"]) // 8
                keys.append(np.frombuffer(r["keys"], U))
                minimisers.append(np.frombuffer(r["body"][: 2 * n], np.uint16).astype(np.uint32) | (np.frombuffer(r["body"][2 * n :], np.uint8).astype(np.uint32) << np.uint32(16)))
                docs.append(np.repeat(np.frombuffer(r["docs"], np.int64), np.frombuffer(r["lens"], np.uint32)))
            blob = np.repeat(np.arange(len(rows)), [len(x) for x in keys])
            doc, key, tag = np.concatenate(docs), np.concatenate(keys), np.concatenate(minimisers)
            order = np.lexsort((doc, key, tag))
            doc, key, tag, blob = doc[order], key[order], tag[order], blob[order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (tag[1:] != tag[:-1])
            first = np.flatnonzero(new)
            size = np.diff(np.append(first, len(key)))
            late = doc > np.repeat(doc[first], size)
            tag = tag[first]
            edge = runs(tag)
            texts_of = np.repeat(np.diff(np.append(edge, len(tag))), np.diff(np.append(edge, len(tag))))
            asked = np.zeros(len(key), bool)
            asked[first[texts_of > 1]] = True
            key &= KEY
            some = late | asked
            yield per_batch(blob[some], doc[some], np.where(late, key | WHOLE, key | SEND)[some], [r["batch"] for r in rows])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in numbered(batches):
            found = answer_arrays(batch)
            if not any((a & SEND).any() for a in found):
                continue
            ids, _ = ids_of(batch)
            b, off = texts(batch.column("text"))
            row, start, count, shard, _, key = cut_up(b, off)
            key &= KEY
            of, told = flattened(found)
            sent = (told & SEND) > 0
            hit = told_masks(row, key, of[sent], told[sent] & KEY, np.ones(int(sent.sum()), U)) > 0
            row, start, count, shard, key = (x[hit] for x in (row, start, count, shard, key))
            doc = ids[row]
            order = np.lexsort((key, doc, shard))
            doc, start, count, shard, key = (x[order] for x in (doc, start, count, shard, key))
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]) | (shard[1:] != shard[:-1])
            doc, start, count, shard, key = (x[new] for x in (doc, start, count, shard, key))
            rows, lens, edges = [], count + width - 1, runs(shard)
            for i, j in zip(edges.tolist(), [*edges[1:].tolist(), len(shard)]):
                n = lens[i:j]
                pick = np.repeat(start[i:j] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                rows.append({"shard": int(shard[i]), "batch": number, "docs": doc[i:j].tobytes(), "keys": key[i:j].tobytes(), "lens": n.astype(np.uint16).tobytes(), "body": b[pick].tobytes()})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, SEGMENT_SCHEMA)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in each_shard(batches):
            doc, key, lens, body = (np.concatenate([np.frombuffer(r[x], t) for r in rows]) for x, t in (("docs", np.int64), ("keys", U), ("lens", np.uint16), ("body", np.uint8)))
            blob = np.repeat(np.arange(len(rows)), [len(r["docs"]) // 8 for r in rows])
            lens = lens.astype(np.int64)
            at = np.cumsum(lens) - lens
            order = np.argsort(doc, kind="stable")
            n, names = lens[order], [r["batch"] for r in rows]
            rows = []  # the body has their text
            hit = matched_in_groups(body, at[order], n, doc[order], width)
            mask = masks_of(hit, n - width + 1)
            some = mask > 0
            yield per_batch(blob[order][some], doc[order][some], np.stack([key[order][some], mask[some]], 1), names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            b, off = texts(batch.column("text"))
            gone = np.zeros(len(b), bool)
            (of, whole), (part_of, part) = flattened(answer_arrays(batch)), flattened(answer_arrays(batch, U, 2, "masks"))
            is_whole = (whole & WHOLE) > 0
            of, whole = of[is_whole], whole[is_whole] & KEY
            if len(whole) or len(part):
                row, start, count, _, _, key = cut_up(b, off)
                every = np.full(len(whole), (1 << (width - k + 1)) - 1, U)
                mask = told_masks(row, key & KEY, np.append(of, part_of), np.append(whole, part[:, 0]), np.append(every, part[:, 1]))
                gone = covered(len(b), start, count, mask, width)
            lost = np.append(0, np.cumsum(gone))
            kept = binary_rows(b[~gone], np.diff(off) - np.diff(lost[off]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(off), pa.int64()), spans_of(gone, off), kept], ["doc_id", "n_bytes", "spans", "kept"])

    # The two joins read the same shuffle of the texts; rows with null ids go past them.
    known = d.where("doc_id is not null")
    judged = cut_lineage(gather(by_shard(known.mapInArrow(compare, SEGMENTS), shards).mapInArrow(judge, ANSWER)))
    found = gather(by_shard(known.join(judged, "doc_id").mapInArrow(ask, SEGMENTS), shards).mapInArrow(scan, ANSWER), 2)
    schema = "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
    told = judged.join(found.withColumnRenamed("answers", "masks"), "doc_id", "left")
    out = known.join(told, "doc_id", "left").mapInArrow(cut, schema)
    nothing = F.array().cast("array<binary>")
    lost = d.where("doc_id is null").withColumn("answers", nothing).withColumn("masks", nothing).mapInArrow(cut, schema)
    return out.unionByName(lost).withColumnRenamed("doc_id", id_col)


class SuffixIndex:
    """A logarithmic index family on disk, for corpora that grow batch by batch.

    `folder` (shared, such as one under spark.checkpoint.dir) holds one Parquet table per level and a small list of the
    levels in use; an index that is there already is opened. Windows are dealt to `shards` by minimiser, as in
    `repeated_bytes`; a level holds, per shard, the text of its segments and their suffix array. `add_batch` brings new
    documents: in each shard they get suffix arrays, are merge-scanned against all levels, and become a level, which
    takes in the last levels as long as those are less than twice its size. So a window is rewritten a logarithmic
    number of times. Sizes are bytes of documents. All comparisons are of bytes.
    """

    def __init__(self, spark: SparkSession, folder: str, width: int = 50, k: int = 20, shards: int | None = None):
        self.spark, self.folder, self.width, self.k = spark, folder.rstrip("/"), width, k
        self.shards, self.levels, self.steps = shards or shuffle_partitions(spark), [], 0
        held = self._path("steps")
        if self._exists(held):
            rows = spark.read.parquet(held)
            self.steps = rows.agg(F.max("step")).first()[0]
            now = rows.where(F.col("step") == self.steps).orderBy("place").collect()  # one row per level
            self.width, self.k, self.shards = (now[0][x] for x in ("width", "k", "shards"))
            self.levels = [(r["level"], r["size"]) for r in now]

    def _path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def _exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def add_batch(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Index these documents; returns per row the id, n_bytes and spans (array<struct<start,end>>): the bytes covered
        by a `width`-byte string that an earlier batch holds, or a smaller id of this one.

        Null text is empty; null ids neither match nor are indexed; rows that share an id are one document; an empty
        batch adds nothing. A batch that fails before its end leaves the index as it was and may be added again.
        """
        d = cut_lineage(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")))
        known, width, k, shards = d.where("doc_id is not null"), self.width, self.k, self.shards
        size = known.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        spans = "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>"
        merge, total = set(), size
        for level, n in reversed(self.levels):
            if n >= 2 * total:
                break
            merge.add(level)
            total += n
        new = self.steps

        def cut(b: np.ndarray, off: np.ndarray):
            row, start, count, h, key = segments(b, off, width, k)  # a key names a segment within its document
            return row, start, count, shards_of(h, shards), key

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for number, batch in numbered(batches):
                ids, _ = ids_of(batch)
                b, off = texts(batch.column("text"))
                row, start, count, shard, key = cut(b, off)
                order = np.lexsort((ids[row], shard))
                doc, start, lens, shard, key = ids[row][order], start[order], count[order] + width - 1, shard[order], key[order]
                edges, rows = runs(shard), []
                for i, j in zip(edges.tolist(), [*edges[1:].tolist(), len(shard)]):
                    n = lens[i:j]
                    pick = np.repeat(start[i:j] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                    rows.append({"shard": int(shard[i]), "batch": number, "docs": doc[i:j].tobytes(), "keys": key[i:j].tobytes(), "lens": n.astype(np.uint16).tobytes(), "body": b[pick].tobytes()})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, SHARD_SCHEMA)

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Of each shard, its levels and the batch's segments: answers, and the new level."""
            for shard, rows in each_shard(batches):
                old = {r["level"]: Level(np.frombuffer(r["body"], np.uint8), np.frombuffer(r["keys"], np.int64), width) for r in rows if r["level"] is not None}
                rows = [r for r in rows if r["level"] is None]
                level = Level(np.zeros(0, np.uint8), np.zeros(0, np.int64), width)
                if rows:
                    doc, key, lens, body = (np.concatenate([np.frombuffer(r[x], t) for r in rows]) for x, t in (("docs", np.int64), ("keys", U), ("lens", np.uint16), ("body", np.uint8)))
                    blob = np.repeat(np.arange(len(rows)), [len(r["docs"]) // 8 for r in rows])
                    lens = lens.astype(np.int64)
                    at, order = np.cumsum(lens) - lens, np.argsort(doc, kind="stable")
                    n = lens[order]
                    body = body[np.repeat(at[order] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
                    family = LogarithmicFamily(width)
                    late = matched_windows(body, n, doc[order], width, family=family)  # within the batch
                    for x in family.levels:
                        level = level.merged(x)
                    count = n - width + 1
                    place = np.repeat(np.cumsum(n) - n - (np.cumsum(count) - count), count) + np.arange(len(late))
                    known = LogarithmicFamily(width, list(old.values())).holds(level.keys)
                    # The windows that a level holds, in every document of the batch that has them.
                    late |= member(windows(body, place, width), level.keys[known])
                    mask = masks_of(late, count)
                    some = mask > 0
                    told = per_batch(blob[order][some], doc[order][some], np.stack([key[order][some], mask[some]], 1), [r["batch"] for r in rows])
                    yield from pa.Table.from_pylist([{"shard": shard, **x} for x in told.to_pylist()], SHARD_SCHEMA).to_batches()
                    level = Level(level.body, level.at[~known], width, level.keys[~known])
                for name in merge & set(old):
                    level = old[name].merged(level)
                if len(level):
                    yield pa.RecordBatch.from_pylist([{"shard": shard, "level": new, "keys": level.at.tobytes(), "body": level.body.tobytes()}], SHARD_SCHEMA)

        def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches, "text"):
                b, off = texts(batch.column("text"))
                row, start, count, _, key = cut(b, off)
                of, told = flattened(answer_arrays(batch, U, 2))
                gone = covered(len(b), start, count, told_masks(row, key, of, told[:, 0], told[:, 1]), width)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(off), pa.int64()), spans_of(gone, off)], ["doc_id", "n_bytes", "spans"])

        brought = known.mapInArrow(deal, SHARD)
        for level, _ in self.levels:
            brought = brought.unionByName(self.spark.read.schema(SHARD).parquet(self._path(f"level-{level}")))
        got = reread(by_shard(brought, shards).mapInArrow(scan, SHARD))
        answered = gather(got.where("level is null").select("batch", "docs", "keys"), 2)
        out = known.join(answered, "doc_id", "left").mapInArrow(mark, spans)
        lost = d.where("doc_id is null").withColumn("answers", F.array().cast("array<binary>")).mapInArrow(mark, spans)
        out = reread(out.unionByName(lost).withColumnRenamed("doc_id", id_col))
        # The level first, then the list that names it: whoever reads the list finds whole levels.
        got.where("level is not null").write.mode("overwrite").parquet(self._path(f"level-{new}"))
        self.levels = [x for x in self.levels if x[0] not in merge] + ([(new, total)] if total else [])
        self.steps += 1
        rows = [(self.steps, i, level, n, width, k, shards) for i, (level, n) in enumerate(self.levels)]
        if rows:
            self.spark.createDataFrame(rows, "step long, place int, level long, size long, width int, k int, shards int").coalesce(1).write.mode("append").parquet(self._path("steps"))
        return out
