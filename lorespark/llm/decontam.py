"""Benchmark decontamination by latent semantic retrieval, checked by longest common subsequence and answer terms.

Documents are read as passages: two neighbouring blocks of BLOCK words, so that passages overlap by half. With A the
TF-IDF matrix of all passages over the benchmark's words, a randomised SVD takes one pass: A^T (A G) for a random G, one
partial product per partition, gives the leading right singular vectors by Nystrom's formula; they span the latent
space. Items longer than a passage are cut into overlapping parts of a passage's size. Passages whose latent vector
points the way of an item's or of one of its parts' are candidates. A candidate counts if enough of the
item's words follow each other in the passage's surroundings and enough of its most telling words (the answer) occur.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import PIECE, binary_rows, pieces
from .common import cut_lineage, shuffle_partitions

BLOCK = 16
EDGES = "\"'.,;:!?()[]{}<>*_-~`|/\\"
#: Every task holds the words and vectors of this much of the benchmark; a larger one is searched for part by part.
BENCHMARK_CHARS = 4 << 20
#: Rows of a matrix that are summed by one task.
RANGE = 256


def words(text: str | None) -> list[str]:
    """Lower-case words without outer punctuation."""
    return [w for w in (t.strip(EDGES) for t in (text or "").lower().split()) if w]


class WordIds(dict):
    """Raw token to word number; -1 for other words, -2 for bare punctuation. Remembers what it has seen, boundedly."""

    def __init__(self, vocabulary: dict[str, int], most: int = 150_000):
        super().__init__()
        self.vocabulary, self.most = vocabulary, most

    def __missing__(self, token: str) -> int:
        if len(self) >= self.most:
            self.clear()
        w = token.strip(EDGES)
        self[token] = i = self.vocabulary.get(w, -1) if w else -2
        return i

    def batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all texts and the texts' offsets."""
        parts = []
        for t in texts:
            tokens = t.lower().split() if t else []
            a = np.fromiter(map(self.__getitem__, tokens), np.int32, len(tokens))
            parts.append(a[a != -2] if len(a) and a.min() == -2 else a)
        return (np.concatenate(parts) if parts else np.zeros(0, np.int32)), np.append(0, np.cumsum([len(p) for p in parts])).astype(np.int64)


def blocks(off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Block of each word (numbered over the batch) and first block of each text; a text's last block may be short."""
    n = np.diff(off)
    first = np.append(0, np.cumsum(-(-n // BLOCK)))
    place = np.arange(off[-1]) - np.repeat(off[:-1], n)
    return np.repeat(first[:-1], n) + place // BLOCK, first


def add_rows(out: np.ndarray, key: np.ndarray, rows: np.ndarray, pick: np.ndarray, factor: np.ndarray, at_once: int = 1024, short: int = 64) -> np.ndarray:
    """Adds factor * rows[pick] to out[key]; keys are sorted. A thousand rows at a time stay in the processor's cache.
    Keys of few rows each are added up side by side, first rows, second rows and so on; the longest keys lead."""
    edge = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    size = np.diff(np.append(edge, len(key)))
    i = 0
    while i < len(edge):
        j = max(i + 1, int(np.searchsorted(edge, edge[i] + at_once)))
        n = size[i:j]
        if n.max() <= short:
            longest = np.argsort(-n, kind="stable")
            at, n = edge[i:j][longest], n[longest]
            total = rows[pick[at]] * factor[at, None]
            for k, many in enumerate(len(n) - np.searchsorted(n[::-1], np.arange(1, n[0]), "right"), 1):
                x = at[:many] + k
                total[:many] += rows[pick[x]] * factor[x, None]
            out[key[at]] += total
        else:
            lo, hi = edge[i], edge[i] + n.sum()
            out[key[edge[i:j]]] += np.add.reduceat(rows[pick[lo:hi]] * factor[lo:hi, None], edge[i:j] - lo, axis=0)
        i = j
    return out


def term_counts(key: np.ndarray, word: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key (ascending), word and damped frequency (1 + ln count) of each pair of a key and a word."""
    pairs, count = np.unique(key * size + word, return_counts=True)
    return pairs // size, pairs % size, (1 + np.log(count)).astype(np.float32)


def passage_sums(sums: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Row i: block i and, unless it ends its text, the next one."""
    out = sums.copy()
    if len(sums) > 1:
        inner = np.ones(len(sums), bool)
        inner[first[1:][np.diff(first) > 0] - 1] = False
        at = np.flatnonzero(inner)
        out[at] += sums[at + 1]
    return out


def summed(df: DataFrame, partial: Callable[[Iterator[pa.RecordBatch]], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
    """The sum over all partitions of `partial`'s array: each range of its rows is added up on its own, in two rounds of
    tasks, so no task sees more than the square root of all parts of a few ranges. The driver gets the sum."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        a, k = partial(batches), TaskContext.get().partitionId() % fan
        rows = [(r, k, x.tobytes()) for r in range(0, shape[0], RANGE) if (x := np.ascontiguousarray(a[r : r + RANGE])).any()]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.binary()))], ["r", "k", "a"])

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None
        for b in batches:
            for r, k, x in zip(b.column("r").to_pylist(), b.column("k").to_pylist(), b.column("a")):
                if (r, k) != now:
                    if now is not None:
                        yield one(now, total)
                    now, total = (r, k), 0.0
                total = total + np.frombuffer(x.as_buffer(), np.float64)
        if now is not None:
            yield one(now, total)

    def one(key: tuple[int, int], total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["r", "k", "a"])

    schema, n = "r long, k long, a binary", shuffle_partitions(df.sparkSession)
    fan = max(1, int(n**0.5))
    parts = df.mapInArrow(first, schema).repartition(n, "r", "k").sortWithinPartitions("r", "k").mapInArrow(again, schema)
    parts = parts.select("r", F.lit(0).cast("long").alias("k"), "a").repartition(n, "r").sortWithinPartitions("r").mapInArrow(again, schema)
    out = np.zeros(shape)
    for x in parts.collect():  # at most one row per range
        out[x["r"] : x["r"] + RANGE] = np.frombuffer(x["a"], np.float64).reshape(-1, *shape[1:])
    return out


def parts_of(words: np.ndarray) -> list[np.ndarray]:
    """An item as a whole and, if it is longer than a passage, in parts of a passage's size that overlap by half."""
    most = 2 * BLOCK
    if len(words) <= most:
        return [words]
    return [words, *(words[i : i + most] for i in [*range(0, len(words) - most, BLOCK), len(words) - most])]


def near_enough(w: np.ndarray, off: np.ndarray, first: np.ndarray, wanted: np.ndarray, reach: int, least: int) -> np.ndarray:
    """Which passages have at least `least` wanted words within themselves and `reach` words around."""
    total = np.append(0, np.cumsum(wanted[w]))
    n = np.diff(first)
    start = np.repeat(off[:-1], n) + (np.arange(first[-1]) - np.repeat(first[:-1], n)) * BLOCK
    lo, hi = np.maximum(np.repeat(off[:-1], n), start - reach), np.minimum(np.repeat(off[1:], n), start + 2 * BLOCK + reach)
    return total[hi] - total[lo] >= least


def holders_of(answers: list[set[int]], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The items whose answers hold each word, word after word, and where those of each word (`size` included) begin."""
    pairs = np.array(sorted((c, i) for i, a in enumerate(answers) for c in a), np.int64).reshape(-1, 2)
    return pairs[:, 1], np.append(0, np.cumsum(np.bincount(pairs[:, 0], minlength=size + 1)))


def told_at_most(w: np.ndarray, block: np.ndarray, first: np.ndarray, holders: np.ndarray, held: np.ndarray, wide: np.ndarray, passage: np.ndarray, item: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """A bound on the distinct words of each item's answer within its passage and `wide` words around it: those of each
    block that this touches, words counted once a block. All pairs are judged by sums over blocks, none by its words."""
    size, n_blocks = len(held) - 1, int(first[-1])
    telling = np.diff(held)[w] > 0
    b, c = np.divmod(np.unique(block[telling] * size + w[telling]), size)
    n = held[c + 1] - held[c]
    b, of = np.repeat(b, n), holders[np.repeat(held[c] - np.cumsum(n) + n, n) + np.arange(n.sum())]
    around = -(-wide[item] // BLOCK)
    lo, hi = np.maximum(first[doc], passage - around), np.minimum(first[doc + 1], passage + 2 + around)
    out, step = np.zeros(len(item), np.int64), max(1, (1 << 22) // (n_blocks + 1))
    words_by_item, pairs_by_item = np.argsort(of, kind="stable"), np.argsort(item, kind="stable")
    for i in range(0, len(wide), step):  # as many items at a time as 4 million sums hold
        some, pairs = (order[slice(*np.searchsorted(x[order], (i, i + step)))] for order, x in ((words_by_item, of), (pairs_by_item, item)))
        total = np.zeros((n_blocks + 1, min(step, len(wide) - i)), np.int32)
        np.add.at(total, (b[some] + 1, of[some] - i), 1)
        np.cumsum(total, axis=0, out=total)
        out[pairs] = total[hi[pairs], item[pairs] - i] - total[lo[pairs], item[pairs] - i]
    return out


def lcs(masks: dict[int, int], length: int, sequence: list[int]) -> int:
    """Length of the longest common subsequence with an item, given where each word stands in it, bit by bit."""
    full = (1 << length) - 1
    v = full
    for c in sequence:
        m = masks.get(c)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return length - v.bit_count()


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut by the bytes of their second column, the text or its word numbers."""
    for b in batches:
        yield from pieces([b], b.schema.names[1], PIECE)


def numbered_words(d: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """(doc_id, words): each text's word numbers, packed, in the checkpoint folder, so that texts are cut up once."""
    kind = number_type(len(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordIds(vocabulary)
        for b in slices(batches):
            w, off = ids.batch(b.column("text").to_pylist())
            packed = binary_rows(np.where(w < 0, np.iinfo(kind).max, w).astype(kind), np.diff(off))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), packed], ["doc_id", "words"])

    return cut_lineage(d.mapInArrow(run, "doc_id long, words binary"))


def number_type(size: int) -> type:
    return np.uint16 if size < (1 << 16) - 1 else np.uint32


def unpacked(b: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers (`size` for words outside the vocabulary) of a slice of `numbered_words`, and offsets."""
    parts = [np.frombuffer(x.as_buffer(), number_type(size)) for x in b.column("words")]
    w = np.concatenate(parts).astype(np.int64)
    return np.minimum(w, size), np.append(0, np.cumsum([len(p) for p in parts])).astype(np.int64)


LEAKS = "doc_id long, item_id long, cosine double, lcs double, answer double, start long, end long"


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    rank: int = 128,
    cosine: float = 0.35,
    least_lcs: float = 0.6,
    least_answer: float = 0.5,
    max_df: float = 0.01,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
) -> DataFrame:
    """(id, item_id, cosine, lcs, answer, start, end): the items that a document holds, nearly or in full.

    lcs: share of the item's words found in order within the passage and five quarters of an item's length around it;
    answer: share of the third of its distinct words that are rarest in the corpus. start and end are word positions of
    the passage with the best lcs. Both shares must reach their limits. Terms in more than `max_df` of all blocks don't
    enter the latent space (they do count in lcs and answer), except the eight rarest of each item and of parts without
    any; document frequencies and the space come from all passages.

    Null texts and items without words match nothing; items with null ids are left out; rows with null ids are
    searched and keep their null; repeated ids each give rows; an empty benchmark gives no rows. Items of more than
    BENCHMARK_CHARS in all are searched for in several passes, each with a space of its own.
    """
    item_text = F.col(f"`{text_col}`").cast("string")
    bench = benchmark.select(F.col(f"`{item_col}`").cast("long").alias("item_id"), item_text.alias("text")).where("item_id is not null and text is not null")
    sizes = bench.groupBy("item_id").agg(F.sum(F.length("text")).alias("n")).orderBy("item_id").collect()  # two numbers per item
    cuts, held = [], 0
    for i, r in enumerate(sizes):
        if not i or held + r["n"] > BENCHMARK_CHARS:
            cuts.append(r["item_id"])
            held = 0
        held += r["n"]
    parts = [bench.where((F.col("item_id") >= a) & (F.lit(True) if z is None else F.col("item_id") < z)) for a, z in zip(cuts, [*cuts[1:], None])]
    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    found = [_find(d, items, rank, cosine, least_lcs, least_answer, max_df) for part in parts if (items := [(i, w) for i, t in sorted(map(tuple, part.collect())) if (w := words(t))])]
    nothing = docs.sparkSession.createDataFrame([], LEAKS)
    return (reduce(DataFrame.unionByName, found) if found else nothing).withColumnRenamed("doc_id", id_col)


def _find(d: DataFrame, items: list[tuple[int, list[str]]], rank: int, cosine: float, least_lcs: float, least_answer: float, max_df: float) -> DataFrame:
    """`find_leaks` for items that every task can hold."""
    vocabulary = {w: n for n, w in enumerate(dict.fromkeys(w for _, ws in items for w in ws))}
    size = len(vocabulary)
    numbers = [np.array([vocabulary[w] for w in ws]) for _, ws in items]

    texts = numbered_words(d, vocabulary)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(size + 1)
        for b in slices(batches):
            w, off = unpacked(b, size)
            block, first = blocks(off)
            keep = w < size
            total[:size] += np.bincount(term_counts(block[keep], w[keep], size)[1], minlength=size)
            total[size] += first[-1]
        return total

    counts = summed(texts, frequencies, (size + 1,))
    df, n_blocks = counts[:size], counts[size]
    weight = np.log((n_blocks + len(items)) / (df + 1))
    usable = df <= max_df * n_blocks
    pieces = [(i, part) for i, w in enumerate(numbers) for part in parts_of(w)]
    for w in numbers:
        distinct = np.unique(w)
        usable[distinct[np.argsort(df[distinct], kind="stable")[:8]]] = True
    for _, w in pieces:
        distinct = np.unique(w)
        if not usable[distinct].any():
            usable[distinct[np.argsort(df[distinct], kind="stable")[:8]]] = True
    weight = np.where(usable, np.maximum(weight, 1e-3), 0).astype(np.float32)
    rare = np.append(usable, False)
    width = min(rank + 8, size)

    def product(basis: np.ndarray) -> np.ndarray:
        """A^T (A basis) over all passages of documents and items."""
        scaled = (basis * weight[:, None]).astype(np.float32)

        def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            total = np.zeros((size, width))
            for b in slices(batches):
                w, off = unpacked(b, size)
                block, first = blocks(off)
                keep = rare[w]
                block, w, tf = term_counts(block[keep], w[keep], size)
                y = passage_sums(add_rows(np.zeros((int(first[-1]), width), np.float32), block, scaled, w, tf), first)
                back = y.copy()  # a word of block i is in passages i and i - 1
                inner = np.ones(len(y), bool)
                inner[first[:-1][np.diff(first) > 0]] = False
                at = np.flatnonzero(inner)
                back[at] += y[at - 1]
                order = np.argsort(w, kind="stable")
                add_rows(total, w[order], back, block[order], tf[order])
            return total * weight[:, None]

        z = summed(texts, partial, (size, width))
        for w in numbers:
            _, w, tf = term_counts(np.zeros(len(w), np.int64), w, size)
            z[w] += (weight[w] * tf)[:, None] * (scaled[w] * tf[:, None]).sum(0)
        return z

    g = np.linalg.qr(np.random.default_rng(9).standard_normal((size, width)))[0]
    y = product(g)
    nudge = 1e-7 * max(np.linalg.norm(y), 1e-12)
    y += nudge * g
    core = g.T @ y
    root = np.linalg.cholesky((core + core.T) / 2 + nudge * np.eye(width))
    vectors, singular, _ = np.linalg.svd(np.linalg.solve(root, y.T).T, full_matrices=False)
    vectors, values = vectors[:, :rank], np.maximum(singular[:rank] ** 2 - nudge, 0)
    # Strong directions, those of frequent words, are damped so that they don't drown an item's own; weak ones are not
    # raised, so that a paraphrase's missing words don't count for more than those it has.
    scale = (values + max(values.mean(), 1e-12)) ** -0.5
    space = (vectors * weight[:, None] * scale).astype(np.float32)
    of_piece, at, tf = term_counts(np.repeat(np.arange(len(pieces)), [len(w) for _, w in pieces]), np.concatenate([w for _, w in pieces]), size)
    latent = add_rows(np.zeros((len(pieces), space.shape[1]), np.float32), of_piece, space, at, tf)
    item_starts = np.flatnonzero(np.diff([i for i, _ in pieces], prepend=-1))
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)
    lengths = [len(w) for w in numbers]
    masks, answers = [], []
    for w in numbers:
        m: dict[int, int] = {}
        for p, c in enumerate(w.tolist()):
            m[c] = m.get(c, 0) | (1 << p)
        masks.append(m)
        distinct = sorted(m, key=lambda c: (df[c], c))
        answers.append(set(distinct[: max(1, len(distinct) // 3)]))
    # Whatever the item, a match needs so many of its words and of its answer's around the passage; fewer rule it out.
    strides = [max(BLOCK, n // 4) for n in lengths]
    reach = max(n + x for n, x in zip(lengths, strides))
    known, telling = np.append(np.ones(size, bool), False), np.zeros(size + 1, bool)
    telling[list(set().union(*answers))] = True
    least_known = min(int(np.ceil(least_lcs * n - 1e-9)) for n in lengths)
    least_telling = min(int(np.ceil(least_answer * len(a) - 1e-9)) for a in answers)

    holders, held = holders_of(answers, size)
    enough_told = np.array([int(np.ceil(least_answer * len(a) - 1e-9)) for a in answers])
    around = np.array(lengths) + np.array(strides)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            w, off = unpacked(b, size)
            block, first = blocks(off)
            keep = rare[w]
            in_block, at, tf = term_counts(block[keep], w[keep], size)
            many = np.bincount(in_block, minlength=int(first[-1]))
            possible = passage_sums(many[:, None], first)[:, 0] > 0  # a passage without usable words has no direction
            possible &= near_enough(w, off, first, known, reach, least_known) & near_enough(w, off, first, telling, reach, least_telling)
            some = np.flatnonzero(possible)
            possible[1:] |= possible[:-1]  # the second block of a passage
            used = possible[in_block]
            z = passage_sums(add_rows(np.zeros((int(first[-1]), space.shape[1]), np.float32), in_block[used], space, at[used], tf[used]), first)[some]
            z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)
            rows = []
            if len(some):
                cos = np.maximum.reduceat(z @ latent.T, item_starts, axis=1)
                p, i = np.nonzero(cos >= cosine)
                best_first = np.argsort(-cos[p, i], kind="stable")
                p, i = p[best_first], i[best_first]
                doc = np.searchsorted(first, some[p], "right") - 1
                told_enough = told_at_most(w, block, first, holders, held, around, some[p], i, doc) >= enough_told[i]
                best: dict[tuple[int, int], tuple] = {}
                looked: dict[tuple[int, int], list[int]] = {}
                for x, item, r, c, enough in zip(some[p].tolist(), i.tolist(), doc.tolist(), cos[p, i].tolist(), told_enough.tolist()):
                    start, wide = int(off[r] + (x - first[r]) * BLOCK), lengths[item] + strides[item]
                    # What is around a passage less than a stride away has been looked at.
                    seen = looked.setdefault((r, item), [])
                    at_ = bisect_left(seen, start)
                    if (at_ and start - seen[at_ - 1] < strides[item]) or (at_ < len(seen) and seen[at_] - start < strides[item]):
                        continue
                    seen.insert(at_, start)
                    if not enough:
                        continue
                    near = w[max(int(off[r]), start - wide) : min(int(off[r + 1]), start + 2 * BLOCK + wide)].tolist()
                    told = len(answers[item].intersection(near)) / len(answers[item])
                    if told < least_answer:
                        continue
                    share = lcs(masks[item], lengths[item], near) / lengths[item]
                    if share >= least_lcs and ((r, item) not in best or best[r, item][1] < share):
                        best[r, item] = (c, share, told, start - int(off[r]), min(int(off[r + 1]), start + 2 * BLOCK) - int(off[r]))
                names = b.column("doc_id").to_pylist()
                rows = [(names[r], items[item][0], *v) for (r, item), v in sorted(best.items())]
            types = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], ["doc_id", "item_id", "cosine", "lcs", "answer", "start", "end"])

    return texts.mapInArrow(search, LEAKS)
