"""Similarity self-join on word n-gram sets: MinHash banding for candidates, full sets for the decision."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import U, binary_rows, inside, mix, pieces, row_of, runs, span_hashes, texts, window_hashes, word_spans
from .common import cut_lineage
from .components import components

#: Buckets of more classes than this are verified in blocks instead of as single pairs. That changes the plan, not the
#: result: either way a link is a pair that shares a band and is similar enough.
LARGE_BUCKET = 16
BLOCK = 512
#: Bytes of text hashed at a time.
PIECE = 1 << 20
#: Ways that the rows of one group are dealt to tasks where each needs a figure of its group.
SALTS = 16


def choose_bands(threshold: float, recall: float, most: int = 128) -> tuple[int, int]:
    """(bands, rows): the most selective banding of at most `most` hashes that finds a pair at `threshold` with `recall`.

    A pair of similarity s shares a band of r rows with probability s**r, and one of b bands with 1 - (1 - s**r)**b.
    """
    best = None
    for r in range(1, most + 1):
        p = threshold**r
        b = 1 if p >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-p))
        if b * r <= most:
            best = (b, r)
    if best is None:
        raise ValueError("no banding reaches that recall with so few hashes")
    return best


def ngram_sets(b: np.ndarray, off: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct word n-grams of each row, sorted, and the rows' offsets.

    A text of fewer than n words (but some) has one gram, all its words; one without words has none.
    """
    s, e, first = word_spans(b, off)
    h = span_hashes(b, s, e)
    rows = len(off) - 1
    ok = inside(first, len(h), n)
    gram, row = window_hashes(h, n)[ok], row_of(first, len(h))[: len(ok)][ok]
    count = np.diff(first)
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        whole = np.array([int(mix(np.array([sum(int(x) * pow(0x9FB21C651E98DF25, i + 1, 1 << 64) for i, x in enumerate(h[first[r] : first[r + 1]])) % (1 << 64)], U))[0]) for r in short], U)
        gram, row = np.concatenate([gram, whole]), np.concatenate([row, short])
    order = np.lexsort((gram, row))
    gram, row = gram[order], row[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (row[1:] != row[:-1])
    gram, row = gram[new], row[new]
    return gram, np.searchsorted(row, np.arange(rows + 1))


def signatures(gram: np.ndarray, first: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash per non-empty row and band: of the `rows` smallest values under as many hash functions."""
    full = np.flatnonzero(np.diff(first))
    out = np.zeros((len(full), bands), U)
    if not len(full):
        return out
    rng = np.random.default_rng(5)
    a = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64) * U(2) + U(1)
    c = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64)
    at = first[full]
    for j in range(bands):
        acc = np.full(len(full), j + 1, U)
        for i in range(j * rows, (j + 1) * rows):
            acc = mix(acc * U(0xD6E8FEB86659FD93) + np.minimum.reduceat(gram * a[i] + c[i], at))
        out[:, j] = acc
    return out


def similar_enough(common: np.ndarray, x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """|A and B| / |A or B| >= threshold, with a hair's breadth for thresholds that floats can't hold."""
    return common >= threshold * (x + y - common) - 1e-9


def common_counts(a: list[np.ndarray], b: list[np.ndarray], columns: int = 1 << 13) -> np.ndarray:
    """The sizes of all intersections of the sets `a` with the sets `b`, as blocked products of 0/1 matrices."""
    out = np.zeros((len(a), len(b)), np.float32)
    na, nb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    va, vb = np.concatenate(a), np.concatenate(b)
    shared = np.intersect1d(va, vb)
    ra, rb = np.repeat(np.arange(len(a)), na), np.repeat(np.arange(len(b)), nb)
    pa_, pb_ = np.searchsorted(shared, va), np.searchsorted(shared, vb)
    if not len(shared):
        return out
    ka, kb = shared[np.minimum(pa_, len(shared) - 1)] == va, shared[np.minimum(pb_, len(shared) - 1)] == vb
    ra, pa_, rb, pb_ = ra[ka], pa_[ka], rb[kb], pb_[kb]
    for lo in range(0, len(shared), columns):
        width = min(columns, len(shared) - lo)
        x, y = np.zeros((len(a), width), np.float32), np.zeros((len(b), width), np.float32)
        i, j = (pa_ >= lo) & (pa_ < lo + width), (pb_ >= lo) & (pb_ < lo + width)
        x[ra[i], pa_[i] - lo] = 1
        y[rb[j], pb_[j] - lo] = 1
        out += x @ y.T
    return out


def share_a_band(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of `a` and `b` (band values by column) agree in some column."""
    out = np.zeros((len(a), len(b)), bool)
    for j in range(a.shape[1]):
        out |= a[:, j][:, None] == b[:, j][None, :]
    return out


def with_group_figures(rows: DataFrame, figures: DataFrame) -> DataFrame:
    """`rows` (node, component ...) with the columns of `figures` (one row per component). A hot component's rows are
    dealt to SALTS tasks."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    return salted.join(figures.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["component", "salt"]).drop("salt")


def block_links(block: np.ndarray, rep: np.ndarray, copies: np.ndarray, sets: list[np.ndarray], bands: np.ndarray, threshold: float):
    """(rep, linked documents) and a spanning forest of the links of one pair of blocks (or one block with itself)."""
    order = np.lexsort((rep, block))
    block, rep, copies, bands, sets = block[order], rep[order], copies[order], bands[order], [sets[i] for i in order]
    cut = int(np.searchsorted(block, block[0], "right"))
    if block[-1] != block[0]:
        one, two, same = slice(0, cut), slice(cut, None), False
    else:
        one, two, same = slice(None), slice(None), True
    n = np.array([len(s) for s in sets], np.float64)
    link = share_a_band(bands[one], bands[two])
    link &= similar_enough(common_counts(sets[one], sets[two]), n[one][:, None], n[two][None, :], threshold)
    if same:
        np.fill_diagonal(link, False)
    total = np.zeros(len(rep), np.int64)
    total[one] += link @ copies[two]
    if not same:
        total[two] += link.T @ copies[one]
    x, y = np.arange(len(rep))[one], np.arange(len(rep))[two]
    parent = list(range(len(rep)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    edges = []
    for i in range(len(x)):
        for j in y[np.flatnonzero(link[i])].tolist():
            p, q = root(int(x[i])), root(j)
            if p != q:
                parent[max(p, q)] = min(p, q)
                edges.append((int(rep[x[i]]), int(rep[j])))
    return total, rep, edges


def jaccard_join(
    docs: DataFrame,
    threshold: float = 0.8,
    n: int = 5,
    recall: float = 0.9999,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Join `docs` with itself on the Jaccard similarity of word n-gram sets, at least `threshold`.

    Returns one row per input row: the id; class_id, the smallest id with the same n-gram set; group_id, the smallest
    id that links lead to, over any number of them; n_ngrams; n_links, the number of other rows (copies included) at
    least that similar and found by a shared band, as all but one in 1 / (1 - recall) are at the threshold and more
    above it. No pairs are returned, so a group of copies costs one row per member.

    1. Rows with equal sets form a class; only one set per class goes on.
    2. Bands of MinHash values, their number chosen for `recall` at the threshold, deal classes into buckets.
    3. Classes of small buckets are paired and each pair is verified once on the full sets. Classes that large buckets
       connect form groups; each group is verified in blocks of about 512 x 512 sets, with pairs counted in place. A
       group of m different texts that are all alike has m squared / 2 links to count, and takes as much work.

    Words are runs of bytes other than space and tab to carriage return, unchanged. A text of fewer than n words counts
    as one gram; texts without words (and null texts) are one class and link to each other alone. Rows with null ids
    have null class and group and no links. Rows that share an id and a text are copies; rows that share only the id
    are joined by text as if they had different ids, but share the reported ids. An empty table gives no rows.
    """
    bands, rows = choose_bands(threshold, recall)
    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", PIECE):
            gram, first = ngram_sets(*texts(batch.column("text")), n)
            size = np.diff(first)
            full = np.flatnonzero(size)
            ident = np.zeros((batch.num_rows, 2), U)
            if len(full):
                for i, x in enumerate((gram, mix(gram ^ U(0xA5A5A5A5DEADBEEF)))):
                    ident[full, i] = np.add.reduceat(x, first[full])
            sig = signatures(gram, first, bands, rows)
            lens = np.zeros(batch.num_rows, np.int64)
            lens[full] = bands
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ident[:, 0].view(np.int64)), pa.array(ident[:, 1].view(np.int64)), pa.array(size.astype(np.int64)),
                 pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lens)).astype(np.int32)), pa.array(sig.ravel().view(np.int64)))],
                ["doc_id", "s1", "s2", "n_ngrams", "bands"],
            )

    signed = cut_lineage(d.mapInArrow(sign, "doc_id long, s1 long, s2 long, n_ngrams long, bands array<long>"))
    ids = signed.where("doc_id is not null")
    same = ["s1", "s2", "n_ngrams"]
    classes = cut_lineage(ids.groupBy(*same).agg(F.min(F.struct("doc_id", "bands")).alias("r"), F.count(F.lit(1)).alias("copies")).select(*same, F.col("r.doc_id").alias("class_id"), "copies", F.col("r.bands").alias("bands")))
    # A class goes on under a number of its own, its set's: two texts may share one doc_id.
    nodes = classes.select(F.xxhash64("s1", "s2").alias("node"), "class_id", "s1", "s2", "n_ngrams", "copies", "bands")

    banded = nodes.select("node", "n_ngrams", F.posexplode("bands").alias("j", "v")).select("node", "n_ngrams", F.xxhash64("j", "v").alias("bucket"))
    buckets = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"), F.min("node").alias("hub")).where("members > 1")
    members = cut_lineage(banded.join(buckets, "bucket"))

    large = members.where(F.col("members") > LARGE_BUCKET)
    groups = components(large.select(F.col("node").alias("a"), F.col("hub").alias("b")))
    small = members.where(F.col("members") <= LARGE_BUCKET).select("bucket", "node", "n_ngrams").join(groups, "node", "left")
    other = small.select("bucket", *[F.col(c).alias(f"{c}_2") for c in ("node", "n_ngrams", "component")])
    pairs = (
        small.join(other, "bucket")
        .where("node < node_2 and not coalesce(component = component_2, false)")
        .where(F.least("n_ngrams", "n_ngrams_2") >= threshold * F.greatest("n_ngrams", "n_ngrams_2") - 1e-9)
        .select(F.col("node").alias("a"), F.col("node_2").alias("b"))
        .distinct()
    )

    def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", PIECE):
            gram, first = ngram_sets(*texts(batch.column("text")), n)
            keep = np.zeros((batch.num_rows, 2), np.int64)
            full = np.flatnonzero(np.diff(first))
            if len(full):
                for i, x in enumerate((gram, mix(gram ^ U(0xA5A5A5A5DEADBEEF)))):
                    keep[full, i] = np.add.reduceat(x, first[full]).view(np.int64)
            good = np.flatnonzero((keep[:, 0] == batch.column("s1").to_numpy()) & (keep[:, 1] == batch.column("s2").to_numpy()))
            packed = binary_rows(gram, np.diff(first)).take(pa.array(good))
            yield pa.RecordBatch.from_arrays([batch.column("node").take(pa.array(good)), packed], ["node", "grams"])

    wanted = members.select("node").distinct().join(nodes.select("node", "class_id", "s1", "s2"), "node")
    sets = d.join(wanted, d.doc_id == wanted.class_id).select("text", "node", "s1", "s2").mapInArrow(full_sets, "node long, grams binary")
    sets = cut_lineage(sets.dropDuplicates(["node"]))
    copies = nodes.select("node", "copies")
    signed_nodes = nodes.select("node", "copies", "bands")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for i, (x, y) in enumerate(zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())):
                x, y = np.frombuffer(x, U), np.frombuffer(y, U)
                common = len(np.intersect1d(x, y, assume_unique=True))
                if similar_enough(common, len(x), len(y), threshold):
                    good.append(i)
            yield batch.select(["a", "b"]).take(pa.array(good, pa.int64()))

    verified = (
        pairs.join(sets.select(F.col("node").alias("a"), F.col("grams").alias("x")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("grams").alias("y")), "b")
        .select("a", "b", "x", "y")
        .mapInArrow(check, "a long, b long")
    )
    verified = cut_lineage(verified)

    sized = groups.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    placed = with_group_figures(groups, sized).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    placed = placed.join(signed_nodes, "node").select("node", "component", "block", "copies", "bands", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o"))
    placed = placed.select("node", "component", "block", "copies", "bands", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"))

    def verify(t: pa.Table) -> pa.Table:
        sets = [np.frombuffer(x, U) for x in t.column("grams").to_pylist()]
        values = np.array(t.column("bands").to_pylist(), np.int64)
        total, rep, edges = block_links(t.column("block").to_numpy(), t.column("node").to_numpy(), t.column("copies").to_numpy(), sets, values, threshold)
        a = [*rep.tolist(), *[e[0] for e in edges]]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array([None] * len(rep) + [e[1] for e in edges], pa.int64()), "links": pa.array([*total.tolist(), *[0] * len(edges)], pa.int64())})

    in_groups = cut_lineage(placed.join(sets, "node").select("component", "i", "j", "block", "node", "copies", "bands", "grams").groupBy("component", "i", "j").applyInArrow(verify, "a long, b long, links long"))

    forest = verified.unionByName(in_groups.where("b is not null").select("a", "b"))
    linked = components(forest)
    weights = copies.withColumnRenamed("node", "b")
    single = verified.unionByName(verified.select(F.col("b").alias("a"), F.col("a").alias("b"))).join(weights, "b").select("a", F.col("copies").alias("links"))
    links = single.unionByName(in_groups.where("b is null").select("a", "links")).groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))

    # Only linked classes have a group of more than themselves.
    linked = linked.join(nodes.select("node", "class_id"), "node")
    least = linked.groupBy("component").agg(F.min("class_id").alias("group_id"))
    grouped = with_group_figures(linked, least).select("node", "group_id")
    result = nodes.join(grouped, "node", "left").join(links, "node", "left")
    result = result.select(*same, "class_id", F.coalesce("group_id", "class_id").alias("group_id"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = ids.select("doc_id", *same).join(result, same).select("doc_id", "class_id", "group_id", "n_ngrams", "n_links")
    lost = signed.where("doc_id is null").select("doc_id", F.lit(None).cast("long").alias("class_id"), F.lit(None).cast("long").alias("group_id"), "n_ngrams", F.lit(0).cast("long").alias("n_links"))
    return out.unionByName(lost).withColumnRenamed("doc_id", id_col)
