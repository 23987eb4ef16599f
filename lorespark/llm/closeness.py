"""Near-duplicate vectors: collisions counted in query-centred windows of many sorted projections, then verified."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, comb, erf, exp, log, pi, sqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ann import axes
from .arrays import mix
from .common import reread, shuffle_partitions
from .components import components

#: Vectors compared at once; a bucket of more is dealt in blocks of so many.
BLOCK = 2048
#: Projections counted, and the probability that a pair at the threshold collides on one of them.
PROJECTIONS, COLLIDES = 24, 0.9
#: Width of a cell of the tables, on projections of variance 1.
CELL = 2.5


class Plan(NamedTuple):
    """How vectors of one length are dealt and counted: numbers that follow from how many there are."""

    dim: int
    block: int  # vectors compared at once
    cells: int  # projections that name a bucket
    tables: int
    half: float  # half a window
    needed: int  # collisions that a pair needs to be verified
    threshold: float


def same_cell(distance: float, cell: float = CELL) -> float:
    """The probability that two points at this distance fall into one cell of a random projection with a random offset."""
    r = cell / distance
    return erf(r / sqrt(2)) - 2 / (sqrt(2 * pi) * r) * (1 - exp(-r * r / 2))


def plan(dim: int, n: int, threshold: float, recall: float, block: int = BLOCK) -> Plan:
    """Enough cells that unrelated vectors share a bucket with about `block` others, and enough tables and collisions that a
    pair of exactly the threshold is found with probability `recall`; nearer pairs are found more often."""
    distance = sqrt(2 - 2 * threshold)
    near, far = same_cell(distance), same_cell(sqrt(2))
    cells = max(0, ceil(log(max(n, 1) / block) / -log(far)))
    missed = (1 - recall) / 2  # half of it by the tables, half by the count
    tables = 1 if not cells else max(1, ceil(log(missed) / log(1 - near**cells)))
    needed, below = 0, 0.0
    while below + (p := comb(PROJECTIONS, needed) * COLLIDES**needed * (1 - COLLIDES) ** (PROJECTIONS - needed)) <= missed:
        needed, below = needed + 1, below + p
    width = next(x for x in np.arange(0.0, 6.0, 0.001) if erf(x / sqrt(2)) >= COLLIDES)
    return Plan(dim, block, cells, tables, float(width) * distance, max(1, needed), threshold)


def unit(x: np.ndarray) -> np.ndarray:
    """Each row by its length; scaled first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def bucket_keys(u: np.ndarray, p: Plan) -> np.ndarray:
    """The bucket of each unit vector in each table, as a hash of its cells."""
    rng = np.random.default_rng(13)
    keys = np.zeros((len(u), p.tables), np.uint64)
    if p.cells:
        at = u @ axes(p.dim, p.tables * p.cells, 14) + rng.uniform(0, CELL, p.tables * p.cells)
        cell = np.floor(at / CELL).astype(np.int64).view(np.uint64).reshape(len(u), p.tables, p.cells)
        for i in range(p.cells):
            keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + cell[:, :, i] + np.uint64(1))
    return keys.view(np.int64)


def colliding(a: np.ndarray, b: np.ndarray, half: float, needed: int) -> np.ndarray:
    """Which rows of `b` lie within `half` of each row of `a` on at least `needed` projections (columns): bits, 64 a word.

    Every projection of `b` is sorted; the sets of its first 0, 1, 2, ... entries are kept as bits, so the window around a
    query is the difference of two of them. Windows are added up in binary counters, one bit plane a power of two, that
    start short of overflow by `needed`.
    """
    n, m, words = len(b), a.shape[1], -(-len(b) // 64)
    bits = m.bit_length()
    start = (1 << bits) - needed
    planes = [np.full((len(a), words), ~np.uint64(0) if start >> i & 1 else np.uint64(0)) for i in range(bits)]
    reached = np.zeros((len(a), words), np.uint64)
    for j in range(m):
        order = np.argsort(b[:, j])
        sorted_ = b[order, j]
        first = np.zeros((n + 1, words), np.uint64)
        first[np.arange(1, n + 1), order // 64] = np.uint64(1) << (order % 64).astype(np.uint64)
        np.bitwise_xor.accumulate(first, axis=0, out=first)
        carry = first[np.searchsorted(sorted_, a[:, j] + half, "right")] ^ first[np.searchsorted(sorted_, a[:, j] - half)]
        for plane in planes:
            both = plane & carry
            plane ^= carry
            carry = both
        reached |= carry
    return reached


def linked(a: np.ndarray, b: np.ndarray, p: Plan) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (row of a, row of b) of unit vectors that collide often enough and whose cosine reaches the threshold."""
    turn = axes(p.dim, PROJECTIONS, 15)
    reached = colliding(a @ turn, b @ turn, p.half, p.needed)
    for i in range(0, len(a), 128):
        some = np.unpackbits(reached[i : i + 128].view(np.uint8), axis=1, bitorder="little", count=len(b)).view(bool)
        columns = np.flatnonzero(some.any(0))
        if len(columns):
            x, y = np.nonzero(some[:, columns] & (a[i : i + 128] @ b[columns].T >= p.threshold))
            if len(x):
                yield x + i, columns[y]


class Block(NamedTuple):
    """Classes of equal vectors in ascending order, with how many vectors each has."""

    ids: np.ndarray
    copies: np.ndarray
    x: np.ndarray

    @staticmethod
    def of(ids: np.ndarray, copies: np.ndarray, x: np.ndarray) -> Block:
        order = np.argsort(ids)
        return Block(ids[order], copies[order], x[order])


def visit(a: Block, b: Block | None, table: int, p: Plan) -> pa.RecordBatch:
    """Compare a block with another one (or its rows with each other) and return, for each class that has a link here,
    the linked vectors and the smallest class that these links reach. A pair whose bucket agrees in an earlier table is
    left to that table."""
    ua, ub = unit(a.x), unit(b.x) if b is not None else None
    all_ids = np.concatenate([a.ids, b.ids]) if b is not None else a.ids
    order = np.argsort(all_ids)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    ids, shift = all_ids[order], len(a.ids) if b is not None else 0
    ka = bucket_keys(ua, p)[:, :table] if table else None
    kb = ka if b is None or ka is None else bucket_keys(ub, p)[:, :table]
    found, links = [], np.zeros(len(ids), np.int64)
    for i, j in linked(ua, ua if ub is None else ub, p):
        fresh = np.ones(len(i), bool) if b is not None else i < j
        if table:
            for lo in range(0, len(i), 1 << 16):
                cut = slice(lo, lo + (1 << 16))
                fresh[cut] &= ~(ka[i[cut]] == kb[j[cut]]).any(1)
        i, j = i[fresh], j[fresh]
        left, right = place[i], place[j + shift]
        np.add.at(links, left, (a if b is None else b).copies[j])
        np.add.at(links, right, a.copies[i])
        found.append(forest(left, right, len(ids)))
    root = np.arange(len(ids))
    if found:
        root = roots(np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found]), len(ids))
    at = np.flatnonzero(links)
    return pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(links[at]), pa.array(ids[root[at]])], ["class", "links", "root"])


def roots(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The smallest of n nodes that each reaches over the edges (i, j)."""
    to = np.arange(n)
    while len(i):
        new = to.copy()
        np.minimum.at(new, i, to[j])
        np.minimum.at(new, j, to[i])
        new = new[new]
        if (new == to).all():
            break
        to = new
    return to


def forest(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """At most n edges that connect what the edges (i, j) connect."""
    to = roots(i, j, n)
    at = np.flatnonzero(to != np.arange(n))
    return at, to[at]


LINKS = "class long, links long, root long"
BLOCKS = "dim int, t int, key long, part int, number int, ids binary, copies binary, body binary"


def _packed(batch: pa.RecordBatch, of: Block, dim: int, t: int, key: int, part: int, number: int) -> pa.RecordBatch:
    """The rows of a visit, and after them the block itself for blocks elsewhere of the same bucket."""
    n = batch.num_rows
    row = {"dim": dim, "t": t, "key": key, "part": part, "number": number, "ids": of.ids.tobytes(), "copies": of.copies.tobytes(), "body": of.x.tobytes()}
    kinds = {"dim": pa.int32(), "t": pa.int32(), "key": pa.int64(), "part": pa.int32(), "number": pa.int32(), "ids": pa.binary(), "copies": pa.binary(), "body": pa.binary()}
    columns = [pa.concat_arrays([c, pa.nulls(1, c.type)]) for c in batch.columns]
    return pa.RecordBatch.from_arrays(columns + [pa.array([None] * n + [row[k]], kind) for k, kind in kinds.items()], [*batch.schema.names, *kinds])


def _compared(rows: DataFrame, plans: dict[int, Plan]) -> DataFrame:
    """Links inside the blocks of every bucket, and the blocks of buckets that have several.

    Classes are sorted by table, bucket and number over range partitions, so a bucket of any size is cut into blocks
    without a task for it alone. Only a bucket at a partition's edge or over a block's rows can have other blocks.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim in set(batch.column("dim").to_pylist()):
                part = batch.filter(pc.equal(batch.column("dim"), dim))
                for i in range(0, part.num_rows, BLOCK):
                    some = part.slice(i, BLOCK)
                    keys = bucket_keys(unit(np.frombuffer(b"".join(some.column("x").to_pylist())).reshape(-1, dim)), plans[dim])
                    for t in range(keys.shape[1]):
                        yield pa.RecordBatch.from_arrays([some.column("dim"), pa.array([t] * len(keys), pa.int32()), pa.array(keys[:, t]), some.column("class"), some.column("copies"), some.column("x")], ["dim", "t", "key", "class", "copies", "x"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, have = TaskContext.get().partitionId(), [], 0
        bucket, number, first = None, 0, True

        def flush(more: bool) -> pa.RecordBatch:
            of = Block.of(*(np.concatenate([h[c] for h in held]) for c in (0, 1)), np.concatenate([h[2] for h in held]))
            out = visit(of, None, bucket[1], plans[bucket[0]])
            if more or first or number:
                return _packed(out, of, *bucket, part, number)
            return pa.RecordBatch.from_arrays(out.columns + [pa.nulls(out.num_rows, k) for k in (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())], [*out.schema.names, "dim", "t", "key", "part", "number", "ids", "copies", "body"])

        for batch in batches:
            dims, ts, keys = (batch.column(c).to_numpy() for c in (0, 1, 2))
            ids, copies, x = batch.column(3).to_numpy(), batch.column(4).to_numpy(), batch.column(5)
            cuts = np.flatnonzero((np.diff(dims) != 0) | (np.diff(ts) != 0) | (np.diff(keys) != 0)) + 1
            for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ids)]):
                here = (int(dims[i]), int(ts[i]), int(keys[i])) if j > i else bucket
                if here != bucket:
                    if have:
                        yield flush(False)
                        first = False
                    bucket, number, held, have = here, 0, [], 0
                while i < j:
                    most = plans[here[0]].block
                    if have == most:
                        yield flush(True)
                        number, held, have = number + 1, [], 0
                    take = min(j - i, most - have)
                    held.append((ids[i : i + take], copies[i : i + take], np.frombuffer(b"".join(x.slice(i, take).to_pylist())).reshape(-1, here[0])))
                    i, have = i + take, have + take
        if have:
            yield flush(True)

    dealt = rows.mapInArrow(deal, "dim int, t int, key long, class long, copies long, x binary")
    order = ["dim", "t", "key", "class"]
    return dealt.repartitionByRange(max(shuffle_partitions(rows.sparkSession), 1), *order).sortWithinPartitions(*order).mapInArrow(blocks, f"{LINKS}, {BLOCKS}")


def _across(found: DataFrame, plans: dict[int, Plan]) -> DataFrame:
    """Links between the blocks of one bucket: every pair of blocks once, each pair a row of its own."""
    bucket, name = ["dim", "t", "key"], ["part", "number"]
    blocks = found.where("body is not null").drop("class", "links", "root")
    whole = Window.partitionBy(*bucket)
    named = blocks.select(*bucket, *name).withColumn("of", F.count(F.lit(1)).over(whole)).where("of > 1").withColumn("i", F.row_number().over(whole.orderBy(*name)))
    other = named.select(*bucket, F.col("part").alias("part_b"), F.col("number").alias("number_b"), F.col("i").alias("j"))
    met = named.join(other, bucket).where("i < j").drop("of", "i", "j")
    right = blocks.select(*bucket, *(F.col(c).alias(f"{c}_b") for c in (*name, "ids", "copies", "body")))
    met = met.join(blocks, [*bucket, *name]).join(right.hint("merge"), [*bucket, "part_b", "number_b"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                r = batch.slice(at, 1).to_pylist()[0]
                a, b = (Block(np.frombuffer(r[f"ids{s}"], np.int64), np.frombuffer(r[f"copies{s}"], np.int64), np.frombuffer(r[f"body{s}"]).reshape(-1, r["dim"])) for s in ("", "_b"))
                yield visit(a, b, r["t"], plans[r["dim"]])

    return met.select("dim", "t", "ids", "copies", "body", "ids_b", "copies_b", "body_b").mapInArrow(compare, LINKS)


def near_copies(vectors: DataFrame, threshold: float = 0.9, recall: float = 0.99, block: int = BLOCK, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Links between all vectors whose cosine (double precision) is at least `threshold`, as far as they are found: a pair
    of exactly the threshold with probability `recall` or more, nearer ones more surely, equal vectors always.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing; nor do vectors of different
    lengths. Every row is a vector of its own: rows may share an id, be repeated or have none. Extra columns are left out.

    Equal vectors are one class, compared once and counted as often as it occurs. Classes are dealt into buckets, once a
    table, by the cells of a few projections; within a bucket collisions are counted in blocks. How many cells and tables
    there are follows from the number of classes: comparisons grow with about the power 1.3 of it. No pair is written:
    blocks return one row for each vector that has a link, with its number of links and a smaller class it reaches.
    Returns id_col, n_links (other vectors linked), component_id (the smallest id reachable, its own included; null if
    none has an id) and kept (the id is the component's; a vector without id is kept if it links with nothing).
    """
    v = F.col("v")
    fine = v.isNotNull() & (F.size(v) > 0) & F.exists(v, lambda x: x != 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    rows = rows.select("vec_id", F.when(fine, v).alias("v"), F.monotonically_increasing_id().alias("row"))
    kind = dict(rows.dtypes)["vec_id"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(1)
            flat = np.asarray(v.flatten(), np.float64) + 0.0  # -0.0 equals 0.0
            x = [None if not n else flat[i : i + n].tobytes() for i, n in _runs(v)]
            dims = pa.array([None if b is None else len(b) // 8 for b in x], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), dims, pa.array(x, pa.binary())], ["vec_id", "row", "dim", "x"])

    rows = reread(rows.mapInArrow(encode, f"vec_id {kind}, row long, dim int, x binary").withColumn("digest", F.sha2("x", 256)))
    by = rows.where("x is not null").groupBy("digest").agg(F.min("row").alias("class"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"), F.first("dim").alias("dim"), F.first("x").alias("x"))
    classes = reread(by)
    sizes = classes.groupBy("dim").count().collect()  # one row per vector length
    plans = {r["dim"]: plan(r["dim"], r["count"], threshold, recall, block) for r in sizes}
    found = reread(_compared(classes.select("dim", "class", "copies", "x"), plans))
    links = reread(found.where("class is not null").select("class", "links", "root").unionByName(_across(found, plans)))
    joined = components(links.select(F.col("class").alias("a"), F.col("root").alias("b")))
    counts = links.groupBy("class").agg(F.sum("links").alias("links"))
    known = classes.select("digest", "class", "copies", "least").join(counts, "class", "left").join(joined.withColumnRenamed("node", "class"), "class", "left")
    known = reread(known.select("digest", "copies", "least", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "class").alias("component")))
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = known.join(least.hint("merge"), "component").select("digest", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id")
    out = rows.select("vec_id", "digest").join(known.hint("merge"), "digest", "left")
    alone = F.col("n_links").isNull()
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(alone, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.select(F.col("vec_id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("n_links") == 0).alias("kept"))


def _runs(v: pa.ListArray) -> list[tuple[int, int]]:
    """Start among the flattened values, and length, of each list (null: 0)."""
    n = np.asarray(pc.fill_null(pc.list_value_length(v), 0), np.int64)
    return list(zip((np.cumsum(n) - n).tolist(), n.tolist()))
