"""Structure repair, centroid clustering and near-duplicate vectors against plain versions, over awkward rows."""

import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lorespark.llm import closeness, clustering, structure

BLANK = " \t\n\v\f\r"
NEXT = {("0", "s"): "1", ("0", "u"): "2", ("1", "u"): "2", ("3", "u"): "2", ("2", "a"): "3"}
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def order(row):
    turn, role, text = row
    return (turn is not None, turn or 0, role, text)


def damaged(rows):
    out = {}
    for c, t, r, x in rows:
        mine = out.setdefault(c, [])
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if kind == 1 else "".join(k for k in x if k not in ".!?") if kind == 2 else x
        mine += [(t, "user" if kind == 4 else r, x)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def plain_repair(turns):
    """(counts, cost, audit, repaired) by keeping, for each state, the least (cost, audit, turns)."""
    turns = sorted(turns, key=order)
    known = [t for t, _, _ in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
    counts, had, best = {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}, set(), {"0": (0, "", ())}

    def inserts(best):
        for _ in range(4):
            for q, (cost, audit, out) in list(best.items()):
                for role in ("user", "assistant"):
                    if to := NEXT.get((q, role[0])):
                        new = (cost + 2, audit + "I", (*out, f"{role}:"))
                        best[to] = min(best.get(to, new), new)
        return best

    best = inserts(best)
    for _, role, text in turns:
        body = text.strip(BLANK)
        kind = "blank" if not body else "duplicate" if (role, text) in had else "" if body[-1] in ".!?" else "truncated"
        had.add((role, text))
        counts[kind] += 1
        nxt = {}
        for q, (cost, audit, out) in best.items():
            ways = [(q, cost + 3, audit + "D", out)]
            if kind in ("", "truncated"):
                late = kind != ""
                for name, price, edit in ((role, 0, "K"), ("user", 2, "R"), ("assistant", 2, "R")):
                    if to := NEXT.get((q, name[:1])):
                        ways.append((to, cost + price + late, audit + edit, (*out, f"{name}:{text}")))
            for to, *way in ways:
                nxt[to] = min(nxt.get(to, tuple(way)), tuple(way))
        best = inserts(nxt)
    cost, audit, out = min(best[q] for q in "03" if q in best)
    return gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def conversations(seed=1, n=60):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "u", "sys", "User"]
    texts = ["Yes.", "No!", "Why?", "cut off", " ", "", None, "\t\n", "end. ", "same text.", "é…", "x ", " ", "z" * 3000 + "."]
    rows = []
    for c in [*range(n), None, 10**12, -3]:
        size = rng.choice([1, 2, 3, 5, 8, 8, 8, 13, 40])
        rows += [(c, rng.choice([i, i, i, i, rng.randrange(size), None, 10 * i, -i]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.6 else f"text {rng.random()}.") for i in range(size)]
    rows += [(777, 5, "user", "again.")] * 30  # repeated rows
    rows += [(778, None, None, None)] * 3
    rows += [(779, i, ("user", "assistant")[i % 2], f"turn {i}.") for i in range(700)]  # a long one
    rows += [(c, t, "user", "dropped.") for c in range(800, 830) for t in range(40) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]  # nothing is left of these
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    """With extra columns whose names the operator uses inside, over several partitions."""
    clash = ["part", "number", "whole", "turns", "at", "said", "place", "under", "state", "live"]
    schema = "conv_id long, turn long, role string, text string, " + ", ".join(f"`{c}` string" for c in clash)
    return spark.createDataFrame([(*r, *["x"] * len(clash)) for r in rows], schema).repartition(5)


def summaries(found):
    digest = F.sha2(structure.lines(F.col("turns")).cast("binary"), 256).alias("repaired_sha256")
    sealed = structure.sealed(found.pieces).withColumnRenamed("conv_id", "c")
    split = found.split.join(sealed, F.col("conv_id").eqNullSafe(F.col("c"))).select(COLUMNS)
    return sorted((tuple(r) for r in found.whole.select(*COLUMNS[:-1], digest).unionByName(split).collect()), key=str)


@pytest.mark.parametrize("piece_rows,fan,partitions", [(512, 64, 4), (3, 2, 9), (1, 2, 3)])
def test_structure_equals_plain_version(spark, piece_rows, fan, partitions):
    rows = conversations()
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = structure.repair(structure.damaged(frame(spark, rows)), piece_rows, fan)
        got = summaries(found)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = sorted(((c, *plain_repair(t)) for c, t in damaged(rows).items()), key=str)
    assert got == want
    assert any(r[6] > 20 for r in want) and sum(r[7] == "" for r in want) >= 10


def test_structure_of_no_rows(spark):
    found = structure.repair(structure.damaged(frame(spark, [])))
    assert summaries(found) == []


def test_layers_reach_every_profile_and_lose_no_cost():
    """Words of layers against plain costs, for all row sequences of up to four codes."""
    def plain(codes, q):
        if not codes:
            return {0: 0, 1: 4, 2: 2, 3: 0}[q]
        wanted = structure.WANTED[q]
        to = structure.NEXT[wanted][q]
        ways = []
        for inserted, state in ((0, q), (2, to), (4, structure.NEXT[structure.WANTED[to]][to])):
            ways.append(inserted + 3 + plain(codes[1:], state))
            if codes[0] != structure.GONE:
                late = codes[0] >> 2
                kept = structure.NEXT.get("sua "[codes[0] & 3], {}).get(state)
                if kept is not None:
                    ways.append(inserted + late + plain(codes[1:], kept))
                ways.append(inserted + 2 + late + plain(codes[1:], structure.NEXT[structure.WANTED[state]][state]))
        return min(ways)

    for n in range(4):
        for codes in itertools.product(range(9), repeat=n):
            words, bases = structure.backward(bytes(codes))
            assert words[0] in structure.profiles()
            for q in range(4):
                assert sum(bases) + structure.layer(words[0], q) == plain(codes, q)


# --- clustering ---


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y", 1) for i, v in rows], "vec_id long, embedding array<double>, cluster string, x string, row int").repartition(3)


def plain_clusters(rows, k, rounds, dim):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest(), np.array(v, np.int32).tobytes(), v) for i, v in kept)
    centroids = [v for _, _, v in named[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(x) // len(groups[j]) for x in zip(*groups[j])] if j in groups else c for j, c in enumerate(centroids)]
    found = [(i, *nearest(v)) for i, v in kept]
    whole = sum(d for _, d, _ in found)
    text = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, j, d, sum(e for _, e, h in found if h == j), whole, text[j]) for i, d, j in found]


def awkward_vectors(dim, n=150, seed=2):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    rows = [(i, [x + rng.gauss(0, 0.1) for x in rng.choice(centres)]) for i in range(n)]
    rows += [(i + n, [float(rng.randrange(-2, 3)) / 256 for _ in range(dim)]) for i in range(30)]  # many ties
    rows += [(5, rows[5][1])] * 4 + [(None, rows[7][1]), (None, [0.0] * dim), (1000, rows[9][1]), (3, [-x for x in rows[3][1]])]
    rows += [(2000, None), (2001, []), (2002, [1.0]), (2003, [None] + [0.5] * (dim - 1)), (2004, [math.inf] * dim), (2005, [math.nan] * dim), (2006, [0.0] * dim), (2007, [-0.0] * dim), (2008, [1e4] * dim), (2009, [1e-9] * dim), (2010, [0.5] * (dim + 1))]
    return rows


@pytest.mark.parametrize("k,rounds,dim", [(7, 5, 12), (40, 2, 64), (1000, 1, 8)])
def test_clusters_equal_plain_version(spark, k, rounds, dim):
    rows = awkward_vectors(dim)
    found, centroids = clustering.cluster_vectors(vectors(spark, rows), k, rounds, dim)
    got = [tuple(r) for r in clustering.with_inertia(found, centroids).collect()]
    assert sorted(got, key=str) == sorted(plain_clusters(rows, k, rounds, dim), key=str)


def test_clusters_of_no_vectors(spark):
    found, centroids = clustering.cluster_vectors(vectors(spark, [(1, None), (2, [1.0])]))
    assert clustering.with_inertia(found, centroids).collect() == []


def test_screening_spares_distances():
    rng = np.random.default_rng(0)
    centroids = rng.integers(-2000, 2000, (40, 64))
    x = centroids[rng.integers(0, 40, 3000)] + rng.integers(-200, 200, (3000, 64))
    small = clustering.compressed(x)
    cluster, distance, took = clustering.nearest_centroid(x, small, centroids, clustering.compressed(centroids))
    every = ((x[:, None] - centroids[None]) ** 2).sum(2)
    assert (cluster == every.argmin(1)).all() and (distance == every.min(1)).all() and took < 2 * len(x)


def test_huge_components_are_held(spark):
    rows = [(1, [1e300] * 64), (2, [-1e300] * 64), (3, [0.0] * 64)]
    found, _ = clustering.cluster_vectors(vectors(spark, rows), k=1, rounds=0)
    assert all(0 <= r.distance < 1 << 63 for r in found.collect())


# --- near copies ---


def plain_near(rows, threshold=0.9):
    fine = [x for x, (_, v) in enumerate(rows) if v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    unit = {x: np.array(rows[x][1]) / max(map(abs, rows[x][1])) for x in fine}
    unit = {x: u / math.sqrt(float(u @ u)) for x, u in unit.items()}
    links = {x: [y for y in fine if y != x and len(unit[x]) == len(unit[y]) and float(unit[x] @ unit[y]) >= threshold] for x in fine}
    out, component = [], {}
    for x in range(len(rows)):
        if x not in component:
            todo, seen = [x], {x}
            while todo:
                for y in links.get(todo.pop(), ()):
                    if y not in seen:
                        seen.add(y)
                        todo.append(y)
            component |= dict.fromkeys(seen, min((rows[y][0] for y in seen if rows[y][0] is not None), default=None))
        i, n, c = rows[x][0], len(links.get(x, ())), component[x]
        out.append((i, n, c, i == c if i is not None and c is not None else n == 0))
    return out


def near_rows(dim, seed=3):
    rng = random.Random(seed)
    rows = awkward_vectors(dim, 80)
    for i in range(60):
        base = [rng.gauss(0, 1) for _ in range(dim)]
        rows += [(3000 + 10 * i + k, [x + rng.gauss(0, 0.3) for x in base]) for k in range(rng.randrange(1, 5))]
    rows += [(4000 + i, [x * 2.0**i for x in rows[0][1]]) for i in range(-3, 3)] + [(4100, [1e200] * dim), (4101, [1e-200] * dim), (4102, [3.0, 4.0]), (4103, [3.0, 4.1]), (4104, [2.0]), (4105, [5.0]), (4106, [-5.0])]
    return rows


@pytest.mark.parametrize("dim", [12, 64])
def test_near_copies_equal_plain_version(spark, dim):
    rows = near_rows(dim)
    got = [tuple(r) for r in closeness.near_copies(vectors(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(plain_near(rows), key=str)


def test_near_copies_of_no_vectors(spark):
    assert closeness.near_copies(vectors(spark, [])).collect() == []
    assert [tuple(r) for r in closeness.near_copies(vectors(spark, [(None, None)])).collect()] == [(None, 0, None, True)]


def test_near_copies_in_buckets_and_blocks(spark):
    """Blocks of 16 vectors and several tables: buckets span blocks and partitions, and no pair counts twice."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((1200, 32))
    x[600:900] = x[:300] + 0.25 * rng.standard_normal((300, 32))
    x[900:1150] = x[5] + 0.2 * rng.standard_normal((250, 32))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = {r.vec_id: tuple(r)[1:] for r in closeness.near_copies(vectors(spark, rows), block=16).collect()}
    want = {i: r for i, *r in plain_near(rows)}
    links, found = sum(r[0] for r in want.values()), sum(r[0] for r in got.values())
    assert all(got[i][0] <= want[i][0] for i in want) and found >= 0.99 * links
    assert closeness.plan(32, 1200, 0.9, 0.99, 16).tables > 1


def test_collisions_are_counted_as_defined():
    rng = np.random.default_rng(5)
    a, b = rng.standard_normal((70, 24)), rng.standard_normal((201, 24))
    for needed in (1, 7, 12, 24):
        got = np.unpackbits(closeness.colliding(a, b, 0.9, needed).view(np.uint8), axis=1, bitorder="little", count=201)
        assert (got == ((np.abs(a[:, None] - b[None]) <= 0.9).sum(2) >= needed)).all()


def test_recall_at_the_threshold():
    """Pairs of exactly cosine 0.9 among many: met in a table and counted often enough."""
    rng = np.random.default_rng(6)
    p = closeness.plan(64, 50_000, 0.9, 0.99)
    a = closeness.unit(rng.standard_normal((2000, 64)))
    side = rng.standard_normal((2000, 64))
    side = closeness.unit(side - (side * a).sum(1, keepdims=True) * a)
    b = 0.9 * a + math.sqrt(1 - 0.81) * side
    met = (closeness.bucket_keys(a, p) == closeness.bucket_keys(b, p)).any(1)
    turn = closeness.axes(64, closeness.PROJECTIONS, 15)
    often = (np.abs(a @ turn - b @ turn) <= p.half).sum(1) >= p.needed
    assert p.cells > 0 and (met & often).mean() >= 0.98
