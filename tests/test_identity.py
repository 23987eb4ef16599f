"""Components and identities against a union-find, with chains, hot keys and nulls."""

import random

import pytest

from lorespark.operators import identity


def union_find(pairs):
    up = {}

    def top(x):
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return {x: top(x) for x in up}


@pytest.mark.parametrize("shape, hot", [("chain", 10_000), ("mixed", 2)])
def test_components_equal_union_find(spark, shape, hot):
    rng = random.Random(shape)
    ids = list(range(300))
    rng.shuffle(ids)
    chain = list(zip(ids, ids[1:]))[:200]
    star = [(ids[7], x) for x in ids[60:150]]
    some = [(rng.randrange(300), rng.randrange(300)) for _ in range(40)]
    pairs = {"chain": chain, "mixed": chain[:60] + star + some}[shape]
    pairs = [*pairs, *pairs[:5], (7, 7)]  # repeated edges, and one that leads nowhere
    got = {r.node: r.root for r in identity.components(spark.createDataFrame(pairs, "a long, b long"), hot).collect()}
    want = union_find((a, b) for a, b in pairs if a != b)
    assert {**{r: r for r in got.values()}, **got} == want


def test_hot_keys_are_broadcast_and_others_joined(spark):
    links = spark.createDataFrame([("hot" if i % 3 else f"k{i % 30}", 1000 - i) for i in range(900)], "k string, id long")
    got = identity.with_least(links, "k", "id", hot=100, parts=20)
    want = {}
    for k, i in ((r.k, r.id) for r in links.collect()):
        want[k] = min(i, want.get(k, i))
    rows = got.collect()
    assert len(rows) == 900 and all(r.least == want[r.k] for r in rows)
    text = got._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in text


def test_identities(spark):
    rows = [(1, "Ann", "a@x"), (2, "ann", "b@x"), (3, "Bo", "b@x"), (4, "Cy", None), (5, None, None), (6, "", ""), (7, "", ""), (None, "Ann", "q@x"), (8, "Di", "q@x"), (4, "Cy", None)]
    p = spark.createDataFrame(rows, "id long, name string, email string")
    got = [tuple(r) for r in identity.identities(p).orderBy("id").collect()]
    assert got == [(1, 1), (2, 1), (3, 1), (4, 4), (5, 5), (6, 6), (7, 7), (8, 8)]
    assert identity.identities(p.where("false")).collect() == []


def test_people_of_commits(spark):
    rows = [
        (1, "Ann Lee", "a@x", "r1"), (2, "ann", "a@x", "r2"), (3, "ann", "a@y", "r2"), (4, "A Lee", "a@y", "r1"), (5, "Ann Lee", None, "r3"),
        (6, "handle", "h@x", "r1"), (7, "renovate[bot]", "a@x", "r1"), (8, "Bo Ek", "", "r1"), (9, "Bo Ek", "", "r1"), (10, "A Lee", "z@z", None),
    ]
    c = spark.createDataFrame(rows, "id long, name string, email string, repo string")
    got = {r.name: (r.commits, r.emails, r.repos) for r in identity.people_of_commits(c).collect()}
    assert got == {"A Lee": (6, 3, 3), "Bo Ek": (2, 0, 1)}
