import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

CLASH = ["id", "row", "shard", "batch", "answers", "toxicity", "spans", "sanitised", "told_terms", "node", "a", "b", "entity", "Rank", "node_2"]


def sample_rows(n=60, seed=3):
    """Prose with copies, near-copies, shared passages and every awkward case; (doc_id, text)."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randrange(2, 8))) for _ in range(300)] + ["é" * 3, "naïve", "日本語"]
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    rows = []
    for i in range(n):
        w = [rng.choice(vocabulary) for _ in range(rng.randrange(1, 120))]
        if i % 5 == 0:
            w[len(w) // 2 : len(w) // 2] = passage.split()
        if i % 7 == 0 and rows:
            w = rows[rng.randrange(len(rows))][1].split() or w
            if i % 14 == 0:
                w[rng.randrange(len(w))] = "changed"
        rows.append((i, rng.choice([" ", "  ", "\n"]).join(w)))
    rows += [(100, None), (101, ""), (102, " \t\n"), (103, "one"), (104, "one"), (105, "a b c d"), (106, "a b c d"), (107, "x" * 5000), (108, "the the " * 400), (109, "the the " * 300)]
    rows += [(3, rows[3][1]), (3, rows[3][1]), (4, "another text under a used id " + passage), (None, passage), (None, None), (-5, passage), (10**12, passage + " end")]
    return rows


@pytest.fixture(scope="session")
def rows():
    return sample_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return frame(spark, rows)


def frame(spark, rows):
    """Documents with extra columns, all null, whose names operators use inside."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH)
    return spark.createDataFrame([(i, t, None, None, None, *[None] * len(CLASH)) for i, t in rows], schema)


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])
