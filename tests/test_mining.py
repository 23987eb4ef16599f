"""Mines into a store: what is current, what is replaced, and what a killed run leaves."""

import pytest
from pyspark.sql import functions as F

from lorespark.operators import entities, memories, mining
from lorespark.sources.store import LINES, MemoryStore

ROOMS = {"backend": ["server", "database"], "planning": ["roadmap"]}
TEXT = "The database of the server holds all rows.\n\n" * 60


def files(spark, rows):
    return spark.createDataFrame(rows, "source_file string, mtime double, document string")


@pytest.fixture
def store(spark, tmp_path):
    return MemoryStore(spark, str(tmp_path / "store"))


def state(store):
    return sorted(tuple(r) for r in store.chunks().select("id", "source_file", "chunk_index", "document", "room").collect())


def test_second_mine_adds_nothing(spark, store):
    rows = [("p/backend/a.py", 1.0, TEXT), ("p/x/roadmap.md", 2.0, "roadmap " * 40), ("p/x/short.md", 1.0, "short"), ("p/x/none.md", 1.0, None)]
    assert store.runs() == [] and state(store) == []
    first = mining.mine_files(store, files(spark, rows), "w", ROOMS, root="p")
    before = state(store)
    assert first and {r[1] for r in before} == {"p/backend/a.py", "p/x/roadmap.md"} and {r[4] for r in before} == {"backend", "planning"}
    assert mining.mine_files(store, files(spark, rows), "w", ROOMS, root="p") is None
    assert state(store) == before and store.runs() == [first]


def test_changed_file_is_replaced_whole(spark, store):
    mining.mine_files(store, files(spark, [("p/a.md", 1.0, TEXT), ("p/b.md", 1.0, TEXT)]), "w", ROOMS)
    kept = [r for r in state(store) if r[1] == "p/b.md"]
    run = mining.mine_files(store, files(spark, [("p/a.md", 5.0, "A new text about the roadmap, shorter than before it."), ("p/b.md", 1.0004, "its time is the same to a thousandth " * 9)]), "w", ROOMS)
    now = state(store)
    assert [r[3] for r in now if r[1] == "p/a.md"] == ["A new text about the roadmap, shorter than before it."] and [r for r in now if r[1] == "p/b.md"] == kept
    assert {(r.source_file, r.run == run) for r in store.sources().collect()} == {("p/a.md", True), ("p/b.md", False)}
    assert [r.source_file for r in store.lines().where("source_file = 'p/a.md'").collect()] == ["p/a.md"]  # earlier lines are gone


def test_unreadable_change_leaves_what_is_stored(spark, store):
    mining.mine_files(store, files(spark, [("p/a.md", 1.0, TEXT)]), "w", ROOMS)
    before = state(store)
    assert mining.mine_files(store, files(spark, [("p/a.md", 2.0, "too short")]), "w", ROOMS) is None
    assert mining.mine_files(store, files(spark, [("p/a.md", 3.0, "many words here " * 900)]), "w", ROOMS, most=3) is None
    assert state(store) == before


@pytest.mark.parametrize("dies_at", ["chunks", "lines", "sources"])
def test_killed_run_leaves_the_old_state(spark, store, dies_at):
    mining.mine_files(store, files(spark, [("p/a.md", 1.0, TEXT)]), "w", ROOMS)
    before, real = state(store), MemoryStore.write

    def dying(self, stage):
        def staged(put):
            def one(table, rows):
                out = put(table, rows)
                if table == dies_at:
                    raise KeyboardInterrupt
                return out

            one.written = put.written
            stage(one)

        return real(self, staged)

    MemoryStore.write = dying
    try:
        with pytest.raises(KeyboardInterrupt):
            mining.mine_files(store, files(spark, [("p/a.md", 2.0, TEXT + "More.")]), "w", ROOMS)
    finally:
        MemoryStore.write = real
    assert state(store) == before and len(store.runs()) == 1
    mining.mine_files(store, files(spark, [("p/a.md", 2.0, TEXT + "More.")]), "w", ROOMS)
    assert state(store)[-1][3].endswith("More.") or any(r[3].endswith("More.") for r in state(store))


def test_new_version_reads_again(spark, store, monkeypatch):
    rows = [("p/a.md", 1.0, TEXT)]
    mining.mine_files(store, files(spark, rows), "w", ROOMS)
    monkeypatch.setattr(mining, "VERSION", 4)
    assert mining.mine_files(store, files(spark, rows), "w", ROOMS)
    assert {r.normalize_version for r in store.chunks().collect()} == {4}


def test_repeated_paths_take_the_latest(spark, store):
    mining.mine_files(store, files(spark, [("p/a.md", 1.0, "old words " * 20), ("p/a.md", 3.0, "new words " * 20), ("p/a.md", 3.0, None)]), "w", ROOMS)
    assert {r[3].split()[0] for r in state(store)} == {"new"}


def test_index_documents_hold_the_lines(spark, store):
    text = "# A header of this file\n\nWe built the parser of notes yesterday. " + TEXT + 'He said "this is quite a long quotation, indeed" and left. Anna saw Anna.'
    mining.mine_files(store, files(spark, [("p/a.md", 1.0, text)]), "w", ROOMS)
    got = store.lines().collect()
    ids = [r[0] for r in sorted(state(store), key=lambda r: r[2])]
    source = spark.createDataFrame([("p/a.md", "w", "backend", ids, text.strip())], "source_file string, wing string, room string, ids array<string>, document string")
    want = [r.line for r in entities.index_lines(source).orderBy("line_no").collect()]
    assert "\n".join(r.document for r in sorted(got, key=lambda r: r.id)) == "\n".join(want) and got[0].id.endswith("_01") and got[0].chunks == len(ids)
    assert store.lines().columns == [c.split()[0] for c in LINES.split(", ")] + ["run"] or set(store.lines().columns) == {c.split()[0] for c in LINES.split(", ")} | {"run"}


CHAT = "> What about the database?\nIt is slow, we decided to use a cache because of it.\n> And the tests?\nThey fail, the fixture is broken.\n> Then fix them please, all of them.\nDone, it works now."


def test_transcripts_by_mode_live_side_by_side(spark, store):
    rows = [("c/1.txt", 0.0, CHAT), ("c/2.txt", 0.0, ""), ("c/3.txt", 0.0, CHAT + "\n=====\n" + CHAT)]
    assert mining.mine_transcripts(store, files(spark, rows), "talks", separator="\n=====\n")
    assert mining.mine_transcripts(store, files(spark, rows), "talks", separator="\n=====\n") is None
    assert mining.mine_transcripts(store, files(spark, rows), "talks", mode="general")
    got = store.chunks().collect()
    by = {(r.source_file, r.mode): sorted(x.chunk_index for x in got if (x.source_file, x.mode) == (r.source_file, r.mode)) for r in got}
    assert by[("c/1.txt", "exchange")] == [0, 1, 2] and by[("c/3.txt", "exchange")] == [0, 1, 2, 3, 4, 5] and by[("c/2.txt", "exchange")] == by[("c/2.txt", "general")] == [0]
    assert {r.room for r in got if r.source_file == "c/2.txt"} == {"_registry"} and len({r.id for r in got}) == len(got)
    assert mining.mine_transcripts(store, files(spark, rows), "talks", rebuild=True) and len(store.chunks().collect()) < len(got) + 1
    with pytest.raises(ValueError):
        mining.mine_transcripts(store, files(spark, rows), "talks", mode="other")


def test_a_mine_of_files_replaces_every_mode(spark, store):
    mining.mine_transcripts(store, files(spark, [("c/1.txt", 0.0, CHAT)]), "talks")
    # Stored without a time, so not current by time.
    mining.mine_files(store, files(spark, [("c/1.txt", 1.0, CHAT)]), "w", ROOMS)
    assert {r.mode for r in store.chunks().collect()} == {"files"}
    mining.mine_transcripts(store, files(spark, [("c/1.txt", 0.0, CHAT)]), "talks")
    assert {r.mode for r in store.chunks().collect()} == {"files", "exchange"}


def test_staged_tables_are_bounded_to_their_run(spark, store):
    mining.mine_files(store, files(spark, [("p/a.md", 1.0, TEXT)]), "w", ROOMS)
    plan = store.chunks()._jdf.queryExecution().toString()
    assert "LeftSemi" in plan and store.chunks().agg(F.count("*")).first()[0] == store.sources().first().chunks


def test_keyword_candidates_equal_a_test_of_all_texts(spark):
    import random

    from lorespark.operators import search

    rng = random.Random(2)
    vocabulary = ["".join(rng.choice("abcdé_1") for _ in range(rng.randrange(1, 7))) for _ in range(200)] + ["common"]
    chunks = [(i, "f", i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 30))) + (" Common" if i % 2 else "")) for i in range(300)] + [(900, "f", 0, None), (901, "f", 0, "")]
    queries = [(q, " ".join(rng.choice(vocabulary + ["nowhere"]) for _ in range(4))) for q in range(40)] + [(50, "common"), (51, "ab"), (52, None), (53, "nowhere at")]
    c = spark.createDataFrame(chunks, "id long, source_file string, chunk_index int, document string")
    q = spark.createDataFrame(queries, "query_id long, query string")
    got = {}
    for r in search.keyword_hits(c, q, 1000, most=25).collect():
        got.setdefault(r.query_id, set()).add(r.id)
    import re

    want = {}
    for i, text in queries:
        ws = {w for w in re.findall(r"\w{2,}", (text or "").lower()) if len(w) >= 3}
        ids = [x for x, _, _, d in sorted(chunks, key=lambda x: x[0]) if any(w in (d or "").lower() for w in ws)][:25] if ws else sorted((x[0] for x in chunks), reverse=True)[:25]
        if ids:
            want[i] = set(ids)
    assert got == want
    with pytest.raises(ValueError):
        search.keyword_hits(c, q, 10, most=500, index=search.keyword_index(c, 25))


def test_chunks_of_a_batch_come_in_pieces(spark, monkeypatch):
    """A worker held the chunks of a whole batch of rows at once."""
    from lorespark.operators import chunks

    monkeypatch.setattr(chunks, "PIECE", 1000)
    docs = [(i, None if i == 7 else f"{i} word " * (i % 90)) for i in range(200)]
    d = spark.createDataFrame(docs, "id int, document string").coalesce(1)
    out = chunks.chunk_overlap(d, 200, 20, 30, 3)
    cut = {i: chunks.split_overlapping(x, 200, 20, 30) for i, x in docs}
    assert sorted(map(tuple, out.collect())) == [(i, n, c) for i, cs in cut.items() if len(cs) <= 3 for n, c in enumerate(cs)]


def test_repeated_names_are_counted_in_one_pass(spark):
    from pyspark.sql import functions as F

    from lorespark.operators import entities

    found = ["Zoe", "Bob", "The", "Bob", "The", "Ann", "Zoe", "Bob", "Zed", "Ann", "Zoe"]
    r = spark.createDataFrame([(found,), ([],)], "f array<string>").select(
        entities.repeated_names(F.col("f")).alias("a"), entities.repeated_names(F.col("f"), 3, ()).alias("b"), entities.frequent_names(F.col("f"), 2, 2).alias("c"), entities.frequent_names(F.col("f"), 1, 9).alias("d")
    ).collect()
    assert [tuple(x) for x in r] == [(["Ann", "Bob", "Zoe"], ["Bob", "Zoe"], ["Zoe", "Bob"], ["Zoe", "Bob", "Ann", "Zed"]), ([], [], [], [])]


TOLD = "We decided to go with the new framework because the old approach was slow.\n\nIt works! We fixed and solved it: a breakthrough.\n\n```\nlet's use code\n```"


def test_memories_are_read_where_their_texts_were_dealt(spark):
    """One large file is not one task's work."""
    docs = spark.createDataFrame([(i, TOLD) for i in range(40)], "id int, document string").coalesce(1)
    found = memories.memories(docs)
    kinds = {(r.id, r.chunk_index): (r.memory_type, r.document) for r in found.collect()}
    assert len(kinds) == 40 * 2 and {k[1] for k in kinds} == {0, 1} and len(set(kinds.values())) == 2
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()
