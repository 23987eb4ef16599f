"""Wake-up text, diaries, notes and suggestions on small tables."""

from pyspark.sql import functions as F

from lorespark.operators import catalog, graph, notes


def chunks(spark, rows):
    return spark.createDataFrame(rows, "id int, wing string, room string, source_file string, document string, importance double")


def plain_story(rows, wing=None):
    """The text as it is built line by line."""
    rows = sorted(r for r in rows if wing is None or r[1] == wing)[:2000]
    if not rows:
        return "## L1 — No memories yet."
    top = sorted(rows, key=lambda r: -(3.0 if r[5] is None else r[5]))[:15]
    by = {}
    for r in top:
        by.setdefault(r[2] or "general", []).append(r)
    lines, total = ["## L1 — ESSENTIAL STORY"], 0
    for room, mine in sorted(by.items()):
        lines.append(f"\n[{room}]")
        total += len(lines[-1])
        for _, _, _, source, text, _ in mine:
            text = (text or "").strip().replace("\n", " ")
            line = "  - " + (text[:197] + "..." if len(text) > 200 else text)
            line += f"  ({source.rsplit('/', 1)[-1]})" if source else ""
            if total + len(line) > 3200:
                return "\n".join([*lines, "  ... (more in L3 search)"])
            lines.append(line)
            total += len(line)
    return "\n".join(lines)


def test_essential_story_equals_line_by_line(spark):
    short = [(i, "w" if i % 3 else "v", ["a", "b", None][i % 3], f"p/f{i}.md" if i % 2 else None, f" text {i}\nmore ", None if i % 4 else i / 10) for i in range(40)]
    long = [(i, "w", f"room{i % 5}", "p/x.md", "word " * 80, float(i % 6)) for i in range(60)]
    huge = [(i, "w", f"room {i}" * 90, "p/x.md", "word " * 80, 1.0) for i in range(30)]
    for rows in (short, long, huge, [(1, None, None, None, None, None)]):
        for wing in (None, "w", "nothing"):
            assert catalog.essential_story(chunks(spark, rows), wing).first().text == plain_story(rows, wing)
    assert catalog.wake_up_text(" me \n", chunks(spark, short)).first().text.startswith("me\n\n## L1")


def test_importance_takes_the_first_key_that_is_there(spark):
    d = spark.createDataFrame([(None, None, None), ("2", "9", None), (None, "high", "7"), (None, None, "4.5")], "a string, b string, c string")
    assert [r[0] for r in d.select(catalog.importance(F.col("a"), F.col("b"), F.col("c"))).collect()] == [3.0, 2.0, 3.0, 4.5]


def test_diary_last(spark):
    rows = [("Ann", "w", "diary", i, f"e{i}") for i in range(5)] + [("ann", "x", "diary", 9, "other wing"), ("bo", "w", "other", 1, "no diary")]
    d = spark.createDataFrame(rows, "agent string, wing string, room string, at int, document string")
    got = sorted((r.agent, r.place, r.document) for r in catalog.diary_last(d, 3).collect())
    assert got == [("ann", 1, "other wing"), ("ann", 2, "e4"), ("ann", 3, "e3")]
    assert [r.document for r in catalog.diary_last(d, 1, "w").collect()] == ["e4"] and catalog.diary_last(d, -5).count() == 1


def test_notes_parse_back(spark):
    schema = "source_file string, id string, people array<string>, topics array<string>, quote string, weight double, emotions array<string>, flags array<string>"
    rows = [
        ("f", "z-12", ["BOB", "ANN", "BOB"], ["cats", "dogs", "more"], "it's a | b", 0.9, ["joy"], ["CORE", "ORIGIN"]),
        ("f", "13", None, None, None, None, None, None),
        ("f", "14", [], [], 'he said "no"\nand left', 0.25, [], ["PIVOT"]),
        ("f", "15", ["ANN"], ["one"], "", 1.0, ["fear", "calm_joy"], []),
    ]
    lines = notes.encoded(spark.createDataFrame(rows, schema))
    assert {r.id: r.line for r in lines.collect()} == {"z-12": '12:ANN+BOB|cats_dogs|"it\'s a | b"|0.90|joy|CORE+ORIGIN', "13": "13:???|misc|0.50", "14": '14:???|misc|"he said \'no\' and left"|0.25|PIVOT', "15": "15:ANN|one|1.00|fear+calm_joy"}
    got = {r.number: r for r in notes.parsed(lines).collect()}
    assert (got["12"].people, got["12"].topics, got["12"].quote, got["12"].weight, got["12"].emotions, got["12"].flags) == (["ANN", "BOB"], ["cats", "dogs"], "it's a | b", 0.9, ["joy"], ["CORE", "ORIGIN"])
    assert (got["13"].people, got["13"].topics, got["13"].quote, got["13"].emotions, got["13"].flags) == ([], [], None, [], []) and got["14"].flags == ["PIVOT"] and got["14"].emotions == []
    assert [r.number for r in notes.summary(notes.parsed(lines)).collect()] == ["15", "12"]
    links = notes.encoded_links(spark.createDataFrame([("f", "a-1", "b-2", "grief: long"), ("f", "3", "4", "x" * 50), ("f", "5", "6", None)], "source_file string, from_id string, to_id string, label string"))
    assert sorted((r.kind, r.from_number, r.to_number, r.label) for r in notes.parsed(links).collect()) == [("link", "1", "2", "grief"), ("link", "3", "4", "x" * 30), ("link", "5", "6", "")]
    others = spark.createDataFrame([("ARC:up and down",), ("001|ANN|2024|title",), ("plain",)], "line string")
    assert sorted((r.kind, r.text) for r in notes.parsed(others).collect()) == [("arc", "up and down"), ("header", "001|ANN|2024|title"), ("other", "plain")]


def test_unknown_rooms_are_suggested(spark):
    node = spark.createDataFrame([("cat-care", ["a", "b"], 3), ("dog-care", ["b"], 2), ("fish", ["c"], 1)], "room string, wings array<string>, n int")
    got = graph.traverse_or_suggest(node, "cat-care").collect()
    assert [(r.room, r.hop, r.suggested) for r in got] == [("cat-care", 0, False), ("dog-care", 1, False)]
    got = graph.traverse_or_suggest(node, "care").collect()
    assert sorted((r.room, r.hop, r.suggested, r.score) for r in got) == [("cat-care", None, True, 1.0), ("dog-care", None, True, 1.0)]


def test_halls_of_sessions_and_questions(spark):
    from lorespark.operators import evaluate, halls

    turns = [(1, 1, "user", "I prefer tea"), (1, 2, "assistant", "1. here are"), (2, 1, "user", "hi"), (2, 2, "assistant", "Here are: 1. a"), (3, 1, "user", "She moved"), (4, 1, "assistant", "the City and a job"), (5, 1, "user", "a job"), (6, 1, "user", None)]
    t = spark.createDataFrame(turns, "conv_id int, turn int, role string, text string")
    got = {r.conv_id: r.hall for r in halls.session_texts(t).select("conv_id", halls.session_hall(F.col("user"), F.col("assistant")).alias("hall")).collect()}
    assert got == {1: halls.PREFERENCES, 2: halls.ADVICE, 3: halls.EVENTS, 4: halls.FACTS, 5: halls.GENERAL, 6: halls.GENERAL}
    q = spark.createDataFrame([("What was it You suggested?",), ("lately it fails",), ("When did she leave",), ("which school",), ("hm",), (None,)], "q string")
    assert [r[0][0] for r in q.select(halls.question_halls(F.col("q"))).collect()] == [halls.ADVICE, halls.PREFERENCES, halls.EVENTS, halls.FACTS, halls.GENERAL, halls.GENERAL]
    said = spark.createDataFrame([(1, 1, "user", "Lately, I've been tired of it. I want to leave soon! I have been having issues with my phone battery"), (1, 2, "assistant", "i prefer nothing at all"), (2, 1, "user", "nothing")], "conv_id int, turn int, role string, text string")
    assert {r.conv_id: r.document for r in evaluate.preference_documents(said).collect()} == {1: "User has mentioned: my phone battery; tired of it; leave soon"}


def test_texts_do_not_travel_once_a_query(spark):
    """The tokens of every candidate were dealt by query, and its text by query and id."""
    import random

    from lorespark.operators import search

    rng = random.Random(1)
    docs = [(i, "f", i, "common " + " ".join(f"{rng.randrange(10**9):x}" for _ in range(2000))) for i in range(60)]
    chunks = spark.createDataFrame(docs, "id int, source_file string, chunk_index int, document string")
    queries = spark.createDataFrame([(q, f"common word{q}") for q in range(40)], "query_id int, query string")
    written = lambda: spark._jsc.sc().statusStore().executorList(False).apply(0).totalShuffleWrite()
    before_join = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        before = written()
        got = search.keyword_hits(chunks, queries, 2).select("query_id", "id", "rank").collect()
        assert len(got) == 80
        assert written() - before < 20e6
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before_join)
