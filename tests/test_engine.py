import json

import pytest
from pyspark.sql import functions as F

from lorespark.functions import temporal, text
from lorespark.functions.filters import UnsupportedFilter, where_column
from lorespark.operators import chunks, entities, evaluate, facts, mutate, neardup
from lorespark.sources import files, transcripts
from lorespark.streaming import sweep


def test_filters(spark):
    d = spark.createDataFrame([("a", 1, "xy"), ("b", 2, "yz"), (None, 3, "q")], "k string, n int, document string")
    n = lambda w: sorted(r.n for r in d.where(where_column(w)).collect())
    assert n(None) == [1, 2, 3] and n({"k": "a"}) == [1] and n({"k": {"$ne": "a"}}) == [2, 3] and n({"k": {"$nin": ["b"]}}) == [1, 3]
    assert n({"$or": [{"n": {"$gt": 2}}, {"$contains": "x"}]}) == [1, 3] and n({"$and": [{"n": {"$gte": 1}}, {"n": {"$lt": 3}}]}) == [1, 2]
    for bad in ({"k": {"$like": 1}}, {"$not": []}, {"$and": []}):
        with pytest.raises(UnsupportedFilter):
            where_column(bad)


def test_temporal_shapes():
    assert temporal.check_temporal("2024-02-29") == "2024-02-29" and temporal.check_temporal("2024-01-01T00:00:00+00:00") == "2024-01-01T00:00:00Z"
    assert temporal.check_temporal("") == "" and temporal.check_temporal(None) is None
    for bad in ("2023-02-29", "2024-1-1", "2024-01-01T25:00:00Z", "today"):
        with pytest.raises(ValueError):
            temporal.check_temporal(bad)


def test_as_of_is_closed_at_both_ends(spark):
    d = spark.createDataFrame([(1, "2024-01-02", "2024-01-05"), (2, None, None), (3, "2024-01-02T12:00:00Z", None)], "id int, valid_from string, valid_to string")
    at = lambda x: sorted(r.id for r in d.where(temporal.valid_at(x)).collect())
    assert at("2024-01-02") == [1, 2] and at("2024-01-05T23:59:59Z") == [1, 2, 3] and at("2024-01-06") == [2, 3] and at(None) == [1, 2, 3]


def test_facts_refuse_inverted_intervals(spark):
    t = spark.createDataFrame([(1, "a", "knows", "b", "2024-01-01", None)], "id int, subject string, predicate string, object string, valid_from string, valid_to string")
    new = spark.createDataFrame([(2, "a", "knows", "b", None, None, 1), (3, "a", "likes", "b", None, None, 2), (4, "a", "likes", "b", None, None, 3)], "id int, subject string, predicate string, object string, valid_from string, valid_to string, ordinal int")
    assert [r.id for r in facts.add(t, new).collect()] == [3]
    with pytest.raises(Exception, match="before it starts"):
        facts.invalidate(t, "A", "knows", "2023-01-01").collect()
    assert facts.invalidate(t, "A", "knows", "2024-02-01").first().valid_to == "2024-02-01"


def test_overlapping_chunks():
    body = "\n\n".join("p%02d " % i + "x" * 290 for i in range(12))
    got = chunks.split_overlapping(body)
    assert all(50 <= len(c) <= 800 for c in got) and got[0].startswith("p00") and got[-1].endswith("x")
    assert chunks.split_overlapping("short") == [] and chunks.split_overlapping(None) == [] and chunks.split_overlapping("a" * 60) == ["a" * 60]
    with pytest.raises(ValueError):
        chunks.split_overlapping("a", 10, 10)


def test_rooms_and_halls(spark):
    rooms = {"backend": ["api", "server"], "frontend": ["button"]}
    d = spark.createDataFrame([("x/backend/a.py", ""), ("x/my-frontend.md", ""), ("x/y.md", "A button, a button and an api"), ("x/y.md", "")], "p string, t string")
    assert [r[0] for r in d.select(chunks.room_of(F.col("p"), F.col("t"), rooms)).collect()] == ["backend", "frontend", "frontend", "general"]
    s = spark.createDataFrame([("i fixed the bug in the python code",), ("nothing",), ("my son",)], "t string")
    assert [r[0] for r in s.select(text.best_label(F.col("t"), chunks.HALLS, "general")).collect()] == ["technical", "general", "family"]


def test_packed_lines(spark):
    d = spark.createDataFrame([(["a" * 6, "b" * 3, "c" * 9, "d"],), ([],)], "l array<string>")
    assert [r[0] for r in d.select(entities.packed_lines(F.col("l"), 10)).collect()] == [["a" * 6 + "\n" + "b" * 3, "c" * 9, "d"], []]


def test_upsert_update_delete(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    new = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (3, "z", 1)], "id int, v string, o int")
    assert sorted(map(tuple, mutate.upsert(old, new, order="o").collect())) == [(1, "a"), (2, "y"), (3, "z")]
    assert sorted(map(tuple, mutate.update(old, spark.createDataFrame([(1, None), (2, "q")], "id int, v string")).collect())) == [(1, "a"), (2, "q")]
    assert [tuple(r) for r in mutate.delete(old, old.where("id = 1")).collect()] == [(2, "b")]


def test_greedy_dedup_keeps_the_longest(spark):
    v = [([1.0, 0.0], "l" * 40), ([1.0, 0.01], "m" * 30), ([0.0, 1.0], "n" * 25), ([0.5, 0.5], "short")]
    d = spark.createDataFrame([(i, "s", t, e) for i, (e, t) in enumerate(v)], "id int, source_file string, document string, embedding array<double>")
    assert {r.id: r.kept for r in neardup.greedy_dedup(d).collect()} == {0: True, 1: False, 2: True, 3: False}


def test_greedy_dedup_equals_a_plain_loop(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    centres = rng.standard_normal((6, 8))
    rows = []
    for i in range(240):
        v = centres[i % 6] + 0.35 * rng.standard_normal(8) if i % 11 else centres[i % 6]
        rows.append((i, f"s{i % 3}", "x" * int(rng.integers(10, 60)), v.tolist()))
    got = {r.id: r.kept for r in neardup.greedy_dedup(spark.createDataFrame(rows, "id int, source_file string, document string, embedding array<double>")).collect()}
    want = {}
    for s in ("s0", "s1", "s2"):
        kept = []
        for i, _, t, v in sorted((r for r in rows if r[1] == s), key=lambda r: (-len(r[2]), r[0])):
            u = np.array(v) / np.linalg.norm(v)
            want[i] = len(t) >= 20 and all(1 - u @ k >= 0.15 for k in kept)
            if want[i]:
                kept.append(u)
    assert got == want and 0 < sum(want.values()) < 200


def test_ndcg_and_f1(spark):
    r = spark.createDataFrame([(1, 1, 0.0), (1, 2, 1.0), (2, 1, 0.0)], "query_id int, rank int, rel double")
    assert {x.query_id: round(x.ndcg, 4) for x in evaluate.ndcg_at_k(r, 10).collect()} == {1: 0.6309, 2: 0.0}
    p = spark.createDataFrame([(1, "the Cat sat", "a cat"), (2, "", "x")], "pair_id int, prediction string, truth string")
    assert {x.pair_id: round(x.f1, 4) for x in evaluate.token_f1(p).collect()} == {1: 0.6667, 2: 0.0}


def test_session_files(spark, tmp_path):
    lines = [
        {"type": "progress"},
        {"type": "user", "timestamp": "1", "sessionId": "s", "uuid": "u1", "message": {"role": "user", "content": "hi"}},
        {"type": "assistant", "timestamp": "2", "sessionId": "s", "uuid": "u2", "message": {"role": "assistant", "content": [{"type": "text", "text": "yo"}]}},
        {"type": "user", "timestamp": "3", "sessionId": "s", "uuid": "u3", "message": {"role": "user", "content": " "}},
    ]
    (tmp_path / "a.jsonl").write_text("\n".join(map(json.dumps, lines)) + "\nnot json\n")
    got = sorted((r.message_uuid, r.role, r.text) for r in transcripts.session_messages(spark, str(tmp_path)).collect())
    assert got == [("u1", "user", "hi"), ("u2", "assistant", "yo")]


def test_ignore_rules():
    r = files.IgnoreRules(["*.log", "!keep.log", "build/", "/top.txt", "docs/**/x.md", "# c", ""])
    assert r.ignores("a/b.log") and not r.ignores("a/keep.log") and r.ignores("build/x.py") and not r.ignores("build")
    assert r.ignores("top.txt") and not r.ignores("a/top.txt") and r.ignores("docs/a/b/x.md") and r.ignores("docs/x.md")


def test_sweep_adds_once(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    schema = "session_id string, message_uuid string, timestamp string, text string"
    spark.createDataFrame([("s", "1", "01", "a"), ("s", "2", "02", "b")], schema).write.parquet(src)
    stream = lambda: spark.readStream.schema(schema).parquet(src)
    sweep.sweep(stream(), out, ck).awaitTermination(120)
    spark.createDataFrame([("s", "2", "02", "b"), ("s", "3", "02", "c"), ("s", "4", "01", "late")], schema).write.mode("append").parquet(src)
    sweep.sweep(stream(), out, ck).awaitTermination(120)
    assert sorted(r.message_uuid for r in spark.read.parquet(out).collect()) == ["1", "2", "3"]
    report = {(r.batch_id, r.verdict): r.n for r in spark.read.parquet(f"{out}.report").collect()}
    assert report == {(0, "added"): 2, (1, "present"): 1, (1, "added"): 1, (1, "skipped"): 1}
    # A batch that died after part of its work is written anew, not judged against its own rows.
    import shutil

    shutil.rmtree(f"{out}/batch_id=1")
    for name in ("commits/1", "commits/.1.crc"):
        (tmp_path / "ck" / name).unlink(missing_ok=True)
    sweep.sweep(stream(), out, ck).awaitTermination(120)
    assert sorted(r.message_uuid for r in spark.read.parquet(out).collect()) == ["1", "2", "3"]


def test_windowed_counts_close_by_watermark(spark, tmp_path):
    src = str(tmp_path / "src")
    schema = "ts timestamp, event_type string, value double"
    put = lambda rows: spark.createDataFrame(rows, "ts string, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(src)
    put([("2024-01-01 01:00:00", "a", 1.0), ("2024-01-01 02:00:00", "a", 2.0), ("2024-01-05 01:00:00", "b", 4.0)])
    q = sweep.windowed_counts(spark.readStream.schema(schema).parquet(src)).writeStream.format("memory").queryName("closed").outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    put([("2024-01-01 03:00:00", "a", 8.0), ("2024-01-09 01:00:00", "b", 1.0)])  # the first is too late
    q.processAllAvailable()
    put([("2024-01-12 01:00:00", "b", 1.0)])
    q.processAllAvailable()
    q.stop()
    got = {(str(r.start)[:10], r.event_type, r.n, r.total) for r in spark.table("closed").collect()}
    assert got == {("2024-01-01", "a", 2, 3.0), ("2024-01-05", "b", 1, 4.0), ("2024-01-09", "b", 1, 1.0)}


def test_diary_files_bring_what_is_new(spark):
    day = lambda *rows: spark.createDataFrame(rows, "source_file string, text string")
    first = day(("d/2024-01-01.md", "# head\n## one\nfirst\n## two\nsecond"), ("d/2024-01-02.md", "## x\ny"), ("d/notes.md", "## z"))
    none = sweep.diary_state(first).limit(0)
    got = sorted(map(tuple, sweep.diary_changes(first, none).select("date", "mode", "entry", "header", "document").collect()))
    assert got == [("2024-01-01", "new", 0, "one", "first"), ("2024-01-01", "new", 1, "two", "second"), ("2024-01-02", "new", 0, "x", "y")]
    later = day(("d/2024-01-01.md", "# head\n## one\nfirst\n## two\nsecond\n## three\nthird"), ("d/2024-01-02.md", "## x\nchanged"))
    got = sorted(map(tuple, sweep.diary_changes(later, sweep.diary_state(first)).select("date", "mode", "entry", "header", "document").collect()))
    assert got == [("2024-01-01", "tail", 2, "three", "third"), ("2024-01-02", "rebuild", 0, "x", "changed")]
    assert sweep.diary_changes(first, sweep.diary_state(first)).count() == 0
    counts = spark.createDataFrame([(1, 20), (2, 20), (3, 14)], "conv_id int, n int")
    assert [r.conv_id for r in sweep.due_for_save(counts, spark.createDataFrame([(2, 10)], "conv_id int, n int")).collect()] == [1]


def test_ignore_rules_as_columns(spark):
    r = files.IgnoreRules(["\\#keep", "  *.log", "\\!bang"])
    assert r.ignores("#keep") and r.ignores("x.log") and r.ignores("!bang") and not r.ignores("keep")
    rules = {"": ["*.tmp", "gen/"], "a": ["!x.tmp", "y.txt"]}
    d = spark.createDataFrame([(p,) for p in ("x.tmp", "a/x.tmp", "a/y.txt", "y.txt", "gen/z.txt", "a/gen/z.txt")], "path string")
    assert {x.path for x in d.where(files.ignored(F.col("path"), rules)).collect()} == {"x.tmp", "a/y.txt", "gen/z.txt", "a/gen/z.txt"}


def test_reserved_transforms(spark):
    d = spark.createDataFrame([(" a \r\n\r\n\r\n \r\n\r\nb\rc ",)], "t string")
    run = lambda *names: d.select(text.transformed(F.col("t"), list(names))).first()[0]
    assert run("newline_normalize") == " a \n\n\n \n\nb\nc " and run("whitespace_trim").startswith("a")
    assert run("newline_normalize", "whitespace_collapse_internal") == " a \n\n\nb\nc "
    assert run("newline_normalize", "line_join_spaces").split("\n\n")[0] == "a" and run("newline_normalize", "line_join_spaces").endswith("\n\nb c")
    assert run("newline_normalize", "line_trim", "blank_line_drop") == "a\nb\nc" and run("strip_tool_chrome") == run()
    raw = spark.createDataFrame([(bytearray(b"a\xffb"),)], "b binary")
    assert raw.select(text.transformed(F.col("b"), ["utf8_replace_invalid"])).first()[0] == "a\ufffdb"
    with pytest.raises(ValueError):
        text.transformed(F.col("t"), ["no_such"])


def test_tools_in_session_files(spark):
    import json

    from lorespark.sources import formats

    say = lambda role, content: json.dumps({"type": role, "message": {"role": role, "content": content}})
    lines = [
        say("user", "list them"),
        say("assistant", [{"type": "text", "text": "sure"}, {"type": "tool_use", "id": "t1", "name": "Bash", "input": {"command": "ls"}}, {"type": "tool_use", "id": "t2", "name": "Read", "input": {"file_path": "/a", "offset": 5, "limit": 10}}]),
        say("user", [{"type": "tool_result", "tool_use_id": "t1", "content": "\n".join(f"f{i}" for i in range(50))}, {"type": "tool_result", "tool_use_id": "t2", "content": "secret"}]),
        say("assistant", [{"type": "text", "text": "done"}, {"type": "tool_use", "id": "t3", "name": "Other", "input": {"a": 1}}]),
        say("user", [{"type": "tool_result", "tool_use_id": "t3", "content": [{"type": "text", "text": "x" * 3000}]}]),
        say("user", "<system-reminder>\nhidden\n</system-reminder>\nthanks"),
    ]
    d = spark.createDataFrame([("s.jsonl", "\n".join(lines))], "path string, text string")
    turns = [(r.role, r.text) for r in formats.session_turns(d).orderBy("pos").collect()]
    assert [r for r, _ in turns] == ["user", "assistant", "user"] and turns[0][1] == "list them" and turns[2][1] == "thanks"
    said = turns[1][1].split("\n")
    assert said[:3] == ["sure", "[Bash] ls", "[Read /a:5-15]"] and said[3] == "→ f0" and said[22] == "→ f19" and said[23] == "→ ... [10 lines omitted] ..." and said[24] == "→ f30"
    assert "secret" not in turns[1][1] and said[-3] == "done" and said[-2] == '[Other] {"a":1}' and said[-1].endswith("... [truncated, 3000 chars]")
    assert formats.normalised(d).first().format == "session"


def test_memories_prose_and_segments(spark):
    from lorespark.operators import memories

    d = spark.createDataFrame([(1, "> we decided to go with the framework because it is better\nok then, fine with me\n> there was a bug and an error, but it is fixed now\nnice\n> short\nx"), (2, "def f():\n    return 1\nimport os\n\nI love you and I am so happy and grateful, wonderful!\n\ntoo short")], "id int, document string")
    got = {(r.id, r.chunk_index, r.memory_type) for r in memories.memories(d).collect()}
    assert got == {(1, 0, "decision"), (1, 1, "milestone"), (2, 0, "emotional")}
    code = spark.createDataFrame([("a line of plain words\n```py\nx = 1\n```\n$ ls\n|a|b|\nmore words here",), ("import os",)], "t string")
    assert [r[0] for r in code.select(memories.prose(F.col("t"))).collect()] == ["a line of plain words\nmore words here", "import os"]


def test_names_and_shorthand(spark):
    d = spark.createDataFrame([(1, "Marta said hello. Marta laughed and she smiled.\nhey Marta, thanks Marta!\nMarta: yes\nshipping Zephyr v2.1, Zephyr.py was deployed; building Zephyr and launch Zephyr")], "id int, document string")
    line = entities.shorthand(spark.createDataFrame([(1, "We met Anna there. It was decided because of the big_plan. Nothing."), (2, None)], "id int, document string"), {"decided": "determ"}, {"because": "DECISION"})
    assert {r.id: r.line for r in line.collect()} == {1: '0:ANN+IT+NOT|anna_big_plan_nothing|"It was decided because of the big_plan"|determ|DECISION', 2: "0:???|misc"}


def test_overlap_cuts(spark):
    body = "a" * 500 + "\n\n" + "b" * 200 + "\n" + "c" * 600
    got = chunks.split_overlapping(body, 800, 100, 50)
    assert [len(x) for x in got] == [500, 800, 203] and got[0] == "a" * 500  # the second cut has no line end in its second half
    lines = "\n".join(["d" * 99] * 20)
    assert [len(x) for x in chunks.split_overlapping(lines, 800, 100, 50)] == [799, 699, 699]
    assert chunks.split_overlapping("  ") == [] and chunks.split_overlapping("x" * 60) == ["x" * 60] and chunks.split_overlapping("x" * 40) == []
    with pytest.raises(ValueError):
        chunks.split_overlapping("x", 100, 100)


def test_search_strategies_are_checked(spark):
    from lorespark.operators import search

    with pytest.raises(ValueError):
        search.search_chunks(None, None, None, strategy="other")


def test_vector_topk_in_pairs_of_blocks(spark, monkeypatch):
    import numpy as np

    from lorespark.operators import search

    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(300)] + [(900, None), (901, [0.0] * 8), (902, [1.0])]
    d = spark.createDataFrame(rows, "id long, embedding array<double>")
    q = spark.createDataFrame([(f"q{i}", v) for i, v in rows[:40]] + [("none", None)], "query_id string, embedding array<double>")
    run = lambda: sorted((r.query_id, r["rank"], r.id, None if r.distance is None else round(r.distance, 9)) for r in search.vector_topk(d, q, 5).where("query_id <> 'none'").collect())
    one = run()
    monkeypatch.setattr(search, "SMALL_QUERIES", 0)
    monkeypatch.setattr(search, "ROW_BLOCK", 64)
    monkeypatch.setattr(search, "QUERY_BLOCK", 16)
    assert run() == one and len(one) == 200 and all(x[2] < 900 for x in one)


def test_session_messages_as_a_data_source(spark, tmp_path):
    import json as j

    from lorespark.sources import plugin

    (tmp_path / "p").mkdir()
    line = lambda u, role, text: j.dumps({"type": role, "sessionId": "s", "uuid": u, "timestamp": "1", "message": {"content": text}})
    (tmp_path / "p" / "a.jsonl").write_text("\n".join([line("1", "user", "hi"), "broken", line("2", "assistant", " "), line("3", "assistant", "yo")]))
    (tmp_path / "b.jsonl").write_text(line("4", "user", "there") + "\n" + line("5", "user", [{"type": "text", "text": "two"}, {"type": "text", "text": "blocks"}, {"type": "image", "id": 1}]) + "\n" + line("6", "user", []))
    plugin.register(spark)
    got = spark.read.format(plugin.resolved()).load(str(tmp_path)).select("message_uuid", "role", "text").collect()
    assert sorted(map(tuple, got)) == [("1", "user", "hi"), ("3", "assistant", "yo"), ("4", "user", "there"), ("5", "user", 'two\nblocks\n{"type":"image","id":1}')]
    assert spark.read.format("session_messages").option("since", "9e12").load(str(tmp_path)).count() == 0
    assert plugin.resolved(None, "session_messages") == "session_messages"
    with pytest.raises(ValueError):
        plugin.resolved("nothing")


def test_markdown_export(spark, tmp_path):
    from lorespark.operators import catalog

    d = spark.createDataFrame([(2, "w", "r", "b\nc"), (1, "w", "r", "a"), (3, "w", None, None), (4, None, "x", "d")], "id int, wing string, room string, document string")
    index = {r.wing: (r.rooms, r.chunks) for r in catalog.export_markdown(d, str(tmp_path / "out")).collect()}
    assert index == {"w": (2, 3), "unknown": (1, 1)}
    text_ = "\n".join(r.value for r in spark.read.text(str(tmp_path / "out" / "wing=w" / "room=r")).collect())
    assert text_.strip() == "## 1\n\n> a\n\n## 2\n\n> b\n> c"


def test_functions_a_user_may_bring(spark):
    d = spark.createDataFrame([("teh cat Teh t3h",), (None,)], "t string")
    assert [r[0] for r in d.select(text.spellchecked(F.col("t"))).collect()] == ["teh cat Teh t3h", None]
    longer = spark.createDataFrame([("thier cat Thier th1er",)], "t string")
    assert longer.select(text.spellchecked(F.col("t"), lambda w: {"thier": "their"}.get(w, w))).first()[0] == "their cat Thier th1er"
    v = [r[0] for r in d.select(text.embedded(F.col("t"), 16)).collect()]
    assert len(v[0]) == 16 and abs(sum(x * x for x in v[0]) - 1) < 1e-9 and set(v[1]) == {0.0}
