"""Streams with state, stopped and started again from their checkpoints."""

import random

from lorespark.streaming import stateful


def run(spark, source, schema, make, out, checkpoint):
    q = make(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(source)).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination(180)
    assert q.exception() is None


def test_saves_fire_once_whatever_the_batches(spark, tmp_path):
    rng = random.Random(4)
    source, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "ck"))
    schema, sent = "session_id string, role string, text string", {}
    for batch in range(4):
        rows = []
        for _ in range(rng.randrange(100, 250)):
            s = rng.choice(["hot"] * 5 + ["a", "b", None])
            role, text = rng.choice([("user", "hello"), ("user", "hi"), ("assistant", "yes"), ("user", " "), ("user", "<command-message>x"), ("user", None)])
            rows.append((s, role, text))
            if s and role == "user" and text and text.strip() and "<command" not in text:
                sent[s] = sent.get(s, 0) + 1
        spark.createDataFrame(rows, schema).repartition(2).write.mode("append").json(source)
        if batch in (1, 3):  # two runs, the second from the first one's checkpoint
            run(spark, source, schema, stateful.save_triggers, out, checkpoint)
    got = sorted((r.session_id, r.nth, r.messages) for r in spark.read.parquet(out).collect())
    assert got == sorted((s, n, 15 * n) for s, c in sent.items() for n in range(1, c // 15 + 1)) and len(got) > 5
    run(spark, source, schema, stateful.save_triggers, out, checkpoint)  # nothing new
    assert spark.read.parquet(out).count() == len(got)


def test_diaries_grow_by_their_new_entries(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "ck"))
    schema = "source_file string, mtime double, text string"
    day, other = "d/2024-05-01.md", "d/2024-05-02.md"
    one = "# Day\n## Morning\nrose\n## Noon\nate"
    steps = [
        [(day, 1.0, one), ("d/notes.md", 1.0, "## A\nb"), (other, 1.0, None), (None, 1.0, "## X")],
        [(day, 2.0, one)],
        [(day, 3.0, one + "\n## Night\nslept"), (other, 5.0, "## Two\nsecond\n## Three\nthird"), (other, 2.0, "## Two\nsecond")],
        [(day, 4.0, one.replace("ate", "fed") + "\n## Night\nslept")],
    ]
    for i, rows in enumerate(steps):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(source)
        run(spark, source, schema, stateful.diary_entries, out, checkpoint)
    got = sorted((r.source_file[-5:-3], r["mode"], r.entry, r.header, r.document) for r in spark.read.parquet(out).collect())
    want = [("01", "new", 0, "Morning", "rose"), ("01", "new", 1, "Noon", "ate"), ("01", "tail", 2, "Night", "slept")]
    want += [("01", "rebuild", 0, "Morning", "rose"), ("01", "rebuild", 1, "Noon", "fed"), ("01", "rebuild", 2, "Night", "slept")]
    want += [("02", "tail", 0, "Two", "second"), ("02", "tail", 1, "Three", "third")]
    assert got == sorted(want)


def test_messages_stream_keeps_blocks_and_resumes(spark, tmp_path):
    import json

    from lorespark.sources import transcripts

    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    (source / "project").mkdir(parents=True)
    line = lambda u, content, role="user": json.dumps({"type": role, "sessionId": "s", "uuid": u, "timestamp": "2024", "message": {"role": role, "content": content}})

    def go():
        q = transcripts.session_message_stream(spark, str(source), 1).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        q.awaitTermination(120)
        return sorted((r.message_uuid, r.role, r.text) for r in spark.read.parquet(out).collect())

    (source / "project" / "a.jsonl").write_text("\n".join([line("1", "hi"), "broken", line("2", [{"type": "text", "text": "two"}, {"type": "text", "text": "blocks"}], "assistant"), line("3", " ")]))
    (source / "notes.txt").write_text(line("9", "no session file"))
    assert go() == [("1", "user", "hi"), ("2", "assistant", "two\nblocks")]
    (source / "b.jsonl").write_text(line("4", "later"))
    assert [u for u, _, _ in go()] == ["1", "2", "4"] and len(go()) == 3
