"""The data source of session messages, as a table and as a stream that goes on from its offset."""

import json
import os

from lorespark.sources import plugin


def line(uuid, content, role="user"):
    return json.dumps({"type": role, "sessionId": "s", "uuid": uuid, "timestamp": "t", "message": {"content": content}}) + "\n"


def put(folder, name, text, at):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)
    os.utime(f"{folder}/{name}", (at, at))


def drain(spark, folder, out):
    stream = spark.readStream.format("session_messages").load(folder)
    run = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-c").trigger(availableNow=True).start()
    run.awaitTermination()
    return sorted(r.message_uuid for r in spark.read.schema(stream.schema).parquet(out).collect())


def test_stream_goes_on_from_its_offset(spark, tmp_path):
    plugin.register(spark)
    folder, out = f"{tmp_path}/in", f"{tmp_path}/out"
    put(folder, "a.jsonl", line("1", "one") + "no json\n" + line("2", [{"type": "text", "text": "two"}, {"type": "tool", "n": 1}]), 1000)
    put(f"{folder}/deep", "b.jsonl", line("3", "three", "assistant") + line("x", " ") + line("y", "said", "system"), 1000)
    put(folder, "c.txt", line("z", "not of the suffix"), 1000)
    assert drain(spark, folder, out) == ["1", "2", "3"]
    assert drain(spark, folder, out) == ["1", "2", "3"]  # nothing new
    put(folder, "d.jsonl", line("4", "four"), 2000)
    put(folder, "e.jsonl", line("5", "too young"), 4e9)
    assert drain(spark, folder, out) == ["1", "2", "3", "4"]
    put(folder, "a.jsonl", line("1", "one") + line("6", "grown"), 3000)
    assert drain(spark, folder, out) == ["1", "1", "2", "3", "4", "6"]
    os.remove(f"{folder}/a.jsonl")  # the newest file goes: nothing is read twice
    assert drain(spark, folder, out) == ["1", "1", "2", "3", "4", "6"]


def test_table_of_files(spark, tmp_path):
    plugin.register(spark)
    for i in range(20):
        put(f"{tmp_path}/in", f"{i:02}.jsonl", line(str(i), [{"type": "text", "text": f"t{i}"}, {"type": "tool", "n": i}]), 1000 + i)
    read = spark.read.format("session_messages")
    uri = f"file://{tmp_path}/in"
    all_ = read.load(uri)
    assert sorted((int(r.message_uuid), r.text) for r in all_.collect()) == [(i, f't{i}\n{{"type":"tool","n":{i}}}') for i in range(20)]
    assert all_.rdd.getNumPartitions() == 1  # small files share a task
    assert read.option("bytes", 1).load(uri).rdd.getNumPartitions() == 20
    assert read.option("since", 1015).load(uri).count() == 5
    assert spark.read.format("session_messages").load(f"{uri}/03.jsonl").count() == 1
