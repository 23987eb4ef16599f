"""The pipeline against a plain version of each stage's decision, over one small corpus."""

import zlib

import brute
import pyarrow as pa
from conftest import frame
from pyspark.sql import functions as F
from test_operators import plain_spans, toxic_sample

import corpus_pipeline as pipeline
from lorespark.llm import tokens
from lorespark.llm.common import modest_batches


def test_stages_in_order():
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "benchmark_decontamination", "pii", "packing"]


def test_whole_pipeline(spark, tmp_path):
    rows, labels, good = toxic_sample(spark)
    item = " ".join(good[i * 7 % 400] for i in range(40))
    rows += [(700, rows[1][1]), (701, rows[1][1] + " tail"), (702, "see " + item + " here"), (703, "mail me at who@example.com soon"), (704, None), (705, ""), (706, "")]
    frame(spark, rows).select(*pipeline.COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    toxic = {i for i, _, y in labels if y}
    left = [(i, t) for i, t in rows if i not in toxic]
    group = {i: g for i, _, g, _, _ in brute.jaccard(left)}
    left = [(i, t) for i, t in left if group[i] == i and i != 702]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == list(pipeline.COLUMNS), name
        docs = docs.checkpoint()
    kept = {r.doc_id: r.text for r in docs.collect()}
    assert set(kept) == {i for i, _ in left}
    for i, t in left:
        assert kept[i] == (t if not plain_spans(t or "") else "mail me at <EMAIL> soon")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.default_vocabulary())
    want = {i: len(t.encode(x or "", add_special_tokens=False).ids) + 1 for i, x in kept.items()}
    packed = pipeline.run(spark, str(tmp_path)).collect()
    got = {}
    for r in packed:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == want and all(0 <= r.ids_crc32 < 1 << 32 for r in packed)
    assert zlib.crc32(b"\x01\x00\x00\x00") in {r.ids_crc32 for r in packed if r.doc_id == 704}


def test_decisions_are_on_rows_not_ids(spark, tmp_path):
    words = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in "lmnrs"]
    one, two, other, item = " ".join(words[:40]), " ".join(words[40:80]), " ".join(words[80:120]), " ".join(words[::3])
    rows = [(1, one), (1, one), (3, one), (3, two), (None, one), (None, two), (None, other), (7, None), (7, ""), (None, None)]
    docs = frame(spark, rows).select(*pipeline.COLUMNS)
    kept = sorted(((r.doc_id, r.text or "") for r in pipeline.drop_near_copies(spark, docs, str(tmp_path)).collect()), key=str)
    assert kept == sorted([(1, one), (3, two), (None, other), (7, "")], key=str)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    leaky = frame(spark, [(1, one), (1, item), (None, item + " tail"), (None, other), (2, None)]).select(*pipeline.COLUMNS)
    kept = sorted(((r.doc_id, r.text) for r in pipeline.drop_leaks(spark, leaky, str(tmp_path)).collect()), key=str)
    assert kept == sorted([(1, one), (None, other), (2, None)], key=str)
    masked = pipeline.mask_personal_data(spark, frame(spark, [(1, "a@b.cd x"), (1, "plain"), (None, "a@b.cd y"), (None, None)]).select(*pipeline.COLUMNS), str(tmp_path))
    assert sorted((r.text for r in masked.collect()), key=str) == ["<EMAIL> x", "<EMAIL> y", None, "plain"]


def test_stages_on_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 1), (2, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    frame(spark, []).select(*pipeline.COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_workers_get_modest_batches(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    texts = spark.range(0, 9000, 1, 1).select(F.repeat(F.lit("word "), 400).alias("text"))
    try:
        spark.conf.unset(key)
        modest_batches(spark)
        assert texts.mapInArrow(sizes, "n long").agg(F.max("n")).first()[0] < 5 << 20
        spark.conf.set(key, "1m")
        modest_batches(spark)
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
