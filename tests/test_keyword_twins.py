"""Keyword searches against their SQL on queries that the shared tables hardly hold."""

import random

import duckdb
import pytest

import __spark_entry__ as entry

ODD = ["Of Of Of Of", "", None, "a b c", "Le la LE", "-- ## --", "The Of", "Straße ÉTÉ été", "zzz nowhere else", "thea"]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Every tenth document is a query, and most queries have no word of three letters."""
    rng, path = random.Random(4), tmp_path_factory.mktemp("odd")
    words = ["the", "thea", "of", "le", "a", "straße", "Été", "anre", "eran", "x1", "nn"]
    docs = [(i, ODD[i // 50 % len(ODD)] if i % 50 == 0 else " ".join(rng.choice(words) for _ in range(rng.randrange(0, 40))), "en", "web", 0) for i in range(600)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{path}/documents.parquet")
    vectors = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(0, 600) if i % 7]
    vectors += [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(0, 600, 50) if i % 7 == 0]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").coalesce(1).write.parquet(f"{path}/embeddings.parquet")
    return str(path)


def equals_sql(spark, name, path):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}/{table}.parquet/*.parquet'")
    want = sorted(map(repr, con.execute(entry.oracle_sql()[name]).fetchall()))
    got = sorted(repr(tuple(r)) for r in entry.queries()[name](spark, path).collect())
    return got == want and len(got) > 0


def test_fallback_finds_nothing_for_queries_of_short_words(spark, odd):
    assert equals_sql(spark, "search_bm25_fallback", odd)


def test_union_adds_nothing_for_queries_of_short_words(spark, odd):
    assert equals_sql(spark, "search_union", odd)


def test_union_reads_its_chunks_and_queries_once(spark):
    """Both were computed anew for every step that reads them: texts of all chunks were joined and dealt each time."""
    from pyspark.sql import functions as F

    from lorespark.operators import search

    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def text(i):
        read.add(1)
        return f"the text of number {i} and more"

    made = spark.range(40).select("id", (F.col("id") % 8).cast("string").alias("source_file"), (F.col("id") / 8).cast("int").alias("chunk_index"), text.asNondeterministic()("id").alias("document"), F.array(F.sin("id"), F.cos("id")).alias("embedding"))
    closets = made.where("id % 5 = 0").select("id", "source_file", "embedding")
    queries = made.where("id < 10").select(F.col("id").alias("query_id"), F.col("document").alias("query"), "embedding")
    found = search.search_chunks(made, closets, queries, 3, strategy="union")
    assert {r.query_id for r in found.collect()} == set(range(10)) and found.count() == 30
    assert read.value <= 2 * 40
