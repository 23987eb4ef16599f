"""The registered queries of the training-data operators: production parameters, whole tables, contract columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, closeness, clustering, decontam, jaccard, oracles, packing, pii, sharding, structure, substring, suffix, tokens, toxicity
from .common import modest_batches, table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(table(spark, sf_dir, "documents"), payload="crc32")
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), hold_out=5)
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out.alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.sanitise(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda x: x["kind"] != "term")

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def terms(removed: bool) -> Column:
        return F.size(F.filter("spans", lambda x: (x["kind"] == "term") & ((x["replacement"] == "") == removed))).cast("long")

    counts = [number(kind) for kind in ("email", "ip", "card", "phone")]
    listed = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    return out.select("doc_id", *counts, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"), terms(False).alias("n_generalised"), terms(True).alias("n_term_removed"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.length_histogram(tokens.token_lengths(table(spark, sf_dir, "documents")))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.repeated_words(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", F.size("removed").cast("long").alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard_documents(table(spark, sf_dir, "documents"), 8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    modest_batches(spark)
    out = suffix.repeated_bytes(table(spark, sf_dir, "documents"))
    gone = F.col("n_bytes") - F.octet_length("kept")
    return out.select("doc_id", "n_bytes", gone.cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), k=10, every=100)


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = structure.repair(structure.damaged(table(spark, sf_dir, "conversations")))
    digest = F.sha2(structure.lines(F.col("turns")).cast("binary"), 256).alias("repaired_sha256")
    columns = ["conv_id", *structure.COUNTS, "audit", "repaired_sha256"]
    sealed = structure.sealed(found.pieces).withColumnRenamed("conv_id", "sealed_id")
    split = found.split.join(sealed, F.col("conv_id").eqNullSafe(F.col("sealed_id"))).select(columns)
    return found.whole.select("conv_id", *structure.COUNTS, "audit", digest).unionByName(split)


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = clustering.cluster_vectors(table(spark, sf_dir, "embeddings"), k=40, rounds=5, dim=64)
    return clustering.with_inertia(found, centroids)


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return closeness.near_copies(table(spark, sf_dir, "embeddings"), threshold=0.9)


QUERIES = {
    "op1_packing": op1_packing,
    "op2_toxicity": op2_toxicity,
    "op3_pii": op3_pii,
    "op4_token_counts": op4_token_counts,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_sharding": op7_sharding,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_nearest_neighbours": op10_nearest_neighbours,
    "op11_structure_repair": op11_structure_repair,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_embedding_near_dedup": op13_embedding_near_dedup,
}
ORACLES: dict[str, str] = {
    "op11_structure_repair": oracles.repaired_conversations(),
    "op12_centroid_clustering": oracles.clusters(),
    "op13_embedding_near_dedup": oracles.near_vectors(),
}
