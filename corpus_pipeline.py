"""A corpus from raw documents to packed sequences, in five stages of training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorespark.llm import decontam, jaccard, packing, pii, toxicity
from lorespark.llm.common import modest_batches, reread, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
ROW = "pipeline_row"


def numbered(docs: DataFrame) -> DataFrame:
    """The documents with a number for each row, written once: ids may be null or shared, decisions are on rows."""
    return reread(docs.select(*COLUMNS, F.monotonically_increasing_id().alias(ROW)))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows scored below 0.5 stay. The machine learns from the labels of the documents that reach this stage."""
    modest_batches(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select(*COLUMNS), model).where("toxicity < 0.5").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar rows one stays: the one with the smallest id (a null id counts as the largest), and of
    several rows with that id the first one. Rows without words are one group; repeated rows are copies of each other."""
    modest_batches(spark)
    rows = numbered(docs)
    joined = reread(jaccard.jaccard_join(rows, id_col=ROW).select(ROW, "group_id"))
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", ROW))
    kept = rows.select("doc_id", ROW).join(joined, ROW).groupBy("group_id").agg(best.alias("best")).select(F.col(f"best.{ROW}").alias(ROW))
    return rows.join(kept, ROW, "left_semi").select(*COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark item go, whatever their id; other rows of the same id stay."""
    modest_batches(spark)
    rows = numbered(docs)
    leaks = decontam.find_leaks(rows, table(spark, sf_dir, "benchmark"), id_col=ROW).select(ROW).distinct()
    return rows.join(leaks, ROW, "left_anti").select(*COLUMNS)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row stays, with its text sanitised by what it holds itself."""
    modest_batches(spark)
    out = pii.sanitise(numbered(docs), id_col=ROW).withColumn("text", F.col("sanitised"))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, placed into sequences of 2048 ids."""
    modest_batches(spark)
    return packing.pack(docs, payload="crc32")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

#: Several stages (the machine, the latent space, the tokenizer) have no SQL; tests compare them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; between stages the rows are written as Parquet, in the shared folder that
    `spark.checkpoint.dir` names, and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = reread(docs)
    return docs
