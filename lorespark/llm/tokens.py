"""Byte-level BPE ids and the exact token-length histogram."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrays import PIECE, pieces
from .common import cut_lineage

#: The vocabulary's only special token; the reference encoder recognises its string in a text.
SPECIAL = "<|endoftext|>"
#: A run without a space longer than this goes to the encoder whose merges stay near-linear.
LONG_RUN = 2000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@cache
def _encoders(path: str):
    """The JSON vocabulary's tokenizer, and its equal-ranks form in the faster library if that lies beside it."""
    import os

    from tokenizers import Tokenizer

    slow, fast = Tokenizer.from_file(path), None
    ranks = path.removesuffix(".json") + ".tiktoken"
    if os.path.exists(ranks):
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    return slow, fast


def encode(text: str, path: str) -> list[int]:
    """Token ids of one text, without special tokens added."""
    slow, fast = _encoders(path)
    if fast is None or SPECIAL in text or (len(text) > LONG_RUN and max(map(len, text.split())) > LONG_RUN if text.strip() else bool(text)):
        return slow.encode(text, add_special_tokens=False).ids
    return fast.encode_ordinary(text)


def encoded(batches: Iterator[pa.RecordBatch], path: str, text_col: str) -> Iterator[tuple[pa.RecordBatch, list[list[int]]]]:
    """Each batch, in pieces of about a megabyte of text, with the ids of its texts; copies in a piece are encoded once."""
    for batch in pieces(batches, text_col, PIECE):
        texts = [t or "" for t in batch.column(text_col).to_pylist()]
        known: dict[str, list[int]] = {}
        for t in texts:
            if t not in known:
                known[t] = encode(t, path)
        yield batch, [known[t] for t in texts]


def token_lengths(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens) of every row; null text counts as empty (0 tokens), repeated rows stay."""
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ids in encoded(batches, path, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([len(x) for x in ids], pa.int64())], ["id", "n_tokens"])

    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return d.mapInArrow(run, "id long, n_tokens long").withColumnRenamed("id", id_col)


def length_histogram(lengths: DataFrame, block: int = 128) -> DataFrame:
    """The exact histogram of `n_tokens`, with suffix sums that answer every context limit.

    One row per distinct length n (nulls are left out; an empty table gives no rows): n_docs and n_tokens_sum of that
    length; docs_at_least and tokens_at_least (suffix sums); truncated_total: tokens kept when every document is cut at
    n, which is the sum of those shorter plus n for each one at least as long; quantile: share of documents of at most
    n tokens. `at_limits` answers any other limit from this table.

    The corpus is read and encoded once: the counts are combined before the only data-sized shuffle, and what comes of
    it (a row per distinct length) is written before both levels of sums read it. Suffix sums run in two levels, over blocks of `block`
    lengths and inside each block, so no task sees more than `block` rows or one row per block.
    """
    h = lengths.where(F.col("n_tokens").isNotNull()).groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))
    h = cut_lineage(h).withColumn("blk", F.expr(f"n_tokens div {int(block)}")).withColumn("n_tokens_sum", F.col("n_tokens") * F.col("n_docs"))
    blocks = h.groupBy("blk").agg(F.sum("n_docs").alias("bd"), F.sum("n_tokens_sum").alias("bt"))
    after = Window.orderBy(F.col("blk").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select(
        "blk",
        F.coalesce(F.sum("bd").over(after), F.lit(0)).alias("d_after"),
        F.coalesce(F.sum("bt").over(after), F.lit(0)).alias("t_after"),
        F.sum("bd").over(whole).alias("d_all"), F.sum("bt").over(whole).alias("t_all"),
    )
    here = Window.partitionBy("blk").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, 0)
    out = h.withColumn("d_here", F.sum("n_docs").over(here)).withColumn("t_here", F.sum("n_tokens_sum").over(here)).join(blocks, "blk")
    at_least, tokens = F.col("d_after") + F.col("d_here"), F.col("t_after") + F.col("t_here")
    return out.select(
        "n_tokens", "n_docs", "n_tokens_sum", at_least.alias("docs_at_least"), tokens.alias("tokens_at_least"),
        (F.col("t_all") - tokens + F.col("n_tokens") * at_least).alias("truncated_total"),
        ((F.col("d_all") - at_least + F.col("n_docs")) / F.col("d_all")).alias("quantile"),
    )


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """For each context limit, from `length_histogram`: n_docs and n_tokens_sum (of all documents), docs_over (longer
    than the limit), truncated_total (tokens left when every document is cut there) and lost (tokens cut off).

    One pass over the histogram, with one sum per limit; repeated limits give one row each, no limits no rows, and an
    empty histogram zeros. Limits must be at least 0.
    """
    if any(x < 0 for x in limits):
        raise ValueError("limits must be at least 0")
    spark = histogram.sparkSession
    if not limits:
        return spark.createDataFrame([], "context_limit long, n_docs long, n_tokens_sum long, docs_over long, truncated_total long, lost long")
    n, docs = F.col("n_tokens"), F.col("n_docs")

    def total(x):
        return F.coalesce(F.sum(x), F.lit(0))

    answers = [F.struct(F.lit(x).cast("long").alias("context_limit"), total(F.when(n > x, docs)).alias("docs_over"), total(F.least(n, F.lit(x)) * docs).alias("truncated_total")) for x in limits]
    one = histogram.agg(total(docs).alias("n_docs"), total(F.col("n_tokens_sum")).alias("n_tokens_sum"), F.array(*answers).alias("a"))
    return one.select("n_docs", "n_tokens_sum", F.explode("a").alias("a")).select("a.context_limit", "n_docs", "n_tokens_sum", "a.docs_over", "a.truncated_total", (F.col("n_tokens_sum") - F.col("a.truncated_total")).alias("lost"))


def crc32_of(ids: np.ndarray) -> int:
    import zlib

    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
