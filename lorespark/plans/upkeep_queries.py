"""Queries of session folders, personas, checks of contents, and the totals of a dedup run, with DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sanitize
from ..operators import entities, neardup
from ..sources import files
from .registry import query, t
from .registry import greedy_dedup as _flags


@query("""WITH s AS (SELECT conv_id, CASE WHEN bool_or(turn < 20 AND turn % 3 = 1 AND ascii(substr(conv_id, 3, 1)) % 2 = 0) THEN '/work/' || substr(conv_id, 1, 2) END AS cwd FROM (SELECT CAST(conv_id AS VARCHAR) AS conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS turn FROM conversations) GROUP BY 1)
SELECT substr(conv_id, 1, 1) AS project, count(*) AS sessions, arg_min(cwd, conv_id) FILTER (cwd IS NOT NULL) AS cwd FROM s GROUP BY 1""")
def session_roots(spark, sf_dir):
    """A conversation is a session file, in the folder of its id's first character; some of its lines tell a working folder."""
    c = t(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("conv_id"), "turn", "role", "text")
    turns = c.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("s"))
    told = lambda i: F.when((i % 3 == 1) & (F.ascii(F.substring("conv_id", 3, 1)) % 2 == 0), F.concat(F.lit("/work/"), F.substring("conv_id", 1, 2)))
    line = F.transform("s", lambda x, i: F.to_json(F.struct(x["role"].alias("type"), told(i).alias("cwd"), x["text"].alias("text"))))
    path = F.concat_ws("/", F.lit("projects"), F.substring("conv_id", 1, 1), F.concat("conv_id", F.lit(".jsonl")))
    return files.session_roots(turns.select(path.alias("path"), F.array_join(line, "\n").alias("text")))


@query("""SELECT c_custkey AS id, CASE WHEN c_nationkey = 3 AND c_custkey % 3 < 2 THEN 'persona' ELSE CASE c_custkey % 3 WHEN 0 THEN 'person' WHEN 1 THEN 'uncertain' ELSE 'project' END END AS type FROM customer""")
def personas_apart(spark, sf_dir):
    k = F.col("c_custkey")
    c = t(spark, sf_dir, "customer")
    kind = F.when(k % 3 == 0, "person").when(k % 3 == 1, "uncertain").otherwise("project")
    return entities.reclassified(c.select(k.alias("id"), F.col("c_name").alias("name"), kind.alias("type")), c.where("c_nationkey = 3").select(F.upper("c_name").alias("name"))).select("id", "type")


_CONTENT = "CASE WHEN doc_id % 50 = 1 THEN repeat(' ', CAST(doc_id % 7 AS INTEGER)) WHEN doc_id % 50 = 2 THEN repeat(text || 'x', 1000) ELSE text END"


@query(rf"SELECT doc_id AS id, CASE WHEN NOT regexp_matches(coalesce(x, ''), '\S') THEN 'content is empty' WHEN length(x) > {sanitize.CONTENT_LENGTH} THEN 'content is too long' END AS error FROM (SELECT doc_id, {_CONTENT} AS x FROM documents)")
def content_errors(spark, sf_dir):
    d = t(spark, sf_dir, "documents")
    i = F.col("doc_id")
    x = F.when(i % 50 == 1, F.repeat(F.lit(" "), (i % 7).cast("int"))).when(i % 50 == 2, F.repeat(F.concat("text", F.lit("x")), F.lit(1000))).otherwise(F.col("text"))
    return d.select(i.alias("id"), sanitize.content_error(x).alias("error"))


@query()
def dedup_totals(spark, sf_dir):
    """What `greedy_dedup` keeps and deletes of each source."""
    return neardup.dedup_totals(_flags(spark, sf_dir))
