"""Queries of whole mines and of indexed vectors, with DuckDB twins."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text
from ..functions.shared import new_folder
from ..operators import chunks, mining, vector_index
from ..sources.store import MemoryStore
from .registry import COS, query, t
from .text_queries import STRIP, _route_sql

# Every third file is read again, at a later time, with its text twice.
_CUT = r"""s AS (SELECT source || '/' || doc_id AS source_file, source, regexp_replace(CASE WHEN doc_id % 3 = 0 THEN text || chr(10) || chr(10) || text ELSE text END, '^\s+|\s+$', '', 'g') AS b, CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 1 END AS run FROM documents),
c AS (SELECT source_file, b, 0 AS a, 0 AS z, 0 AS k FROM s WHERE length(b) >= 50 UNION ALL
  SELECT source_file, b, a2, CASE WHEN a2 + 800 >= length(b) THEN length(b)
    WHEN strpos(reverse(substr(b, a2 + 1, 800)), chr(10) || chr(10)) > 0 AND 799 - strpos(reverse(substr(b, a2 + 1, 800)), chr(10) || chr(10)) > 400 THEN a2 + 799 - strpos(reverse(substr(b, a2 + 1, 800)), chr(10) || chr(10))
    WHEN strpos(reverse(substr(b, a2 + 1, 800)), chr(10)) > 0 AND 800 - strpos(reverse(substr(b, a2 + 1, 800)), chr(10)) > 400 THEN a2 + 800 - strpos(reverse(substr(b, a2 + 1, 800)), chr(10)) ELSE a2 + 800 END, k + 1
  FROM (SELECT source_file, b, k, CASE WHEN k = 0 THEN 0 ELSE z - 100 END AS a2, z FROM c) WHERE k = 0 OR z < length(b)),
p AS (SELECT source_file, k, regexp_replace(substr(b, a + 1, z - a), '^\s+|\s+$', '', 'g') AS p FROM c WHERE k > 0),
n AS (SELECT source_file, p, row_number() OVER (PARTITION BY source_file ORDER BY k) - 1 AS chunk_index, count(*) OVER (PARTITION BY source_file) AS n FROM p WHERE length(p) >= 50)"""
ROOMS = {"src1": [], "src2": ["heon"]}


def _mined(spark, sf_dir) -> MemoryStore:
    d = t(spark, sf_dir, "documents").select(F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("source_file"), F.lit(1.0).alias("mtime"), F.col("text").alias("document"), "doc_id")
    changed = F.col("doc_id") % 3 == 0
    later = d.select("source_file", F.when(changed, 2.0).otherwise(1.0).alias("mtime"), F.when(changed, F.concat("document", F.lit("\n\n"), "document")).otherwise(F.col("document")).alias("document"))
    store = MemoryStore(spark, new_folder(spark, "mined"))
    for files in (d.drop("doc_id"), later, later):  # the third mine finds everything current
        mining.mine_files(store, files, "documents", ROOMS)
    return store


@query(rf"""WITH RECURSIVE {_CUT}, r AS (SELECT source_file, CASE WHEN source IN ('src1', 'src2') THEN source WHEN contains(lower(substr(b, 1, 2000)), 'heon') THEN 'src2' ELSE 'general' END AS room, run FROM s)
SELECT 'drawer_documents_' || room || '_' || substr(sha256(source_file || chunk_index), 1, 24) AS id, source_file, CAST(chunk_index AS INTEGER) AS chunk_index, room, {_route_sql(chunks.HALLS, 'lower(substr(p, 1, 3000))')} AS hall, md5(p) AS digest, CAST(run AS DOUBLE) AS source_mtime
FROM n JOIN r USING (source_file) WHERE n <= 500""")
def mined_files(spark, sf_dir):
    return _mined(spark, sf_dir).chunks().select("id", "source_file", "chunk_index", "room", "hall", F.md5("document").alias("digest"), "source_mtime")


@query(rf"""WITH RECURSIVE {_CUT} SELECT source_file, CAST(run AS BIGINT) AS run, any_value(n) AS chunks FROM n JOIN s USING (source_file) WHERE n <= 500 GROUP BY 1, 2""")
def mined_sources(spark, sf_dir):
    """What the three mines left: the run that each source is current of, and its chunks; no third run exists."""
    return _mined(spark, sf_dir).sources().select("source_file", F.split("run", "-")[0].cast("long").alias("run"), "chunks")


@query(rf"""WITH l AS (SELECT conv_id, turn, CASE WHEN role = 'user' THEN '> ' ELSE '' END || {STRIP.format("regexp_replace(text, chr(10), ' ', 'g')")} AS line FROM conversations),
q AS (SELECT conv_id, count(*) FILTER (line LIKE '>%') AS q, string_agg(line, chr(10) ORDER BY turn) AS d FROM l GROUP BY 1),
x AS (SELECT *, sum(CASE WHEN line LIKE '>%' OR line LIKE '---%' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS ex FROM l),
y AS (SELECT *, arg_min(line, turn) OVER (PARTITION BY conv_id, ex) AS head, row_number() OVER (PARTITION BY conv_id, ex ORDER BY turn) AS k FROM x WHERE line <> ''),
g AS (SELECT conv_id, ex, any_value(head) || coalesce(chr(10) || string_agg(line, ' ' ORDER BY turn) FILTER (k > 1), '') AS d FROM y WHERE ex > 0 AND head LIKE '>%' GROUP BY 1, 2),
u AS (SELECT conv_id, ex, g.d FROM g JOIN q USING (conv_id) WHERE q >= 3 UNION ALL SELECT conv_id, 0, {STRIP.format('d')} FROM q WHERE q < 3 AND length({STRIP.format('d')}) > 0),
k AS (SELECT conv_id, ex, u.d, unnest(range(0, CAST(ceil(length(u.d) / 800.0) AS BIGINT))) AS i FROM u JOIN q USING (conv_id) WHERE length({STRIP.format('u.d')}) > 30 AND length({STRIP.format('q.d')}) >= 30),
c AS (SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY ex, i) - 1 AS INTEGER) AS chunk_index, substr(d, i * 800 + 1, 800) AS p FROM k)
SELECT 'conv/' || conv_id AS source_file, chunk_index, {_route_sql(chunks.TOPICS, chr(39) + ' ' + chr(39) + ' || lower(p) || ' + chr(39) + ' ' + chr(39))} AS room, md5(p) AS digest FROM c
UNION ALL SELECT 'conv/' || conv_id, 0, '_registry', md5('[registry] conv/' || conv_id) FROM q WHERE conv_id NOT IN (SELECT conv_id FROM c)""")
def mined_transcripts(spark, sf_dir):
    """Transcripts in two mines, the second of which reads only what the first left, and a third that finds nothing."""
    line = F.concat(F.when(F.col("role") == "user", "> ").otherwise(""), text.strip(F.regexp_replace("text", "\n", " ")))
    said = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", line.alias("line")))), lambda x: x["line"]), "\n")
    d = t(spark, sf_dir, "conversations").groupBy("conv_id").agg(said.alias("document"))
    d = d.select(F.concat(F.lit("conv/"), F.col("conv_id").cast("string")).alias("source_file"), "document", "conv_id")
    store = MemoryStore(spark, new_folder(spark, "mined"))
    for files in (d.where("conv_id % 2 = 0"), d, d):
        mining.mine_transcripts(store, files, "talks")
    return store.chunks().select("source_file", "chunk_index", "room", F.md5("document").alias("digest"))


def _indexed(spark, sf_dir, probes):
    v = t(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    index = vector_index.built(v, new_folder(spark, "vectors"))
    queries = v.where("id % 50 = 0").select(F.col("id").alias("query_id"), "embedding")
    out = vector_index.nearest(index, queries, 6, probes and len(index.centres)).where("id <> query_id")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("rank")).alias("rank")
    return out.select("query_id", place, "id", F.abs(F.round("distance", 6)).alias("distance")).where("rank <= 5")


@query(f"""SELECT query_id, rank, id, distance FROM (SELECT q.vec_id AS query_id, e.vec_id AS id, abs(round(1 - {COS.format('e.embedding', 'q.embedding')}, 6)) AS distance,
row_number() OVER (PARTITION BY q.vec_id ORDER BY 1 - {COS.format('e.embedding', 'q.embedding')}, e.vec_id) AS rank FROM embeddings e, embeddings q
WHERE q.vec_id % 50 = 0 AND e.vec_id <> q.vec_id) WHERE rank <= 5""")
def indexed_topk_all_cells(spark, sf_dir):
    """Every cell probed: the index holds every vector, and the answer is exact."""
    return _indexed(spark, sf_dir, True)


@query()
def indexed_topk(spark, sf_dir):
    """As many cells as the sample asks for; a test measures the recall on the same table."""
    return _indexed(spark, sf_dir, None)
