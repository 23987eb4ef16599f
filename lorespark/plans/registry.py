"""All registered queries of the memory engine's operators, with DuckDB twins written for the same tables.

Tables stand in for the data model: documents are chunks (wing = lang, room = source, source_file = source/doc_id),
conversations are messages, orders of customers in nations are facts, and vec_id pairs with doc_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import temporal, text
from ..functions.filters import get, scope, where_column
from ..operators import catalog, chunks, entities, evaluate, facts, graph, mutate, neardup, search

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
QUERY = "the heon and ered that"


def query(sql: str | None = None):
    """Register a function under its name, with its DuckDB twin."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chunk_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = t(spark, sf_dir, "documents")
    file = F.concat_ws("/", "source", F.col("doc_id").cast("string"))
    return d.select(F.col("doc_id").alias("id"), F.col("text").alias("document"), F.col("lang").alias("wing"), F.col("source").alias("room"), file.alias("source_file"))


def fact_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders, cust, nation = (t(spark, sf_dir, n) for n in ("orders", "customer", "nation"))
    day = F.to_date("o_orderdate")
    c = cust.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_name", "n_name")
    end = F.when(F.col("o_orderkey") % 10 < 3, F.date_format(F.date_add(day, (30 + F.col("o_orderkey") % 365).cast("int")), "yyyy-MM-dd"))
    triples = orders.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("id"), text.entity_id(F.col("c_name")).alias("subject"), F.lower("o_orderstatus").alias("predicate"),
        text.entity_id(F.col("n_name")).alias("object"), F.date_format(day, "yyyy-MM-dd").alias("valid_from"), end.alias("valid_to"),
    )
    ents = cust.select(F.col("c_name").alias("name")).unionByName(nation.select(F.col("n_name").alias("name"))).select(text.entity_id(F.col("name")).alias("id"), "name")
    return triples, ents


FACTS = """
triples AS (SELECT o_orderkey AS id, replace(replace(lower(c_name),' ','_'),'''','') AS subject, lower(o_orderstatus) AS predicate,
  replace(replace(lower(n_name),' ','_'),'''','') AS object, strftime(CAST(o_orderdate AS DATE),'%Y-%m-%d') AS valid_from,
  CASE WHEN o_orderkey % 10 < 3 THEN strftime(CAST(o_orderdate AS DATE) + CAST(30 + o_orderkey % 365 AS INTEGER),'%Y-%m-%d') END AS valid_to
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
ents AS (SELECT replace(replace(lower(name),' ','_'),'''','') AS id, name FROM (SELECT c_name AS name FROM customer UNION ALL SELECT n_name FROM nation))
"""
VALID = "(valid_from IS NULL OR valid_from || 'T00:00:00Z' <= '{0}T00:00:00Z') AND (valid_to IS NULL OR valid_to || 'T23:59:59Z' >= '{0}T00:00:00Z')"
TOKENS = r"regexp_extract_all(lower(coalesce({0},'')), '[\p{{L}}\p{{N}}_]{{2,}}')"
COS = "list_cosine_similarity(CAST({0} AS DOUBLE[]), CAST({1} AS DOUBLE[]))"


# --- retrieval ---------------------------------------------------------------------------------------------------------


def _bm25_sql(docs: str, queries: str, extra: str = "") -> str:
    """CTEs ending in bm25(query_id, id, bm25) for candidates `docs`(query_id, id, document) and `queries`(query_id, query)."""
    return f"""
d AS (SELECT query_id, id, {TOKENS.format('document')} AS ts FROM {docs}),
terms AS (SELECT DISTINCT query_id, unnest({TOKENS.format('query')}) AS term FROM {queries}),
st AS (SELECT query_id, count(*) AS n, avg(len(ts)) AS avgdl FROM d GROUP BY 1),
tf AS (SELECT x.query_id, x.id, x.dl, x.term, count(*) AS tf FROM (SELECT query_id, id, len(ts) AS dl, unnest(ts) AS term FROM d) x
  JOIN terms USING (query_id, term) GROUP BY 1,2,3,4),
df AS (SELECT query_id, term, count(*) AS df FROM tf GROUP BY 1,2),
sc AS (SELECT tf.query_id, tf.id, sum(ln((n - df + 0.5) / (df + 0.5) + 1.0) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) AS s
  FROM tf JOIN df USING (query_id, term) JOIN st USING (query_id) GROUP BY 1,2),
bm25 AS (SELECT d.query_id, d.id, coalesce(s, 0.0) AS bm25 FROM d LEFT JOIN sc ON d.query_id = sc.query_id AND d.id = sc.id)"""


@query(f"""WITH c AS (SELECT 0 AS query_id, doc_id AS id, text AS document FROM documents), q AS (SELECT 0 AS query_id, '{QUERY}' AS query),
{_bm25_sql('c', 'q')} SELECT id, round(bm25, 6) AS score FROM bm25 ORDER BY round(bm25, 9) DESC, id LIMIT 10""")
def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.bm25_topk(chunk_table(spark, sf_dir), QUERY, 10).select("id", F.round("score", 6).alias("score"))


def _vectors(spark, sf_dir):
    return t(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")


@query(f"""SELECT e.vec_id AS id, round(1 - {COS.format('e.embedding', 'q.embedding')}, 6) AS distance FROM embeddings e, embeddings q
WHERE q.vec_id = 7 ORDER BY round(1 - {COS.format('e.embedding', 'q.embedding')}, 9), id LIMIT 10""")
def vector_topk(spark, sf_dir):
    v = _vectors(spark, sf_dir)
    q = v.where("id = 7").select(F.lit(7).alias("query_id"), "embedding")
    out = search.vector_topk(v, q, 10)
    return out.select("id", F.abs(F.round("distance", 6)).alias("distance"))


@query(f"""SELECT query_id, rank, id, distance FROM (SELECT q.vec_id AS query_id, e.vec_id AS id, abs(round(1 - {COS.format('e.embedding', 'q.embedding')}, 6)) AS distance,
row_number() OVER (PARTITION BY q.vec_id ORDER BY 1 - {COS.format('e.embedding', 'q.embedding')}, e.vec_id) AS rank FROM embeddings e, embeddings q
WHERE q.vec_id % 50 = 0 AND e.vec_id <> q.vec_id) WHERE rank <= 5""")
def vector_topk_batch(spark, sf_dir):
    v = _vectors(spark, sf_dir)
    q = v.where("id % 50 = 0").select(F.col("id").alias("query_id"), "embedding")
    out = search.vector_topk(v, q, 6).where("id <> query_id")
    w = Window.partitionBy("query_id").orderBy("rank")
    out = out.withColumn("rank", F.row_number().over(w)).where("rank <= 5")
    return out.select("query_id", F.col("rank").cast("long").alias("rank"), "id", F.abs(F.round("distance", 6)).alias("distance"))


@query(f"""WITH top AS (SELECT e.vec_id AS id, round({COS.format('e.embedding', 'q.embedding')}, 3) AS similarity FROM embeddings e, embeddings q WHERE q.vec_id = 3
ORDER BY {COS.format('e.embedding', 'q.embedding')} DESC, e.vec_id LIMIT 5) SELECT * FROM top WHERE similarity >= 0.3""")
def near_duplicates(spark, sf_dir):
    v = _vectors(spark, sf_dir)
    probe = v.where("id = 3").first()["embedding"]
    return search.duplicates(v, probe, threshold=0.3).select("id", "similarity")


def _hybrid(spark, sf_dir, n=10):
    v = _vectors(spark, sf_dir)
    docs = chunk_table(spark, sf_dir)
    q = v.where("id % 50 = 0").join(docs.select("id"), "id", "left_semi").select(F.col("id").alias("query_id"), "embedding")
    hits = search.vector_topk(v.join(docs.select("id"), "id", "left_semi"), q, 3 * n).select("query_id", "id", "distance")
    cand = hits.join(docs.select("id", "document"), "id")
    queries = q.join(docs, F.col("query_id") == docs.id).select("query_id", F.col("document").alias("query"))
    return search.hybrid_rank(cand, queries).where(F.col("rank") <= n)


HYBRID = f"""WITH q AS (SELECT vec_id AS query_id, embedding, text AS query FROM embeddings JOIN documents ON vec_id = doc_id WHERE vec_id % 50 = 0),
hits AS (SELECT * FROM (SELECT query_id, e.vec_id AS id, greatest(0.0, 1 - {COS.format('e.embedding', 'q.embedding')}) AS distance,
  row_number() OVER (PARTITION BY query_id ORDER BY greatest(0.0, 1 - {COS.format('e.embedding', 'q.embedding')}), e.vec_id) AS r FROM embeddings e JOIN documents ON e.vec_id = doc_id, q) WHERE r <= 30),
c AS (SELECT query_id, id, distance, text AS document FROM hits JOIN documents ON id = doc_id),
{_bm25_sql('c', 'q')},
s AS (SELECT c.query_id, c.id, bm25, 0.6 * greatest(0.0, 1 - distance) + CASE WHEN max(bm25) OVER (PARTITION BY c.query_id) > 0 THEN 0.4 * bm25 / max(bm25) OVER (PARTITION BY c.query_id) ELSE 0 END AS score
  FROM c JOIN bm25 ON c.query_id = bm25.query_id AND c.id = bm25.id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS rank FROM s)
SELECT query_id, rank, id, round(bm25, 3) AS bm25, round(score, 5) AS score FROM ranked WHERE rank <= 10"""


@query(HYBRID)
def hybrid_rank(spark, sf_dir):
    return _listed(_hybrid(spark, sf_dir))


def _listed(ranked: DataFrame) -> DataFrame:
    return ranked.select("query_id", F.col("rank").cast("long").alias("rank"), "id", "bm25", F.round("score", 5).alias("score"))


CLOSET_BOOST = f"""WITH q AS (SELECT vec_id AS query_id, embedding FROM embeddings WHERE vec_id % 50 = 0),
e AS (SELECT vec_id AS id, embedding, source AS source_file FROM embeddings JOIN documents ON vec_id = doc_id),
a AS (SELECT query_id, id, source_file, greatest(0.0, 1 - {COS.format('e.embedding', 'q.embedding')}) AS distance FROM e, q),
hits AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS r FROM a WHERE id % 10 <> 0) WHERE r <= 15),
closets AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS r FROM a WHERE id % 10 = 0) WHERE r <= 10),
first AS (SELECT query_id, source_file, min(r) AS r, arg_min(distance, r) AS cd FROM closets GROUP BY 1, 2),
b AS (SELECT h.query_id, h.id, h.distance, coalesce(CASE WHEN f.r <= 5 AND cd <= 1.5 THEN [0.40,0.25,0.15,0.08,0.04][f.r] END, 0) AS boost FROM hits h LEFT JOIN first f USING (query_id, source_file))
SELECT query_id, id, round(CAST(boost AS DOUBLE), 2) AS boost, round(greatest(0.0, least(2.0, distance - CAST(boost AS DOUBLE))), 5) AS effective FROM b"""


@query(CLOSET_BOOST)
def closet_boost(spark, sf_dir):
    return _closet_boost(spark, sf_dir, "id % 50 = 0")


def _closet_boost(spark, sf_dir, asked):
    d = t(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("source_file"))
    v = _vectors(spark, sf_dir).join(d, "id")
    q = _vectors(spark, sf_dir).where(asked).select(F.col("id").alias("query_id"), "embedding")
    files = v.select("id", "source_file")
    hits = search.vector_topk(v.where("id % 10 <> 0"), q, 15).select("query_id", "id", "distance").join(files, "id")
    closets = search.vector_topk(v.where("id % 10 = 0"), q, 10).join(files, "id")
    return search.index_boost(hits, closets).select("query_id", "id", F.round("boost", 2).alias("boost"), F.round("effective", 5).alias("effective"))


@query(f"""WITH c AS (SELECT 1 AS query_id, doc_id AS id, text AS document FROM documents), q AS (SELECT 1 AS query_id, '{QUERY}' AS query), {_bm25_sql('c', 'q')},
v AS (SELECT e.vec_id AS id, greatest(0.0, 1 - {COS.format('e.embedding', 'p.embedding')}) AS distance FROM embeddings e JOIN documents ON e.vec_id = doc_id, embeddings p WHERE p.vec_id = 1 ORDER BY distance, id LIMIT 10),
k AS (SELECT id FROM bm25 ORDER BY round(bm25, 9) DESC, id LIMIT 30)
SELECT id, round(distance, 5) AS distance FROM v UNION ALL SELECT id, NULL FROM k WHERE id NOT IN (SELECT id FROM v)""")
def candidate_union(spark, sf_dir):
    c = chunk_table(spark, sf_dir)
    where = c.select("id", "source_file", F.lit(0).alias("chunk_index"))
    v = _vectors(spark, sf_dir)
    q = v.where("id = 1").select(F.lit(1).alias("query_id"), "embedding")
    hits = search.vector_topk(v.join(c.select("id"), "id", "left_semi"), q, 10).join(where, "id").select("query_id", "id", "source_file", "chunk_index", "distance")
    key = search.bm25_topk(c, QUERY, 30).join(where, "id").select(F.lit(1).alias("query_id"), "id", "source_file", "chunk_index")
    return search.union_candidates(hits, key).select("id", F.round("distance", 5).alias("distance"))


# --- catalog -----------------------------------------------------------------------------------------------------------


@query("SELECT lang AS wing, source AS room, count(*) AS n FROM documents GROUP BY GROUPING SETS ((), (lang), (source))")
def status_totals(spark, sf_dir):
    return catalog.status(chunk_table(spark, sf_dir))


@query("SELECT coalesce(lang, 'unknown') AS wing, count(*) AS n FROM documents GROUP BY 1")
def list_wings(spark, sf_dir):
    return catalog.count_by(chunk_table(spark, sf_dir), "wing")


@query("SELECT coalesce(source, 'unknown') AS room, count(*) AS n FROM documents WHERE lang = 'en' GROUP BY 1")
def list_rooms(spark, sf_dir):
    return catalog.count_by(chunk_table(spark, sf_dir).where(scope(wing="en")), "room")


@query("SELECT wing, room, count(*) AS n FROM (SELECT coalesce(lang, 'unknown') AS wing, coalesce(source, 'unknown') AS room FROM documents) GROUP BY ROLLUP (wing, room)")
def taxonomy(spark, sf_dir):
    return catalog.taxonomy(chunk_table(spark, sf_dir))


@query("SELECT doc_id AS id, lang AS wing, source AS room FROM documents ORDER BY doc_id LIMIT 50 OFFSET 100")
def list_chunks_page(spark, sf_dir):
    return catalog.page(chunk_table(spark, sf_dir).select("id", "wing", "room"), 50, 100)


@query("SELECT doc_id AS id, length(text) AS n FROM documents WHERE (lang = 'en' OR source IN ('src1','src2')) AND lang <> 'fr' AND doc_id >= 10 AND contains(text, 'the')")
def where_filter(spark, sf_dir):
    c = chunk_table(spark, sf_dir)
    w = {"$and": [{"$or": [{"wing": "en"}, {"room": {"$in": ["src1", "src2"]}}]}, {"wing": {"$ne": "fr"}}, {"id": {"$gte": 10}}]}
    return get(c, where=w, where_document={"$contains": "the"}).select("id", F.length("document").cast("long").alias("n"))


@query("SELECT source AS source_file, count(*) AS n, min(doc_id) AS first_id, max(doc_id) AS last_id FROM documents GROUP BY 1 HAVING count(*) >= 5")
def source_groups(spark, sf_dir):
    return catalog.source_groups(chunk_table(spark, sf_dir).withColumn("source_file", F.col("room")))


@query("SELECT source AS source_file, count(*) AS n, CAST(CASE WHEN count(*) > 20 THEN floor(count(*) * 0.4) ELSE 0 END AS BIGINT) AS estimate FROM documents GROUP BY 1 HAVING count(*) >= 5 ORDER BY n DESC, source_file LIMIT 15")
def dedup_stats(spark, sf_dir):
    c = chunk_table(spark, sf_dir).withColumn("source_file", F.col("room"))
    return catalog.dedup_statistics(catalog.source_groups(c)).select("source_file", "n", "estimate")


@query(r"""WITH s AS (SELECT doc_id AS id, source AS room, coalesce(CASE WHEN doc_id % 7 > 0 THEN CAST(doc_id % 7 AS DOUBLE) END, 3.0) AS importance, regexp_replace(text, '\s+', ' ', 'g') AS d FROM (SELECT * FROM documents ORDER BY doc_id LIMIT 2000)),
top AS (SELECT * FROM s ORDER BY importance DESC, id LIMIT 15), x AS (SELECT id, room, importance, CASE WHEN length(d) > 200 THEN substr(d,1,200) || '...' ELSE d END AS snippet FROM top),
r AS (SELECT id, room, importance, CAST(sum(length(snippet)) OVER (ORDER BY room, importance DESC, id) AS BIGINT) AS used FROM x) SELECT * FROM r WHERE used <= 3200""")
def wakeup_top(spark, sf_dir):
    c = chunk_table(spark, sf_dir).withColumn("importance", F.when(F.col("id") % 7 > 0, (F.col("id") % 7).cast("double")))
    return catalog.wake_up(c).select("id", "room", "importance", "used")


# --- facts -------------------------------------------------------------------------------------------------------------


@query(f"WITH {FACTS} SELECT id, subject, predicate, object FROM triples WHERE {VALID.format('1995-06-17')}")
def facts_as_of(spark, sf_dir):
    tr, _ = fact_tables(spark, sf_dir)
    return tr.where(temporal.valid_at("1995-06-17")).select("id", "subject", "predicate", "object")


@query(f"""WITH {FACTS} SELECT t.id, 'incoming' AS direction, s.name AS subject_name, predicate, 'NATION_7' AS object_name, valid_to IS NULL AS current FROM triples t JOIN ents s ON s.id = subject WHERE object = 'nation_7' AND {VALID.format('1996-01-01')}
UNION ALL SELECT t.id, 'outgoing', 'NATION_7', predicate, o.name, valid_to IS NULL FROM triples t JOIN ents o ON o.id = object WHERE subject = 'nation_7' AND {VALID.format('1996-01-01')}""")
def facts_entity_both(spark, sf_dir):
    tr, en = fact_tables(spark, sf_dir)
    return facts.query_entity(tr, en, "NATION_7", "1996-01-01", "both").select("id", "direction", "subject_name", "predicate", "object_name", "current")


@query(f"WITH {FACTS} SELECT t.id, s.name AS subject_name, o.name AS object_name, valid_to IS NULL AS current FROM triples t JOIN ents s ON s.id = subject JOIN ents o ON o.id = object WHERE predicate = 'p'")
def facts_by_predicate(spark, sf_dir):
    tr, en = fact_tables(spark, sf_dir)
    return facts.query_relationship(tr, en, "P").select("id", "subject_name", "object_name", "current")


@query(f"WITH {FACTS} SELECT t.id, s.name AS subject_name, predicate, valid_from FROM triples t JOIN ents s ON s.id = subject JOIN ents o ON o.id = object WHERE object = 'nation_3' OR subject = 'nation_3' ORDER BY valid_from NULLS LAST, t.id LIMIT 100")
def facts_timeline(spark, sf_dir):
    tr, en = fact_tables(spark, sf_dir)
    return facts.timeline(tr, en, "NATION_3").select("id", "subject_name", "predicate", "valid_from")


@query(f"WITH {FACTS} SELECT (SELECT count(*) FROM ents) AS entities, count(*) AS triples, count(*) FILTER (valid_to IS NULL) AS current, count(*) FILTER (valid_to IS NOT NULL) AS expired, string_agg(DISTINCT predicate, ',' ORDER BY predicate) AS predicates FROM triples")
def facts_stats(spark, sf_dir):
    return facts.stats(*fact_tables(spark, sf_dir))


@query(f"WITH {FACTS} SELECT id, CASE WHEN subject = 'customer#000000007' AND predicate = 'o' AND valid_to IS NULL THEN '2030-01-01' ELSE valid_to END AS valid_to FROM triples")
def facts_invalidate(spark, sf_dir):
    tr, _ = fact_tables(spark, sf_dir)
    return facts.invalidate(tr, "Customer#000000007", "o", "2030-01-01").select("id", "valid_to")


@query(f"""WITH {FACTS}, fresh AS (SELECT * FROM triples n WHERE id % 2 = 1 AND NOT EXISTS (SELECT 1 FROM triples o WHERE o.id % 2 = 0 AND o.valid_to IS NULL AND o.subject = n.subject AND o.predicate = n.predicate AND o.object = n.object))
SELECT id FROM (SELECT id, coalesce(bool_or(valid_to IS NULL) OVER (PARTITION BY subject, predicate, object ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) AS before FROM fresh) WHERE NOT before""")
def facts_add(spark, sf_dir):
    tr, _ = fact_tables(spark, sf_dir)
    return facts.add(tr.where("id % 2 = 0"), tr.where("id % 2 = 1").withColumn("ordinal", F.col("id"))).select("id")


CONTRADICTIONS = f"""WITH {FACTS}, claims AS (SELECT DISTINCT subject, 'f' AS predicate, object FROM triples), m AS (SELECT c.*, t.predicate AS known, valid_to FROM claims c JOIN triples t USING (subject, object))
SELECT DISTINCT 'relationship_mismatch' AS kind, subject, predicate, object, known FROM m WHERE known <> predicate AND valid_to IS NULL
UNION ALL SELECT DISTINCT 'stale_fact', subject, predicate, object, known FROM m WHERE known = predicate AND valid_to < '1997-01-01'"""


@query(CONTRADICTIONS)
def contradictions(spark, sf_dir):
    return _contradictions(spark, sf_dir, "true")


def _contradictions(spark, sf_dir, claimed):
    tr, _ = fact_tables(spark, sf_dir)
    claims = tr.where(claimed).select("subject", F.lit("f").alias("predicate"), "object").distinct()
    return facts.contradictions(claims, tr, "1997-01-01")


@query(f"""WITH w AS (SELECT DISTINCT word FROM (SELECT unnest(string_split(lower(r_name || ' ' || n_name), ' ')) AS word FROM nation JOIN region ON n_regionkey = r_regionkey)),
a AS (SELECT word FROM w WHERE length(word) % 2 = 0), b AS (SELECT word FROM w WHERE length(word) % 2 = 1)
SELECT a.word AS a, b.word AS b, CAST(levenshtein(a.word, b.word) AS INTEGER) AS distance FROM a, b WHERE levenshtein(a.word, b.word) BETWEEN 1 AND 2""")
def name_confusion(spark, sf_dir):
    n, r = t(spark, sf_dir, "nation"), t(spark, sf_dir, "region")
    w = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.explode(F.split(F.lower(F.concat_ws(" ", "r_name", "n_name")), " ")).alias("name")).distinct()
    return facts.name_confusion(w.where(F.length("name") % 2 == 0), w)


# --- graph -------------------------------------------------------------------------------------------------------------

ROWS = """r AS (SELECT event_type || '_' || CAST(user_id % 40 AS VARCHAR) AS room, 'wing_' || CAST(user_id % 7 AS VARCHAR) AS wing,
  CASE WHEN event_id % 3 = 0 THEN 'hall_' || CAST(event_id % 2 AS VARCHAR) ELSE '' END AS hall, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date FROM events)"""
NODES = f"""{ROWS}, node AS (SELECT room, list_sort(list(DISTINCT wing)) AS wings, list_sort(coalesce(list(DISTINCT hall) FILTER (hall <> ''), [])) AS halls, count(*) AS n, list_sort(list(DISTINCT date)) AS dates FROM r GROUP BY room)"""


def _nodes(spark, sf_dir):
    e = t(spark, sf_dir, "events")
    room = F.concat_ws("_", "event_type", (F.col("user_id") % 40).cast("string"))
    hall = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("hall_"), (F.col("event_id") % 2).cast("string"))).otherwise("")
    rows = e.select(room.alias("room"), F.concat(F.lit("wing_"), (F.col("user_id") % 7).cast("string")).alias("wing"), hall.alias("hall"), F.date_format("ts", "yyyy-MM-dd").alias("date"))
    return graph.nodes(rows)


@query(f"WITH {NODES} SELECT room, array_to_string(wings, ',') AS wings, array_to_string(halls, ',') AS halls, n, array_to_string(list_slice(dates, greatest(1, len(dates) - 4), len(dates)), ',') AS dates FROM node")
def graph_nodes(spark, sf_dir):
    return _nodes(spark, sf_dir).select("room", F.array_join("wings", ",").alias("wings"), F.array_join("halls", ",").alias("halls"), "n", F.array_join("dates", ",").alias("dates"))


@query(f"WITH {NODES}, a AS (SELECT room, n, unnest(wings) AS wing_a FROM node), b AS (SELECT room, unnest(wings) AS wing_b FROM node), h AS (SELECT room, unnest(halls) AS hall FROM node) SELECT room, wing_a, wing_b, hall, n FROM a JOIN b USING (room) JOIN h USING (room) WHERE wing_a < wing_b")
def graph_edges(spark, sf_dir):
    return graph.edges(_nodes(spark, sf_dir))


@query(f"WITH {NODES} SELECT room, n FROM node WHERE len(wings) >= 2 AND list_contains(wings, 'wing_1') ORDER BY n DESC, room LIMIT 50")
def tunnels(spark, sf_dir):
    return graph.tunnels(_nodes(spark, sf_dir), "wing 1").select("room", "n")


@query(f"WITH {NODES} SELECT count(*) AS rooms, count(*) FILTER (len(wings) >= 2) AS tunnel_rooms, CAST(sum(len(wings) * (len(wings) - 1) // 2 * len(halls)) AS BIGINT) AS edges FROM node")
def graph_stats(spark, sf_dir):
    return graph.stats(_nodes(spark, sf_dir))


@query(f"""WITH {NODES}, p AS (SELECT room, unnest(wings) AS wing FROM node), h0 AS (SELECT room FROM node WHERE room = 'click_3'),
m1 AS (SELECT b.room, a.room AS parent, a.wing FROM h0 JOIN p a USING (room) JOIN p b ON a.wing = b.wing WHERE b.room NOT IN (SELECT room FROM h0)),
h1 AS (SELECT room, array_to_string(list_sort(list(DISTINCT wing)), ',') AS via FROM (SELECT *, min(parent) OVER (PARTITION BY room) AS best FROM m1) WHERE parent = best GROUP BY room),
m2 AS (SELECT b.room, a.room AS parent, a.wing FROM h1 JOIN p a USING (room) JOIN p b ON a.wing = b.wing WHERE b.room NOT IN (SELECT room FROM h0) AND b.room NOT IN (SELECT room FROM h1)),
h2 AS (SELECT room, array_to_string(list_sort(list(DISTINCT wing)), ',') AS via FROM (SELECT *, min(parent) OVER (PARTITION BY room) AS best FROM m2) WHERE parent = best GROUP BY room),
u AS (SELECT room, 0 AS hop, '' AS via FROM h0 UNION ALL SELECT room, 1, via FROM h1 UNION ALL SELECT room, 2, via FROM h2)
SELECT room, hop, via, n FROM u JOIN node USING (room) ORDER BY hop, n DESC, room LIMIT 50""")
def traverse_hops(spark, sf_dir):
    return graph.traverse(_nodes(spark, sf_dir), "click_3")


TOPIC_TUNNELS = """WITH tt AS (SELECT DISTINCT lang AS wing, lower(trim(source)) AS key, trim(source) AS topic FROM documents), m AS (SELECT a.wing AS wing_a, b.wing AS wing_b, 'topic:' || a.topic AS room FROM tt a JOIN tt b USING (key) WHERE a.wing < b.wing)
SELECT wing_a, wing_b, room, count(*) OVER (PARTITION BY wing_a, wing_b) AS shared FROM m"""


@query(TOPIC_TUNNELS)
def topic_tunnels(spark, sf_dir):
    return _topic_tunnels(t(spark, sf_dir, "documents"))


def _topic_tunnels(docs):
    d = docs.select(F.col("lang").alias("wing"), F.col("source").alias("topic")).distinct()
    return graph.topic_tunnels(d)


@query(f"WITH {NODES} SELECT room, CAST(CASE WHEN contains(lower(room), 'purchase-3') THEN 1.0 WHEN contains(lower(room), 'purchase') OR contains(lower(room), '3') THEN 0.5 END AS DOUBLE) AS score FROM node WHERE contains(lower(room), 'purchase') OR contains(lower(room), '3') ORDER BY score DESC, room LIMIT 5")
def fuzzy_rooms(spark, sf_dir):
    return graph.suggest(_nodes(spark, sf_dir), "purchase-3")


# --- chunks and routes -------------------------------------------------------------------------------------------------


@query(r"""WITH RECURSIVE s AS (SELECT doc_id AS id, regexp_replace(text, '^\s+|\s+$', '', 'g') AS b FROM documents),
c AS (SELECT id, b, 0 AS a, 0 AS z, 0 AS k FROM s UNION ALL
  SELECT id, b, a2, CASE WHEN a2 + 800 >= length(b) THEN length(b)
    WHEN strpos(reverse(substr(b, a2 + 1, 800)), chr(10) || chr(10)) > 0 AND 799 - strpos(reverse(substr(b, a2 + 1, 800)), chr(10) || chr(10)) > 400 THEN a2 + 799 - strpos(reverse(substr(b, a2 + 1, 800)), chr(10) || chr(10))
    WHEN strpos(reverse(substr(b, a2 + 1, 800)), chr(10)) > 0 AND 800 - strpos(reverse(substr(b, a2 + 1, 800)), chr(10)) > 400 THEN a2 + 800 - strpos(reverse(substr(b, a2 + 1, 800)), chr(10)) ELSE a2 + 800 END, k + 1
  FROM (SELECT id, b, k, CASE WHEN k = 0 THEN 0 ELSE z - 100 END AS a2, z FROM c) WHERE length(b) > 0 AND (k = 0 OR z < length(b)))
SELECT id, count(*) AS n, CAST(sum(length(p)) AS BIGINT) AS chars FROM (SELECT id, regexp_replace(substr(b, a + 1, z - a), '^\s+|\s+$', '', 'g') AS p FROM c WHERE k > 0) WHERE length(p) >= 50 GROUP BY id""")
def chunk_overlap(spark, sf_dir):
    c = chunks.chunk_overlap(chunk_table(spark, sf_dir), most=None)
    return c.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("document")).cast("long").alias("chars"))


@query("SELECT doc_id AS id, CAST(i AS INTEGER) AS chunk_index, md5(substr(text, CAST(i * 800 + 1 AS BIGINT), 800)) AS digest FROM documents, generate_series(0, CAST(ceil(length(text) / 800.0) AS BIGINT) - 1) g(i) WHERE length(trim(text)) > 30")
def bounded_chunks(spark, sf_dir):
    return chunks.bounded(chunk_table(spark, sf_dir)).select("id", "chunk_index", F.md5("document").alias("digest"))


@query("""SELECT conv_id AS source_file, turn AS chunk_index, md5(string_agg(text, chr(10) || chr(10)) OVER w) AS digest, count(*) OVER (PARTITION BY conv_id) AS total FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING)""")
def neighbor_expand(spark, sf_dir):
    c = t(spark, sf_dir, "conversations").select(F.col("conv_id").alias("source_file"), F.col("turn").alias("chunk_index"), F.col("text").alias("document"))
    return search.neighbours(c).select("source_file", "chunk_index", F.md5("expanded").alias("digest"), "total")


@query("""WITH x AS (SELECT *, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS ex FROM conversations),
g AS (SELECT conv_id, ex, arg_min(text, turn) AS u, string_agg(text, ' ' ORDER BY turn) FILTER (role <> 'user') AS r FROM x WHERE ex > 0 GROUP BY 1, 2), d AS (SELECT conv_id, CAST(ex AS BIGINT) AS exchange, CASE WHEN r IS NULL THEN '> ' || u ELSE '> ' || u || chr(10) || r END AS document FROM g),
k AS (SELECT conv_id, exchange, document, unnest(generate_series(0, CAST(ceil(length(document) / 800.0) AS BIGINT) - 1)) AS i FROM d WHERE length(trim(document)) > 30)
SELECT conv_id, exchange, CAST(i AS INTEGER) AS slice, length(substr(document, i * 800 + 1, 800)) AS chars, md5(substr(document, i * 800 + 1, 800)) AS digest FROM k""")
def exchange_chunks(spark, sf_dir):
    e = chunks.exchanges(t(spark, sf_dir, "conversations"))
    return e.select("conv_id", "exchange", "slice", F.length("document").cast("long").alias("chars"), F.md5("document").alias("digest"))


LISTS = {"first": ["tion", "ment"], "second": ["und", "ich"], "third": ["heon", "ered", "than"]}


def _label_sql(col: str) -> str:
    s = {k: " + ".join(f"CAST(contains({col}, '{w}') AS INTEGER)" for w in ws) for k, ws in LISTS.items()}
    return f"CASE WHEN ({s['first']}) > 0 AND ({s['first']}) >= ({s['second']}) AND ({s['first']}) >= ({s['third']}) THEN 'first' WHEN ({s['second']}) > 0 AND ({s['second']}) >= ({s['third']}) THEN 'second' WHEN ({s['third']}) > 0 THEN 'third' ELSE 'general' END"


@query(f"SELECT doc_id AS id, {_label_sql('lower(substr(text, 1, 3000))')} AS hall FROM documents")
def hall_route(spark, sf_dir):
    c = chunk_table(spark, sf_dir)
    return c.select("id", text.best_label(F.lower(F.substring("document", 1, 3000)), LISTS, "general").alias("hall"))


# --- entities, lines, claims -------------------------------------------------------------------------------------------


@query(r"SELECT name, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS name FROM documents) WHERE regexp_full_match(name, '\p{Lu}\p{Ll}{2,}') GROUP BY 1 HAVING count(*) >= 3")
def entity_candidates(spark, sf_dir):
    return entities.candidates(chunk_table(spark, sf_dir))


_STOP = ", ".join(f"'{w}'" for w in entities.NO_NAMES)


@query(rf"""WITH w AS (SELECT doc_id AS id, regexp_extract_all(substr(text, 1, 5000), '[\p{{L}}\p{{N}}_]+') AS ws FROM documents), u AS (SELECT id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM w),
k AS (SELECT id, w, count(*) AS c, min(i) AS first FROM u WHERE regexp_full_match(w, '\p{{Lu}}\p{{Ll}}{{2,}}') AND w NOT IN ({_STOP}) GROUP BY 1, 2 HAVING count(*) >= 2),
n AS (SELECT id, string_agg(w, ';' ORDER BY c DESC, first) AS names FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY c DESC, first) AS r FROM k) WHERE r <= 5 GROUP BY id),
q AS (SELECT doc_id, list_concat(regexp_extract_all(substr(text, 1, 5000), '(?i)((?:{'|'.join(entities.ACTIONS)})\s+[\p{{L}}\p{{N}}_\s]{{3,40}})', 1), regexp_extract_all(substr(text, 1, 5000), '(?m)^#{{1,3}}\s+(.{{5,60}})$', 1)) AS tops,
  regexp_extract_all(substr(text, 1, 5000), '"([^"]{{15,150}})"', 1) AS qs FROM documents),
x AS (SELECT doc_id, list_transform(tops, lambda x: lower(regexp_replace(x, '^\s+|\s+$', '', 'g'))) AS tops, qs FROM q),
y AS (SELECT doc_id, list_slice(list_filter(tops, lambda x, i: list_position(tops, x) = i), 1, 12) AS tops, list_transform(list_slice(qs, 1, 3), lambda x: '"' || x || '"') AS qs FROM x),
l AS (SELECT doc_id, CASE WHEN len(tops) + len(qs) > 0 THEN list_concat(tops, qs) ELSE [lang || '/' || source || '/' || CAST(doc_id AS VARCHAR)] END AS ts FROM y JOIN documents USING (doc_id))
SELECT doc_id AS id, topic || '|' || coalesce(names, '') || '|→' || CAST(doc_id AS VARCHAR) AS line FROM (SELECT doc_id, unnest(ts) AS topic FROM l) LEFT JOIN n ON n.id = doc_id""")
def closet_lines(spark, sf_dir):
    lines = entities.index_lines(chunk_table(spark, sf_dir))
    return lines.select("id", "line")


@query(r"""SELECT doc_id AS id, array_to_string([CAST(doc_id AS VARCHAR), CAST(doc_id + 1 AS VARCHAR), 'x_' || CAST(doc_id % 3 AS VARCHAR)], ',') AS ids FROM documents""")
def pointer_parse(spark, sf_dir):
    i = F.col("doc_id").cast("string")
    line = F.concat(F.lit("a|b|→"), i, F.lit(","), (F.col("doc_id") + 1).cast("string"), F.lit("\nc||→"), i, F.lit(",x_"), (F.col("doc_id") % 3).cast("string"))
    return t(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.array_join(entities.pointers(line), ",").alias("ids"))


@query("SELECT c_custkey AS id, 'a' || CAST(c_custkey AS VARCHAR) AS subject, CASE WHEN c_custkey % 2 = 0 THEN 'brother' ELSE 'boss' END AS predicate, 'b' || CAST(c_nationkey AS VARCHAR) AS object FROM customer")
def claims(spark, sf_dir):
    c = t(spark, sf_dir, "customer")
    a, b = F.concat(F.lit("a"), F.col("c_custkey").cast("string")), F.concat(F.lit("b"), F.col("c_nationkey").cast("string"))
    said = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("Well, "), a, F.lit(" is "), b, F.lit("'s brother."))).otherwise(F.concat(b, F.lit("'s Boss is "), a, F.lit("!")))
    return entities.claims(c.select(F.col("c_custkey").alias("id"), said.alias("document")), ("brother", "boss"))


@query(r"""WITH w AS (SELECT doc_id AS id, len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS n, regexp_extract_all(text, '[a-zA-Z][a-zA-Z_-]{2,}') AS ws FROM documents),
u AS (SELECT id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM w), k AS (SELECT id, lower(w) AS w, min(i) AS first, sum(1 + CASE WHEN regexp_matches(w, '^[A-Z]') THEN 2 ELSE 0 END + CASE WHEN regexp_matches(w, '[_-]') OR regexp_matches(substr(w, 2), '[A-Z]') THEN 2 ELSE 0 END) AS c FROM u WHERE lower(w) NOT IN ('the', 'and', 'der', 'que') GROUP BY 1, 2),
r AS (SELECT id, string_agg(w, '_' ORDER BY c DESC, first) AS topics FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY c DESC, first) AS rn FROM k) WHERE rn <= 3 GROUP BY id)
SELECT w.id, n AS words, greatest(1, CAST(floor(n * 1.3) AS BIGINT)) AS tokens, coalesce(topics, '') AS topics FROM w LEFT JOIN r USING (id)""")
def dialect_stats(spark, sf_dir):
    return entities.compression(chunk_table(spark, sf_dir), ("the", "and", "der", "que"))


# --- ingest ------------------------------------------------------------------------------------------------------------


@query("SELECT source || '/' || CAST(doc_id AS VARCHAR) AS source_file FROM documents WHERE NOT (doc_id % 4 = 0 AND doc_id % 3 <> 0)")
def already_mined_skip(spark, sf_dir):
    c = chunk_table(spark, sf_dir)
    files = c.select("source_file", F.lit(None).cast("string").alias("extract_mode"), F.col("id").cast("double").alias("mtime"))
    store = c.where("id % 4 = 0").select("source_file", F.lit("exchange").alias("extract_mode"), F.col("id").cast("double").alias("source_mtime"), F.when(F.col("id") % 3 == 0, 2).otherwise(3).alias("normalize_version"))
    return mutate.not_yet_current(files, store).select("source_file")


@query("SELECT id, arg_max(text, turn) AS text FROM (SELECT conv_id * 10 + turn % 5 AS id, turn, text FROM conversations) GROUP BY id")
def upsert_last_wins(spark, sf_dir):
    c = t(spark, sf_dir, "conversations").select((F.col("conv_id") * 10 + F.col("turn") % 5).alias("id"), "turn", "text")
    old = c.where("turn < 3").select("id", "text")
    return mutate.upsert(old, c.where("turn >= 3"), "id", "turn").select("id", "text").unionByName(old.limit(0))


@query("""SELECT source AS source_file, CASE WHEN source IN ('src0','src1','src2') THEN NULL ELSE source END AS root, CASE WHEN source IN ('src0','src1','src2') THEN 'out_of_scope' WHEN source IN ('src3','src4') THEN 'missing' WHEN source = 'src5' THEN 'gitignored' ELSE 'kept' END AS bucket FROM (SELECT DISTINCT source FROM documents)""")
def sync_buckets(spark, sf_dir):
    s = t(spark, sf_dir, "documents").select(F.col("source").alias("source_file")).distinct()
    roots = s.where(~F.col("source_file").isin("src0", "src1", "src2")).select(F.col("source_file").alias("root"))
    return mutate.sync_buckets(s, roots, s.where(~F.col("source_file").isin("src3", "src4")), s.where("source_file = 'src5'"))


@query("""WITH st AS (SELECT * FROM conversations WHERE turn % 2 = 0 AND turn < 4), cur AS (SELECT conv_id, max(turn) AS c FROM st GROUP BY 1)
SELECT verdict, count(*) AS n FROM (SELECT CASE WHEN m.turn < c THEN 'skipped' WHEN s.turn IS NOT NULL THEN 'present' ELSE 'added' END AS verdict FROM conversations m LEFT JOIN cur USING (conv_id) LEFT JOIN st s ON m.conv_id = s.conv_id AND m.turn = s.turn) GROUP BY 1""")
def sweep_report(spark, sf_dir):
    c = t(spark, sf_dir, "conversations")
    m = c.select(F.col("conv_id").alias("session_id"), F.col("turn").alias("message_uuid"), F.lpad(F.col("turn").cast("string"), 6, "0").alias("timestamp"))
    return mutate.sweep_split(m, m.where("message_uuid % 2 = 0 and message_uuid < 4")).groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT conv_id AS session_id, max(turn) AS cursor FROM conversations WHERE role IN ('user','assistant') GROUP BY 1")
def session_cursor(spark, sf_dir):
    c = t(spark, sf_dir, "conversations").where(F.col("role").isin("user", "assistant"))
    return mutate.cursors(c.select(F.col("conv_id").alias("session_id"), F.col("turn").alias("timestamp")))


@query()
def greedy_dedup(spark, sf_dir):
    c = chunk_table(spark, sf_dir).withColumn("source_file", F.col("room"))
    return neardup.greedy_dedup(c.join(_vectors(spark, sf_dir), "id"), threshold=0.6)


# --- evaluation --------------------------------------------------------------------------------------------------------

TOP = f"""top AS (SELECT * FROM (SELECT q.vec_id AS query_id, e.vec_id AS id, CAST(e.label = q.label AS DOUBLE) AS rel, row_number() OVER (PARTITION BY q.vec_id ORDER BY 1 - {COS.format('e.embedding', 'q.embedding')}, e.vec_id) AS rank FROM embeddings e, embeddings q WHERE q.vec_id % 50 = 0) WHERE rank <= 10)"""


def _ranked(spark, sf_dir):
    e = t(spark, sf_dir, "embeddings")
    q = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("label").alias("q_label"))
    r = search.vector_topk(_vectors(spark, sf_dir), e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding"), 10)
    return r.join(e.select(F.col("vec_id").alias("id"), "label"), "id").join(q, "query_id").select("query_id", "id", "rank", (F.col("label") == F.col("q_label")).cast("double").alias("rel"))


RECALL = f"""WITH {TOP}, rel AS (SELECT q.vec_id AS query_id, e.vec_id AS id FROM embeddings q JOIN embeddings e ON e.label = q.label WHERE q.vec_id % 50 = 0),
h AS (SELECT rel.query_id, CASE WHEN top.id IS NULL THEN 0 ELSE 1 END AS hit FROM rel LEFT JOIN top ON top.query_id = rel.query_id AND top.id = rel.id) SELECT query_id, max(hit) > 0 AS any_hit, min(hit) > 0 AS all_hit, round(avg(hit), 6) AS share FROM h GROUP BY 1"""


@query(RECALL)
def recall_at_k(spark, sf_dir):
    return _recall_at_k(spark, sf_dir, "true")


def _recall_at_k(spark, sf_dir, counted):
    e = t(spark, sf_dir, "embeddings").select("vec_id", "label")
    q = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "label")
    relevant = q.join(e.where(counted).withColumnRenamed("vec_id", "id"), "label").select("query_id", "id")
    return evaluate.recall_at_k(_ranked(spark, sf_dir), relevant, 10).withColumn("share", F.round("share", 6))


@query(f"""WITH {TOP}, i AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rel DESC, rank) AS ideal FROM top) SELECT query_id, round(coalesce(sum(rel / log2(rank + 1.0)) / nullif(sum(rel / log2(ideal + 1.0)), 0), 0), 6) AS ndcg FROM i GROUP BY 1""")
def ndcg_at_k(spark, sf_dir):
    return evaluate.ndcg_at_k(_ranked(spark, sf_dir), 10).withColumn("ndcg", F.round("ndcg", 6))


def _answer_sql(c: str) -> str:
    """Articles are words of their own among letters, digits and underscores."""
    parts = rf"list_transform(regexp_extract_all(replace({c}, ',', ''), '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_]'), lambda x: CASE WHEN x IN ('a','an','the','and') THEN ' ' ELSE x END)"
    return rf"list_filter(regexp_split_to_array(lower(regexp_replace(array_to_string({parts}, ''), '[!-/:-@\[-`{{-~]', '', 'g')), '\s+'), lambda x: x <> '')"


@query(rf"""WITH b AS (SELECT item_id AS pair_id, text AS t, CASE item_id % 5 WHEN 0 THEN '' ELSE substr(text, 1, 60) || ' the and of, the A' END AS p FROM benchmark UNION ALL SELECT -1, 'cats and dogs', 'cats dogs' UNION ALL SELECT -2, '', 'the' UNION ALL SELECT -3, 'The end.', 'the end'),
p AS (SELECT pair_id, {_answer_sql('t')} AS t, {_answer_sql('p')} AS p FROM b),
a AS (SELECT pair_id, w, count(*) AS c FROM (SELECT pair_id, unnest(p) AS w FROM p) GROUP BY 1, 2), d AS (SELECT pair_id, w, count(*) AS c FROM (SELECT pair_id, unnest(t) AS w FROM p) GROUP BY 1, 2),
m AS (SELECT a.pair_id, sum(least(a.c, d.c)) AS c FROM a JOIN d USING (pair_id, w) GROUP BY 1) SELECT p.pair_id, round(CAST(CASE WHEN len(p) + len(t) = 0 THEN 1 ELSE coalesce(2 * c / (len(p) + len(t)), 0) END AS DOUBLE), 6) AS f1 FROM p LEFT JOIN m USING (pair_id)""")
def token_f1(spark, sf_dir):
    b = t(spark, sf_dir, "benchmark")
    said = F.when(F.col("item_id") % 5 == 0, "").otherwise(F.concat(F.substring("text", 1, 60), F.lit(" the and of, the A")))
    given = spark.createDataFrame([(-1, "cats dogs", "cats and dogs"), (-2, "the", ""), (-3, "the end", "The end.")], "pair_id long, prediction string, truth string")
    pairs = b.select(F.col("item_id").cast("long").alias("pair_id"), said.alias("prediction"), F.col("text").alias("truth")).unionByName(given)
    return evaluate.token_f1(pairs).withColumn("f1", F.round("f1", 6))


@query(f"""SELECT e.vec_id AS id, round((1 - {COS.format('e.embedding', 'q.embedding')}) * (1 - 0.30 * (CAST(contains(lower(text), 'heon') AS INTEGER) + CAST(contains(lower(text), 'ered') AS INTEGER) + CAST(contains(lower(text), 'und') AS INTEGER)) / 3.0), 5) AS distance
FROM embeddings e JOIN documents ON e.vec_id = doc_id, embeddings q WHERE q.vec_id = 0 AND e.vec_id <> 0""")
def keyword_overlap_rerank(spark, sf_dir):
    c, v = chunk_table(spark, sf_dir), _vectors(spark, sf_dir)
    probe = F.array(*[F.lit(float(x)) for x in v.where("id = 0").first()["embedding"]])
    d = v.where("id <> 0").join(c, "id").select("id", "document", search.cosine_distance(F.col("embedding"), probe).alias("distance"))
    return d.select("id", F.round(evaluate.boosted(F.col("distance"), [(evaluate.overlap(F.col("document"), ["heon", "ered", "und"]), 0.30)]), 5).alias("distance"))


@query("""WITH x AS (SELECT event_id AS id, abs(date_diff('day', CAST(ts AS DATE), DATE '2024-01-16')) AS d, event_id % 4 AS k FROM events), y AS (SELECT id, d, CASE k WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 5 END AS tol FROM x)
SELECT id, round(CAST(coalesce(CASE WHEN d <= tol THEN 0.40 WHEN d <= tol * 3 THEN 0.40 * (1.0 - (d - tol) / (tol * 2.0)) ELSE 0.0 END, 0.0) AS DOUBLE), 6) AS boost FROM y""")
def temporal_boost(spark, sf_dir):
    phrase = F.element_at(F.array(F.lit("what was it 10 days ago?"), F.lit("and a week ago"), F.lit("2 weeks ago, or last week"), F.lit("no time")), (F.col("event_id") % 4 + 1).cast("int"))
    e = t(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.abs(F.datediff(F.lit("2024-01-16"), F.to_date("ts"))).alias("d"), temporal.relative_days(phrase).alias("r"))
    return e.select("id", F.round(F.coalesce(temporal.temporal_boost(F.col("d"), F.col("r.tolerance")), F.lit(0.0)), 6).alias("boost"))


# --- streams -----------------------------------------------------------------------------------------------------------


@query("SELECT time_bucket(INTERVAL 1 DAY, CAST(ts AS TIMESTAMP)) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def window_counts(spark, sf_dir):
    e = t(spark, sf_dir, "events")
    g = e.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("w.start").alias("start"), "event_type", "n")


@query("""WITH o AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts > lag(ts) OVER w + INTERVAL 12 HOUR OR ts = lag(ts) OVER w + INTERVAL 12 HOUR THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM o) SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k""")
def session_windows(spark, sf_dir):
    from ..streaming.sweep import sessions

    return sessions(t(spark, sf_dir, "events"), "12 hours")


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hybrid_rank(spark, sf_dir)
