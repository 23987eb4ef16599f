"""Queries of retrieval quality and of the benchmark variants' distances, with DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate, search
from .registry import COS, TOP, _bm25_sql, _ranked, _vectors, chunk_table, query, t

STOP = ("the", "what", "who", "was")


@query(f"""WITH {TOP}, e AS (SELECT vec_id AS query_id, CASE WHEN vec_id % 100 = 0 THEN [] ELSE [vec_id, vec_id + 1, vec_id + 1, -5] END AS ids FROM embeddings WHERE vec_id % 50 = 0)
SELECT query_id, CASE WHEN len(ids) = 0 THEN 1.0 ELSE round((SELECT count(*) FROM top WHERE top.query_id = e.query_id AND list_contains(ids, top.id)) / len(list_distinct(ids)), 6) END AS recall FROM e""")
def fractional_recall(spark, sf_dir):
    i = F.col("vec_id")
    e = t(spark, sf_dir, "embeddings").where("vec_id % 50 = 0")
    e = e.select(i.alias("query_id"), F.when(i % 100 > 0, F.array(i, i + 1, i + 1, F.lit(-5).cast("long"))).alias("ids"))
    return evaluate.fractional_recall(_ranked(spark, sf_dir), e, 10).withColumn("recall", F.round("recall", 6))


@query("""SELECT doc_id AS query_id, CASE doc_id % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 0.5 WHEN 2 THEN 1.0 ELSE 0.0 END AS recall FROM documents""")
def evidence_recall(spark, sf_dir):
    k = F.col("doc_id") % 4
    words = lambda *x: F.array(*[F.lit(w) for w in x])
    evidence = F.when(k == 1, words("The cat sat", "no such thing")).when(k == 2, words(" A LONGER TEXT about cats ", "dog")).when(k == 3, words("zebra"))
    return evaluate.evidence_recall(t(spark, sf_dir, "documents").select(F.col("doc_id").alias("query_id"), evidence.alias("evidence"), words("well, the cat sat here", "longer text", "the dog ran").alias("retrieved")))


@query(f"""WITH {TOP}, g AS (SELECT q.vec_id AS query_id, CAST(q.label AS VARCHAR) AS category, unnest([q.vec_id, q.vec_id + 7]) AS id FROM embeddings q WHERE q.vec_id % 50 = 0),
h AS (SELECT category, g.query_id, max(CASE WHEN top.id IS NULL OR rank > 5 THEN 0 ELSE 1 END) AS hit FROM (SELECT category, query_id, id + CASE WHEN query_id % 100 = 0 THEN 0 ELSE 1 END AS id FROM g) g LEFT JOIN top ON top.query_id = g.query_id AND top.id = g.id GROUP BY 1, 2)
SELECT category, count(*) AS queries, sum(hit) AS hits, round(avg(hit), 6) AS rate FROM h GROUP BY 1""")
def hit_at_k(spark, sf_dir):
    q = F.col("vec_id")
    shift = F.when(q % 100 == 0, 0).otherwise(1)
    g = t(spark, sf_dir, "embeddings").where("vec_id % 50 = 0").select(q.alias("query_id"), F.col("label").cast("string").alias("category"), F.explode(F.array(q + shift, q + 7 + shift)).alias("id"))
    return evaluate.hit_at_k(_ranked(spark, sf_dir), g, 5).withColumn("rate", F.round("rate", 6))


_NEAR = f"""n AS (SELECT e.vec_id AS id, text, lang, source, greatest(0.0, least(2.0, 1 - {COS.format('e.embedding', 'q.embedding')})) AS distance FROM embeddings e JOIN documents ON e.vec_id = doc_id, embeddings q WHERE q.vec_id = 0)"""


def _near(spark, sf_dir):
    v = _vectors(spark, sf_dir)
    probe = F.array(*[F.lit(float(x)) for x in v.where("id = 0").first()["embedding"]])
    return v.join(chunk_table(spark, sf_dir), "id").select("id", "document", "wing", "room", search.cosine_distance(F.col("embedding"), probe).alias("distance"))


def _share(*words: str) -> str:
    return "(" + " + ".join(f"CAST(contains(lower(text), '{w}') AS INTEGER)" for w in words) + f") / {len(words)}.0"


ASKED = "What was Heon that said 'the tion and' or \"de la\" with ment"


@query(f"""WITH {_NEAR} SELECT id, round(distance * (1 - 0.5 * {_share('that', 'said', 'tion', 'and', 'with', 'ment')}) * (1 - 0.6 * {_share('the tion and', 'de la')}) * (1 - 0.2 * {_share('heon')}), 5) AS distance FROM n""")
def predicate_distance(spark, sf_dir):
    names = F.array(F.lit("Heon"))
    d = evaluate.hybrid_distance(F.col("distance"), F.lit(ASKED), F.col("document"), names, STOP)
    return _near(spark, sf_dir).select("id", F.round(d, 5).alias("distance"))


@query(f"""WITH {_NEAR} SELECT id, round(distance * (1 - 0.30 * {_share('that', 'heon')}) * (1 - 0.6 * {_share('the tion and', 'de la')}) * (1 - 0.4 * {_share('heon')}), 5) AS distance FROM n""")
def quoted_and_named_distance(spark, sf_dir):
    doc = F.col("document")
    signals = [(evaluate.overlap(doc, ["that", "heon"]), 0.30), (evaluate.share_found(evaluate.quoted(F.lit(ASKED)), doc), 0.60), (evaluate.share_found(F.array(F.lit("Heon")), doc), 0.40)]
    return _near(spark, sf_dir).select("id", F.round(evaluate.boosted(F.col("distance"), signals), 5).alias("distance"))


@query(f"WITH {_NEAR} SELECT id, round(distance * CASE WHEN source = 'src1' THEN 0.8 ELSE 1 END, 5) AS distance FROM n")
def room_distance(spark, sf_dir):
    return _near(spark, sf_dir).select("id", F.round(evaluate.scope_distance(F.col("distance"), F.col("room") == "src1"), 5).alias("distance"))


@query(f"WITH {_NEAR} SELECT id, round(distance * CASE WHEN lang = 'en' THEN 0.75 WHEN lang IN ('de', 'fr') THEN 0.90 ELSE 1 END * CASE WHEN id % 3 = 0 THEN 0.85 ELSE 1 END, 5) AS distance FROM n")
def navigated_distance(spark, sf_dir):
    d = evaluate.navigated_distance(F.col("distance"), F.col("wing"), F.lit("en"), F.array(F.lit("de"), F.lit("fr")), F.col("id") % 3 == 0)
    return _near(spark, sf_dir).select("id", F.round(d, 5).alias("distance"))


@query(f"WITH {_NEAR} SELECT id, round(distance * CASE WHEN id % 2 = 0 THEN 0.80 ELSE 1 END, 5) AS distance FROM n")
def layer_distance(spark, sf_dir):
    return _near(spark, sf_dir).select("id", F.round(evaluate.scope_distance(F.col("distance"), F.col("id") % 2 == 0, 0.80), 5).alias("distance"))


@query(r"""WITH s AS (SELECT DISTINCT source AS room, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{3,}')) AS w FROM documents), q AS (SELECT item_id AS query_id, list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{3,}')) AS ws FROM benchmark),
u AS (SELECT query_id, unnest(CASE WHEN query_id % 10 = 0 THEN ['nosuchword'] ELSE ws END) AS w FROM q), c AS (SELECT query_id, room, count(*) AS s FROM u JOIN s USING (w) GROUP BY 1, 2),
b AS (SELECT query_id, room FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, room) AS n FROM c) WHERE n <= 3)
SELECT * FROM b UNION ALL SELECT query_id, room FROM q, (SELECT DISTINCT room FROM s) r WHERE query_id NOT IN (SELECT query_id FROM b)""")
def routed_rooms(spark, sf_dir):
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}_]{3,}"), 0)
    q = t(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.when(F.col("item_id") % 10 == 0, F.array(F.lit("nosuchword"))).otherwise(words).alias("words"))
    c = chunk_table(spark, sf_dir)
    rooms = c.groupBy("room").agg(F.concat_ws(" ", F.collect_list("document")).alias("document"))
    return evaluate.routed(rooms, q)


@query("SELECT conv_id, md5(string_agg(text, chr(10) ORDER BY turn)) AS digest FROM conversations WHERE role = 'user' AND text IS NOT NULL GROUP BY 1")
def session_corpus(spark, sf_dir):
    return evaluate.session_corpus(t(spark, sf_dir, "conversations")).select("conv_id", F.md5("document").alias("digest"))


@query("SELECT conv_id, md5(string_agg(text, chr(10) ORDER BY turn)) AS digest FROM conversations WHERE role IN ('user', 'assistant') AND text IS NOT NULL GROUP BY 1")
def full_turn_corpus(spark, sf_dir):
    return evaluate.session_corpus(t(spark, sf_dir, "conversations"), ("user", "assistant")).select("conv_id", F.md5("document").alias("digest"))


@query("""SELECT 'dialog' AS granularity, conv_id || ':' || turn AS id, md5(role || ': ' || coalesce(text, '')) AS digest FROM conversations
UNION ALL SELECT 'session', CAST(conv_id AS VARCHAR), md5(string_agg(role || ': ' || coalesce(text, ''), chr(10) ORDER BY turn)) FROM conversations GROUP BY conv_id
UNION ALL SELECT 'summary', CAST(conv_id AS VARCHAR), md5(arg_min(role || ': ' || coalesce(text, ''), turn) || CASE WHEN count(*) > 1 THEN chr(10) || arg_max(role || ': ' || coalesce(text, ''), turn) ELSE '' END) FROM conversations GROUP BY conv_id""")
def dialog_corpora(spark, sf_dir):
    c = t(spark, sf_dir, "conversations")
    parts = [evaluate.dialog_corpus(c, g).select(F.lit(g).alias("granularity"), "id", F.md5("document").alias("digest")) for g in ("dialog", "session", "summary")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(f"""WITH {TOP}, k AS (SELECT query_id, id, rank FROM top WHERE id % 2 = 0), c AS (SELECT vec_id AS id, vec_id AS place FROM embeddings WHERE vec_id < 40), q AS (SELECT DISTINCT query_id FROM k)
SELECT query_id, id, rank FROM k UNION ALL SELECT query_id, id, (SELECT max(rank) FROM k WHERE k.query_id = q.query_id) + row_number() OVER (PARTITION BY query_id ORDER BY place) FROM q, c WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.query_id = q.query_id AND k.id = c.id)""")
def ranked_with_rest(spark, sf_dir):
    r = _ranked(spark, sf_dir).where("id % 2 = 0")
    corpus = _vectors(spark, sf_dir).where("id < 40").select("id", F.col("id").alias("place"))
    return evaluate.with_unranked(r, corpus).withColumn("rank", F.col("rank").cast("long"))


@query("""WITH u AS (SELECT conv_id, turn, unnest(regexp_extract_all(lower(text || ' i prefer tea number ' || turn || '. i prefer tea.'), 'i prefer ([^.!?]{3,90})', 1)) AS x FROM conversations WHERE role = 'user' AND text IS NOT NULL),
f AS (SELECT conv_id, trim(x) AS x, min(turn) AS turn FROM u WHERE length(trim(x)) BETWEEN 5 AND 80 GROUP BY 1, 2)
SELECT conv_id, CAST(least(count(*), 10) AS BIGINT) AS found, bool_and(x LIKE 'tea number%') AS plain FROM f GROUP BY 1""")
def preference_documents(spark, sf_dir):
    c = t(spark, sf_dir, "conversations")
    said = F.concat("text", F.lit(" i prefer tea number "), F.col("turn").cast("string"), F.lit(". i prefer tea."))
    d = evaluate.preference_documents(c.withColumn("text", said), (r"i prefer ([^.!?]{3,90})",))
    items = F.split(F.regexp_replace("document", "^User has mentioned: ", ""), "; ")
    return d.select("conv_id", F.size(items).cast("long").alias("found"), F.forall(items, lambda x: x.startswith("tea number")).alias("plain"))


@query("SELECT count(*) AS n, CAST(50 AS BIGINT) AS held_out FROM documents")
def dev_split(spark, sf_dir):
    s = evaluate.split(chunk_table(spark, sf_dir).select("id"), 50, 7)
    return s.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("part") == "held_out").alias("held_out"))


@query(f"""WITH {TOP}, q AS (SELECT doc_id AS query_id, substr(text, 1, 80) AS query FROM documents), c AS (SELECT query_id, id, text AS document FROM top JOIN documents ON id = doc_id WHERE rank <= 5),
{_bm25_sql('c', 'q')} SELECT query_id, id, round(bm25, 6) AS score FROM bm25""")
def two_pass_rerank(spark, sf_dir):
    """The second pass asks only the documents of the first pass's best sessions, by words."""
    c = chunk_table(spark, sf_dir)
    first = _ranked(spark, sf_dir).where("rank <= 5").select("query_id", "id")
    texts = c.select(F.col("id").alias("query_id"), F.substring("document", 1, 80).alias("query"))
    cand = first.join(c.select("id", "document"), "id")
    return search.bm25(cand, texts).select("query_id", "id", F.round("score", 6).alias("score"))
