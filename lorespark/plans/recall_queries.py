"""Queries of the wake-up text, diaries, notes, threads and codes, with DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalog, chunks, entities, halls, notes
from .registry import COS, chunk_table, query, t

_KEYS = "CASE WHEN doc_id % 4 = 0 THEN CAST(doc_id % 9 AS VARCHAR) END, CASE WHEN doc_id % 3 = 0 THEN CASE WHEN doc_id % 2 = 0 THEN 'high' ELSE CAST(doc_id % 7 AS VARCHAR) END END, CASE WHEN doc_id % 5 = 0 THEN '4.5' END"


@query(rf"""WITH s AS (SELECT doc_id AS id, source AS room, source || '/' || doc_id AS file, coalesce(TRY_CAST(coalesce({_KEYS}) AS DOUBLE), 3.0) AS importance, replace(regexp_replace(text, '^\s+|\s+$', '', 'g'), chr(10), ' ') AS d FROM documents WHERE lang = 'en' ORDER BY doc_id LIMIT 2000),
x AS (SELECT *, '  - ' || CASE WHEN length(d) > 200 THEN substr(d, 1, 197) || '...' ELSE d END || '  (' || string_split(file, '/')[-1] || ')' AS line FROM s ORDER BY importance DESC, id LIMIT 15),
h AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY room ORDER BY importance DESC, id) = 1 THEN chr(10) || chr(10) || '[' || room || ']' ELSE '' END AS head FROM x),
u AS (SELECT *, sum(length(line) + greatest(length(head) - 1, 0)) OVER w AS used, row_number() OVER w AS place FROM h WINDOW w AS (ORDER BY room, importance DESC, id)),
b AS (SELECT *, lag(used, 1, 0) OVER (ORDER BY place) AS earlier FROM u)
SELECT 'I am a test.' || chr(10) || chr(10) || '## L1 — ESSENTIAL STORY' || string_agg(CASE WHEN used <= 3200 THEN head || chr(10) || line WHEN earlier <= 3200 THEN head || chr(10) || '  ... (more in L3 search)' ELSE '' END, '' ORDER BY place) AS text FROM b""")
def wakeup_text(spark, sf_dir):
    i = F.col("id")
    keys = [F.when(i % 4 == 0, (i % 9).cast("string")), F.when(i % 3 == 0, F.when(i % 2 == 0, "high").otherwise((i % 7).cast("string"))), F.when(i % 5 == 0, "4.5")]
    return catalog.wake_up_text(" I am a test. \n", chunk_table(spark, sf_dir).withColumn("importance", catalog.importance(*keys)), "en")


@query("""SELECT agent, CAST(place AS INTEGER) AS place, stamp, md5(document) AS digest FROM (SELECT lower('Agent' || conv_id % 7) AS agent, turn * 1000 + conv_id AS stamp, text AS document,
row_number() OVER (PARTITION BY conv_id % 7 ORDER BY turn * 1000 + conv_id DESC, text) AS place FROM conversations WHERE turn % 3 > 0) WHERE place <= 10""")
def diary_last(spark, sf_dir):
    c = t(spark, sf_dir, "conversations")
    entries = c.select(F.concat(F.lit("Agent"), (F.col("conv_id") % 7).cast("string")).alias("agent"), F.lit("w").alias("wing"), F.when(F.col("turn") % 3 > 0, "diary").otherwise("other").alias("room"), (F.col("turn") * 1000 + F.col("conv_id")).alias("at"), F.col("text").alias("document"))
    return catalog.diary_last(entries, 10).select("agent", "place", F.col("at").alias("stamp"), F.md5("document").alias("digest"))


@query(r"""SELECT id, CAST(thread - 1 AS INTEGER) AS thread, md5(document) AS digest FROM (SELECT doc_id AS id, unnest(string_split(text, '.' || chr(10))) AS document, generate_subscripts(string_split(text, '.' || chr(10)), 1) AS thread FROM documents) WHERE regexp_matches(document, '\S')""")
def document_threads(spark, sf_dir):
    return chunks.threads(chunk_table(spark, sf_dir).select("id", "document"), ".\n").select("id", "thread", F.md5("document").alias("digest"))


@query("SELECT c_custkey AS id, CASE lower(c_mktsegment) WHEN 'building' THEN 'BLD' WHEN 'machinery' THEN 'MACH' ELSE upper(substr(c_mktsegment, 1, 3)) END AS code FROM customer")
def known_codes(spark, sf_dir):
    return t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), entities.entity_code(F.col("c_mktsegment"), {"Building": "BLD", "machinery": "MACH"}).alias("code"))


_SAID = r"""n AS (SELECT conv_id, list_sort(list(DISTINCT upper(substr(role, 1, 3)))) AS people, regexp_extract_all(lower(arg_min(text, turn)), '[a-z]{4,}')[:2] AS topics,
  nullif(translate(substr(arg_min(text, turn), 1, 40), '"' || chr(10) || chr(13), '''  '), '') AS quote, CAST(conv_id % 100 AS DOUBLE) / 100 AS weight, CASE WHEN conv_id % 2 = 0 THEN ['joy', 'calm'] ELSE [] END AS emotions, CASE conv_id % 3 WHEN 0 THEN ['CORE'] WHEN 1 THEN ['ORIGIN', 'PIVOT'] ELSE [] END AS flags FROM conversations WHERE text IS NOT NULL GROUP BY conv_id)"""


@query(rf"""WITH {_SAID} SELECT CAST(conv_id AS VARCHAR) AS number, array_to_string(people, '+') AS people, array_to_string(topics, '_') AS topics, quote, weight, array_to_string(emotions, '+') AS emotions, array_to_string(flags, '+') AS flags FROM n""")
def notes_round_trip(spark, sf_dir):
    """Every conversation as a note, encoded as a line and parsed again."""
    c = t(spark, sf_dir, "conversations").where("text is not null")
    i, first = F.col("conv_id"), F.min_by("text", "turn")
    n = c.groupBy("conv_id").agg(F.collect_set(F.upper(F.substring("role", 1, 3))).alias("people"), first.alias("text"))
    none = F.array().cast("array<string>")
    n = n.select(
        F.lit("talks").alias("source_file"), F.concat(F.lit("conv-"), i.cast("string")).alias("id"), "people", F.slice(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{4,}"), 0), 1, 2).alias("topics"),
        F.substring("text", 1, 40).alias("quote"), ((i % 100) / 100).alias("weight"), F.when(i % 2 == 0, F.array(F.lit("joy"), F.lit("calm"))).otherwise(none).alias("emotions"),
        F.when(i % 3 == 0, F.array(F.lit("CORE"))).when(i % 3 == 1, F.array(F.lit("ORIGIN"), F.lit("PIVOT"))).otherwise(none).alias("flags"),
    )
    p = notes.parsed(notes.encoded(n)).where("kind = 'note'")
    return p.select("number", F.array_join("people", "+").alias("people"), F.array_join("topics", "_").alias("topics"), "quote", "weight", F.array_join("emotions", "+").alias("emotions"), F.array_join("flags", "+").alias("flags"))


def _any_sql(text: str, signals: tuple[str, ...]) -> str:
    return "(" + " + ".join("CASE WHEN contains(%s, '%s') THEN 1 ELSE 0 END" % (text, s.replace("'", "''")) for s in signals) + ")"


# Sessions say, beside what they hold, something of one of the halls; so do the questions.
_SESSION = ["i prefer tea", "option 1: here are", "she moved", "the city and the company", ""]
_QUESTION = ["you said", "i usually", "when did", "which job", ""]
_PICK = lambda of, by: "CASE " + " ".join(f"WHEN {by} % 5 = {i} THEN '{x}'" for i, x in enumerate(of)) + " END"


@query(f"""WITH s AS (SELECT conv_id AS id, lower(coalesce(string_agg(text, ' ' ORDER BY turn) FILTER (role = 'user'), '') || CASE WHEN conv_id % 5 = 1 THEN '' ELSE {_PICK(_SESSION, 'conv_id')} END) AS u,
  lower(coalesce(string_agg(text, ' ' ORDER BY turn) FILTER (role = 'assistant'), '') || CASE WHEN conv_id % 5 = 1 THEN {_PICK(_SESSION, 'conv_id')} ELSE '' END) AS a FROM conversations GROUP BY 1),
h AS (SELECT id, CASE WHEN {_any_sql('u', halls.SESSION_PREFERENCES)} >= 1 THEN 'hall_preferences' WHEN {_any_sql('a', halls.SESSION_ADVICE)} >= 2 THEN 'hall_assistant_advice' WHEN {_any_sql('u || a', halls.SESSION_EVENTS)} >= 1 THEN 'hall_events' WHEN {_any_sql('u || a', halls.SESSION_FACTS)} >= 2 THEN 'hall_facts' ELSE 'hall_general' END AS hall, embedding FROM s JOIN embeddings ON vec_id = id),
w AS (SELECT id AS query_id, lower({_PICK(_QUESTION, '(conv.id // 20)')}) AS q, embedding AS qe FROM h conv WHERE id % 20 = 0),
k AS (SELECT query_id, qe, CASE WHEN {_any_sql('q', halls.QUESTION_ADVICE)} >= 1 THEN ['hall_assistant_advice', 'hall_general'] WHEN {_any_sql('q', halls.QUESTION_PREFERENCES)} >= 1 THEN ['hall_preferences', 'hall_general'] WHEN {_any_sql('q', halls.QUESTION_EVENTS)} >= 1 THEN ['hall_events', 'hall_facts', 'hall_general'] WHEN {_any_sql('q', halls.QUESTION_FACTS)} >= 1 THEN ['hall_facts', 'hall_general'] ELSE ['hall_general'] END AS hs FROM w),
d AS (SELECT query_id, hs, id, hall, 1 - {COS.format('embedding', 'qe')} AS distance FROM k, h),
v AS (SELECT query_id, id FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(distance, 12), id) AS r FROM d WHERE hall = hs[1] AND hs[1] <> 'hall_general') WHERE r <= 10),
n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(distance, 12), id) AS r FROM d) WHERE r <= 50),
f AS (SELECT n.query_id, n.id, hall, distance * CASE WHEN hall = hs[1] THEN 0.75 WHEN list_contains(hs, hall) THEN 0.9 ELSE 1.0 END * CASE WHEN v.id IS NULL THEN 1.0 ELSE 0.85 END AS adjusted FROM n LEFT JOIN v ON v.query_id = n.query_id AND v.id = n.id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(adjusted, 12), id) AS INTEGER) AS rank, id, hall, abs(round(adjusted, 6)) AS adjusted FROM f""")
def navigated_sessions(spark, sf_dir):
    """Sessions of all conversations, classified by what was said; every twentieth asks."""
    i = F.col("conv_id")
    pick = lambda of, by: F.element_at(F.array(*[F.lit(x) for x in of]), (by % 5 + 1).cast("int"))
    s = halls.session_texts(t(spark, sf_dir, "conversations"))
    extra = pick(_SESSION, i)
    s = s.withColumn("user", F.concat("user", F.when(i % 5 == 1, "").otherwise(extra))).withColumn("assistant", F.concat("assistant", F.when(i % 5 == 1, extra).otherwise("")))
    s = s.select(i.alias("id"), halls.session_hall(F.col("user"), F.col("assistant")).alias("hall")).join(t(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding"), "id")
    q = s.where("id % 20 = 0").select(F.col("id").alias("query_id"), halls.question_halls(pick(_QUESTION, F.floor(F.col("id") / 20))).alias("halls"), "embedding")
    out = halls.navigate(s, q).join(s.select("id", "hall"), "id")
    return out.select("query_id", "rank", "id", "hall", F.abs(F.round("adjusted", 6)).alias("adjusted"))
