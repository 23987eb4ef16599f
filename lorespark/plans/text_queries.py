"""Queries of routing, memories, names and shorthand over documents and conversations, with DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import catalog, chunks, entities, memories
from .registry import chunk_table, query, t

STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
STOP = ("the", "and", "der", "que")


def _route_sql(lists: dict[str, list[str]], c: str) -> str:
    """The label with most keywords, the first declared of equals."""
    scores = ", ".join(f"{{'s': {' + '.join(f'CAST(contains({c}, {chr(39)}{w}{chr(39)}) AS INTEGER)' for w in ws)}, 'p': {i}, 'n': '{k}'}}" for i, (k, ws) in enumerate(lists.items()))
    return f"coalesce(list_filter(list_sort(list_transform([{scores}], lambda x: {{'a': -x.s, 'b': x.p, 'n': x.n}})), lambda x: x.a < 0)[1].n, 'general')"


@query(f"SELECT doc_id AS id, {_route_sql(chunks.HALLS, 'lower(substr(text, 1, 3000))')} AS hall FROM documents")
def hall_of_content(spark, sf_dir):
    return chunk_table(spark, sf_dir).select("id", text.best_label(F.lower(F.substring("document", 1, 3000)), chunks.HALLS, "general").alias("hall"))


_CONV = "SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS d FROM conversations GROUP BY 1"


@query(f"SELECT doc_id AS id, {_route_sql(chunks.TOPICS, chr(39) + ' ' + chr(39) + ' || lower(substr(text, 1, 3000)) || ' + chr(39) + ' ' + chr(39))} AS room FROM documents")
def topic_room(spark, sf_dir):
    return chunk_table(spark, sf_dir).select("id", chunks.topic_room(F.col("document")).alias("room"))


def _words_sql(ws: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in ws) + "]"


@query(rf"""WITH w AS (SELECT doc_id AS id, list_distinct(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+')) AS ws FROM documents),
s AS (SELECT id, len(list_intersect(ws, {_words_sql(memories.POSITIVE)})) AS p, len(list_intersect(ws, {_words_sql(memories.NEGATIVE)})) AS n FROM w)
SELECT id, CASE WHEN p > n THEN 'positive' WHEN n > p THEN 'negative' ELSE 'neutral' END AS sentiment FROM s""")
def sentiment(spark, sf_dir):
    return chunk_table(spark, sf_dir).select("id", memories.sentiment(F.col("document")).alias("sentiment"))


# Every document tells, beside its own text, a few things that markers know.
TALES = [
    "We decided to use the framework because it works, instead of the old stack. It was the right approach and strategy for us.",
    "I prefer tabs over spaces and always use snake_case. Please never mock the database in these tests of ours.",
    "Finally got it working! Fixed the crash and shipped version 2, a breakthrough for everyone here.",
    "There is a bug: the import keeps failing and it does not help. The root cause is a broken and wrong path, still stuck.",
    "I feel so grateful and happy today, I love you all. It is beautiful and wonderful to be here with you.",
    "cd /tmp/work\ngit commit -m x\n```\nthe bug is broken\n```\nNothing else is said about that in this place today.",
]
KINDS = ["decision", "preference", "milestone", "problem", "emotional", None]


@query(f"SELECT doc_id AS id, CAST(0 AS INTEGER) AS chunk_index, {_words_sql(tuple(k or '' for k in KINDS))}[CAST(doc_id % 6 AS INTEGER) + 1] AS memory_type FROM documents WHERE doc_id % 6 < 5")
def memory_kinds(spark, sf_dir):
    tale = F.element_at(F.array(*[F.lit(x) for x in TALES]), (F.col("doc_id") % 6 + 1).cast("int"))
    d = t(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), tale.alias("document"))
    return memories.memories(d).select("id", "chunk_index", "memory_type")


@query()
def memories_of_documents(spark, sf_dir):
    return memories.memories(chunk_table(spark, sf_dir)).select("id", "chunk_index", "memory_type", F.md5("document").alias("digest"))


@query(rf"""WITH p AS (SELECT doc_id AS id, list_filter(list_transform(string_split(text, chr(10) || chr(10)), lambda x: {STRIP.format('x')}), lambda x: x <> '') AS ps, string_split(text, chr(10)) AS ls FROM documents),
g AS (SELECT id, CASE WHEN len(ps) <= 1 AND len(ls) - 1 > 20 THEN list_filter(list_transform(range(0, CAST(ceil(len(ls) / 25.0) AS BIGINT)), lambda i: {STRIP.format("array_to_string(ls[CAST(i * 25 + 1 AS BIGINT):CAST(i * 25 + 25 AS BIGINT)], chr(10))")}), lambda x: x <> '') ELSE ps END AS ps FROM p),
u AS (SELECT id, unnest(ps) AS part, generate_subscripts(ps, 1) AS n FROM g), k AS (SELECT id, n, part, unnest(range(0, CAST(ceil(length(part) / 800.0) AS BIGINT))) AS i FROM u WHERE length({STRIP.format('part')}) > 30)
SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY n, i) - 1 AS INTEGER) AS chunk_index, md5(substr(part, i * 800 + 1, 800)) AS digest FROM k""")
def paragraph_chunks(spark, sf_dir):
    return chunks.paragraphs(chunk_table(spark, sf_dir)).select("id", "chunk_index", F.md5("document").alias("digest"))


@query(rf"""WITH l AS (SELECT conv_id, turn, CASE WHEN role = 'user' THEN '> ' ELSE '' END || {STRIP.format("regexp_replace(text, chr(10), ' ', 'g')")} AS line, role FROM conversations),
x AS (SELECT *, sum(CASE WHEN line LIKE '>%' THEN 1 ELSE 0 END) OVER w AS ex, count(*) FILTER (line LIKE '>%') OVER (PARTITION BY conv_id) AS q, bool_or(line LIKE '---%') OVER (PARTITION BY conv_id) AS rule FROM l WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
g AS (SELECT conv_id, ex, arg_min(line, turn) || coalesce(chr(10) || string_agg(line, ' ' ORDER BY turn) FILTER (NOT line LIKE '>%' AND line <> ''), '') AS d FROM x WHERE q >= 3 AND ex > 0 AND NOT rule GROUP BY 1, 2),
k AS (SELECT conv_id, ex, d, unnest(range(0, CAST(ceil(length(d) / 800.0) AS BIGINT))) AS i FROM g WHERE length({STRIP.format('d')}) > 30)
SELECT conv_id AS id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY ex, i) - 1 AS INTEGER) AS chunk_index, md5(substr(d, i * 800 + 1, 800)) AS digest FROM k""")
def transcript_exchanges(spark, sf_dir):
    line = F.concat(F.when(F.col("role") == "user", "> ").otherwise(""), text.strip(F.regexp_replace("text", "\n", " ")))
    c = t(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", line.alias("line")))).alias("s"), F.count_if(F.col("role") == "user").alias("q"), F.max(line.startswith("---")).alias("rule"))
    d = c.where("q >= 3 and not rule").select(F.col("conv_id").alias("id"), F.array_join(F.transform("s", lambda x: x["line"]), "\n").alias("document"))
    return chunks.transcript_chunks(d).select("id", "chunk_index", F.md5("document").alias("digest"))


EMOTIONS = {"heon": "joy", "und": "doubt", "tion": "joy", "que": "love", "der": "calm"}
FLAGS = {"ering": "CORE", "und": "PIVOT", "ment": "ORIGIN", "able": "CORE"}


def _signals_sql(table: dict[str, str]) -> str:
    rows = ", ".join(f"CASE WHEN contains(lower(text), '{k}') THEN '{v}' END" for k, v in table.items())
    found = f"list_filter([{rows}], lambda x: x IS NOT NULL)"
    return f"array_to_string(list_slice(list_filter({found}, lambda x, i: list_position({found}, x) = i), 1, 3), '+')"


@query(f"SELECT doc_id AS id, {_signals_sql(EMOTIONS)} AS emotions, {_signals_sql(FLAGS)} AS flags FROM documents")
def emotions_and_flags(spark, sf_dir):
    d = chunk_table(spark, sf_dir)
    return d.select("id", F.array_join(entities.signals(F.col("document"), EMOTIONS), "+").alias("emotions"), F.array_join(entities.signals(F.col("document"), FLAGS), "+").alias("flags"))


def _points_sql(x: str) -> str:
    words = " + ".join(f"CASE WHEN contains(lower({x}), '{w}') THEN 2 ELSE 0 END" for w in entities.WEIGHTY)
    return f"{words} + CASE WHEN length({x}) < 80 THEN 1 ELSE 0 END + CASE WHEN length({x}) < 40 THEN 1 ELSE 0 END - CASE WHEN length({x}) > 150 THEN 2 ELSE 0 END"


@query(rf"""WITH s AS (SELECT doc_id AS id, list_filter(list_transform(regexp_split_to_array(text, '[.!?\n]+'), lambda x: {STRIP.format('x')}), lambda x: length(x) > 10) AS ss FROM documents),
u AS (SELECT id, unnest(ss) AS x, generate_subscripts(ss, 1) AS i FROM s), b AS (SELECT id, arg_max(x, ({_points_sql('x')}) * 1000000 - i) AS x FROM u GROUP BY 1)
SELECT s.id, coalesce(CASE WHEN length(x) > 55 THEN substr(x, 1, 52) || '...' ELSE x END, '') AS sentence FROM s LEFT JOIN b USING (id)""")
def key_sentence(spark, sf_dir):
    return chunk_table(spark, sf_dir).select("id", entities.key_sentence(F.col("document")).alias("sentence"))


@query(rf"""WITH w AS (SELECT doc_id AS id, list_transform(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> ''), lambda x: regexp_replace(x, '[^a-zA-Z]', '', 'g')) AS ws FROM documents),
f AS (SELECT id, list_transform(list_filter(ws[2:], lambda x: regexp_matches(x, '^[A-Z][a-z]+$') AND lower(x) NOT IN ({", ".join(f"'{s}'" for s in STOP)})), lambda x: upper(substr(x, 1, 3))) AS cs FROM w)
SELECT id, array_to_string(list_slice(list_filter(cs, lambda x, i: list_position(cs, x) = i), 1, 3), '+') AS codes FROM f""")
def name_codes(spark, sf_dir):
    return chunk_table(spark, sf_dir).select("id", F.array_join(entities.name_codes(F.col("document"), STOP), "+").alias("codes"))


@query()
def shorthand(spark, sf_dir):
    return entities.shorthand(chunk_table(spark, sf_dir), EMOTIONS, FLAGS, STOP)


@query()
def shorthand_decoded(spark, sf_dir):
    d = entities.decoded(entities.shorthand(chunk_table(spark, sf_dir), EMOTIONS, FLAGS, STOP))
    return d.select("id", F.array_join("names", "+").alias("names"), F.array_join("topics", "_").alias("topics"), "quote")


@query("SELECT sum(length(text)) AS before, sum(length(substr(text, 1, 55))) AS after, sum(length(text)) / greatest(sum(length(substr(text, 1, 55))), 1) AS ratio FROM documents")
def compression_totals(spark, sf_dir):
    d = chunk_table(spark, sf_dir).select("document", F.substring("document", 1, 55).alias("compressed"))
    return entities.compression_totals(d)


KNOWN = ("Heon", "Und", "Que")


@query(rf"""WITH w AS (SELECT doc_id AS id, text, regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+') AS ws FROM documents), u AS (SELECT id, unnest(ws) AS w FROM w),
k AS (SELECT id, w FROM u WHERE regexp_full_match(w, '\p{{Lu}}\p{{Ll}}{{2,}}') AND w NOT IN ({", ".join(f"'{x}'" for x in entities.NO_NAMES)}) GROUP BY 1, 2 HAVING count(*) >= 2 UNION SELECT id, w FROM u WHERE w IN ({", ".join(f"'{x}'" for x in KNOWN)})),
s AS (SELECT id, list_slice(list_sort(list(w)), 1, 25) AS ns FROM k GROUP BY 1) SELECT w.id, coalesce(array_to_string(ns, ';'), '') AS names FROM w LEFT JOIN s USING (id)""")
def metadata_names(spark, sf_dir):
    d = chunk_table(spark, sf_dir).select("id", "document", entities.names_in(F.col("document")).alias("found"))
    return d.select("id", entities.metadata_names(F.col("document"), F.col("found"), KNOWN).alias("names"))



@query(r"""WITH l AS (SELECT doc_id AS id, string_split(text, chr(10)) AS ls FROM documents), u AS (SELECT id, trim(unnest(ls)) AS line, generate_subscripts(ls, 1) AS pos FROM l),
m AS (SELECT DISTINCT id, pos, line, unnest(regexp_extract_all(line, '[\p{L}\p{N}_]+')) AS name FROM u), f AS (SELECT name, line, min({'id': id, 'pos': pos}) AS a FROM m WHERE name IN ('The', 'Und', 'La') GROUP BY 1, 2)
SELECT name, CAST(place AS INTEGER) AS place, md5(line) AS digest FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY a) AS place FROM f) WHERE place <= 3""")
def context_lines(spark, sf_dir):
    names = spark.createDataFrame([("The",), ("Und",), ("La",)], "name string")
    return entities.context_lines(chunk_table(spark, sf_dir), names).select("name", "place", F.md5("line").alias("digest"))


@query("""SELECT n_name AS word, CASE WHEN n_nationkey % 3 = 0 THEN 'person' WHEN n_nationkey % 3 = 1 OR n_nationkey % 7 = 0 THEN CASE WHEN n_nationkey % 3 = 1 THEN 'project' ELSE 'place' END ELSE 'unknown' END AS type FROM nation""")
def registry_lookup(spark, sf_dir):
    n = t(spark, sf_dir, "nation")
    k, none = F.col("n_nationkey"), F.array().cast("array<string>")
    people = n.where(k % 3 == 0).select(F.when(k % 2 == 0, F.lower("n_name")).otherwise(F.lit("someone else")).alias("name"), F.when(k % 2 == 1, F.array("n_name")).otherwise(none).alias("aliases"))
    projects = n.where(k % 3 == 1).select(F.col("n_name").alias("name"))
    confirmed = n.where(k % 7 == 0).select(F.col("n_name").alias("name"), F.lit("place").alias("type"))
    return entities.looked_up(n.select(F.col("n_name").alias("word")), people, projects, confirmed)


@query("""WITH a AS (SELECT o_orderpriority AS category, lower(c_name) AS name FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_custkey % 2 = 0), b AS (SELECT o_orderpriority AS category, c_name AS name FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT category, arg_min(name, {'o': o, 'n': name}) AS name FROM (SELECT *, 0 AS o FROM a UNION ALL SELECT *, 1 FROM b) GROUP BY category, lower(name)""")
def registry_union(spark, sf_dir):
    o = t(spark, sf_dir, "orders").join(t(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    first = o.where("c_custkey % 2 = 0").select(F.col("o_orderpriority").alias("category"), F.lower("c_name").alias("name"))
    return entities.registry_union(first, o.select(F.col("o_orderpriority").alias("category"), F.col("c_name").alias("name")))


@query("SELECT n_name AS name, CASE WHEN n_nationkey % 2 = 0 THEN 'person' ELSE 'project' END AS type FROM nation")
def merged_names(spark, sf_dir):
    n = t(spark, sf_dir, "nation")
    first = n.where("n_nationkey % 2 = 0").select(F.col("n_name").alias("name"), F.lit("person").alias("type"))
    return entities.merged(first, n.select(F.when(F.col("n_nationkey") % 2 == 0, F.lower("n_name")).otherwise(F.col("n_name")).alias("name"), F.lit("project").alias("type")))


@query("SELECT DISTINCT o_orderkey AS query_id, c_name AS name FROM orders JOIN customer ON o_custkey = c_custkey")
def people_in_queries(spark, sf_dir):
    o, c = t(spark, sf_dir, "orders"), t(spark, sf_dir, "customer")
    short = F.concat(F.lit("Cust"), F.col("c_custkey").cast("string"))
    people = c.select(F.col("c_name").alias("name"), F.array(short).alias("aliases"))
    said = o.select(F.col("o_orderkey").alias("query_id"), F.concat(F.lit("What did cust"), F.col("o_custkey").cast("string"), F.lit(" order?")).alias("query"))
    return entities.people_in(said, people)


@query("SELECT r_regionkey AS query_id, 'Region' AS word FROM region")
def unknown_words(spark, sf_dir):
    r = t(spark, sf_dir, "region")
    said = r.select(F.col("r_regionkey").alias("query_id"), F.lit("Where is Region near Atlantis now?").alias("query"))
    return entities.unknown_words(said, spark.createDataFrame([("atlantis",)], "name string"))


# --- conversations as sessions ------------------------------------------------------------------------------------------


@query("SELECT conv_id, CAST(place AS INTEGER) AS place, text FROM (SELECT conv_id, substr(text, 1, 200) AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS place FROM conversations WHERE role = 'user' AND text IS NOT NULL) WHERE place <= 5")
def recent_messages(spark, sf_dir):
    return catalog.recent_messages(t(spark, sf_dir, "conversations"))


@query("SELECT conv_id, string_agg(text, '|' ORDER BY place DESC) AS document FROM (SELECT conv_id, substr(text, 1, 200) AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS place FROM conversations WHERE role = 'user' AND text IS NOT NULL) WHERE place <= 5 GROUP BY 1")
def checkpoint_entries(spark, sf_dir):
    return catalog.checkpoint_entry(t(spark, sf_dir, "conversations"))


@query(r"SELECT conv_id, count(*) FILTER (role = 'user' AND regexp_matches(text, '\S') AND NOT contains(text, '<command-message>')) AS n FROM conversations GROUP BY 1")
def human_messages(spark, sf_dir):
    return catalog.human_messages(t(spark, sf_dir, "conversations"))


@query("""WITH u AS (SELECT conv_id, unnest(regexp_extract_all(lower(text), '[a-z]{4,}')) AS word FROM conversations WHERE role = 'user'), g AS (SELECT conv_id, word, count(*) AS n FROM u WHERE word NOT IN ('that', 'with') GROUP BY 1, 2)
SELECT conv_id, CAST(place AS INTEGER) AS place, word, n FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY n DESC, word) AS place FROM g) WHERE place <= 3""")
def theme_words(spark, sf_dir):
    return catalog.theme_words(t(spark, sf_dir, "conversations"), ("that", "with"))


@query(r"""WITH p AS (SELECT doc_id AS id, lang || ' ' || source || '-x' AS name, ' -' || text || '! ' AS label, lang || '/' || source || '/f.' || doc_id || '.tar.gz' AS path, text FROM documents)
SELECT id, lower(translate(name, ' -', '__')) AS slug, md5(regexp_replace(regexp_replace(lower(label), '[^\p{L}\p{N}]+', '_', 'g'), '^_+|_+$', '', 'g')) AS label, string_split(path, '/')[3] AS base, regexp_replace(string_split(path, '/')[3], '\.[^.]+$', '') AS stem,
md5('> ' || replace(text, chr(10), chr(10) || '> ')) AS quote, substr(sha256(text), 1, 24) AS hex, CAST((length(text) - length(replace(text, 'the', ''))) / 3 AS INTEGER) AS n FROM p""")
def text_scalars(spark, sf_dir):
    i, doc = F.col("id").cast("string"), F.col("document")
    path = F.concat_ws("/", "wing", "room", F.concat(F.lit("f."), i, F.lit(".tar.gz")))
    name = F.concat("wing", F.lit(" "), "room", F.lit("-x"))
    label = text.label_slug(F.concat(F.lit(" -"), doc, F.lit("! ")))
    return chunk_table(spark, sf_dir).select("id", text.scope_slug(name).alias("slug"), F.md5(label).alias("label"), text.basename(path).alias("base"), text.stem(path).alias("stem"), F.md5(text.blockquote(doc)).alias("quote"), text.hex_id(doc).alias("hex"), text.occurrences(doc, "the").alias("n"))
