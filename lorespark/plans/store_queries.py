"""Queries of mutations, facts, links, file rules and project discovery, with DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import catalog, facts, graph, mutate
from ..sources import files
from .registry import chunk_table, fact_tables, query, t

# --- mutations ---------------------------------------------------------------------------------------------------------


def _halves(spark, sf_dir):
    c = chunk_table(spark, sf_dir).select("id", "document", "wing", "room", "source_file")
    return c.where("id % 2 = 0"), c.where("id % 3 = 0")


@query("SELECT doc_id AS id, CASE WHEN doc_id % 2 = 0 THEN 'old' ELSE 'new' END AS origin FROM documents WHERE doc_id % 2 = 0 OR doc_id % 3 = 0")
def add_chunks(spark, sf_dir):
    old, new = _halves(spark, sf_dir)
    return mutate.add(old.select("id", F.lit("old").alias("origin")), new.unionByName(new).select("id", F.lit("new").alias("origin")))


@query("SELECT doc_id AS id, CASE WHEN doc_id % 2 = 0 THEN 'already_exists' ELSE 'added' END AS verdict FROM documents WHERE doc_id % 3 = 0")
def add_report(spark, sf_dir):
    return mutate.add_report(*_halves(spark, sf_dir))


@query("SELECT doc_id AS id, CASE WHEN doc_id % 3 = 0 AND doc_id % 5 > 0 THEN 'x' || doc_id ELSE md5(text) END AS digest, CASE WHEN doc_id % 3 = 0 THEN 'wing=new;room=' || source || ';tag=t' ELSE 'wing=' || lang || ';room=' || source END AS meta FROM documents WHERE doc_id % 2 = 0")
def update_chunks(spark, sf_dir):
    old, new = _halves(spark, sf_dir)
    old = old.select("id", F.md5("document").alias("document"), F.create_map(F.lit("wing"), "wing", F.lit("room"), "room").alias("meta"))
    new = new.select("id", F.when(F.col("id") % 5 > 0, F.concat(F.lit("x"), F.col("id").cast("string"))).alias("document"), F.create_map(F.lit("wing"), F.lit("new"), F.lit("tag"), F.lit("t")).alias("meta"))
    m = lambda k: F.when(F.map_contains_key("meta", F.lit(k)), F.concat(F.lit(f"{k}="), F.col("meta")[k]))
    return mutate.update(old, new).select("id", F.col("document").alias("digest"), F.concat_ws(";", m("wing"), m("room"), m("tag")).alias("meta"))


@query("SELECT doc_id AS id FROM documents WHERE NOT (coalesce(lang = 'en', FALSE) AND coalesce(source IN ('src1', 'src2'), FALSE))")
def delete_where(spark, sf_dir):
    return mutate.delete_where(chunk_table(spark, sf_dir), {"$and": [{"wing": "en"}, {"room": {"$in": ["src1", "src2"]}}]}).select("id")


@query("SELECT '_reg_' || substr(sha256(source || '/' || doc_id), 1, 24) AS id, source || '/' || doc_id AS source_file, '[registry] ' || source || '/' || doc_id AS document FROM documents WHERE doc_id % 4 > 0")
def registry_rows(spark, sf_dir):
    c = chunk_table(spark, sf_dir)
    return mutate.registry_rows(c, c.where("id % 4 = 0"), "w").where(mutate.is_registry_row()).select("id", "source_file", "document")


@query("""WITH s AS (SELECT doc_id AS id, doc_id // 4 AS f, CASE doc_id % 3 WHEN 0 THEN 'exchange' WHEN 1 THEN 'general' END AS m FROM documents)
SELECT id, 'old' AS origin FROM s WHERE NOT (f % 2 = 0 AND coalesce(m, 'exchange') = 'exchange') UNION ALL SELECT id + 1000000, 'new' FROM s WHERE f % 2 = 0""")
def mined_store(spark, sf_dir):
    c = t(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.floor(F.col("doc_id") / 4).alias("source_file"))
    mode = F.when(F.col("id") % 3 == 0, "exchange").when(F.col("id") % 3 == 1, "general")
    store = c.select("id", "source_file", mode.alias("extract_mode"), F.lit("old").alias("origin"))
    new = c.where("source_file % 2 = 0").select((F.col("id") + 1000000).alias("id"), "source_file", F.lit("exchange").alias("extract_mode"), F.lit("new").alias("origin"))
    return mutate.mined(store, new, "exchange").select("id", "origin")


@query("""SELECT 'diary_' || CASE WHEN conv_id % 2 = 0 THEN 'w' ELSE 'wing_agent_' || conv_id END || '_20240102030405_' || substr(sha256(text), 1, 12) AS id, CASE WHEN conv_id % 2 = 0 THEN 'w' ELSE 'wing_agent_' || conv_id END AS wing, 'agent ' || conv_id AS agent, '2024-01-02' AS date FROM conversations""")
def diary_rows(spark, sf_dir):
    c = t(spark, sf_dir, "conversations")
    entries = c.select(F.concat(F.lit(" Agent "), F.col("conv_id").cast("string")).alias("agent"), F.when(F.col("conv_id") % 2 == 0, "w").alias("wing"), F.col("text").alias("entry"), F.lit("2024-01-02T03:04:05").alias("at"))
    return mutate.diary_rows(entries).select("id", "wing", "agent", "date")


@query("SELECT doc_id AS id, '[redacted ' || length(text) || ' chars]' AS content, lang AS wing FROM documents")
def audit_rows(spark, sf_dir):
    c = chunk_table(spark, sf_dir).select(F.col("id").alias("at"), F.lit("add").alias("op"), F.create_map(F.lit("content"), "document", F.lit("wing"), "wing").alias("params"))
    return mutate.audit_rows(c).select(F.col("at").alias("id"), F.col("params")["content"].alias("content"), F.col("params")["wing"].alias("wing"))


# Paths of three levels: the longest root decides, and one kind of path has no root at all.
_PATHS = "SELECT DISTINCT 'home/' || lang || '/' || source || '/f' || doc_id % 7 AS p, lang, source, doc_id % 7 AS k FROM documents"


@query(f"""WITH s AS ({_PATHS} UNION ALL SELECT 'tmp/x' || doc_id % 3, NULL, NULL, 0 FROM documents UNION ALL SELECT NULL, NULL, NULL, 0 FROM documents)
SELECT DISTINCT p AS source_file, CASE WHEN lang IN ('en', 'de') THEN CASE WHEN source = 'src1' THEN 'home/' || lang || '/src1' ELSE 'home/' || lang END END AS root,
CASE WHEN p IS NULL THEN 'no_source' WHEN lang IS NULL OR lang NOT IN ('en', 'de') THEN 'out_of_scope' WHEN k = 3 THEN 'missing' WHEN k = 4 THEN 'gitignored' ELSE 'kept' END AS bucket FROM s""")
def sync_buckets_nested(spark, sf_dir):
    d = t(spark, sf_dir, "documents")
    k = (F.col("doc_id") % 7).cast("string")
    s = d.select(F.concat_ws("/", F.lit("home"), "lang", "source", F.concat(F.lit("f"), k)).alias("source_file"))
    rest = d.select(F.concat(F.lit("tmp/x"), (F.col("doc_id") % 3).cast("string")).alias("source_file")).unionByName(d.select(F.lit(None).cast("string").alias("source_file")))
    roots = spark.createDataFrame([(r,) for r in ("home/en", "home/en/src1", "home/de", "home/de/src1", "home/d")], "root string")
    return mutate.sync_buckets(s.unionByName(rest), roots, s.where(~F.col("source_file").endswith("f3")), s.where(F.col("source_file").endswith("f4")))


# --- catalog -----------------------------------------------------------------------------------------------------------


@query("SELECT wing, room, n, CAST(row_number() OVER (PARTITION BY wing ORDER BY n DESC, room) AS INTEGER) AS place FROM (SELECT coalesce(lang, '?') AS wing, coalesce(source, '?') AS room, count(*) AS n FROM documents GROUP BY 1, 2)")
def room_listing(spark, sf_dir):
    return catalog.listing(chunk_table(spark, sf_dir))


@query("SELECT lang AS wing, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY 1")
def named_wings(spark, sf_dir):
    return catalog.named_counts(chunk_table(spark, sf_dir), "wing")


@query("SELECT coalesce(lang, 'unknown') AS wing, count(DISTINCT coalesce(source, 'general')) AS rooms, count(*) AS chunks FROM documents GROUP BY 1")
def export_index(spark, sf_dir):
    return catalog.export_index(chunk_table(spark, sf_dir))


@query("SELECT doc_id AS id, (SELECT count(*) FROM documents) AS total FROM documents ORDER BY doc_id LIMIT 20 OFFSET 40")
def page_with_total(spark, sf_dir):
    return catalog.page_with_total(chunk_table(spark, sf_dir).select("id"), 20, 40)


@query("SELECT event_type AS step, count(*) AS n, quantile_cont(CAST(event_id % 997 AS DOUBLE), 0.5) AS p50, round(quantile_cont(CAST(event_id % 997 AS DOUBLE), 0.95), 6) AS p95 FROM events GROUP BY 1")
def timing_percentiles(spark, sf_dir):
    e = t(spark, sf_dir, "events").select(F.col("event_type").alias("step"), (F.col("event_id") % 997).cast("double").alias("ms"))
    return catalog.percentiles(e).withColumn("p95", F.round("p95", 6))


# --- facts and links ---------------------------------------------------------------------------------------------------


@query("""WITH old AS (SELECT 'nation_' || n_nationkey AS id, 'Nation ' || n_nationkey AS name FROM nation WHERE n_nationkey < 10)
SELECT id, name, 'unknown' AS type FROM old WHERE id NOT IN ('nation_3', 'nation_4') UNION ALL SELECT 'nation_' || n_nationkey, 'NATION ' || n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'place' ELSE 'unknown' END FROM nation WHERE n_nationkey IN (3, 4, 20)""")
def entities_upserted(spark, sf_dir):
    n = t(spark, sf_dir, "nation")
    k = F.col("n_nationkey").cast("string")
    old = n.where("n_nationkey < 10").select(F.concat(F.lit("nation_"), k).alias("id"), F.concat(F.lit("Nation "), k).alias("name"), F.lit("unknown").alias("type"), F.lit("{}").alias("properties"))
    new = n.where("n_nationkey in (3, 4, 20)").select(F.concat(F.lit("NATION "), k).alias("name"), F.when(F.col("n_nationkey") % 2 == 0, "place").alias("type"), F.lit(None).cast("string").alias("properties"))
    return facts.entities_upserted(old, new).select("id", "name", "type")


@query("""WITH x AS (SELECT lower(c_name) AS id, c_name AS name FROM customer UNION SELECT lower(replace(n_name, ' ', '_')), n_name FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer))
SELECT id, name FROM x WHERE id NOT IN ('nation_1', 'nation_2')""")
def entities_of_facts(spark, sf_dir):
    c, n = t(spark, sf_dir, "customer"), t(spark, sf_dir, "nation")
    raw = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_name").alias("subject"), F.lit("lives in").alias("predicate"), F.col("n_name").alias("object"), F.col("c_custkey").alias("ordinal"))
    have = spark.createDataFrame([("nation_1",), ("nation_2",)], "id string")
    return facts.entities_of(raw, have).select("id", "name")


@query("""SELECT DISTINCT lower(c_name) AS subject, 'lives_in' AS predicate, lower(replace(n_name, ' ', '_')) AS object, 't_' || lower(c_name) || '_lives_in_' || lower(replace(n_name, ' ', '_')) AS stem FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def facts_normalised(spark, sf_dir):
    c, n = t(spark, sf_dir, "customer"), t(spark, sf_dir, "nation")
    none = F.lit(None).cast("string")
    raw = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_name").alias("subject"), F.lit("Lives In").alias("predicate"), F.col("n_name").alias("object"), none.alias("valid_from"), none.alias("valid_to"), F.col("c_custkey").alias("ordinal"))
    out = facts.normalised(raw)
    return out.select("subject", "predicate", "object", F.regexp_replace("id", "_[0-9a-f]{12}$", "").alias("stem"))


@query("""WITH p AS (SELECT 'P' || c_custkey AS name, c_custkey % 4 AS k, 'q' || c_custkey AS q FROM customer)
SELECT name AS subject, 'child_of' AS predicate, 'Q' || substr(q, 2) AS object, '2001-02-03' AS valid_from FROM p WHERE k = 0 UNION ALL SELECT name, 'is_child_of', 'Q' || substr(q, 2), '2001-02-03' FROM p WHERE k = 0
UNION ALL SELECT name, 'married_to', 'Q' || substr(q, 2), NULL FROM p WHERE k = 1 UNION ALL SELECT name, 'is_partner_of', 'Q' || substr(q, 2), NULL FROM p WHERE k = 1
UNION ALL SELECT name, 'is_pet_of', name, NULL FROM p WHERE k = 2 UNION ALL SELECT name, 'loves', x, '2025-01-01' FROM p, (SELECT unnest(['Chess', 'Tea']) AS x) WHERE k = 3""")
def facts_seeded(spark, sf_dir):
    k, s = F.col("c_custkey") % 4, F.col("c_custkey").cast("string")
    q, none = F.concat(F.lit("q"), s), F.lit(None).cast("string")
    people = t(spark, sf_dir, "customer").select(
        F.concat(F.lit("P"), s).alias("name"), F.when(k == 0, "2001-02-03").otherwise("").alias("birthday"), F.element_at(F.array(F.lit("daughter"), F.lit("husband"), F.lit("dog"), F.lit("")), (k + 1).cast("int")).alias("relationship"),
        F.when(k == 0, q).alias("parent"), F.when(k == 1, q).alias("partner"), none.alias("sibling"), F.lit("").alias("owner"), F.when(k == 3, F.array(F.lit("chess"), F.lit("tea"))).alias("interests"),
    )
    return facts.seeded(people)


def _tunnel_tables(spark, sf_dir):
    n = t(spark, sf_dir, "nation")
    k, r = F.col("n_nationkey").cast("string"), F.col("n_regionkey").cast("string")
    ends = [F.concat(F.lit("Wing "), r).alias("source_wing"), F.concat(F.lit("room_"), k).alias("source_room"), F.lit("hub-wing").alias("target_wing"), F.lit("hub").alias("target_room")]
    links = n.select(*ends, F.concat(F.lit("label "), k).alias("label"), F.lit(None).cast("string").alias("source_drawer"), k.alias("target_drawer"), F.lit("2024-01-01").alias("at"))
    empty = links.select(F.lit("").alias("id"), *[c for c in links.columns if c != "at"], F.lit("").alias("created_at"), F.lit("").alias("updated_at")).limit(0)
    return empty, links


_TUNNEL = """SELECT n_nationkey AS k, n_regionkey AS r, 'Wing ' || n_regionkey || '/room_' || n_nationkey AS a, 'hub-wing/hub' AS b FROM nation"""


@query(f"WITH x AS ({_TUNNEL}) SELECT substr(sha256(least(a, b) || '↔' || greatest(a, b)), 1, 16) AS id, CASE WHEN k % 2 = 0 THEN 'again ' || k ELSE 'label ' || k END AS label, '2024-01-01' AS created_at, CASE WHEN k % 2 = 0 THEN '2024-02-02' END AS updated_at FROM x")
def tunnels_upserted(spark, sf_dir):
    empty, links = _tunnel_tables(spark, sf_dir)
    first = graph.tunnels_upserted(empty, links)
    again = links.where(F.col("target_drawer").cast("int") % 2 == 0)
    turned = again.select(F.col("target_wing").alias("source_wing"), F.col("target_room").alias("source_room"), F.col("source_wing").alias("target_wing"), F.col("source_room").alias("target_room"), F.concat(F.lit("again "), "target_drawer").alias("label"), F.col("target_drawer").alias("source_drawer"), F.lit(None).cast("string").alias("target_drawer"), F.lit("2024-02-02").alias("at"))
    return graph.tunnels_upserted(first, turned).select("id", "label", "created_at", "updated_at")


@query(f"WITH x AS ({_TUNNEL}) SELECT substr(sha256(least(a, b) || '↔' || greatest(a, b)), 1, 16) AS id FROM x WHERE r = 2")
def tunnels_of_wing(spark, sf_dir):
    empty, links = _tunnel_tables(spark, sf_dir)
    return graph.tunnels_of(graph.tunnels_upserted(empty, links), "wing_2").select("id")


@query(f"WITH x AS ({_TUNNEL}) SELECT 'incoming' AS direction, 'Wing ' || r AS connected_wing, 'room_' || k AS connected_room, NULL AS preview FROM x UNION ALL SELECT 'outgoing', 'hub-wing', 'hub', substr(text, 1, 300) FROM documents WHERE doc_id = 3")
def tunnels_followed(spark, sf_dir):
    empty, links = _tunnel_tables(spark, sf_dir)
    tunnels = graph.tunnels_upserted(empty, links)
    c = chunk_table(spark, sf_dir).select(F.col("id").cast("string").alias("id"), "document")
    back = graph.followed(tunnels, "hub-wing", "hub", c)
    region = t(spark, sf_dir, "nation").where("n_nationkey = 3").first()["n_regionkey"]
    return back.unionByName(graph.followed(tunnels, f"wing {region}", "room_3", c)).select("direction", "connected_wing", "connected_room", "preview")


@query("""WITH x AS (SELECT DISTINCT 'w' || n_regionkey AS w, lower(left(n_name, 8)) || n_nationkey % 4 AS topic FROM nation), p AS (SELECT a.w AS wing_a, b.w AS wing_b, 'topic:' || a.topic AS room FROM x a JOIN x b ON a.topic = b.topic AND a.w < b.w WHERE a.w = 'w1' OR b.w = 'w1')
SELECT *, count(*) OVER (PARTITION BY wing_a, wing_b) AS shared FROM p""")
def topic_tunnels_for_wing(spark, sf_dir):
    n = t(spark, sf_dir, "nation").select(F.concat(F.lit("w"), F.col("n_regionkey").cast("string")).alias("wing"), F.concat(F.lower(F.substring("n_name", 1, 8)), (F.col("n_nationkey") % 4).cast("string")).alias("topic"))
    return graph.topic_tunnels_for(n, "w1")


@query("SELECT lang AS wing, count(DISTINCT source) AS rooms FROM documents GROUP BY 1")
def rooms_per_wing(spark, sf_dir):
    node = chunk_table(spark, sf_dir).groupBy("room").agg(F.collect_set("wing").alias("wings"), F.count(F.lit(1)).alias("count"))
    return graph.rooms_per_wing(node)


@query("SELECT source AS room, string_agg(DISTINCT lang, ',' ORDER BY lang) AS wings, count(DISTINCT lang) AS n_wings, count(*) AS count FROM documents GROUP BY 1 HAVING count(DISTINCT lang) >= 2 ORDER BY n_wings DESC, room LIMIT 10")
def top_tunnels(spark, sf_dir):
    node = chunk_table(spark, sf_dir).groupBy("room").agg(F.collect_set("wing").alias("wings"), F.count(F.lit(1)).alias("count"))
    return graph.top_tunnels(node).withColumn("n_wings", F.col("n_wings").cast("long"))


# --- files and projects ------------------------------------------------------------------------------------------------

_FILES = """SELECT doc_id AS id, CASE doc_id % 8 WHEN 0 THEN 'src/a' || doc_id || '.py' WHEN 1 THEN 'node_modules/x/a.js' WHEN 2 THEN 'docs/.gitignore' WHEN 3 THEN 'docs/b' || doc_id || '.PNG' WHEN 4 THEN 'logs/c.log.txt' WHEN 5 THEN 'logs/keep.txt' WHEN 6 THEN 'build/out.md' ELSE 'big/d.txt' END AS path, CASE WHEN doc_id % 8 = 7 THEN 600000000 ELSE 10 END AS length FROM documents"""


def _files(spark, sf_dir):
    k, i = (F.col("doc_id") % 8 + 1).cast("int"), F.col("doc_id").cast("string")
    names = F.array(F.concat(F.lit("src/a"), i, F.lit(".py")), F.lit("node_modules/x/a.js"), F.lit("docs/.gitignore"), F.concat(F.lit("docs/b"), i, F.lit(".PNG")), F.lit("logs/c.log.txt"), F.lit("logs/keep.txt"), F.lit("build/out.md"), F.lit("big/d.txt"))
    return t(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.element_at(names, k).alias("path"), F.when(k == 8, 600000000).otherwise(10).alias("length"))


@query(f"SELECT id FROM ({_FILES}) WHERE id % 8 IN (0, 5) OR id % 8 = 6")
def readable_files(spark, sf_dir):
    rules = {"": ["# comment", "  *.tmp  ", "logs/*"], "logs": ["!keep.txt"]}
    return _files(spark, sf_dir).where(files.readable(F.col("path"), F.col("length"), rules, include=("build/out.md",))).select("id")


@query(f"SELECT id FROM ({_FILES}) WHERE id % 8 IN (4, 5, 6, 7)")
def transcript_files(spark, sf_dir):
    return _files(spark, sf_dir).where(files.is_transcript(F.col("path"))).select("id")


@query("""SELECT n_nationkey AS id, CASE n_nationkey % 5 WHEN 0 THEN 'pkg-' || n_nationkey WHEN 1 THEN 'py-' || n_nationkey WHEN 2 THEN 'crate-' || n_nationkey WHEN 3 THEN 'mod' || n_nationkey END AS name FROM nation""")
def manifest_names(spark, sf_dir):
    i, k = F.col("n_nationkey").cast("string"), (F.col("n_nationkey") % 5 + 1).cast("int")
    file = F.element_at(F.array(*[F.lit(x) for x in ("a/package.json", "pyproject.toml", "b/Cargo.toml", "go.mod", "setup.py")]), k)
    body = F.element_at(F.array(F.concat(F.lit('{"name": "pkg-'), i, F.lit('"}')), F.concat(F.lit('[build]\nname = "no"\n[project]\nversion = "1"\nname = "py-'), i, F.lit('"\n')), F.concat(F.lit('[package]\nname = "crate-'), i, F.lit('"')), F.concat(F.lit("module example.org/x/mod"), i, F.lit("\ngo 1.22")), F.lit("name = 'x'")), k)
    return t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), files.manifest_name(file, body).alias("name"))


_COMMITS = """c AS (SELECT o_orderpriority AS repo, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS place, CASE WHEN o_custkey % 11 = 0 THEN 'Robo [bot]' WHEN o_custkey % 11 = 1 THEN 'handle' || o_custkey ELSE 'Ann Smith' || o_custkey % 23 END AS name FROM orders),
g AS (SELECT repo, name AS author, count(*) AS n FROM c WHERE place <= 1000 AND name LIKE 'Ann %' GROUP BY 1, 2), a AS (SELECT *, row_number() OVER (PARTITION BY repo ORDER BY n DESC, author) AS place FROM g)"""


def _authors(spark, sf_dir):
    from pyspark.sql import Window

    k = F.col("o_custkey")
    name = F.when(k % 11 == 0, "Robo [bot]").when(k % 11 == 1, F.concat(F.lit("handle"), k.cast("string"))).otherwise(F.concat(F.lit("Ann Smith"), (k % 23).cast("string")))
    place = F.row_number().over(Window.partitionBy("o_orderpriority").orderBy("o_orderkey"))
    return files.authors(t(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("repo"), place.alias("place"), name.alias("name"), F.lit("a@b.c").alias("email")))


@query(f"WITH {_COMMITS} SELECT repo, author, n FROM a WHERE place <= 5")
def top_authors(spark, sf_dir):
    return _authors(spark, sf_dir).where("place <= 5").select("repo", "author", "n")


@query(f"WITH {_COMMITS} SELECT repo, bool_or(author = 'Ann Smith5' AND (place <= 5 OR n >= 0.1 * total OR n >= 20)) AS is_mine FROM (SELECT *, sum(n) OVER (PARTITION BY repo) AS total FROM a) GROUP BY 1")
def my_projects(spark, sf_dir):
    return files.mine(_authors(spark, sf_dir), "ann smith5")


_WORDS = {"frontend": ("ui", "web"), "docs": ("doc", "wiki"), "tests": ("test",)}


@query("SELECT room, count(*) AS n FROM (SELECT doc_id, unnest(CASE doc_id % 4 WHEN 0 THEN ['frontend', 'docs'] WHEN 1 THEN ['tests'] WHEN 2 THEN ['frontend'] ELSE [] END) AS room FROM documents) GROUP BY 1")
def rooms_of_folders(spark, sf_dir):
    paths = F.element_at(F.array(*[F.lit(x) for x in ("Web/ui/wiki/a.py", "x/test/docs.py", "frontend/b.py", "other/test.py")]), (F.col("doc_id") % 4 + 1).cast("int"))
    return files.rooms_of_folders(t(spark, sf_dir, "documents").select(F.concat(F.col("doc_id").cast("string"), F.lit("/"), paths).alias("path")), _WORDS)


@query("SELECT room, count(*) AS n FROM (SELECT unnest(CASE WHEN doc_id % 4 = 0 THEN ['frontend', 'docs'] WHEN doc_id % 4 = 1 THEN ['tests'] ELSE [] END) AS room FROM documents) GROUP BY 1 HAVING count(*) >= 2")
def rooms_of_files(spark, sf_dir):
    names = F.element_at(F.array(*[F.lit(x) for x in ("a/web_doc.py", "a/TEST_x.py", "b/plain.py", "ui/none.py")]), (F.col("doc_id") % 4 + 1).cast("int"))
    return files.rooms_of_files(t(spark, sf_dir, "documents").select(names.alias("path")), _WORDS)
