"""Queries of transcript formats: conversations are written in each format and read back, with DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import memories
from ..sources import formats
from .registry import query, t

PLAIN = r"regexp_replace({0}, '\s+', ' ', 'g')"


def _turns(spark, sf_dir) -> DataFrame:
    """Turns on one line each, users and assistants only, empty ones left out."""
    line = text.strip(F.regexp_replace("text", r"\s+", " "))
    return t(spark, sf_dir, "conversations").where("role in ('user', 'assistant')").select("conv_id", "turn", "role", line.alias("text")).where("text <> ''")


def _files(turns: DataFrame, record, head: str = "", tail: str = "", sep: str = "\n", ending: str = "jsonl") -> DataFrame:
    """(path, text): the records of each conversation in one file."""
    g = turns.select("conv_id", F.struct("turn", record.alias("r")).alias("x")).groupBy("conv_id").agg(F.sort_array(F.collect_list("x")).alias("s"))
    body = F.array_join(F.transform("s", lambda x: x["r"]), sep)
    return g.select(F.concat(F.col("conv_id").cast("string"), F.lit("." + ending)).alias("path"), F.concat(F.lit(head), body, F.lit(tail)).alias("text"))


def _json(**fields) -> F.Column:
    return F.to_json(F.struct(*[(v if not isinstance(v, str) else F.lit(v)).alias(k) for k, v in fields.items()]))


_T = rf"c AS (SELECT conv_id, turn, role, trim({PLAIN.format('text')}) AS text FROM conversations WHERE role IN ('user', 'assistant') AND trim({PLAIN.format('text')}) <> '')"
_MERGED = f"""{_T}, m AS (SELECT *, CASE WHEN role = 'user' OR lag(role) OVER w IS NULL OR lag(role) OVER w <> 'assistant' THEN 1 ELSE 0 END AS new FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
n AS (SELECT *, sum(new) OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM m), g AS (SELECT conv_id, k AS turn, any_value(role) AS role, string_agg(text, chr(10) ORDER BY turn) AS text FROM n GROUP BY 1, 2)"""


def _render_sql(table: str, ending: str = "jsonl", extra: str = "", footer: str = "''") -> str:
    return f"""l AS (SELECT conv_id, turn, CASE WHEN role = 'user' THEN '> ' || text || CASE WHEN coalesce(lead(role) OVER w, '') = 'assistant' THEN '' ELSE chr(10) END ELSE text || chr(10) END AS line FROM {table} WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id || '.{ending}' AS path, md5(string_agg(line, chr(10) ORDER BY turn) || {footer}) AS digest{extra} FROM l GROUP BY conv_id HAVING count(*) >= 2"""


def _shown(transcripts: DataFrame) -> DataFrame:
    return transcripts.select("path", F.md5("transcript").alias("digest"))


@query(f"WITH {_MERGED}, {_render_sql('g')}")
def session_format(spark, sf_dir):
    block = F.array(F.struct(F.lit("text").alias("type"), F.col("text").alias("text")))
    files = _files(_turns(spark, sf_dir), _json(type=F.col("role"), message=F.struct("role", block.alias("content"))), head='{"type": "summary"}\nnot json\n')
    return _shown(formats.rendered(formats.session_turns(files)))


@query(f"WITH {_T}, {_render_sql('c')}")
def event_format(spark, sf_dir):
    kind = F.when(F.col("role") == "user", "user_message").otherwise("agent_message")
    files = _files(_turns(spark, sf_dir), _json(type="event_msg", payload=F.struct(kind.alias("type"), F.col("text").alias("message"))), head='{"type": "session_meta", "payload": {}}\n')
    return _shown(formats.rendered(formats.event_turns(files)))


@query(f"WITH {_T}, {_render_sql('c')}")
def stream_format(spark, sf_dir):
    blocks = F.array(F.struct(F.col("text").alias("text")), F.struct(F.lit(" ").alias("text")))
    record = _json(type=F.when(F.col("role") == "user", "user").otherwise("gemini"), content=blocks)
    head = '{"type": "user", "content": [{"text": "too early"}]}\n{"type": "session_metadata"}\n{"type": "message_update"}\n'
    return _shown(formats.rendered(formats.stream_turns(_files(_turns(spark, sf_dir), record, head=head))))


@query(f"WITH {_T}, {_render_sql('c', 'json')}")
def export_format(spark, sf_dir):
    who = F.when(F.col("role") == "user", "human").otherwise("assistant")
    files = _files(_turns(spark, sf_dir), _json(sender=who, text=F.col("text"), content=F.array().cast("array<string>")), '[{"uuid": "a", "chat_messages": [', "]}]", ",", "json")
    return _shown(formats.rendered(formats.export_turns(files)))


@query(f"WITH {_T}, {_render_sql('c', 'json')}")
def tree_format(spark, sf_dir):
    """Each turn's node has the one before it as parent; a branch beside the last is not followed."""
    turns = _turns(spark, sf_dir)
    g = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("s"))
    name = lambda i: F.concat(F.lit("n"), i.cast("string"))

    def node(x, i):
        message = F.struct(F.struct(x["role"].alias("role")).alias("author"), F.struct(F.array(x["text"]).alias("parts")).alias("content"))
        return F.concat(F.lit('"'), name(i), F.lit('": '), F.to_json(F.struct(name(i - 1).alias("parent"), message.alias("message"), F.array(name(i + 1)).alias("children"))))

    root = F.lit('"n-1": {"parent": null, "message": null, "children": ["n0"]}, "other": {"parent": "n0", "message": {"author": {"role": "user"}, "content": {"parts": ["no"]}}}, ')
    body = F.concat(F.lit('{"mapping": {'), root, F.array_join(F.transform("s", node), ", "), F.lit('}, "current_node": "'), name(F.size("s") - 1), F.lit('"}'))
    files = g.select(F.concat(F.col("conv_id").cast("string"), F.lit(".json")).alias("path"), body.alias("text"))
    return _shown(formats.rendered(formats.tree_turns(files)))


@query(f"WITH {_T}, s AS (SELECT conv_id, turn, role, '[' || CASE WHEN role = 'user' THEN 'U1' ELSE 'U_2' END || '] ' || text AS text, first_value(role) OVER (PARTITION BY conv_id ORDER BY turn) AS head FROM c), r AS (SELECT conv_id, turn, CASE WHEN role = head THEN 'user' ELSE 'assistant' END AS role, text FROM s), {_render_sql('r', 'json', footer='chr(10) || ' + chr(39) + formats.CHAT_FOOTER.strip() + chr(39))}")
def chat_format(spark, sf_dir):
    who = F.when(F.col("role") == "user", "U1").otherwise("U[2")
    files = _files(_turns(spark, sf_dir), _json(type="message", user=who, text=F.col("text")), "[", "]", ",", "json")
    return _shown(formats.rendered(formats.chat_turns(files), formats.CHAT_FOOTER))


@query(f"""WITH {_T}, ok AS (SELECT conv_id FROM c GROUP BY 1 HAVING count(*) >= 2) SELECT conv_id || '.jsonl' AS path, CASE conv_id % 3 WHEN 0 THEN 'session' WHEN 1 THEN 'events' ELSE 'text' END AS format FROM c JOIN ok USING (conv_id)
WHERE conv_id IN (SELECT conv_id FROM {"(SELECT conv_id, count(*) FILTER (role = 'user') AS u, count(*) FILTER (role = 'assistant') AS a FROM c GROUP BY 1) WHERE u >= 1 AND a >= 1"}) GROUP BY 1, 2""")
def format_of_files(spark, sf_dir):
    turns = _turns(spark, sf_dir)
    both = turns.groupBy("conv_id").agg(F.count_if(F.col("role") == "user").alias("u"), F.count_if(F.col("role") == "assistant").alias("a")).where("u >= 1 and a >= 1").select("conv_id")
    turns = turns.join(both, "conv_id")
    session = _files(turns.where("conv_id % 3 = 0"), _json(type=F.col("role"), message=F.struct(F.col("text").alias("content"))))
    kind = F.when(F.col("role") == "user", "user_message").otherwise("agent_message")
    events = _files(turns.where("conv_id % 3 = 1"), _json(type="event_msg", payload=F.struct(kind.alias("type"), F.col("text").alias("message"))), head='{"type": "session_meta"}\n')
    plain = _files(turns.where("conv_id % 3 = 2"), F.concat(F.lit("> "), "text"))
    return formats.normalised(session.unionByName(events).unionByName(plain)).select("path", "format")


LOG = "\n".join(["intro", "Welcome to Shell v1", "⏺ 9:05 AM Tuesday, March 5, 2024", "> ls -la", "> fix the {0} parser, please!", *["line"] * 8, "Welcome to Shell v1", "Press Ctrl+E to see previous messages", *["more"] * 9, "Welcome to Shell v1", "> short one here", *["tail"] * 10, "Welcome to Shell v1", "too short"])


@query("""SELECT doc_id || '.log' AS path, s AS session, CASE s WHEN 1 THEN 1 ELSE 24 END AS first_line, CASE s WHEN 1 THEN 23 ELSE 12 END AS lines, CASE s WHEN 1 THEN '2024-03-05_905AM' END AS stamp, CASE s WHEN 1 THEN 'fix-the-' || doc_id || '-parser-please' ELSE 'short-one-here' END AS subject FROM documents, (SELECT unnest([1, 2]) AS s)""")
def log_sessions(spark, sf_dir):
    i = F.col("doc_id").cast("string")
    files = t(spark, sf_dir, "documents").select(F.concat(i, F.lit(".log")).alias("path"), F.replace(F.lit(LOG), F.lit("{0}"), i).alias("text"))
    s = formats.sessions_of(files, "Shell v", ("Ctrl+E", "previous messages"))
    return s.select("path", "session", "first_line", "lines").join(formats.headers(s), ["path", "session"]).select("path", "session", "first_line", F.col("lines").cast("long").alias("lines"), "stamp", "subject")


@query("SELECT doc_id AS id, 'kept ' || doc_id || chr(10) || 'prose about <system-reminder> stays' || chr(10) || 'end' AS document FROM documents")
def noise_stripped(spark, sf_dir):
    i = F.col("doc_id").cast("string")
    noisy = F.concat(F.lit("> <system-reminder>\nhidden\n</system-reminder>\nCURRENT TIME: 10\nkept "), i, F.lit(" [12 tokens] (ctrl+o to expand)\nRan 2 Stop hooks today\nprose about <system-reminder> stays\n… +14 lines more\nend\n\n"))
    return t(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), memories.without_noise(noisy).alias("document"))


@query("SELECT lang, CASE WHEN lang = 'en' THEN TRUE ELSE FALSE END AS dialogue FROM documents WHERE lang IN ('en', 'de') GROUP BY 1")
def corpus_origin(spark, sf_dir):
    d = t(spark, sf_dir, "documents")
    out = []
    for lang in ("en", "de"):
        said = F.concat(F.substring("text", 1, 100), F.lit("\nuser: hello\nassistant: hi\n" if lang == "en" else "\nOpus 5 in C\n"))
        o = memories.origin(d.where(F.col("lang") == lang).select(said.alias("document")), ("LLM", "context window"), ("Opus",))
        out.append(o.select(F.lit(lang).alias("lang"), "dialogue"))
    return out[0].unionByName(out[1])
