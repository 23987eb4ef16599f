"""Chat exports of several kinds, and terminal logs, to transcripts. Every reader takes whole files (path, text) and gives
turns (path, conv, pos, role, text) or rows of its own; `normalised` picks the first that fits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip
from ..operators.memories import without_noise

# How much of a tool's call and result is kept, and what marks a chat export's end.
ENDS, MATCHES, CALL, RESULT = 20, 20, 200, 2048
CHAT_FOOTER = "\n[source: slack-export | multi-party chat — speaker roles are positional, not verified]"
THREAD_BREAK = "\n\n<<<TRANSCRIPT_BOUNDARY>>>\n\n"
QUIET_TOOLS = ("Read", "Edit", "Write")


def json_lines(files: DataFrame) -> DataFrame:
    """(path, pos, line): the lines that hold a JSON object."""
    lines = files.select("path", F.posexplode(F.split("text", "\n")).alias("pos", "line")).withColumn("line", strip(F.col("line")))
    return lines.where(F.col("line").startswith("{") & F.get_json_object("line", "$").isNotNull())


def _at(c: Column | str, path: str) -> Column:
    return F.get_json_object(c, path)


def _list(c: Column) -> Column:
    """The items of a JSON list as JSON texts; null for anything else. Strings keep their quotation marks off."""
    return F.when(F.ltrim(c).startswith("["), F.from_json(c, "array<string>"))


def call_text(name: Column, given: Column) -> Column:
    """One line for a tool's call."""
    arg = lambda k: F.coalesce(_at(given, f"$.{k}"), F.lit(""))
    cut = lambda c: F.when(F.length(c) > CALL, F.concat(F.substring(c, 1, CALL), F.lit("..."))).otherwise(c)
    path, offset, limit = F.coalesce(_at(given, "$.file_path"), F.lit("?")), _at(given, "$.offset"), _at(given, "$.limit")
    upto = F.coalesce((offset.try_cast("long") + limit.try_cast("long")).cast("string"), F.lit(""))
    span = F.when(upto != "", F.concat(F.lit(":"), offset, F.lit("-"), upto)).otherwise(F.concat(F.lit(":"), offset, F.lit("+"), limit))
    read = F.concat(F.lit("[Read "), path, F.when(offset.isNotNull() & limit.isNotNull(), span).otherwise(""), F.lit("]"))
    where = F.coalesce(F.nullif(_at(given, "$.path"), F.lit("")), F.nullif(_at(given, "$.glob"), F.lit("")), F.lit(""))
    return (
        F.when(name == "Bash", F.concat(F.lit("[Bash] "), cut(arg("command"))))
        .when(name == "Read", read)
        .when(name == "Grep", F.concat(F.lit("[Grep] "), arg("pattern"), F.lit(" in "), where))
        .when(name == "Glob", F.concat(F.lit("[Glob] "), arg("pattern")))
        .when(name.isin("Edit", "Write"), F.concat(F.lit("["), name, F.lit(" "), path, F.lit("]")))
        .otherwise(F.concat(F.lit("["), name, F.lit("] "), cut(F.coalesce(given, F.lit("{}")))))
    )


def result_text(name: Column, text: Column) -> Column:
    """A tool's result behind arrows: head and tail of a shell's, the first matches of a search, nothing of a file tool's,
    the beginning of anything else. Null where nothing is kept."""
    t = strip(text)
    lines = F.split(t, "\n")
    n = F.size(lines)
    arrows = lambda a: F.concat(F.lit("→ "), F.array_join(a, "\n→ "))
    ends = F.concat(arrows(F.slice(lines, 1, ENDS)), F.format_string("\n→ ... [%d lines omitted] ...\n", n - 2 * ENDS), arrows(F.slice(lines, -ENDS, ENDS)))
    shell = F.when(n <= 2 * ENDS, arrows(lines)).otherwise(ends)
    found = F.when(n <= MATCHES, arrows(lines)).otherwise(F.concat(arrows(F.slice(lines, 1, MATCHES)), F.format_string("\n→ ... [%d more matches]", n - MATCHES)))
    other = F.when(F.length(t) > RESULT, F.concat(F.lit("→ "), F.substring(t, 1, RESULT), F.format_string("... [truncated, %d chars]", F.length(t)))).otherwise(F.concat(F.lit("→ "), t))
    return F.when((t != "") & ~name.isin(*QUIET_TOOLS), F.when(name == "Bash", shell).when(name.isin("Grep", "Glob"), found).otherwise(other))


def plain_content(content: Column) -> Column:
    """The text of a message without tools: a string, the text blocks of a list, or a block's text."""
    blocks = F.transform(_list(content), lambda b: F.when(b.startswith("{"), F.when(_at(b, "$.type") == "text", _at(b, "$.text"))).otherwise(b))
    some = F.filter(blocks, lambda b: b.isNotNull() & (b != ""))
    return strip(F.when(F.ltrim(content).startswith("["), F.array_join(some, "\n")).when(F.ltrim(content).startswith("{"), _at(content, "$.text")).otherwise(content))


def _enough(turns: DataFrame) -> DataFrame:
    """Turns of conversations of at least two."""
    n = F.count(F.lit(1)).over(Window.partitionBy("path", "conv"))
    return turns.withColumn("n__", n).where("n__ >= 2").drop("n__")


def session_turns(files: DataFrame) -> DataFrame:
    """Turns of an assistant's session log: content blocks as text, a tool's calls and results within the turn of the
    assistant that used it, noise taken out of each message by itself."""
    kind = _at("line", "$.type")
    m = json_lines(files).select("path", "pos", kind.alias("type"), _at("line", "$.message.content").alias("content")).where(F.col("type").isin("user", "human", "assistant"))
    whole = F.array(F.to_json(F.struct(F.lit("text").alias("type"), F.coalesce("content", F.lit("")).alias("text"))))
    listed = F.ltrim("content").startswith("[")
    b = m.select("path", "pos", "type", F.posexplode_outer(F.when(listed, _list(F.col("content"))).otherwise(whole)).alias("at", "b"))
    b = b.withColumn("kind", F.when(F.col("b").startswith("{"), _at("b", "$.type")).otherwise("text"))
    names = b.where("type = 'assistant' and kind = 'tool_use'").select("path", _at("b", "$.id").alias("tool"), F.coalesce(_at("b", "$.name"), F.lit("Unknown")).alias("name")).dropDuplicates(["path", "tool"])
    b = b.withColumn("tool", F.when(F.col("kind") == "tool_result", _at("b", "$.tool_use_id"))).join(names, ["path", "tool"], "left")
    inner = _at("b", "$.content")
    given = F.when(F.ltrim(inner).startswith("["), F.array_join(F.filter(F.transform(_list(inner), lambda x: F.when(x.startswith("{"), F.when(_at(x, "$.type") == "text", _at(x, "$.text"))).otherwise(x)), lambda x: x.isNotNull()), "\n")).otherwise(F.coalesce(inner, F.lit("")))
    text = F.when(F.col("kind") == "text", F.when(F.col("b").startswith("{"), _at("b", "$.text")).otherwise(F.col("b")))
    text = F.coalesce(text, F.when(F.col("kind") == "tool_use", call_text(F.coalesce(_at("b", "$.name"), F.lit("Unknown")), _at("b", "$.input"))), F.when(F.col("kind") == "tool_result", result_text(F.coalesce("name", F.lit("Unknown")), given)))
    b = b.select("path", "pos", "type", "at", "kind", text.alias("text"))
    said = F.sort_array(F.collect_list(F.when(F.col("text") != "", F.struct("at", "text"))))
    g = b.groupBy("path", "pos", "type").agg(said.alias("s"), F.min((F.coalesce("kind", F.lit("")) == "tool_result").cast("int")).alias("tools"))
    role = F.when(F.col("type") == "assistant", "assistant").when(F.col("tools") == 1, "tool").otherwise("user")
    g = g.select("path", "pos", role.alias("role"), without_noise(strip(F.array_join(F.transform("s", lambda x: x["text"]), "\n"))).alias("text")).where("text <> ''")
    before = Window.partitionBy("path").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("path").orderBy("pos")
    g = g.withColumn("last", F.last(F.when(F.col("role") != "tool", F.col("role")), True).over(before))
    g = g.where("role <> 'tool' or last = 'assistant'")
    starts = (F.col("role") == "user") | ((F.col("role") == "assistant") & ~(F.coalesce("last", F.lit("")) == "assistant"))
    g = g.withColumn("turn", F.sum(starts.cast("int")).over(upto))
    t = g.groupBy("path", "turn").agg(F.min_by("role", "pos").alias("role"), F.sort_array(F.collect_list(F.struct("pos", "text"))).alias("s"))
    return _enough(t.select("path", F.lit(0).alias("conv"), F.col("turn").cast("int").alias("pos"), "role", F.array_join(F.transform("s", lambda x: x["text"]), "\n").alias("text")))


def event_turns(files: DataFrame) -> DataFrame:
    """Turns of an event log: user and agent messages of files with a session_meta record."""
    d = json_lines(files).select("path", "pos", _at("line", "$.type").alias("type"), _at("line", "$.payload.type").alias("of"), strip(_at("line", "$.payload.message")).alias("text"))
    d = d.withColumn("meta", F.max((F.col("type") == "session_meta").cast("int")).over(Window.partitionBy("path")))
    role = F.when(F.col("of") == "user_message", "user").when(F.col("of") == "agent_message", "assistant")
    d = d.where("meta = 1 and type = 'event_msg' and text <> ''").select("path", F.lit(0).alias("conv"), "pos", role.alias("role"), "text").where("role is not null")
    return _enough(d)


def stream_turns(files: DataFrame) -> DataFrame:
    """Turns of a message stream: user and gemini records after the first session_metadata record, with their text
    blocks."""
    d = json_lines(files).select("path", "pos", _at("line", "$.type").alias("type"), _at("line", "$.content").alias("content"))
    d = d.withColumn("from", F.min(F.when(F.col("type") == "session_metadata", F.col("pos"))).over(Window.partitionBy("path")))
    parts = F.filter(F.transform(_list(F.col("content")), lambda b: _at(b, "$.text")), lambda x: x.isNotNull() & x.rlike(r"\S"))
    role = F.when(F.col("type") == "user", "user").otherwise("assistant")
    d = d.where(F.col("type").isin("user", "gemini") & (F.col("pos") > F.col("from")) & (F.size(parts) > 0))
    return _enough(d.select("path", F.lit(0).alias("conv"), "pos", role.alias("role"), F.array_join(parts, "\n").alias("text")))


def export_turns(files: DataFrame) -> DataFrame:
    """Turns of an export: one list of messages (under messages or chat_messages, or bare), or a list of conversations
    that hold one each."""
    held = lambda c: F.coalesce(_list(_at(c, "$.chat_messages")), _list(_at(c, "$.messages")))
    top = F.when(F.ltrim("text").startswith("["), _list(F.col("text"))).otherwise(F.coalesce(_list(_at("text", "$.messages")), _list(_at("text", "$.chat_messages"))))
    d = files.select("path", top.alias("items")).where("size(items) > 0")
    many = held(F.get("items", F.lit(0))).isNotNull()
    convs = F.when(many, F.transform("items", held)).otherwise(F.array("items"))
    d = d.select("path", F.posexplode(convs).alias("conv", "ms")).select("path", "conv", F.posexplode("ms").alias("pos", "m"))
    who = F.coalesce(F.nullif(_at("m", "$.role"), F.lit("")), _at("m", "$.sender"))
    role = F.when(who.isin("user", "human"), "user").when(who.isin("assistant", "ai"), "assistant")
    text = F.coalesce(F.nullif(plain_content(_at("m", "$.content")), F.lit("")), strip(_at("m", "$.text")))
    return _enough(d.select("path", "conv", "pos", role.alias("role"), text.alias("text")).where("role is not null and text <> ''"))


def tree_turns(files: DataFrame) -> DataFrame:
    """Turns of exported message trees: from `current_node` up by parents, or, without one, from the root down by first
    children. A node is visited once."""
    convs = F.when(F.ltrim("text").startswith("["), _list(F.col("text"))).otherwise(F.array("text"))
    d = files.select("path", F.posexplode(convs).alias("conv", "c"))
    d = d.select("path", "conv", F.from_json(_at("c", "$.mapping"), "map<string,string>").alias("nodes"), _at("c", "$.current_node").alias("now")).where("size(nodes) > 0")
    nothing = F.array().cast("array<string>")

    def walk(start: Column, step) -> Column:
        go = lambda acc, _: F.when(acc["at"].isNull() | F.array_contains(acc["path"], acc["at"]) | ~F.coalesce(F.map_contains_key("nodes", acc["at"]), F.lit(False)), acc).otherwise(
            F.struct(F.concat(acc["path"], F.array(acc["at"])).alias("path"), step(F.col("nodes")[acc["at"]]).alias("at"))
        )
        return F.aggregate(F.sequence(F.lit(1), F.size("nodes")), F.struct(nothing.alias("path"), start.alias("at")), go)["path"]

    roots = F.filter(F.map_entries("nodes"), lambda x: _at(x["value"], "$.parent").isNull())
    bare = F.filter(roots, lambda x: _at(x["value"], "$.message").isNull())
    root = F.when(F.size(bare) > 0, F.get(bare, F.lit(0))["key"]).when(F.size(roots) > 0, F.get(roots, F.lit(0))["key"])
    up = F.reverse(walk(F.col("now"), lambda n: _at(n, "$.parent")))
    down = walk(root, lambda n: _at(n, "$.children[0]"))
    known = F.coalesce(F.map_contains_key("nodes", F.col("now")), F.lit(False))
    d = d.select("path", "conv", "nodes", F.posexplode(F.when(known, up).otherwise(down)).alias("pos", "node")).withColumn("n", F.col("nodes")[F.col("node")])
    role = _at("n", "$.message.author.role")
    parts = F.filter(_list(_at("n", "$.message.content.parts")), lambda x: x.isNotNull() & (x != "") & ~x.startswith("{"))
    text = strip(F.array_join(parts, "\n"))
    return _enough(d.select("path", "conv", "pos", role.alias("role"), text.alias("text")).where(F.col("role").isin("user", "assistant") & (F.col("text") != "")))


def chat_turns(files: DataFrame) -> DataFrame:
    """Turns of a workspace's chat export: a new speaker takes the role that the last message didn't have, the first one
    the user's; every text has its speaker before it."""
    d = files.select("path", F.posexplode(_list(F.col("text"))).alias("pos", "m")).where(_at("m", "$.type") == "message")
    who = strip(F.regexp_replace(F.coalesce(_at("m", "$.user"), _at("m", "$.username"), F.lit("")), r"[\[\]\n\r\x00-\x1f]", "_"))
    d = d.select("path", "pos", who.alias("who"), strip(F.coalesce(_at("m", "$.text"), F.lit(""))).alias("text")).where("who <> '' and text <> ''")
    g = d.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("pos", "who", "text"))).alias("s"))
    none = F.create_map().cast("map<string,string>")

    def step(acc, x):
        other = F.when(acc["last"] == "user", "assistant").otherwise("user")
        role = F.coalesce(acc["roles"][x["who"]], other)
        roles = F.when(F.map_contains_key(acc["roles"], x["who"]), acc["roles"]).otherwise(F.map_concat(acc["roles"], F.create_map(x["who"], role)))
        turn = F.struct(x["pos"].alias("pos"), role.alias("role"), F.concat(F.lit("["), x["who"], F.lit("] "), x["text"]).alias("text"))
        return F.struct(roles.alias("roles"), role.alias("last"), F.concat(acc["out"], F.array(turn)).alias("out"))

    start = F.struct(none.alias("roles"), F.lit("").alias("last"), F.array().cast("array<struct<pos:int,role:string,text:string>>").alias("out"))
    out = g.select("path", F.explode(F.aggregate("s", start, step)["out"]).alias("t"))
    return _enough(out.select("path", F.lit(0).alias("conv"), "t.pos", "t.role", "t.text"))


def rendered(turns: DataFrame, footer: str = "") -> DataFrame:
    """(path, transcript): user lines behind `> `, each followed by the assistant's next text, a blank line after; the
    conversations of one file with a break between them."""
    w = Window.partitionBy("path", "conv").orderBy("pos")
    alone = F.coalesce(F.lead("role").over(w), F.lit("")) != "assistant"
    line = F.when(F.col("role") == "user", F.concat(F.lit("> "), "text", F.when(alone, "\n").otherwise(""))).otherwise(F.concat("text", F.lit("\n")))
    said = turns.withColumn("line", line).groupBy("path", "conv").agg(F.sort_array(F.collect_list(F.struct("pos", "line"))).alias("s"))
    said = said.select("path", "conv", F.concat(F.array_join(F.transform("s", lambda x: x["line"]), "\n"), F.lit(footer)).alias("t"))
    return said.groupBy("path").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("conv", "t"))), lambda x: x["t"]), THREAD_BREAK).alias("transcript"))


READERS = (("session", session_turns, ""), ("events", event_turns, ""), ("stream", stream_turns, ""), ("export", export_turns, ""), ("tree", tree_turns, ""), ("chat", chat_turns, CHAT_FOOTER))


def normalised(files: DataFrame) -> DataFrame:
    """(path, format, transcript): each file by the first reader that finds two turns in it. Texts with at least three
    lines that begin with `>`, and those that no reader knows, stay as they are (format text)."""
    quoted = F.size(F.filter(F.split("text", "\n"), lambda x: strip(x).startswith(">"))) >= 3
    looks = F.lower("path").rlike(r"\.jsonl?$") | F.ltrim("text").rlike(r"^\s*[{\[]")
    tried = files.where(~quoted & looks)
    found = [rendered(read(tried), footer).select("path", F.lit(i).alias("o"), F.lit(name).alias("format"), "transcript") for i, (name, read, footer) in enumerate(READERS)]
    best = reduce(DataFrame.unionByName, found).groupBy("path").agg(F.min(F.struct("o", "format", "transcript")).alias("x"))
    return files.join(best, "path", "left").select("path", F.coalesce("x.format", F.lit("text")).alias("format"), F.coalesce("x.transcript", "text").alias("transcript"))


def sessions_of(files: DataFrame, banner: str, restored: tuple[str, ...], ahead: int = 6, least: int = 10) -> DataFrame:
    """(path, session, first_line, lines, text): a terminal log in sessions. A line with the banner begins one unless it
    or the next lines tell of a restored session; sessions of fewer than `least` lines are dropped."""
    lines = files.select("path", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    w = Window.partitionBy("path").orderBy("pos")
    near = F.array_join(F.collect_list("line").over(w.rowsBetween(0, ahead - 1)), "\n")
    again = reduce(lambda a, b: a | b, (F.contains(near, F.lit(x)) for x in restored), F.lit(False))
    lines = lines.withColumn("starts", F.contains("line", F.lit(banner)) & ~again)
    lines = lines.withColumn("session", F.sum(F.col("starts").cast("int")).over(w)).where("session > 0")
    g = lines.groupBy("path", "session").agg(F.min("pos").alias("first_line"), F.count(F.lit(1)).alias("lines"), F.sort_array(F.collect_list(F.struct("pos", "line"))).alias("s"))
    return g.where(F.col("lines") >= least).select("path", "session", "first_line", "lines", F.array_join(F.transform("s", lambda x: x["line"]), "\n").alias("text"))


MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
SHELL = r"^(\./|cd |ls |python|bash|git |cat |source |export |claude|./activate)"


def headers(sessions: DataFrame, people: tuple[str, ...] = ()) -> DataFrame:
    """(path, session, stamp, people, subject) of `sessions_of`: the first time in 50 lines, known names in 100 lines, and
    the first prompt of more than five characters that is no shell command, as a file name (`session` without one)."""
    lines = F.split("text", "\n")
    time = r"⏺\s+(\d{1,2}):(\d{2})\s+([AP]M)\s+\w+,\s+(\w+)\s+(\d{1,2}),\s+(\d{4})"
    first = F.get(F.filter(F.slice(lines, 1, 50), lambda x: x.rlike(time)), F.lit(0))
    g = lambda i: F.regexp_extract(first, time, i)
    month = F.lpad(F.array_position(F.array(*[F.lit(m) for m in MONTHS]), g(4)).cast("string"), 2, "0")
    stamp = F.when(first.isNotNull(), F.concat(g(6), F.lit("-"), month, F.lit("-"), F.lpad(g(5), 2, "0"), F.lit("_"), g(1), g(2), g(3)))
    text = F.array_join(F.slice(lines, 1, 100), "\n")
    found = F.filter(F.array(*[F.when(text.rlike(rf"(?i)\b{p}\b"), F.lit(p)) for p in sorted(people)]), lambda x: x.isNotNull()) if people else F.array().cast("array<string>")
    prompts = F.filter(F.transform(F.filter(lines, lambda x: x.startswith("> ")), lambda x: strip(F.substring(x, 3, 1 << 30))), lambda x: (F.length(x) > 5) & ~x.rlike(SHELL))
    subject = F.regexp_replace(strip(F.regexp_replace(F.get(prompts, F.lit(0)), r"[^\p{L}\p{N}_\s-]", "")), r"\s+", "-")
    return sessions.select("path", "session", stamp.alias("stamp"), F.array_join(found, ",").alias("people"), F.coalesce(F.substring(subject, 1, 60), F.lit("session")).alias("subject"))
