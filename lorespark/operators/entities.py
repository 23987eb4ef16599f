"""Entities and the pointer index: candidates, index lines, pointers, claims."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.shared import is_small
from ..functions.text import bound

WORD, NAME = r"[\p{L}\p{N}_]+", r"^\p{Lu}\p{Ll}{2,}$"


def names_in(text: Column) -> Column:
    """The capitalised words of a text, in order."""
    return F.filter(F.regexp_extract_all(text, F.lit(WORD), 0), lambda w: w.rlike(NAME))


def candidates(docs: DataFrame, least: int = 3, stop: tuple[str, ...] = ()) -> DataFrame:
    """Capitalised words of (document) that occur at least `least` times over the table: name, n."""
    words = docs.select(F.explode(names_in(F.col("document"))).alias("name"))
    if stop:
        words = words.where(~F.lower("name").isin(list(stop)))
    return words.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


#: Capitalised words that name nobody, and verbs that begin an action phrase.
NO_NAMES = (
    "The", "This", "That", "These", "Those", "When", "Where", "What", "Why", "Who", "Which", "How", "After", "Before", "Then", "Now",
    "Here", "There", "And", "But", "Or", "Yet", "So", "If", "Else", "Yes", "No", "Maybe", "Okay", "User", "Assistant", "System", "Tool",
    "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday", "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)
ACTIONS = ("built", "fixed", "wrote", "added", "pushed", "tested", "created", "decided", "migrated", "reviewed", "deployed", "configured", "removed", "updated")


def frequent_names(found: Column, least: int = 2, most: int = 5, stop: tuple[str, ...] = NO_NAMES) -> Column:
    """The names (from `names_in`, as a column of its own) that occur at least `least` times, most frequent first, then
    first seen first."""
    counted = F.transform(repeated_names(found, least, stop), lambda w: F.named_struct(F.lit("c"), -F.size(F.filter(found, lambda x: x == w)), F.lit("i"), F.array_position(found, w), F.lit("w"), w))
    return F.transform(F.slice(F.array_sort(counted), 1, most), lambda s: s["w"])


def repeated_names(found: Column, least: int = 2, stop: tuple[str, ...] = NO_NAMES) -> Column:
    """The names that occur at least `least` times, sorted: those that stand again `least` - 1 places on among the sorted."""
    often = bound(F.sort_array(found), lambda s: F.array_distinct(F.filter(s, lambda w, i: w == F.get(s, i + (least - 1)))))
    return F.filter(often, lambda w: ~w.isin(*stop)) if stop else often


def index_lines(sources: DataFrame, window: int = 5000, topics: int = 12, quotes: int = 3, actions: tuple[str, ...] = ACTIONS) -> DataFrame:
    """Pointer lines of each source (id or ids, wing, room, source_file, document): `topic|names|→ids`, with its first
    three ids.

    Topics are action phrases and headers, then quotes; without any, one line points to the scope and file.
    """
    ids = F.slice("ids", 1, 3) if "ids" in sources.columns else F.array("id")
    text = F.substring("document", 1, window)
    d = sources.select("*", text.alias("text_here"), names_in(text).alias("found_here"))
    heads = F.regexp_extract_all("text_here", F.lit(r"(?m)^#{1,3}\s+(.{5,60})$"), 1)
    done = F.regexp_extract_all("text_here", F.lit(r"(?i)((?:%s)\s+[\p{L}\p{N}_\s]{3,40})" % "|".join(actions)), 1) if actions else F.array().cast("array<string>")
    topic = F.slice(F.array_distinct(F.transform(F.concat(done, heads), lambda t: F.lower(F.regexp_replace(t, r"^\s+|\s+$", "")))), 1, topics)
    said = F.transform(F.slice(F.regexp_extract_all("text_here", F.lit('"([^"]{15,150})"'), 1), 1, quotes), lambda q: F.concat(F.lit('"'), q, F.lit('"')))
    file = F.substring(F.regexp_replace(F.element_at(F.split("source_file", "/"), -1), r"\.[^.]+$", ""), 1, 40)
    names = F.array_join(frequent_names(F.col("found_here")), ";")
    key = "ids" if "ids" in sources.columns else "id"
    d = d.select(key, "source_file", F.concat_ws("/", "wing", "room", file).alias("place"), F.concat(topic, said).alias("both"), names.alias("names"), F.array_join(F.transform(ids, lambda i: i.cast("string")), ",").alias("refs"))
    lines = F.when(F.size("both") > 0, F.col("both")).otherwise(F.array("place"))
    out = d.select(key, "source_file", "names", "refs", F.posexplode(lines).alias("line_no", "topic"))
    return out.withColumn("line", F.concat(F.col("topic"), F.lit("|"), F.col("names"), F.lit("|→"), F.col("refs"))).drop("refs")


def packed_lines(lines: Column, most: int = 1500) -> Column:
    """Lines into documents of at most `most` characters, greedily and unsplit: an array of documents."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("now"))
    put = lambda acc, x: F.when(acc["now"] == "", F.struct(acc["done"].alias("done"), x.alias("now"))).when(
        F.length(acc["now"]) + 1 + F.length(x) <= most, F.struct(acc["done"].alias("done"), F.concat(acc["now"], F.lit("\n"), x).alias("now"))
    ).otherwise(F.struct(F.concat(acc["done"], F.array(acc["now"])).alias("done"), x.alias("now")))
    return F.aggregate(lines, start, put, lambda acc: F.when(acc["now"] == "", acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["now"]))))


def pointers(text: Column) -> Column:
    """The ids that index lines point to, in order, each once."""
    lists = F.regexp_extract_all(text, F.lit(r"→([\w,]+)"), 1)
    return F.array_distinct(F.flatten(F.transform(lists, lambda s: F.split(s, ","))))


def claims(docs: DataFrame, roles: tuple[str, ...]) -> DataFrame:
    """(id, subject, predicate, object) of "X is Y's role" and "X's role is Y" (then Y has the role), in that order."""
    role = "|".join(roles)
    first, second = rf"(?i)\b(\w+) is (\w+)'s ({role})\b", rf"(?i)\b(\w+)'s ({role}) is (\w+)\b"
    cut = lambda p, groups: F.arrays_zip(*[F.regexp_extract_all("document", F.lit(p), g).alias(n) for n, g in groups.items()])
    a = docs.select("id", F.explode(cut(first, {"subject": 1, "object": 2, "predicate": 3})).alias("c"))
    b = docs.select("id", F.explode(cut(second, {"object": 1, "predicate": 2, "subject": 3})).alias("c"))
    get = lambda d: d.select("id", "c.subject", F.lower("c.predicate").alias("predicate"), "c.object")
    return get(a).unionByName(get(b))


def _ranked_words(texts: pd.Series, stop: frozenset[str], most: int) -> list[str]:
    """The most telling words of each text: a point for each time a word occurs, two more if it is capitalised, two more
    if it has an inner capital, an underscore or a hyphen; first seen first among equals."""
    out = []
    for text in texts:
        points: dict[str, int] = {}
        for w in TOPIC.findall(text or ""):
            low = w.lower()
            if low not in stop:
                points[low] = points.get(low, 0) + 1 + 2 * w[0].isupper() + 2 * ("_" in w or "-" in w or w[1:] != w[1:].lower())
        out.append("_".join(sorted(points, key=lambda w: -points[w])[:most]))
    return out


TOPIC = re.compile(r"[a-zA-Z][a-zA-Z_-]{2,}")


def topics(text: Column, stop: tuple[str, ...] = (), most: int = 3) -> Column:
    """The `most` most telling words of a text, joined by `_`. One pass over each text; nothing is shuffled."""
    no = frozenset(stop)

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(_ranked_words(texts, no, most))

    return run(text)


def compression(docs: DataFrame, stop: tuple[str, ...] = ()) -> DataFrame:
    """Per document: words, the token estimate max(1, floor(1.3 words)), and its topics."""
    n = F.size(F.filter(F.split("document", r"\s+"), lambda w: w != ""))
    return docs.select("id", n.cast("long").alias("words"), F.greatest(F.lit(1), F.floor(n * 1.3)).cast("long").alias("tokens"), topics(F.col("document"), stop).alias("topics"))


def compression_totals(pairs: DataFrame) -> DataFrame:
    """Characters before and after, and their ratio, of (document, compressed)."""
    d = pairs.agg(F.sum(F.length("document")).alias("before"), F.sum(F.length("compressed")).alias("after"))
    return d.withColumn("ratio", F.col("before") / F.greatest(F.col("after"), F.lit(1)))


def signals(text: Column, table: dict[str, str], most: int = 3) -> Column:
    """The first `most` different codes, in the table's order, whose keyword occurs in the text."""
    low = F.lower(text)
    hit = F.filter(F.array(*[F.when(F.contains(low, F.lit(k)), F.lit(c)) for k, c in table.items()]), lambda x: x.isNotNull())
    return F.slice(F.array_distinct(hit), 1, most)


#: Words that mark a decision or an insight.
WEIGHTY = ("decided", "because", "instead", "prefer", "switched", "chose", "realized", "important", "key", "critical", "discovered", "learned", "conclusion", "solution", "reason", "why", "breakthrough", "insight")


def key_sentence(text: Column, longest: int = 55) -> Column:
    """The sentence of more than ten characters with most weighty words, short ones preferred, the first of equals; cut
    at `longest`. Empty if there is none."""
    parts = F.filter(F.transform(F.split(text, r"[.!?\n]+"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), lambda x: F.length(x) > 10)

    def score(x: Column) -> Column:
        low = F.lower(x)
        words = sum((F.when(F.contains(low, F.lit(w)), 2).otherwise(0) for w in WEIGHTY), F.lit(0))
        return words + F.when(F.length(x) < 80, 1).otherwise(0) + F.when(F.length(x) < 40, 1).otherwise(0) - F.when(F.length(x) > 150, 2).otherwise(0)

    best = F.array_max(F.transform(parts, lambda x, i: F.struct(score(x).alias("s"), (-i).alias("i"), x.alias("x"))))["x"]
    return F.coalesce(F.when(F.length(best) > longest, F.concat(F.substring(best, 1, longest - 3), F.lit("..."))).otherwise(best), F.lit(""))


def entity_code(name: Column, known: dict[str, str] | None = None) -> Column:
    """The known code of a name, else its first three letters in capitals."""
    code = F.upper(F.substring(name, 1, 3))
    if not known:
        return code
    return F.coalesce(F.create_map(*[F.lit(x) for kv in known.items() for x in (kv[0].lower(), kv[1])])[F.lower(name)], code)


def name_codes(text: Column, stop: tuple[str, ...], most: int = 3) -> Column:
    """Codes of the capitalised words of a text that don't begin it, each once, in order."""
    words = F.transform(F.filter(F.split(text, r"\s+"), lambda w: w != ""), lambda w: F.regexp_replace(w, "[^a-zA-Z]", ""))
    later = F.filter(F.slice(words, 2, 1 << 30), lambda w: w.rlike("^[A-Z][a-z]+$") & ~F.lower(w).isin(*stop))
    return F.slice(F.array_distinct(F.transform(later, lambda w: F.upper(F.substring(w, 1, 3)))), 1, most)


def shorthand(docs: DataFrame, emotions: dict[str, str], flags: dict[str, str], stop: tuple[str, ...] = ("the",)) -> DataFrame:
    """(id, line): each document as `0:NAMES|topics|"key sentence"|emotions|flags`, lossy; parts that are empty are left
    out."""
    d = docs.select("id", F.coalesce("document", F.lit("")).alias("document"))
    d = d.select("id", name_codes(F.col("document"), stop).alias("n"), topics(F.col("document"), stop).alias("t"), key_sentence(F.col("document")).alias("q"), signals(F.col("document"), emotions).alias("e"), signals(F.col("document"), flags).alias("f"))
    some = lambda c: F.when(F.size(c) > 0, F.array_join(c, "+"))
    names = F.concat(F.lit("0:"), F.coalesce(some("n"), F.lit("???")))
    topic = F.when(F.col("t") == "", "misc").otherwise(F.col("t"))
    quote = F.when(F.col("q") != "", F.concat(F.lit('"'), F.col("q"), F.lit('"')))
    return d.select("id", F.concat_ws("|", names, topic, quote, some("e"), some("f")).alias("line"))


def decoded(lines: DataFrame) -> DataFrame:
    """(id, names, topics, quote) back from `shorthand` lines."""
    parts = F.split("line", r"\|")
    quote = F.regexp_extract("line", r'\|"(.*)"', 1)
    return lines.select("id", F.split(F.regexp_replace(F.get(parts, F.lit(0)), "^0:", ""), r"\+").alias("names"), F.split(F.get(parts, F.lit(1)), "_").alias("topics"), quote.alias("quote"))


def metadata_names(text: Column, found: Column, known: tuple[str, ...] = (), most: int = 25) -> Column:
    """Known names that stand in the text as words, and its own that occur twice and are longer than two letters; sorted,
    at most `most`, joined by `;`. found: `names_in` of the text."""
    there = [F.when(text.rlike(r"(?<![\p{L}\p{N}_])" + re.escape(n) + r"(?![\p{L}\p{N}_])"), F.lit(n)) for n in known]
    seen = F.filter(F.array(*there), lambda x: x.isNotNull()) if there else F.array().cast("array<string>")
    own = F.filter(repeated_names(found), lambda w: F.length(w) > 2)
    return F.array_join(F.slice(F.array_sort(F.array_union(seen, own)), 1, most), ";")


def looked_up(words: DataFrame, people: DataFrame, projects: DataFrame, confirmed: DataFrame) -> DataFrame:
    """(word, type): each word against people and their aliases, then projects, then confirmed findings, without case;
    else unknown. people: name, aliases (array<string>); projects: name; confirmed: name, type."""
    w = words.select("word", F.lower("word").alias("k"))
    p = people.select(F.explode(F.array_union(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("x")).select(F.lower("x").alias("k"), F.lit("person").alias("person")).distinct()
    j = projects.select(F.lower("name").alias("k"), F.lit("project").alias("project")).distinct()
    c = confirmed.groupBy(F.lower("name").alias("k")).agg(F.min("type").alias("found"))
    out = w.join(p, "k", "left").join(j, "k", "left").join(c, "k", "left")
    return out.select("word", F.coalesce("person", "project", "found", F.lit("unknown")).alias("type"))


def reclassified(found: DataFrame, personas: DataFrame) -> DataFrame:
    """People and uncertain names that are personas of the dialogue's software (name) become `persona`."""
    p = personas.select(F.lower("name").alias("k"), F.lit(True).alias("is_persona")).distinct()
    moved = F.col("is_persona") & F.col("type").isin("person", "uncertain")
    return found.withColumn("k", F.lower("name")).join(p, "k", "left").withColumn("type", F.when(moved, "persona").otherwise(F.col("type"))).drop("k", "is_persona")


def people_in(queries: DataFrame, people: DataFrame) -> DataFrame:
    """(query_id, name): the people whose name or alias stands in a query as a word, without case."""
    w = queries.select("query_id", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("query"), F.lit(WORD), 0))).alias("k"))
    p = people.select("name", F.explode(F.array_union(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("x")).select("name", F.lower("x").alias("k"))
    return w.join(p, "k").select("query_id", "name").distinct()


def unknown_words(queries: DataFrame, known: DataFrame) -> DataFrame:
    """(query_id, word): capitalised words of queries that are no known name (name)."""
    w = queries.select("query_id", F.explode(F.array_distinct(names_in(F.col("query")))).alias("word")).where(~F.col("word").isin(*NO_NAMES))
    return w.withColumn("k", F.lower("word")).join(known.select(F.lower("name").alias("k")), "k", "left_anti").select("query_id", "word")


def registry_union(first: DataFrame, second: DataFrame) -> DataFrame:
    """(category, name) of both, each once without case, the first table's spelling before the second's, then the
    smaller."""
    both = first.select("category", "name", F.lit(0).alias("o")).unionByName(second.select("category", "name", F.lit(1).alias("o")))
    return both.groupBy("category", F.lower("name").alias("k")).agg(F.min(F.struct("o", "name")).alias("x")).select("category", F.col("x.name").alias("name"))


def merged(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """Detected names (name, type) of both; where both have one, without case, the primary's type stays."""
    k = secondary.withColumn("k", F.lower("name")).join(primary.select(F.lower("name").alias("k")), "k", "left_anti").drop("k")
    return primary.select("name", "type").unionByName(k.select("name", "type"))


def context_lines(docs: DataFrame, names: DataFrame, most: int = 3) -> DataFrame:
    """(name, place, line): the first `most` different lines, by document and position, that hold each name as a word.

    Only digests of lines meet the names; the lines themselves are read again for the places that remain. A small table
    of names goes to the tasks that read the documents, and a larger one meets words with digests.
    """
    n = names.select("name").distinct()
    few = is_small(n)
    lines = docs.select("id", F.posexplode(F.split("document", "\n")).alias("pos", "line")).withColumn("line", F.trim("line"))
    words = lines.select("id", "pos", F.md5("line").alias("digest"), F.explode(F.array_distinct(F.regexp_extract_all("line", F.lit(WORD), 0))).alias("name"))
    once = words.join(F.broadcast(n) if few else n, "name").groupBy("name", "digest").agg(F.min(F.struct("id", "pos")).alias("at"))
    first = once.withColumn("place", F.row_number().over(Window.partitionBy("name").orderBy("at"))).where(F.col("place") <= most)
    first = first.select("name", "place", "digest", "at.id", "at.pos")
    line = F.trim(F.get(F.split("document", "\n"), F.col("pos")))
    found = docs.join(F.broadcast(first) if few else first, "id").select("name", "place", "digest", line.alias("line"))
    return found.where(F.md5("line") == F.col("digest")).select("name", "place", "line").distinct()  # rows may share an id
