"""The registry of people and projects: look-ups that read a word's context, and learning, version by version."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.locales import LOCALES, Locale
from ..functions.shared import small
from . import detection

# Names that are also common words, and what stands around a name or around a word that is none.
COMMON_WORDS = (
    "ever", "grace", "will", "bill", "mark", "april", "may", "june", "joy", "hope", "faith", "chance", "chase", "hunter", "dash", "flash", "star", "sky", "river",
    "brook", "lane", "art", "clay", "gil", "nat", "max", "rex", "ray", "jay", "rose", "violet", "lily", "ivy", "ash", "reed", "sage",
    "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday", "january", "february", "march", "july", "august", "september", "october", "november",
    "december",
)
PERSON_CONTEXTS = (
    r"\b{name}\s+said\b", r"\b{name}\s+told\b", r"\b{name}\s+asked\b", r"\b{name}\s+laughed\b", r"\b{name}\s+smiled\b", r"\b{name}\s+was\b", r"\b{name}\s+is\b",
    r"\b{name}\s+called\b", r"\b{name}\s+texted\b", r"\bwith\s+{name}\b", r"\bsaw\s+{name}\b", r"\bcalled\s+{name}\b", r"\btook\s+{name}\b", r"\bpicked\s+up\s+{name}\b",
    r"\bdrop(?:ped)?\s+(?:off\s+)?{name}\b", r"\b{name}(?:'s|s')\b", r"\bhey\s+{name}\b", r"\bthanks?\s+{name}\b", r"^{name}[:\s]",
    r"\bmy\s+(?:son|daughter|kid|child|brother|sister|friend|partner|colleague|coworker)\s+{name}\b",
)
CONCEPT_CONTEXTS = (
    r"\bhave\s+you\s+{name}\b", r"\bif\s+you\s+{name}\b", r"\b{name}\s+since\b", r"\b{name}\s+again\b", r"\bnot\s+{name}\b", r"\b{name}\s+more\b", r"\bwould\s+{name}\b",
    r"\bcould\s+{name}\b", r"\bwill\s+{name}\b", r"(?:the\s+)?{name}\s+(?:of|in|at|for|to)\b",
)

REGISTRY = "name string, aliases array<string>, source string, contexts array<string>, relationship string, confidence double, seen long, ambiguous boolean, version int"


def registry(people: DataFrame, version: int = 1) -> DataFrame:
    """People a user names (name; aliases, contexts, relationship where there are such columns) as a registry's first
    version. A name that is a common word, by itself or as an alias, is marked ambiguous."""
    column = lambda c, other: F.coalesce(c, other) if c in people.columns else other
    none = F.array().cast("array<string>")
    out = people.select(
        "name", column("aliases", none).alias("aliases"), F.lit("onboarding").alias("source"), column("contexts", F.array(F.lit("personal"))).alias("contexts"),
        column("relationship", F.lit("")).alias("relationship"), F.lit(1.0).alias("confidence"), F.lit(None).cast("long").alias("seen"), F.lit(version).alias("version"),
    )
    common = F.exists(F.concat(F.array("name"), "aliases"), lambda x: F.lower(x).isin(*COMMON_WORDS))
    return out.withColumn("ambiguous", common).select(*[c.split()[0] for c in REGISTRY.split(", ")])


def as_of(people: DataFrame, version: int) -> DataFrame:
    """The registry as it was at a version."""
    return people.where(F.col("version") <= version)


def votes(context: Column, word: Column, patterns: tuple[str, ...]) -> Column:
    """How many of the patterns the context, in lower case, matches with the word in place of {name}."""
    return _votes(F.lower(context), word, patterns)


def needed(pattern: str) -> str:
    """The longest word that each match of a pattern holds beside the name; empty if there is none."""
    plain = re.sub(r"\(\?:[^()]*\)\??|\[[^\]]*\]|\\[a-z]|\{name\}|\w\?", " ", pattern)
    return max(re.findall(r"\w+", plain), key=len, default="")


def _votes(low: Column, word: Column, patterns: tuple[str, ...]) -> Column:
    """`votes` of a context in lower case. A pattern holds the row's word, so each trial compiles it anew; a context
    without the pattern's own word isn't tried."""
    quoted = F.concat(F.lit("\\Q"), F.lower(word), F.lit("\\E"))
    parts = [(needed(p), *p.split("{name}")) for p in patterns]
    tried = F.array(*[F.struct(F.lit(w).alias("w"), F.lit("(?U)" + before).alias("before"), F.lit(after).alias("after")) for w, before, after in parts])
    return F.size(F.filter(tried, lambda p: F.contains(low, p["w"]) & F.rlike(low, F.concat(p["before"], quoted, p["after"]))))


def looked_up(words: DataFrame, people: DataFrame, projects: DataFrame, confirmed: DataFrame, ambiguous: tuple[str, ...] = COMMON_WORDS, unknown: bool = True) -> DataFrame:
    """Columns of `words` (word, context) with type, confidence, source, name and disambiguated.

    Without case: a person by name or alias (of several the one whose name comes first), else a project (name), else a
    confirmed finding (name, type, confidence), else unknown. If a person's name is ambiguous, the context votes: more
    patterns of people than of other words confirm the person, fewer make it a concept, and as many, or no context, leave
    it a person as registered. Only rows of ambiguous names are searched for patterns. Small tables of names go to the
    tasks that hold the words, so contexts stay where they are. Without `unknown`, words that no table holds are dropped
    before anything is asked of them.
    """
    called = people.select(F.explode(F.array_union(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("x"), "name", "source", "confidence")
    p = called.groupBy(F.lower("x").alias("k__")).agg(F.min(F.struct("name", "source", "confidence")).alias("p__"))
    j = projects.groupBy(F.lower("name").alias("k__")).agg(F.min("name").alias("j__"))
    c = confirmed.groupBy(F.lower("name").alias("k__")).agg(F.min(F.struct("type", "confidence")).alias("c__"))
    d = words.withColumn("k__", F.lower("word"))
    if not unknown:
        d = d.join(small(reduce(DataFrame.union, [x.select("k__") for x in (p, j, c)]).distinct()), "k__", "left_semi")
    d = d.join(small(p), "k__", "left").join(small(j), "k__", "left").join(small(c), "k__", "left")
    asks = F.col("p__").isNotNull() & F.col("k__").isin(*ambiguous) & (F.coalesce("context", F.lit("")) != "")
    d, low = d.withColumn("low__", F.when(asks, F.lower("context"))), F.col("low__")
    asked = low.isNotNull()
    d = d.withColumn("yes__", F.when(asked, _votes(low, F.col("word"), PERSON_CONTEXTS))).withColumn("no__", F.when(asked, _votes(low, F.col("word"), CONCEPT_CONTEXTS)))
    yes, no = F.col("yes__") > F.col("no__"), F.col("no__") > F.col("yes__")
    person = F.struct(F.lit("person").alias("type"), F.col("p__.confidence").alias("confidence"), F.col("p__.source").alias("source"), F.col("p__.name").alias("name"), F.lit(False).alias("disambiguated"))
    sure = F.struct(F.lit("person").alias("type"), F.least(F.lit(0.95), F.lit(0.7) + F.col("yes__") * 0.1).alias("confidence"), F.col("p__.source").alias("source"), F.col("word").alias("name"), F.lit(True).alias("disambiguated"))
    other = F.struct(F.lit("concept").alias("type"), F.least(F.lit(0.90), F.lit(0.7) + F.col("no__") * 0.1).alias("confidence"), F.lit("context_disambiguated").alias("source"), F.col("word").alias("name"), F.lit(True).alias("disambiguated"))
    project = F.struct(F.lit("project").alias("type"), F.lit(1.0).alias("confidence"), F.lit("onboarding").alias("source"), F.col("j__").alias("name"), F.lit(False).alias("disambiguated"))
    found = F.struct(F.col("c__.type").alias("type"), F.col("c__.confidence").cast("double").alias("confidence"), F.lit("wiki").alias("source"), F.col("word").alias("name"), F.lit(False).alias("disambiguated"))
    nothing = F.struct(F.lit("unknown").alias("type"), F.lit(0.0).alias("confidence"), F.lit("none").alias("source"), F.col("word").alias("name"), F.lit(False).alias("disambiguated"))
    told = F.when(yes, sure).when(no, other).when(F.col("p__").isNotNull(), person).when(F.col("j__").isNotNull(), project).when(F.col("c__").isNotNull(), found).otherwise(nothing)
    return d.select(*[F.col(f"`{x}`") for x in words.columns], told.alias("t__")).select(*[F.col(f"`{x}`") for x in words.columns], "t__.*")


def people_named(queries: DataFrame, people: DataFrame, ambiguous: tuple[str, ...] = COMMON_WORDS) -> DataFrame:
    """(query_id, name): the people whose name or alias stands in a query as a word, without case; one that is ambiguous
    only where the query's votes are for a person."""
    w = queries.select("query_id", F.col("query").alias("context"), F.explode(F.array_distinct(F.regexp_extract_all(F.lower("query"), F.lit(detection.WORD), 0))).alias("k__"))
    called = people.select("name", F.explode(F.array_union(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("x"))
    met = w.join(called.select("name", "x", F.lower("x").alias("k__")), "k__")
    asked = F.col("k__").isin(*ambiguous)
    fits = F.when(asked, votes(F.col("context"), F.col("x"), PERSON_CONTEXTS) > votes(F.col("context"), F.col("x"), CONCEPT_CONTEXTS)).otherwise(F.lit(True))
    return met.where(fits).select("query_id", "name").distinct()


def learned(people: DataFrame, projects: DataFrame, docs: DataFrame, version: int, least: float = 0.75, mode: str = "personal", locales: dict[str, Locale] = LOCALES) -> DataFrame:
    """The registry with the people that documents (id, document, lang) tell of and it doesn't know, as a new version.

    A name counts as known if a person or project bears it. Learning from the same documents again adds nothing. A name
    found in several languages is taken from where it is surest.
    """
    found = detection.detected(docs, 3, None, locales).where((F.col("type") == "person") & (F.col("confidence") >= least))
    known = people.select("name").unionByName(projects.select("name")).distinct()
    new = found.join(known, "name", "left_anti").groupBy("name").agg(F.max(F.struct("confidence", "n")).alias("x"))
    none = F.array().cast("array<string>")
    rows = new.select(
        "name", none.alias("aliases"), F.lit("learned").alias("source"), F.array(F.lit("personal" if mode == "combo" else mode)).alias("contexts"), F.lit("").alias("relationship"),
        F.col("x.confidence").alias("confidence"), F.col("x.n").alias("seen"), F.lower("name").isin(*COMMON_WORDS).alias("ambiguous"), F.lit(version).alias("version"),
    )
    return people.unionByName(rows)
