"""Cleaning of queries and checks of names and contents, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bound, strip

# Lengths that a query, a part of it, a name and a content may have.
SAFE, LONGEST, SHORTEST = 200, 250, 10
NAME_LENGTH, CONTENT_LENGTH = 128, 100_000
SENTENCES, ASKS = r"[.!?。！？\n]+", r"[?？]\s*[\"']?\s*$"


def unquoted(c: Column) -> Column:
    """Without the quotation marks that wrap a text, in pairs or at either end."""
    for _ in range(3):  # pairs within pairs
        c = strip(F.regexp_replace(c, r"^(['\"])(.*)\1$", "$2"))
    return strip(F.regexp_replace(strip(F.regexp_replace(c, r"^['\"]", "")), r"['\"]$", ""))


def _fitting(c: Column) -> Column:
    """A candidate of at most LONGEST characters: itself, the last of its sentences that fits, or its end."""

    def cut(c: Column) -> Column:
        parts = F.transform(F.filter(F.split(c, SENTENCES), lambda x: x.rlike(r"\S")), unquoted)
        fit = bound(F.filter(parts, lambda x: F.length(x).between(SHORTEST, LONGEST)), lambda f: F.when(F.size(f) > 0, F.element_at(f, -1)))
        return F.when(F.length(c) <= LONGEST, c).otherwise(F.coalesce(fit, strip(F.substring(c, -LONGEST, LONGEST))))

    return bound(unquoted(c), cut)


def clean_query(raw: Column) -> Column:
    """struct<clean_query, was_sanitized, original_length, clean_length, method> of a query that may have prompt text
    before it: short ones pass; else the last line that asks, or sentence with a question mark; else the last line long
    enough; else the end. The text, its lines and the candidates are computed once each."""
    text = F.coalesce(raw, F.lit(""))
    bare = strip(text)
    return bound(F.struct(F.when(bare == "", text).otherwise(bare).alias("q"), (bare == "").alias("blank")), lambda x: _cleaned(x["q"], x["blank"]))


def _cleaned(q: Column, blank: Column) -> Column:
    short = blank | (F.length(q) <= SAFE)

    def candidates(lines: Column) -> Column:
        asking = F.filter(lines, lambda x: x.rlike(ASKS))
        # Sentences lose their marks when they are cut, so only lines can ask with one inside.
        last = lambda found: F.when(F.size(found) > 0, F.element_at(found, -1))
        question = bound(bound(asking, last), lambda x: F.when(F.length(x) >= SHORTEST, F.when(F.length(x) > LONGEST, _fitting(x)).otherwise(x)))
        tails = F.filter(F.transform(F.filter(lines, lambda x: F.length(x) >= SHORTEST), _fitting), lambda x: F.length(x) >= SHORTEST)
        return F.struct(question.alias("question"), bound(tails, last).alias("tail"))

    def told(found: Column) -> Column:
        question, tail = found["question"], found["tail"]
        clean = F.coalesce(question, tail, strip(F.substring(q, -LONGEST, LONGEST)))
        method = F.when(question.isNotNull(), "question_extraction").when(tail.isNotNull(), "tail_sentence").otherwise("tail_truncation")
        return bound(clean, lambda c: F.struct(c.alias("clean_query"), F.lit(True).alias("was_sanitized"), F.length(q).alias("original_length"), F.length(c).alias("clean_length"), method.alias("method")))

    as_is = F.struct(q.alias("clean_query"), F.lit(False).alias("was_sanitized"), F.length(q).alias("original_length"), F.length(q).alias("clean_length"), F.lit("passthrough").alias("method"))
    lines = F.filter(F.transform(F.split(q, "\n"), strip), lambda x: x != "")
    return F.when(short, as_is).otherwise(bound(bound(lines, candidates), told))


def name_error(c: Column, what: str = "name") -> Column:
    """Why a name can't be used, or null: it must have 1 to 128 characters, begin and end with a letter or digit, hold
    only letters, digits, spaces, dots, apostrophes, dashes and underscores, and no part of a path."""
    n = strip(F.coalesce(c, F.lit("")))
    bad = F.contains(n, F.lit("..")) | F.contains(n, F.lit("/")) | F.contains(n, F.lit("\\"))
    shape = n.rlike(r"^[\p{L}\p{N}_](?:[\p{L}\p{N}_ .'-]{0,126}[\p{L}\p{N}_])?$")
    error = F.when(n == "", "is empty").when(F.length(n) > NAME_LENGTH, "is too long").when(bad, "holds a path").when(F.contains(n, F.lit("\u0000")), "holds a null byte").when(~shape, "holds other characters")
    return F.when(error.isNotNull(), F.concat(F.lit(what + " "), error))


def checked_name(c: Column, what: str = "name") -> Column:
    """The stripped name; an error is raised when rows with a bad one are computed."""
    error = name_error(c, what)
    return F.when(error.isNotNull(), F.raise_error(error).cast("string")).otherwise(strip(c))


def content_error(c: Column) -> Column:
    return F.when(~F.coalesce(c, F.lit("")).rlike(r"\S"), "content is empty").when(F.length(c) > CONTENT_LENGTH, "content is too long").when(F.contains(c, F.lit("\u0000")), "content holds a null byte")
