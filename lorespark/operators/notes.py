"""Structured notes as lines of a small language, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A note: number, people's codes, topics, a quotation, a weight, emotions and flags; the last four may be missing.
NOTE = r'^([^:|]*):([^|]*)\|([^|]*)(?:\|"(.*)")?\|([0-9.]+)(?:\|([a-z][a-z_+]*))?(?:\|([A-Z][A-Z_+]*))?$'
LINK = r"^T:(.*?)<->(.*?)\|(.*)$"
NOBODY, NOTHING = "???", "misc"


def _joined(c: Column, with_: str, none: str | None = None) -> Column:
    return F.when(F.size(c) > 0, F.array_join(c, with_)).otherwise(none)


def encoded(notes: DataFrame) -> DataFrame:
    """(source_file, id, line) of notes (source_file, id, people, topics, quote, weight, emotions, flags).

    The number is what follows the last dash of the id. People's codes are sorted, each once; two topics are kept; a
    missing weight counts as 0.5. Line breaks and quotation marks of a quotation become blanks and apostrophes.
    """
    number = F.element_at(F.split("id", "-"), -1)
    people = F.array_sort(F.array_distinct(F.filter(F.coalesce("people", F.array().cast("array<string>")), lambda x: x.isNotNull())))
    topics = F.slice(F.coalesce("topics", F.array().cast("array<string>")), 1, 2)
    quote = F.nullif(F.translate(F.coalesce("quote", F.lit("")), '"\n\r', "'  "), F.lit(""))
    some = lambda c: F.filter(F.coalesce(c, F.array().cast("array<string>")), lambda x: x.isNotNull() & (x != ""))
    weight = F.coalesce(F.col("weight").cast("decimal(6,2)"), F.lit(0.5).cast("decimal(6,2)")).cast("string")
    line = F.concat_ws("|", F.concat(number, F.lit(":"), _joined(people, "+", NOBODY)), _joined(topics, "_", NOTHING), F.concat(F.lit('"'), quote, F.lit('"')), weight, _joined(some("emotions"), "+"), _joined(some("flags"), "+"))
    return notes.select("source_file", "id", line.alias("line"))


def encoded_links(links: DataFrame) -> DataFrame:
    """(source_file, line) of links (source_file, from_id, to_id, label): a label up to its colon, or its first 30
    characters."""
    end = lambda c: F.element_at(F.split(c, "-"), -1)
    label = F.coalesce("label", F.lit(""))
    short = F.when(F.contains(label, F.lit(":")), F.substring_index(label, ":", 1)).otherwise(F.substring(label, 1, 30))
    return links.select("source_file", F.concat(F.lit("T:"), end("from_id"), F.lit("<->"), end("to_id"), F.lit("|"), F.translate(short, "\n", " ")).alias("line"))


def parsed(lines: DataFrame) -> DataFrame:
    """Columns of `lines` (line) with kind (note, link, arc, header or other) and what the line says: number, people,
    topics, quote, weight, emotions, flags of a note; from_number, to_number, label of a link; text of the others."""
    line = F.col("line")
    note, link = line.rlike(NOTE) & ~line.startswith("T:"), line.rlike(LINK)
    part = lambda n: F.regexp_extract(line, NOTE, n)
    many = lambda n, with_, none="": F.when(note & (part(n) != none) & (part(n) != ""), F.split(part(n), with_)).when(note, F.array().cast("array<string>"))
    return lines.select(
        "*",
        F.when(link, "link").when(note, "note").when(line.startswith("ARC:"), "arc").when(F.size(F.split(line, r"\|")) == 4, "header").otherwise("other").alias("kind"),
        F.when(note, part(1)).alias("number"), many(2, r"\+", NOBODY).alias("people"), many(3, "_", NOTHING).alias("topics"), F.when(note, F.nullif(part(4), F.lit(""))).alias("quote"),
        F.when(note, part(5).try_cast("double")).alias("weight"), many(6, r"\+").alias("emotions"), many(7, r"\+").alias("flags"),
        F.when(link, F.regexp_extract(line, LINK, 1)).alias("from_number"), F.when(link, F.regexp_extract(line, LINK, 2)).alias("to_number"), F.when(link, F.regexp_extract(line, LINK, 3)).alias("label"),
        F.when(~note & ~link, F.regexp_replace(line, "^ARC:", "")).alias("text"),
    )


def summary(parsed_lines: DataFrame, least: float = 0.85, most: int = 20) -> DataFrame:
    """(number, people, topics, quote, weight, flags): the weightiest notes of at least `least`, or flagged as an
    origin or core, heaviest first, then by number."""
    told = parsed_lines.where("kind = 'note'").where((F.col("weight") >= least) | F.arrays_overlap("flags", F.array(F.lit("ORIGIN"), F.lit("CORE"))))
    return told.orderBy(F.desc("weight"), "number").limit(most).select("number", "people", "topics", "quote", "weight", "flags")
