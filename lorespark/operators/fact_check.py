"""Texts against what is known: claims that the fact store contradicts, and names that are easily mixed up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.shared import small
from ..functions.text import entity_id
from .facts import name_confusion

#: Fixed values: "X is Y's role" and "Y's role is X", with capitalised names and roles of 3 to 20 small letters.
NAME, ROLE = r"([A-Z][\w-]+)", r"([a-z]{3,20})"
HAS_ROLE, ROLE_IS = rf"(?U)\b{NAME}\s+is\s+{NAME}'s\s+{ROLE}\b", rf"(?U)\b{NAME}'s\s+{ROLE}\s+is\s+{NAME}\b"


def claims_in(docs: DataFrame) -> DataFrame:
    """(id, subject, predicate, object) of the claims in texts (id, document), each once a text: the subject has a role
    with regard to the object. Nothing is shuffled but for the repeats of one text."""

    def found(pattern: str, subject: int, predicate: int, obj: int):
        part = lambda group, name: F.regexp_extract_all("document", F.lit(pattern), group).alias(name)
        return F.arrays_zip(part(subject, "subject"), part(predicate, "predicate"), part(obj, "object"))

    every = F.concat(found(HAS_ROLE, 1, 3, 2), found(ROLE_IS, 3, 2, 1))
    return docs.where(F.col("document").contains("'s")).select("id", F.explode(F.array_distinct(every)).alias("c")).select("id", "c.*")


def contradicted(docs: DataFrame, triples: DataFrame, entities: DataFrame, today: str) -> DataFrame:
    """(id, kind, subject, predicate, object, known, valid_to): claims in texts that the store speaks against.

    `relationship_mismatch`: a current fact of the same two says another role (`known`). `stale_fact`: the claim itself was
    a fact until `valid_to`, before today. Subjects meet by their ids, objects by their names in any case of letters. Only
    claims are joined, never texts; each answer stands once a text. Many facts may share few objects: what is looked up
    is the name of each object, not of each fact, and a small table of names goes to the facts, which stay where they are.
    """
    asked = triples.select(F.col("object").alias("id")).distinct()
    names = small(entities.join(asked, "id").select(F.col("id").alias("object"), F.lower(F.trim("name")).alias("oid")).distinct())
    t = triples.join(names, "object").select(F.col("subject").alias("sid"), "oid", F.lower("predicate").alias("known"), "valid_to").distinct()
    c = claims_in(docs).distinct().withColumn("sid", entity_id(F.col("subject"))).withColumn("oid", F.lower("object"))
    met = c.join(t, ["sid", "oid"])
    other = F.col("valid_to").isNull() & (F.col("known") != "") & (F.col("known") != F.col("predicate"))
    stale = (F.col("valid_to") < today) & (F.col("known") == F.col("predicate"))
    kind = F.when(other, "relationship_mismatch").when(stale, "stale_fact")
    return met.withColumn("kind", kind).where("kind is not null").select("id", "kind", "subject", "predicate", "object", "known", "valid_to")  # distinct claims met distinct facts


def mentions(docs: DataFrame, names: DataFrame) -> DataFrame:
    """(id, name): known names (name, unique) whose words follow each other in a text, in any case of letters, whatever
    stands between the words. Runs of words as long as some name are looked up by an equality join; names without words
    are never mentioned."""
    words = lambda c: F.regexp_extract_all(F.lower(c), F.lit(r"(?U)\w+"), 0)
    n = names.select("name", words(F.col("name")).alias("ws")).where(F.size("ws") > 0).select("name", F.size("ws").alias("len"), F.array_join("ws", " ").alias("run"))
    lengths = n.agg(F.collect_set("len").alias("lens"))  # one row; as many numbers as there are lengths of names
    d = docs.select("id", words(F.col("document")).alias("ws")).join(F.broadcast(lengths))
    starts = lambda x: F.sequence(F.lit(1), F.greatest(F.size("ws") - x + 1, F.lit(1)))
    runs = F.flatten(F.transform("lens", lambda x: F.transform(starts(x), lambda i: F.array_join(F.slice("ws", i, x), " "))))
    return d.select("id", F.explode(F.array_distinct(runs)).alias("run")).join(n, "run").select("id", "name").distinct()


def mixed_up(docs: DataFrame, names: DataFrame, by_bytes: bool = False) -> DataFrame:
    """(id, mentioned, meant, distance): known names in a text that differ by one or two edits (of characters, or of UTF-8
    bytes) from a known name that the text doesn't hold. The pairs of like names are found once, not once a text."""
    n = names.select("name").where("name is not null").distinct()
    like = name_confusion(n, n, apart=False, by_bytes=by_bytes).select(F.col("a").alias("mentioned"), F.col("b").alias("meant"), "distance")
    met = mentions(docs, n)
    asked = met.withColumnRenamed("name", "mentioned").join(like, "mentioned")
    return asked.join(met.withColumnRenamed("name", "meant"), ["id", "meant"], "left_anti").select("id", "mentioned", "meant", "distance")
