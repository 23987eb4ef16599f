"""The temporal fact store: entities(id, name, type) and triples(id, subject, predicate, object, valid_from, valid_to)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.temporal import check_temporal, end_key, start_key, valid_at
from ..functions.text import entity_id, hex_id


def named(triples: DataFrame, entities: DataFrame, column: str, alias: str) -> DataFrame:
    """Join an entity's name to a triple column; Spark broadcasts the entities if their size allows it."""
    return triples.join(entities.select(F.col("id").alias(column), F.col("name").alias(alias)), column)


def query_entity(triples: DataFrame, entities: DataFrame, name: str, as_of: str | None = None, direction: str = "outgoing") -> DataFrame:
    """Facts that go out from or come in to an entity (or both, a loop then twice); `current` means an open end."""
    if direction not in ("outgoing", "incoming", "both"):
        raise ValueError(f"unknown direction {direction}")
    me = entity_id(F.lit(name))
    now = triples.where(valid_at(as_of))
    cols = ["id", "direction", "subject_name", "predicate", "object_name", "valid_from", "valid_to", "current"]
    sides = []
    if direction != "incoming":
        out = named(now.where(F.col("subject") == me), entities, "object", "object_name")
        sides.append(out.withColumn("subject_name", F.lit(name)).withColumn("direction", F.lit("outgoing")))
    if direction != "outgoing":
        inc = named(now.where(F.col("object") == me), entities, "subject", "subject_name")
        sides.append(inc.withColumn("object_name", F.lit(name)).withColumn("direction", F.lit("incoming")))
    sides = [s.withColumn("current", F.col("valid_to").isNull()).select(cols) for s in sides]
    return sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])


def query_relationship(triples: DataFrame, entities: DataFrame, predicate: str, as_of: str | None = None) -> DataFrame:
    p = F.replace(F.lower(F.lit(predicate)), F.lit(" "), F.lit("_"))
    t = triples.where((F.col("predicate") == p) & valid_at(as_of))
    t = named(named(t, entities, "subject", "subject_name"), entities, "object", "object_name")
    return t.withColumn("current", F.col("valid_to").isNull())


def timeline(triples: DataFrame, entities: DataFrame, name: str | None = None, limit: int = 100) -> DataFrame:
    """The first facts by start (as text, open ones last, then id), of one entity or of all."""
    t = triples
    if name is not None:
        me = entity_id(F.lit(name))
        t = t.where((F.col("subject") == me) | (F.col("object") == me))
    t = named(named(t, entities, "subject", "subject_name"), entities, "object", "object_name")
    return t.orderBy(F.col("valid_from").asc_nulls_last(), "id").limit(limit)


def stats(triples: DataFrame, entities: DataFrame) -> DataFrame:
    t = triples.agg(F.count(F.lit(1)).alias("triples"), F.count_if(F.col("valid_to").isNull()).alias("current"), F.count_if(F.col("valid_to").isNotNull()).alias("expired"), F.array_join(F.sort_array(F.collect_set("predicate")), ",").alias("predicates"))
    return entities.agg(F.count(F.lit(1)).alias("entities")).join(t)


def add(triples: DataFrame, new: DataFrame) -> DataFrame:
    """The new facts that are worth adding: not those that repeat an open fact, of the store or earlier in the batch
    (by `ordinal`). A fact that ends before it starts raises an error when the rows are computed."""
    key = ["subject", "predicate", "object"]
    bad = F.col("valid_from").isNotNull() & F.col("valid_to").isNotNull() & (end_key(F.col("valid_to")) < start_key(F.col("valid_from")))
    checked = new.withColumn("valid_to", F.when(bad, F.raise_error(F.lit("a fact ends before it starts")).cast("string")).otherwise(F.col("valid_to")))
    fresh = checked.join(triples.where(F.col("valid_to").isNull()).select(key).distinct(), key, "left_anti")
    # A repeat is dropped if an open fact of the same key came before it.
    w = Window.partitionBy(*key).orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    return fresh.withColumn("before", F.coalesce(F.max(F.col("valid_to").isNull()).over(w), F.lit(False))).where(~F.col("before")).drop("before")


def invalidate(triples: DataFrame, subject: str, predicate: str, ended: str, obj: str | None = None) -> DataFrame:
    """All triples, with the open ones of that subject and predicate (and object) closed at `ended`, unless that would
    be before their start, which raises an error when the rows are computed."""
    ended = check_temporal(ended)
    hit = (F.col("subject") == entity_id(F.lit(subject))) & (F.col("predicate") == predicate) & F.col("valid_to").isNull()
    if obj is not None:
        hit = hit & (F.col("object") == entity_id(F.lit(obj)))
    late = F.coalesce(end_key(F.lit(ended)) < start_key(F.col("valid_from")), F.lit(False))
    closed = F.when(late, F.raise_error(F.lit("a fact would end before it starts")).cast("string")).otherwise(F.lit(ended))
    return triples.withColumn("valid_to", F.when(hit, closed).otherwise(F.col("valid_to")))


def contradictions(claims: DataFrame, triples: DataFrame, today: str) -> DataFrame:
    """Claims (subject, predicate, object) against the store: another current relationship of the same pair
    (relationship_mismatch), or the same fact with an end before today (stale_fact)."""
    t = triples.select("subject", F.col("predicate").alias("known"), "object", "valid_to")
    met = claims.join(t, ["subject", "object"])
    wrong = met.where((F.col("known") != F.col("predicate")) & F.col("valid_to").isNull()).withColumn("kind", F.lit("relationship_mismatch"))
    stale = met.where((F.col("known") == F.col("predicate")) & (F.col("valid_to") < today)).withColumn("kind", F.lit("stale_fact"))
    return wrong.unionByName(stale).select("kind", "subject", "predicate", "object", "known").distinct()


def name_confusion(mentioned: DataFrame, known: DataFrame, apart: bool = True, by_bytes: bool = False) -> DataFrame:
    """Pairs of a mentioned and an unmentioned name (name) that differ by one or two edits, each pair once; if not `apart`,
    of a mentioned and any known name. Edits are of characters, or, if `by_bytes`, of the bytes of their UTF-8 form.

    Names are blocked by length, so a name only meets those of at most two letters more or fewer that share a deletion
    variant with it: two strings within two edits share one after at most two deletions each.
    """

    def compared(alias: str) -> Column:
        low = F.lower(F.col(alias))
        return F.decode(F.encode(low, "UTF-8"), "ISO-8859-1") if by_bytes else low  # one character a byte

    def variants(df: DataFrame, alias: str) -> DataFrame:
        drop = lambda c: F.transform(F.sequence(F.lit(1), F.greatest(F.length(c), F.lit(1))), lambda i: F.concat(F.substr(c, F.lit(1), i - 1), F.substr(c, i + 1)))
        low = compared(alias)
        one = drop(low)
        two = F.flatten(F.transform(one, drop))
        every = F.array_distinct(F.concat(F.array(low), one, two))
        return df.select(alias, F.explode(every).alias("variant"))

    a = mentioned.select(F.col("name").alias("a")).distinct()
    b = known.select(F.col("name").alias("b")).distinct()
    b = b.join(a.withColumnRenamed("a", "b"), "b", "left_anti") if apart else b
    met = variants(a, "a").join(variants(b, "b"), "variant").select("a", "b").distinct()
    met = met.withColumn("distance", F.levenshtein(compared("a"), compared("b"), 2)).where("distance between 1 and 2")
    return met.select("a", "b", "distance")


def entities_upserted(entities: DataFrame, new: DataFrame) -> DataFrame:
    """The entity table after new ones (name, type, properties): one row per id, of new ones of the same id the last name
    in order, and they replace what was there. Null types are `unknown`, null properties `{}`."""
    n = new.select(entity_id(F.col("name")).alias("id"), "name", F.coalesce("type", F.lit("unknown")).alias("type"), F.coalesce("properties", F.lit("{}")).alias("properties"))
    n = n.groupBy("id").agg(F.max(F.struct("name", "type", "properties")).alias("x")).select("id", "x.*")
    return entities.join(n.select("id"), "id", "left_anti").select("id", "name", "type", "properties").unionByName(n)


def predicate_id(c):
    """Predicates in lower case, with underscores for spaces."""
    return F.replace(F.lower(c), F.lit(" "), F.lit("_"))


def normalised(raw: DataFrame) -> DataFrame:
    """Facts (subject, predicate, object as named, valid_from, valid_to, ordinal) with ids in place of names, and an id of
    their own made of them."""
    s, p, o = entity_id(F.col("subject")), predicate_id(F.col("predicate")), entity_id(F.col("object"))
    start = F.coalesce("valid_from", F.lit(""))
    key = F.concat(F.lit("t_"), s, F.lit("_"), p, F.lit("_"), o, F.lit("_"), hex_id(F.concat_ws("|", s, p, o, start, F.col("ordinal").cast("string")), 12))
    return raw.select(key.alias("id"), s.alias("subject"), p.alias("predicate"), o.alias("object"), "valid_from", "valid_to", "ordinal")


def entities_of(raw: DataFrame, entities: DataFrame) -> DataFrame:
    """The entities (id, name, type) that facts name and the store doesn't hold: of spellings of one id the first by
    ordinal, subjects before objects."""
    named = raw.select(F.col("subject").alias("name"), F.struct("ordinal", F.lit(0).alias("o")).alias("at")).unionByName(raw.select(F.col("object").alias("name"), F.struct("ordinal", F.lit(1).alias("o")).alias("at")))
    first = named.groupBy(entity_id(F.col("name")).alias("id")).agg(F.min_by("name", "at").alias("name"))
    return first.join(entities.select("id"), "id", "left_anti").select("id", "name", F.lit("unknown").alias("type"))


#: What a relationship says, and which column names the other end.
RELATIONSHIPS = {"daughter": ("is_child_of", "parent"), "husband": ("is_partner_of", "partner"), "brother": ("is_sibling_of", "sibling"), "dog": ("is_pet_of", "owner")}


def seeded(people: DataFrame, interests_since: str = "2025-01-01") -> DataFrame:
    """(subject, predicate, object, valid_from) of known people (name, birthday, relationship, parent, partner, sibling,
    owner, interests): child_of, married_to, what the relationship says (of oneself where the other end is missing), and
    loves for each interest. Empty strings count as missing."""
    told = lambda c: F.initcap(F.nullif(F.col(c), F.lit("")))
    kinds = [F.struct(F.lit("child_of").alias("p"), told("parent").alias("o"), F.col("birthday").alias("f")), F.struct(F.lit("married_to").alias("p"), told("partner").alias("o"), F.lit(None).cast("string").alias("f"))]
    for kind, (p, c) in RELATIONSHIPS.items():
        start = F.col("birthday") if kind == "daughter" else F.lit(None).cast("string")
        kinds.append(F.struct(F.lit(p).alias("p"), F.when(F.col("relationship") == kind, F.coalesce(told(c), F.col("name"))).alias("o"), start.alias("f")))
    loves = F.transform(F.coalesce("interests", F.array().cast("array<string>")), lambda x: F.struct(F.lit("loves").alias("p"), F.initcap(x).alias("o"), F.lit(interests_since).alias("f")))
    d = people.select("name", F.explode(F.concat(F.array(*kinds), loves)).alias("x")).where("x.o is not null")
    return d.select(F.col("name").alias("subject"), F.col("x.p").alias("predicate"), F.col("x.o").alias("object"), F.nullif(F.col("x.f"), F.lit("")).alias("valid_from"))
