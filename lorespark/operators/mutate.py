"""Mutations as new DataFrames: upsert, update, delete, currency tests, sync buckets, session cursors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.filters import where_column
from ..functions.text import hex_id


def last_per_key(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(F.desc(order))
    return rows.withColumn("nth__", F.row_number().over(w)).where("nth__ = 1").drop("nth__")


def upsert(old: DataFrame, new: DataFrame, key: str = "id", order: str | None = None) -> DataFrame:
    """The store after the new rows: of those that share a key the last by `order` wins (any one of them without an
    order), and replaces the old row."""
    new = last_per_key(new, [key], order).drop(order) if order else new.dropDuplicates([key])
    return new.unionByName(old.join(new.select(key), key, "left_anti"))


def add(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """The store after the new rows whose key it doesn't hold yet; of those that share a key one is added."""
    return old.unionByName(new.dropDuplicates([key]).join(old.select(key), key, "left_anti"))


def add_report(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """(key, verdict): whether each new key would be added or already exists."""
    have = old.select(key, F.lit(True).alias("have__")).distinct()
    return new.select(key).distinct().join(have, key, "left").select(key, F.when(F.col("have__"), "already_exists").otherwise("added").alias("verdict"))


def update(old: DataFrame, changes: DataFrame, key: str = "id") -> DataFrame:
    """Old rows with the changes' non-null values, maps merged key by key; unknown keys change nothing."""
    maps = {f.name for f in old.schema if f.dataType.typeName() == "map"}
    c = changes.select(key, *[F.col(x).alias(f"{x}__") for x in changes.columns if x != key])
    out = old.join(c, key, "left")

    def value(x: str):
        if x == key or f"{x}__" not in c.columns:
            return F.col(x)
        if x not in maps:
            return F.coalesce(f"{x}__", x).alias(x)
        kept = F.map_filter(x, lambda k, _: ~F.coalesce(F.map_contains_key(F.col(f"{x}__"), k), F.lit(False)))
        return F.coalesce(F.map_concat(kept, f"{x}__"), x, f"{x}__").alias(x)

    return out.select(*[value(x) for x in old.columns])


def delete(old: DataFrame, keys: DataFrame, key: str = "id") -> DataFrame:
    return old.join(keys.select(key).distinct(), key, "left_anti")


def delete_where(old: DataFrame, where: dict) -> DataFrame:
    """The rows that the filter doesn't match; rows for which it is null stay."""
    return old.where(~F.coalesce(where_column(where), F.lit(False)))


def is_registry_row(room: str = "room", mode: str = "ingest_mode", key: str = "id"):
    """Whether a row only marks a file as read."""
    return F.coalesce((F.col(room) == "_registry") | (F.col(mode) == "registry") | F.col(key).startswith("_reg_"), F.lit(False))


def registry_rows(files: DataFrame, chunks: DataFrame, wing: str) -> DataFrame:
    """(id, document, wing, room, source_file, ingest_mode): a row for each file (source_file) that gave no chunks, so
    that it counts as read."""
    empty = files.select("source_file").distinct().join(chunks.select("source_file"), "source_file", "left_anti")
    text = F.concat(F.lit("[registry] "), F.col("source_file"))
    return empty.select(F.concat(F.lit("_reg_"), hex_id(F.col("source_file"))).alias("id"), text.alias("document"), F.lit(wing).alias("wing"), F.lit("_registry").alias("room"), "source_file", F.lit("registry").alias("ingest_mode"))


def mined(store: DataFrame, chunks: DataFrame, mode: str | None = None) -> DataFrame:
    """The store after a mine: the chunks' files lose what they had (of this extract mode, null counting as exchange) and
    get the new chunks."""
    files = chunks.select("source_file").distinct()
    if mode is None:
        return store.join(files, "source_file", "left_anti").unionByName(chunks)
    mine = F.coalesce("extract_mode", F.lit("exchange")) == mode
    return store.where(~mine).unionByName(store.where(mine).join(files, "source_file", "left_anti")).unionByName(chunks)


def diary_rows(entries: DataFrame) -> DataFrame:
    """(id, document, wing, room, agent, date) of diary entries (agent, wing, entry, at: yyyy-MM-ddTHH:mm:ss): agents in
    lower case, the wing `wing_<agent>` where none is given."""
    agent = F.lower(F.trim("agent"))
    wing = F.coalesce("wing", F.concat(F.lit("wing_"), F.translate(agent, " -", "__")))
    stamp = F.translate("at", "-T:", "_")
    key = F.concat(F.lit("diary_"), wing, F.lit("_"), F.replace(stamp, F.lit("_"), F.lit("")), F.lit("_"), hex_id(F.col("entry"), 12))
    return entries.select(key.alias("id"), F.col("entry").alias("document"), wing.alias("wing"), F.lit("diary").alias("room"), agent.alias("agent"), F.substring("at", 1, 10).alias("date"))


def audit_rows(operations: DataFrame, secret: tuple[str, ...] = ("content", "document", "entry", "query")) -> DataFrame:
    """(at, op, params): operations (at, op, params: map) with the values of content keys replaced by their lengths."""
    hidden = F.transform_values("params", lambda k, v: F.when(k.isin(*secret), F.concat(F.lit("[redacted "), F.length(v).cast("string"), F.lit(" chars]"))).otherwise(v))
    return operations.select("at", "op", hidden.alias("params"))


def not_yet_current(files: DataFrame, store: DataFrame, version: int = 3) -> DataFrame:
    """Files (source_file, extract_mode, mtime) without chunks of at least that version, of the same mode (null counts
    as exchange) and of the same time to a thousandth of a second."""
    have = store.where(F.col("normalize_version") >= version).select("source_file", F.coalesce("extract_mode", F.lit("exchange")).alias("mode"), F.col("source_mtime").alias("m")).distinct()
    f = files.withColumn("mode", F.coalesce("extract_mode", F.lit("exchange")))
    return f.join(have, (f.source_file == have.source_file) & (f["mode"] == have["mode"]) & (F.abs(f.mtime - have.m) < 0.001), "left_anti").drop("mode")


def sync_buckets(sources: DataFrame, roots: DataFrame, existing: DataFrame, ignored: DataFrame) -> DataFrame:
    """(source_file, root, bucket): each source against the longest root that is a prefix of it.

    Sources are cut at every slash and joined by equality with the roots, so no prefix comparison of all pairs is made.
    """
    parts = F.split("source_file", "/")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    named = sources.where("source_file is not null").distinct()
    met = named.select("source_file", F.explode(prefixes).alias("root")).join(roots.select("root").distinct(), "root")
    best = met.groupBy("source_file").agg(F.max_by("root", F.length("root")).alias("root"))
    here = existing.select("source_file", F.lit(True).alias("here")).distinct()
    ign = ignored.select("source_file", F.lit(True).alias("ign")).distinct()
    out = sources.select("source_file").distinct().join(best, "source_file", "left").join(here, "source_file", "left").join(ign, "source_file", "left")
    bucket = F.when(F.col("source_file").isNull(), "no_source").when(F.col("root").isNull(), "out_of_scope").when(F.col("here").isNull(), "missing").when(F.col("ign"), "gitignored").otherwise("kept")
    return out.select("source_file", "root", bucket.alias("bucket"))


def cursors(stored: DataFrame) -> DataFrame:
    """(session_id, cursor): the last timestamp that is stored of each session."""
    return stored.groupBy("session_id").agg(F.max("timestamp").alias("cursor"))


def sweep_split(messages: DataFrame, stored: DataFrame) -> DataFrame:
    """Messages (session_id, message_uuid, timestamp) with a verdict against the stored ones: skipped (before the
    session's last stored timestamp), present (id known) or added. Equal timestamps are tried again."""
    cursor = cursors(stored)
    known = stored.select("session_id", "message_uuid", F.lit(True).alias("known")).distinct()
    m = messages.join(cursor, "session_id", "left").join(known, ["session_id", "message_uuid"], "left")
    verdict = F.when(F.col("timestamp") < F.col("cursor"), "skipped").when(F.col("known"), "present").otherwise("added")
    return m.withColumn("verdict", verdict).drop("cursor", "known")
