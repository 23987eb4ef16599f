"""The scope graph: rooms as nodes, wings they share as edges; tunnels, traversal, topic links."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import scope_slug


def nodes(chunks: DataFrame) -> DataFrame:
    """Per room (not `general`, not of a blank wing): wings, halls, count and the last five dates."""
    d = chunks.where((F.col("room") != "general") & (F.coalesce("wing", F.lit("")) != "") & (F.coalesce("room", F.lit("")) != ""))
    some = lambda c: F.sort_array(F.collect_set(F.when(F.col(c) != "", F.col(c))))
    g = d.groupBy("room").agg(some("wing").alias("wings"), some("hall").alias("halls"), F.count(F.lit(1)).alias("n"), some("date").alias("dates"))
    return g.withColumn("dates", F.when(F.size("dates") > 5, F.slice("dates", -5, 5)).otherwise(F.col("dates")))


def edges(node: DataFrame) -> DataFrame:
    """One edge per room, pair of its wings (a < b) and hall; a room without halls has none."""
    e = node.select("room", "n", F.explode("wings").alias("wing_a"), "wings", "halls").select("room", "n", "wing_a", F.explode("wings").alias("wing_b"), "halls")
    return e.where(F.col("wing_a") < F.col("wing_b")).select("room", "wing_a", "wing_b", F.explode("halls").alias("hall"), "n")


def tunnels(node: DataFrame, wing_a: str | None = None, wing_b: str | None = None, limit: int = 50) -> DataFrame:
    """Rooms of at least two wings, among them the given ones; most chunks first."""
    d = node.where(F.size("wings") >= 2)
    for w in (wing_a, wing_b):
        if w is not None:
            d = d.where(F.array_contains("wings", w.lower().replace(" ", "_").replace("-", "_")))
    return d.orderBy(F.desc("n"), "room").limit(limit)


def stats(node: DataFrame) -> DataFrame:
    pairs = F.size("wings") * (F.size("wings") - 1) / 2 * F.size("halls")
    return node.agg(F.count(F.lit(1)).alias("rooms"), F.count_if(F.size("wings") >= 2).alias("tunnel_rooms"), F.coalesce(F.sum(pairs), F.lit(0)).cast("long").alias("edges"))


def rooms_per_wing(node: DataFrame) -> DataFrame:
    return node.select(F.explode("wings").alias("wing")).groupBy("wing").agg(F.count(F.lit(1)).alias("rooms"))


def traverse(node: DataFrame, start: str, max_hops: int = 2, limit: int = 50) -> DataFrame:
    """Rooms within `max_hops` shared wings of `start`: room, hop, n, via (the wings shared with the smallest room of
    the hop before). Each hop joins the frontier's wings with the rooms' wings; only (wing) sets cross the shuffle."""
    pairs = node.select("room", F.explode("wings").alias("wing"))
    seen = node.where(F.col("room") == start).select("room", F.lit(0).alias("hop"), F.lit("").alias("via"))
    frontier = seen
    for hop in range(1, max_hops + 1):
        # The smallest parent of a room is the smallest of one of its wings, so a wing keeps one parent.
        wings = frontier.select(F.col("room").alias("parent")).join(pairs, F.col("parent") == pairs.room).groupBy("wing").agg(F.min("parent").alias("parent"))
        met = wings.join(pairs, "wing").join(seen.select("room"), "room", "left_anti")
        parent = F.min("parent").over(Window.partitionBy("room"))
        met = met.withColumn("best", parent).where(F.col("parent") == F.col("best"))
        frontier = met.groupBy("room").agg(F.array_join(F.sort_array(F.collect_set("wing")), ",").alias("via")).select("room", F.lit(hop).alias("hop"), "via")
        seen = seen.unionByName(frontier)
    return seen.join(node.select("room", "n"), "room").orderBy("hop", F.desc("n"), "room").limit(limit)


def suggest(node: DataFrame, query: str, n: int = 5) -> DataFrame:
    """Rooms like a name: 1 where it occurs in the room's name, 0.5 where one of its dash-separated words does."""
    room, q = F.lower("room"), query.lower()
    any_word = F.lit(False)
    for w in q.split("-"):
        any_word = any_word | F.contains(room, F.lit(w))
    score = F.when(F.contains(room, F.lit(q)), 1.0).when(any_word, 0.5)
    return node.select("room", score.alias("score")).where("score is not null").orderBy(F.desc("score"), "room").limit(n)


def traverse_or_suggest(node: DataFrame, start: str, max_hops: int = 2, limit: int = 50, most: int = 5) -> DataFrame:
    """`traverse` with `suggested` = false; where no room is called `start`, rooms like it instead, with hop, n and via null
    and `suggested` = true."""
    there = node.where(F.col("room") == start).limit(1).select(F.lit(True).alias("there"))
    walked = traverse(node, start, max_hops, limit).select("room", "hop", "n", "via", F.lit(False).alias("suggested"), F.lit(None).cast("double").alias("score"))
    like = suggest(node, start, most).join(F.broadcast(there), how="left_anti")  # one row, or none
    empty = [F.lit(None).cast(k).alias(c) for c, k in walked.dtypes if c in ("hop", "n", "via")]
    return walked.unionByName(like.select("room", *empty, F.lit(True).alias("suggested"), "score"))


def topic_tunnels(topics: DataFrame, least: int = 1) -> DataFrame:
    """Pairs of wings (a < b) that share at least `least` topics (compared in lower case), one row per shared topic,
    spelled as in the first wing's smallest spelling."""
    t = topics.select("wing", F.lower(F.trim("topic")).alias("key"), F.trim("topic").alias("topic")).where("key <> ''")
    t = t.groupBy("wing", "key").agg(F.min("topic").alias("topic"))
    a, b = t.select(F.col("wing").alias("wing_a"), "key", "topic"), t.select(F.col("wing").alias("wing_b"), "key")
    met = a.join(b, "key").where("wing_a < wing_b")
    shared = F.count(F.lit(1)).over(Window.partitionBy("wing_a", "wing_b"))
    return met.withColumn("shared", shared).where(F.col("shared") >= least).select("wing_a", "wing_b", F.concat(F.lit("topic:"), "topic").alias("room"), "shared")


def tunnel_id(a_wing: str, a_room: str, b_wing: str, b_room: str):
    """The symmetric id of a link between two wing/room ends, as a Column over the named columns."""
    a, b = F.concat_ws("/", a_wing, a_room), F.concat_ws("/", b_wing, b_room)
    return F.substring(F.sha2(F.concat(F.least(a, b), F.lit("↔"), F.greatest(a, b)), 256), 1, 16)


def tunnels_upserted(tunnels: DataFrame, new: DataFrame) -> DataFrame:
    """Links after the new ones (source_wing, source_room, target_wing, target_room, label, source_drawer, target_drawer,
    at): a pair of ends has one link, whatever their order; a new one keeps the time the first was made. Of new ones of
    the same ends the latest counts. Returns id, both ends, label, drawers, created_at, updated_at."""
    ends = ["source_wing", "source_room", "target_wing", "target_room", "label", "source_drawer", "target_drawer"]
    n = new.withColumn("id", tunnel_id("source_wing", "source_room", "target_wing", "target_room"))
    n = n.groupBy("id").agg(F.max_by(F.struct(*ends), "at").alias("x"), F.min("at").alias("first"), F.max("at").alias("last"))
    n = n.join(tunnels.select("id", F.col("created_at").alias("had")), "id", "left")
    changed = F.col("had").isNotNull() | (F.col("first") != F.col("last"))
    fresh = n.select("id", *[F.col(f"x.{c}").alias(c) for c in ends], F.coalesce("had", "first").alias("created_at"), F.when(changed, F.col("last")).alias("updated_at"))
    return tunnels.join(n.select("id"), "id", "left_anti").select(fresh.columns).unionByName(fresh)


def _wing(c: str):
    return scope_slug(F.trim(F.col(c)))


def tunnels_of(tunnels: DataFrame, wing: str | None = None) -> DataFrame:
    """All links, or those with an end in a wing, names compared as slugs."""
    if not wing:
        return tunnels
    w = scope_slug(F.lit(wing.strip()))
    return tunnels.where((_wing("source_wing") == w) | (_wing("target_wing") == w))


def tunnels_without(tunnels: DataFrame, ids: list[str]) -> DataFrame:
    return tunnels.where(~F.col("id").isin(*ids))


def followed(tunnels: DataFrame, wing: str, room: str, chunks: DataFrame, length: int = 300) -> DataFrame:
    """(tunnel_id, direction, connected_wing, connected_room, label, drawer_id, preview): where the links of a room lead,
    outgoing if it is their source, with the beginning of the chunk (id, document) at the other end."""
    w = scope_slug(F.lit(wing.strip()))
    out = (_wing("source_wing") == w) & (F.col("source_room") == room)
    back = ~F.coalesce(out, F.lit(False)) & (_wing("target_wing") == w) & (F.col("target_room") == room)
    a = tunnels.where(out).select(F.col("id").alias("tunnel_id"), F.lit("outgoing").alias("direction"), F.col("target_wing").alias("connected_wing"), F.col("target_room").alias("connected_room"), "label", F.col("target_drawer").alias("drawer_id"))
    b = tunnels.where(back).select(F.col("id").alias("tunnel_id"), F.lit("incoming").alias("direction"), F.col("source_wing").alias("connected_wing"), F.col("source_room").alias("connected_room"), "label", F.col("source_drawer").alias("drawer_id"))
    c = chunks.select(F.col("id").alias("drawer_id"), F.substring("document", 1, length).alias("preview"))
    return a.unionByName(b).join(c, "drawer_id", "left")


def topic_tunnels_for(topics: DataFrame, wing: str, least: int = 1) -> DataFrame:
    """`topic_tunnels` with one wing at an end: only its topics meet the others'."""
    key = F.lower(F.trim("topic"))
    mine = topics.where(F.col("wing") == wing).select(key.alias("k")).distinct()
    near = topics.withColumn("k", key).join(mine, "k", "left_semi").drop("k")
    return topic_tunnels(near, least).where((F.col("wing_a") == wing) | (F.col("wing_b") == wing))


def top_tunnels(node: DataFrame, n: int = 10) -> DataFrame:
    """The rooms of at least two wings with most wings, then by name: room, wings, count."""
    d = node.where(F.size("wings") >= 2).select("room", F.array_join(F.array_sort("wings"), ",").alias("wings"), F.size("wings").alias("n_wings"), "count")
    return d.orderBy(F.desc("n_wings"), "room").limit(n)
