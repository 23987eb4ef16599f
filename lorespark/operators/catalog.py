"""Counts over scopes: status, wings, rooms, taxonomy, pages, source groups, wake-up lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import blockquote, snippet


def status(chunks: DataFrame) -> DataFrame:
    """Total, per wing and per room, by one pass of grouping sets; null means all."""
    d = chunks.select(F.coalesce("wing", F.lit("unknown")).alias("wing"), F.coalesce("room", F.lit("unknown")).alias("room"))
    return d.groupingSets([[], ["wing"], ["room"]], "wing", "room").agg(F.count(F.lit(1)).alias("n"))


def count_by(chunks: DataFrame, column: str) -> DataFrame:
    return chunks.groupBy(F.coalesce(F.col(column), F.lit("unknown")).alias(column)).agg(F.count(F.lit(1)).alias("n"))


def taxonomy(chunks: DataFrame) -> DataFrame:
    """Counts by wing and room, with wing totals and the grand total (nulls); missing names count as `unknown`."""
    d = chunks.select(F.coalesce("wing", F.lit("unknown")).alias("wing"), F.coalesce("room", F.lit("unknown")).alias("room"))
    return d.rollup("wing", "room").agg(F.count(F.lit(1)).alias("n"))


def listing(chunks: DataFrame) -> DataFrame:
    """(wing, room, n, place): the rooms of each wing, most chunks first, then by name; missing names show as `?`."""
    d = chunks.groupBy(F.coalesce("wing", F.lit("?")).alias("wing"), F.coalesce("room", F.lit("?")).alias("room")).agg(F.count(F.lit(1)).alias("n"))
    return d.withColumn("place", F.row_number().over(Window.partitionBy("wing").orderBy(F.desc("n"), "room")))


def named_counts(chunks: DataFrame, column: str) -> DataFrame:
    """Counts by a column, rows without a value left out."""
    return chunks.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def export_index(chunks: DataFrame) -> DataFrame:
    """(wing, rooms, chunks): what an export holds of each wing."""
    return chunks.groupBy(F.coalesce("wing", F.lit("unknown")).alias("wing")).agg(F.countDistinct(F.coalesce("room", F.lit("general"))).alias("rooms"), F.count(F.lit(1)).alias("chunks"))


def page_with_total(chunks: DataFrame, limit: int, offset: int) -> DataFrame:
    """`page`, with the table's size beside each row."""
    total = chunks.agg(F.count(F.lit(1)).alias("total"))
    return page(chunks, limit, offset).join(F.broadcast(total))  # one row


def recall(chunks: DataFrame, limit: int = 10, length: int = 300) -> DataFrame:
    """The first chunks of a scope by id, as snippets."""
    return chunks.orderBy("id").limit(limit).select("id", "wing", "room", snippet(F.regexp_replace("document", r"\s+", " "), length).alias("snippet"))


def percentiles(timings: DataFrame) -> DataFrame:
    """Count, median and 95th percentile of `ms` by step."""
    return timings.groupBy("step").agg(F.count(F.lit(1)).alias("n"), F.percentile("ms", 0.5).alias("p50"), F.percentile("ms", 0.95).alias("p95"))


def recent_messages(turns: DataFrame, n: int = 5, length: int = 200) -> DataFrame:
    """The last n user messages of each conversation, newest first, cut at `length`: (conv_id, place, text)."""
    w = Window.partitionBy("conv_id").orderBy(F.desc("turn"))
    t = turns.where("role = 'user' and text is not null").withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)
    return t.select("conv_id", "place", F.substring("text", 1, length).alias("text"))


def checkpoint_entry(turns: DataFrame, n: int = 5, length: int = 200) -> DataFrame:
    """(conv_id, document): the last n user messages of each conversation in order, joined by `|`."""
    g = recent_messages(turns, n, length).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct((-F.col("place")).alias("p"), "text"))).alias("s"))
    return g.select("conv_id", F.array_join(F.transform("s", lambda x: x["text"]), "|").alias("document"))


def human_messages(turns: DataFrame) -> DataFrame:
    """(conv_id, n): user messages that are not commands."""
    said = (F.col("role") == "user") & F.col("text").rlike(r"\S") & ~F.col("text").contains("<command-message>")
    return turns.groupBy("conv_id").agg(F.count_if(F.coalesce(said, F.lit(False))).alias("n"))


def theme_words(turns: DataFrame, stop: tuple[str, ...], n: int = 3) -> DataFrame:
    """(conv_id, place, word, n): the most frequent words of at least four letters in user messages, ties by word."""
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{4,}"), 0)
    d = turns.where("role = 'user'").select("conv_id", F.explode(words).alias("word")).where(~F.col("word").isin(*stop))
    g = d.groupBy("conv_id", "word").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("conv_id").orderBy(F.desc("n"), "word")
    return g.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n).select("conv_id", "place", "word", "n")


def page(chunks: DataFrame, limit: int, offset: int) -> DataFrame:
    """One page by id, limit from 1 to 100."""
    return chunks.orderBy("id").offset(max(0, offset)).limit(max(1, min(100, limit)))


def source_groups(chunks: DataFrame, least: int = 5) -> DataFrame:
    """Sources of at least `least` chunks, with their sizes and the bounds of their ids."""
    g = chunks.groupBy(F.coalesce("source_file", F.lit("unknown")).alias("source_file"))
    return g.agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id")).where(F.col("n") >= least)


def dedup_statistics(groups: DataFrame, top: int = 15) -> DataFrame:
    """The largest groups and, for those of more than 20 chunks, an estimate of how many are near-copies."""
    estimate = F.when(F.col("n") > 20, F.floor(F.col("n") * 0.4)).otherwise(F.lit(0)).cast("long")
    return groups.withColumn("estimate", estimate).orderBy(F.desc("n"), "source_file").limit(top)


def wake_up(chunks: DataFrame, scan: int = 2000, top: int = 15, length: int = 200, budget: int = 3200) -> DataFrame:
    """The most important of the first `scan` chunks by id, as snippets, grouped by room, up to `budget` characters.

    importance null counts as 3. Rows come by room, importance, id; the cut is a running sum over at most `top` rows.
    """
    d = chunks.orderBy("id").limit(scan).withColumn("importance", F.coalesce(F.col("importance").cast("double"), F.lit(3.0)))
    d = d.orderBy(F.desc("importance"), "id").limit(top)
    d = d.select("id", "room", "importance", snippet(F.regexp_replace("document", r"\s+", " "), length).alias("snippet"))
    w = Window.orderBy("room", F.desc("importance"), "id")  # at most `top` rows
    return d.withColumn("used", F.sum(F.length("snippet")).over(w)).where(F.col("used") <= budget)


def importance(*keys: Column) -> Column:
    """The first of several weights that is there, as a number; 3 if none is, or if that one is no number."""
    return F.coalesce(F.coalesce(*[k.cast("string") for k in keys]).try_cast("double"), F.lit(3.0))


def essential_story(chunks: DataFrame, wing: str | None = None, scan: int = 2000, top: int = 15, length: int = 200, budget: int = 3200) -> DataFrame:
    """One row: the text that a session wakes up with. chunks: id, wing, room, source_file, document and importance (see
    `importance`; null counts as 3).

    Of the first `scan` chunks by id the `top` most important ones, by room and importance, each as a line of at most
    `length` characters with its file's name, until `budget` characters are used; a last line says if some were left out.
    The rows that are put in order here are at most `top`.
    """
    d = chunks if wing is None else chunks.where(F.col("wing") == wing)
    d = d.orderBy("id").limit(scan).withColumn("importance", F.coalesce(F.col("importance").cast("double"), F.lit(3.0)))
    d = d.orderBy(F.desc("importance"), "id").limit(top).withColumn("room", F.coalesce("room", F.lit("general")))
    text = F.replace(F.regexp_replace(F.coalesce("document", F.lit("")), r"^\s+|\s+$", ""), F.lit("\n"), F.lit(" "))
    d = d.withColumn("text", F.when(F.length(text) > length, F.concat(F.substring(text, 1, length - 3), F.lit("..."))).otherwise(text))
    file = F.element_at(F.split("source_file", "/"), -1)
    line = F.concat(F.lit("  - "), F.col("text"), F.when(F.coalesce(file, F.lit("")) != "", F.concat(F.lit("  ("), file, F.lit(")"))).otherwise(""))
    w = Window.orderBy("room", F.desc("importance"), "id")
    d = d.withColumn("line", line).withColumn("first", F.row_number().over(Window.partitionBy("room").orderBy(F.desc("importance"), "id")) == 1)
    head = F.when(F.col("first"), F.concat(F.lit("\n\n["), "room", F.lit("]"))).otherwise("")
    d = d.withColumn("head", head).withColumn("used", F.sum(F.length("line") + F.greatest(F.length("head") - 1, F.lit(0))).over(w)).withColumn("at", F.row_number().over(w))
    d = d.withColumn("before", F.lag("used", 1, 0).over(w))  # the first row beyond the budget still names its room
    kept = F.when(F.col("used") <= budget, F.concat("head", F.lit("\n"), "line")).when(F.col("before") <= budget, F.concat("head", F.lit("\n  ... (more in L3 search)")))
    said = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", kept.alias("kept")))), lambda x: x["kept"]), "")
    return d.agg(F.count(F.lit(1)).alias("n"), said.alias("said")).select(F.when(F.col("n") == 0, "## L1 — No memories yet.").otherwise(F.concat(F.lit("## L1 — ESSENTIAL STORY"), "said")).alias("text"))


def wake_up_text(identity: str, chunks: DataFrame, wing: str | None = None) -> DataFrame:
    """One row: who is asked, then the essential story."""
    return essential_story(chunks, wing).select(F.concat(F.lit(identity.strip() + "\n\n"), "text").alias("text"))


def diary_last(entries: DataFrame, n: int = 10, wing: str | None = None) -> DataFrame:
    """(agent, place, at, document): the last n diary entries (agent, wing, room, at, document) of each agent, newest first;
    n from 1 to 100. Agents are compared in lower case."""
    d = entries.where(F.col("room") == "diary")
    d = d if wing is None else d.where(F.col("wing") == wing)
    w = Window.partitionBy("agent").orderBy(F.desc("at"), "document")
    d = d.withColumn("agent", F.lower("agent")).withColumn("place", F.row_number().over(w))
    return d.where(F.col("place") <= max(1, min(100, n))).select("agent", "place", "at", "document")


def export_markdown(chunks: DataFrame, folder: str) -> DataFrame:
    """Write chunks (id, wing, room, document) as Markdown, a folder per wing and room in which chunks follow by id, each
    as a heading and a quotation; returns `export_index`."""
    named = chunks.select(F.coalesce("wing", F.lit("unknown")).alias("wing"), F.coalesce("room", F.lit("general")).alias("room"), "id", "document")
    text = F.concat(F.lit("## "), F.col("id").cast("string"), F.lit("\n\n"), blockquote(F.coalesce("document", F.lit(""))), F.lit("\n"))
    out = named.repartition("wing", "room").sortWithinPartitions("wing", "room", "id").select("wing", "room", text.alias("value"))
    out.write.mode("overwrite").partitionBy("wing", "room").text(folder)
    return export_index(named)
