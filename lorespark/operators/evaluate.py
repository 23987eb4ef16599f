"""Retrieval quality and re-ranking signals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import bound, keyword_hits


def recall_at_k(ranked: DataFrame, relevant: DataFrame, k: int) -> DataFrame:
    """Per query of `relevant` (query_id, id): whether any and whether all relevant ids are among the first k of
    `ranked` (query_id, id, rank), and their share."""
    hits = relevant.join(ranked.where(F.col("rank") <= k).select("query_id", "id", F.lit(1).alias("hit")), ["query_id", "id"], "left")
    hit = F.coalesce("hit", F.lit(0))
    return hits.groupBy("query_id").agg((F.max(hit) > 0).alias("any_hit"), (F.min(hit) > 0).alias("all_hit"), F.avg(hit.cast("double")).alias("share"))


def ndcg_at_k(ranked: DataFrame, k: int) -> DataFrame:
    """Per query of (query_id, rank, rel): DCG over that of the same relevances in the best order, 0 if there are none."""
    top = ranked.where(F.col("rank") <= k)
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("rel"), "rank"))
    gain = lambda r: F.sum(F.col("rel") / F.log2(r + 1.0))
    g = top.withColumn("ideal", best).groupBy("query_id").agg(gain(F.col("rank")).alias("dcg"), gain(F.col("ideal")).alias("idcg"))
    return g.select("query_id", F.when(F.col("idcg") > 0, F.col("dcg") / F.col("idcg")).otherwise(0.0).alias("ndcg"))


def answer_tokens(c: Column) -> Column:
    """The words of an answer: commas go, then the lower-case articles and `and`, then ASCII punctuation, then case."""
    plain = F.regexp_replace(F.replace(c, F.lit(","), F.lit("")), r"\b(a|an|the|and)\b", " ")
    plain = F.regexp_replace(plain, r"[!-/:-@\[-`{-~]", "")
    return F.filter(F.split(F.lower(plain), r"\s+"), lambda w: w != "")


def token_f1(pairs: DataFrame) -> DataFrame:
    """Token F1 of (pair_id, prediction, truth) by multisets of answer words; two empty answers agree fully, one empty
    answer not at all. Null counts as empty."""
    words = lambda name: answer_tokens(F.coalesce(name, F.lit("")))
    p = pairs.select("pair_id", words("prediction").alias("p"), words("truth").alias("t"))
    common = F.aggregate(F.array_distinct("p"), F.lit(0), lambda s, w: s + F.least(F.size(F.filter("p", lambda x: x == w)), F.size(F.filter("t", lambda x: x == w))))
    p = p.select("pair_id", common.cast("double").alias("c"), F.size("p").alias("np"), F.size("t").alias("nt"))
    empty = (F.col("np") == 0) & (F.col("nt") == 0)
    return p.select("pair_id", F.when(empty, 1.0).when(F.col("c") > 0, 2 * F.col("c") / (F.col("np") + F.col("nt"))).otherwise(0.0).alias("f1"))


def overlap(text: Column, keywords: list[str]) -> Column:
    """The share of the keywords that occur in a text as substrings."""
    if not keywords:
        return F.lit(0.0)
    return bound(F.lower(text), lambda x: keyword_hits(x, keywords)) / float(len(keywords))


def boosted(distance: Column, signals: list[tuple[Column, float]]) -> Column:
    """The distance, shortened by each signal (0 to 1) with its weight."""
    for share, weight in signals:
        distance = distance * (1.0 - weight * share)
    return distance


def split(ids: DataFrame, held_out: int, seed: int) -> DataFrame:
    """(id, part): the `held_out` ids with the smallest seeded hashes, and the rest as dev. Only the held-out ids, a
    bounded number, are ranked together."""
    order = F.xxhash64("id", F.lit(seed))
    chosen = ids.select("id").orderBy(order, "id").limit(held_out).select("id", F.lit("held_out").alias("part"))
    return ids.select("id").join(chosen, "id", "left").select("id", F.coalesce("part", F.lit("dev")).alias("part"))


def evidence_recall(pairs: DataFrame) -> DataFrame:
    """Per query of (query_id, evidence, retrieved): the share of evidence texts that some retrieved text contains or is
    contained in, without case and outer space; 1 for a query without evidence. evidence: array<string>, retrieved:
    array<string>."""
    clean = lambda c: F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda x: F.lower(F.trim(x)))
    p = pairs.select("query_id", clean(F.col("evidence")).alias("e"), clean(F.col("retrieved")).alias("r"))
    found = F.size(F.filter("e", lambda x: F.exists("r", lambda y: F.contains(y, x) | F.contains(x, y))))
    return p.select("query_id", F.when(F.size("e") == 0, 1.0).otherwise(found / F.size("e")).alias("recall"))


def fractional_recall(ranked: DataFrame, evidence: DataFrame, k: int) -> DataFrame:
    """Per query of `evidence` (query_id, ids: array): the share of its ids among the first k of `ranked` (query_id, id,
    rank); 1 where there is no evidence."""
    top = ranked.where(F.col("rank") <= k).groupBy("query_id").agg(F.collect_set("id").alias("got"))
    e = evidence.join(top, "query_id", "left")
    ids = F.array_distinct(F.coalesce("ids", F.array().cast(evidence.schema["ids"].dataType)))
    hit = F.size(F.array_intersect(ids, F.coalesce("got", F.array().cast(evidence.schema["ids"].dataType))))
    return e.select("query_id", F.when(F.size(ids) == 0, 1.0).otherwise(hit / F.size(ids)).alias("recall"))


def hit_at_k(ranked: DataFrame, targets: DataFrame, k: int) -> DataFrame:
    """By category of `targets` (query_id, category, id): queries, hits (any target among the first k) and their rate."""
    top = ranked.where(F.col("rank") <= k).select("query_id", "id", F.lit(1).alias("hit"))
    q = targets.join(top, ["query_id", "id"], "left").groupBy("category", "query_id").agg(F.max(F.coalesce("hit", F.lit(0))).alias("hit"))
    return q.groupBy("category").agg(F.count(F.lit(1)).alias("queries"), F.sum("hit").alias("hits"), F.avg("hit").alias("rate"))


def quoted(text: Column) -> Column:
    """Phrases of 3 to 60 characters between quotation marks, single or double."""
    found = F.concat(F.regexp_extract_all(text, F.lit("'([^']{3,60})'"), 1), F.regexp_extract_all(text, F.lit('"([^"]{3,60})"'), 1))
    return F.filter(F.transform(found, F.trim), lambda x: F.length(x) >= 3)


def share_found(needles: Column, text: Column) -> Column:
    """The share of the strings that occur in a text, without case; 0 for none."""
    n = bound(F.lower(text), lambda low: F.size(F.filter(needles, lambda x: F.contains(low, F.lower(x)))))
    return F.when(F.size(needles) > 0, n / F.size(needles)).otherwise(0.0)


def predicate_words(question: Column, names: Column, stop: tuple[str, ...]) -> Column:
    """The question's words of at least three letters that are neither stop words nor names."""
    words = F.regexp_extract_all(F.lower(question), F.lit("[a-z]{3,}"), 0)
    named = F.transform(names, lambda x: F.lower(x))
    return F.filter(F.array_distinct(words), lambda w: ~w.isin(*stop) & ~F.array_contains(named, w))


def hybrid_distance(distance: Column, question: Column, document: Column, names: Column, stop: tuple[str, ...], keyword: float = 0.5, phrase: float = 0.6, person: float = 0.2) -> Column:
    """The distance shortened by the shares of the question's predicate words, quoted phrases and person names that the
    document holds."""
    return boosted(distance, [(share_found(predicate_words(question, names, stop), document), keyword), (share_found(quoted(question), document), phrase), (share_found(names, document), person)])


def scope_distance(distance: Column, same: Column, factor: float = 0.8) -> Column:
    """The distance times `factor` where the scopes are the same: rooms, halls, or a summary layer."""
    return F.when(same, distance * factor).otherwise(distance)


def navigated_distance(distance: Column, hall: Column, primary: Column, targets: Column, validated: Column) -> Column:
    """The distance times 0.75 in the question's primary hall, else 0.90 in another of its halls; and times 0.85 where a
    first pass through the primary hall found the session too."""
    near = F.when(hall == primary, 0.75).when(F.array_contains(targets, hall), 0.90).otherwise(1.0)
    return distance * near * F.when(validated, 0.85).otherwise(1.0)


def routed(summaries: DataFrame, questions: DataFrame, rooms: int = 3) -> DataFrame:
    """(query_id, room): the rooms whose summaries hold most of the question's words, at most `rooms` (ties by name); all
    rooms if none holds any. summaries: room, document; questions: query_id, words (array<string>)."""
    words = questions.select("query_id", F.explode(F.array_distinct("words")).alias("w"))
    told = summaries.select("room", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("document"), F.lit(r"[\p{L}\p{N}_]{3,}"), 0))).alias("w"))
    score = words.join(told, "w").groupBy("query_id", "room").agg(F.count(F.lit(1)).alias("s"))
    nth = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("s"), "room"))
    best = score.withColumn("n", nth).where(F.col("n") <= rooms).select("query_id", "room")
    lost = questions.select("query_id").join(best, "query_id", "left_anti")
    every = summaries.agg(F.array_sort(F.collect_set("room")).alias("r"))
    return best.unionByName(lost.select("query_id").join(F.broadcast(every)).select("query_id", F.explode("r").alias("room")))  # one row of room names


def session_corpus(turns: DataFrame, roles: tuple[str, ...] = ("user",)) -> DataFrame:
    """One document per conversation, its turns of these roles in order, one per line: (conv_id, document). turns:
    conv_id, turn, role, text."""
    said = F.sort_array(F.collect_list(F.struct("turn", "text")))
    d = turns.where(F.col("role").isin(*roles) & F.col("text").isNotNull()).groupBy("conv_id").agg(said.alias("s"))
    return d.select("conv_id", F.array_join(F.transform("s", lambda x: x["text"]), "\n").alias("document"))


def dialog_corpus(turns: DataFrame, granularity: str) -> DataFrame:
    """(id, document) at a granularity: each turn (`dialog`), each conversation (`session`), or the first and last turn of
    each (`summary`), with the speaker before each text."""
    line = F.concat_ws(": ", "role", F.coalesce("text", F.lit("")))
    if granularity == "dialog":
        return turns.select(F.concat_ws(":", "conv_id", "turn").alias("id"), line.alias("document"))
    if granularity not in ("session", "summary"):
        raise ValueError("granularity is dialog, session or summary")
    said = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", line.alias("line")))).alias("s"))
    lines = F.transform("s", lambda x: x["line"])
    if granularity == "summary":
        lines = F.when(F.size(lines) > 1, F.array(lines[0], F.element_at(lines, -1))).otherwise(lines)
    return said.select(F.col("conv_id").cast("string").alias("id"), F.array_join(lines, "\n").alias("document"))


def with_unranked(ranked: DataFrame, corpus: DataFrame) -> DataFrame:
    """`ranked` (query_id, id, rank), followed per query by the documents of `corpus` (id, place) it left out, in corpus
    order; the corpus is what one query is asked of and joins by query_id if it has one."""
    key = ["query_id"] if "query_id" in corpus.columns else []
    every = corpus if key else ranked.select("query_id").distinct().join(F.broadcast(corpus))
    rest = every.join(ranked.select("query_id", "id"), ["query_id", "id"], "left_anti")
    last = ranked.groupBy("query_id").agg(F.max("rank").alias("last"))
    nth = F.row_number().over(Window.partitionBy("query_id").orderBy("place"))
    rest = rest.withColumn("n", nth).join(last, "query_id", "left").select("query_id", "id", (F.coalesce("last", F.lit(0)) + F.col("n")).alias("rank"))
    return ranked.select("query_id", "id", "rank").unionByName(rest)


#: How a user tells of preferences, worries and plans.
PREFERENCES = (
    r"i(?:'ve been| have been) having (?:trouble|issues?|problems?) with ([^,\.!?]{5,80})", r"i(?:'ve been| have been) feeling ([^,\.!?]{5,60})",
    r"i(?:'ve been| have been) (?:struggling|dealing) with ([^,\.!?]{5,80})", r"i(?:'ve been| have been) (?:worried|concerned) about ([^,\.!?]{5,80})",
    r"i(?:'m| am) (?:worried|concerned) about ([^,\.!?]{5,80})", r"i prefer ([^,\.!?]{5,60})", r"i usually ([^,\.!?]{5,60})",
    r"i(?:'ve been| have been) (?:trying|attempting) to ([^,\.!?]{5,80})", r"i(?:'ve been| have been) (?:considering|thinking about) ([^,\.!?]{5,80})",
    r"lately[,\s]+(?:i've been|i have been|i'm|i am) ([^,\.!?]{5,80})", r"recently[,\s]+(?:i've been|i have been|i'm|i am) ([^,\.!?]{5,80})",
    r"i(?:'ve been| have been) (?:working on|focused on|interested in) ([^,\.!?]{5,80})", r"i want to ([^,\.!?]{5,60})", r"i(?:'m| am) looking (?:to|for) ([^,\.!?]{5,60})",
    r"i(?:'m| am) thinking (?:about|of) ([^,\.!?]{5,60})", r"i(?:'ve been| have been) (?:noticing|experiencing) ([^,\.!?]{5,80})",
)


def preference_documents(turns: DataFrame, patterns: tuple[str, ...] = PREFERENCES, most: int = 10) -> DataFrame:
    """(conv_id, document): what user turns say of preferences, as one synthetic document per conversation of at most
    `most` distinct statements of 5 to 80 characters, in order. Patterns have one group."""
    text = F.lower("text")
    found = F.concat(*[F.transform(F.regexp_extract_all(text, F.lit(p), 1), F.trim) for p in patterns])
    t = turns.where("role = 'user' and text is not null").select("conv_id", "turn", F.filter(found, lambda x: F.length(x).between(5, 80)).alias("found"))
    said = t.where(F.size("found") > 0).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "found"))).alias("s"))
    kept = F.slice(F.array_distinct(F.flatten(F.transform("s", lambda x: x["found"]))), 1, most)
    return said.select("conv_id", F.concat(F.lit("User has mentioned: "), F.array_join(kept, "; ")).alias("document"))
