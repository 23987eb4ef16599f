"""Halls of sessions and of questions, and search that enters through the question's hall first."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .evaluate import navigated_distance
from .search import vector_topk

# Names of halls, and what in a session or a question tells of them.
PREFERENCES, FACTS, EVENTS, ADVICE, GENERAL = "hall_preferences", "hall_facts", "hall_events", "hall_assistant_advice", "hall_general"
SESSION_PREFERENCES = (
    "i prefer", "i usually", "i've been having trouble", "i've been feeling", "i've been struggling", "i want to", "i'm worried", "i've been thinking", "i've been considering",
    "lately i", "recently i", "i tend to",
)
SESSION_ADVICE = (
    "i suggest", "i recommend", "here are", "you might want to", "option 1", "option 2", "1.", "2.", "3.", "first,", "second,", "you could try", "i would recommend",
    "my recommendation",
)
SESSION_EVENTS = (
    "milestone", "graduation", "promotion", "anniversary", "birthday", "moved", "started", "finished", "completed", "launched", "opened", "achieved", "won", "accepted", "hired",
    "married", "born",
)
SESSION_FACTS = (
    "degree", "major", "university", "college", "job", "position", "role", "company", "city", "country", "street", "born in", "grew up", "studied", "works at", "lives in",
    "years old", "salary", "budget",
)
QUESTION_ADVICE = (
    "you suggested", "you told me", "you mentioned", "you said", "you recommended", "you provided", "you listed", "you gave", "remind me what you", "you came up with", "you explained",
)
QUESTION_PREFERENCES = ("i've been having trouble", "i've been feeling", "i prefer", "i usually", "battery", "nostalgic", "reunion", "lately", "recently been", "struggling with")
QUESTION_EVENTS = ("milestone", "when did", "what happened", "achievement", "ago", "last week", "last month", "last year", "four weeks", "three months")
QUESTION_FACTS = ("degree", "study", "graduate", "major", "job", "work", "live", "born", "city", "country", "company", "school")


def _holds(text: Column, signals: tuple[str, ...], least: int = 1) -> Column:
    """Whether at least so many of the signals stand in a text."""
    return sum((F.contains(text, F.lit(s)).cast("int") for s in signals), F.lit(0)) >= least


def session_hall(user: Column, assistant: Column) -> Column:
    """The hall of a session, by what its user and the assistant said: preferences by one sign, advice by two, events by
    one in either, facts by two in either; the first that applies, else the general one."""
    u, a = F.lower(F.coalesce(user, F.lit(""))), F.lower(F.coalesce(assistant, F.lit("")))
    both = F.concat(u, a)
    told = F.when(_holds(u, SESSION_PREFERENCES), PREFERENCES).when(_holds(a, SESSION_ADVICE, 2), ADVICE)
    return told.when(_holds(both, SESSION_EVENTS), EVENTS).when(_holds(both, SESSION_FACTS, 2), FACTS).otherwise(GENERAL)


def question_halls(question: Column) -> Column:
    """The halls that a question asks, the likeliest first."""
    q = F.lower(F.coalesce(question, F.lit("")))
    of = lambda *names: F.array(*[F.lit(n) for n in names])
    told = F.when(_holds(q, QUESTION_ADVICE), of(ADVICE, GENERAL)).when(_holds(q, QUESTION_PREFERENCES), of(PREFERENCES, GENERAL))
    return told.when(_holds(q, QUESTION_EVENTS), of(EVENTS, FACTS, GENERAL)).when(_holds(q, QUESTION_FACTS), of(FACTS, GENERAL)).otherwise(of(GENERAL))


def session_texts(turns: DataFrame) -> DataFrame:
    """(conv_id, user, assistant): what each said, by turn, joined by blanks."""
    said = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    of = lambda role: F.array_join(F.transform(F.filter("said", lambda x: x["role"] == role), lambda x: x["text"]), " ")
    return turns.groupBy("conv_id").agg(said.alias("said")).select("conv_id", of("user").alias("user"), of("assistant").alias("assistant"))


def navigate(sessions: DataFrame, questions: DataFrame, n: int = 50, inside: int = 10) -> DataFrame:
    """(query_id, rank, id, distance, adjusted): the `n` sessions nearest to each question by their adjusted distance.

    sessions: id, hall, embedding; questions: query_id, halls, embedding. First each question searches its likeliest hall
    alone (unless that is the general one) and takes the `inside` nearest; then all sessions. Of the `n` nearest of all,
    those in the question's halls come nearer, and those that the first search found nearer still. Questions meet only
    sessions of their hall in the first search; both are exact searches in blocks.
    """
    q = questions.withColumn("primary", F.get("halls", F.lit(0)))
    found = [vector_topk(sessions.where(F.col("hall") == h).select("id", "embedding"), q.where(F.col("primary") == h).select("query_id", "embedding"), inside) for h in (PREFERENCES, FACTS, EVENTS, ADVICE)]
    validated = reduce(DataFrame.unionByName, found).select("query_id", "id", F.lit(True).alias("validated"))
    near = vector_topk(sessions.select("id", "embedding"), q.select("query_id", "embedding"), n).select("query_id", "id", "distance")
    near = near.join(sessions.select("id", "hall"), "id").join(q.select("query_id", "primary", "halls"), "query_id").join(validated, ["query_id", "id"], "left")
    adjusted = navigated_distance(F.col("distance"), F.col("hall"), F.col("primary"), F.col("halls"), F.coalesce("validated", F.lit(False)))
    near = near.withColumn("adjusted", adjusted)
    w = Window.partitionBy("query_id").orderBy(F.round("adjusted", 12).asc_nulls_last(), "id")
    return near.select("query_id", F.row_number().over(w).alias("rank"), "id", "distance", "adjusted")
