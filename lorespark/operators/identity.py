"""Who is who: connected components by alternating stars, identities from shared names or addresses, and their names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.shared import rewritten
from ..sources.files import bot, real_name


def with_least(links: DataFrame, key: str, value: str, hot: int = 10_000, parts: int = 256) -> DataFrame:
    """The links with `least`, the smallest `value` of their key.

    The minimum is an aggregate that combines on the map side. Keys of more than `hot` links and more than one in `parts` of
    all links number less than `parts`: their minima are broadcast to the links where they are, so no key's links meet in
    one task. The other links are joined by key.
    """
    total = links.agg(F.count(F.lit(1)).alias("total"))
    least = links.groupBy(key).agg(F.min(value).alias("least"), F.count(F.lit(1)).alias("n")).join(F.broadcast(total))  # one row
    is_hot = (F.col("n") > hot) & (F.col("n") * parts > F.col("total"))
    near = links.join(F.broadcast(least.where(is_hot).select(key, F.col("least").alias("near"))), key, "left")
    far = near.where("near is null").drop("near").join(least.where(~is_hot).select(key, "least"), key)
    return near.where("near is not null").withColumnRenamed("near", "least").unionByName(far)


def components(edges: DataFrame, hot: int = 10_000) -> DataFrame:
    """(node, root) of nodes with an edge (a, b) to another: root is the smallest node of the component.

    Large stars tie each node's larger neighbours to its smallest one (or to itself), small stars its smaller neighbours
    and itself to the smallest; in turns they leave one star a component after about log n rounds, long chains included.
    Each round keeps at most as many edges as it began with and is written to the shared folder.
    """
    u, v = F.col("u"), F.col("v")
    e = rewritten(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        both = e.select("u", "v").unionByName(e.select(v.alias("u"), u.alias("v")))
        large = rewritten(with_least(both, "u", "v", hot).where("v > u").select(v.alias("u"), F.least("least", "u").alias("v")).distinct(), e)
        small = with_least(large, "u", "v", hot)
        tied = small.where("v > least").select(v.alias("u"), F.col("least").alias("v")).unionByName(small.select("u", F.col("least").alias("v")))
        e = rewritten(tied.distinct(), large)
        ends = e.select(F.explode(F.array(F.struct(u.alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")), F.struct(v.alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("s")).select("s.*")
        odd = ends.groupBy("x").agg(F.sum("up").alias("up"), F.sum("down").alias("down")).where("up > 1 or (up > 0 and down > 0)")
        if odd.isEmpty():
            return e.select(u.alias("node"), v.alias("root"))


def identities(people: DataFrame, hot: int = 10_000) -> DataFrame:
    """(id, person): rows (id, name, email) are one person if they share a name or an address, in any case of letters, over
    any number of steps; person is the smallest id. Empty names and addresses and nulls tell nothing; rows without an id
    are left out, and one row stands for each id."""
    key = lambda kind, c: F.when(F.col(c) != "", F.concat(F.lit(kind), F.lower(c)))
    links = people.where("id is not null").select("id", F.explode(F.array(key("n:", "name"), key("e:", "email"))).alias("k")).where("k is not null")
    links = rewritten(links.distinct())
    stars = components(with_least(links, "k", "id", hot).select(F.col("id").alias("a"), F.col("least").alias("b")), hot)
    ids = people.where("id is not null").select("id").distinct()
    return ids.join(stars.withColumnRenamed("node", "id"), "id", "left").select("id", F.coalesce("root", "id").alias("person"))


def display_names(people: DataFrame, persons: DataFrame) -> DataFrame:
    """(person, name): of each identity the name that most of its rows bear, then the smallest; names that look like a
    person's come before handles, and an identity with handles alone has none."""
    c = people.join(persons, "id").where(real_name(F.col("name")) & ~bot(F.col("name"))).groupBy("person", "name").agg(F.count(F.lit(1)).alias("n"))
    return c.groupBy("person").agg(F.min(F.struct((-F.col("n")).alias("n"), "name")).alias("x")).select("person", F.col("x.name").alias("name"))


def people_of_commits(commits: DataFrame, hot: int = 10_000) -> DataFrame:
    """(name, commits, emails, repos): the people behind commits (id, name, email, repo), bots left out. Identities that
    come to one display name are one person."""
    c = commits.where(~bot(F.col("name")) & ~F.coalesce(bot(F.col("email")), F.lit(False)))
    persons = rewritten(identities(c.select("id", "name", "email"), hot))
    names = display_names(c, persons)
    mine = c.select("id", "email", "repo").join(persons, "id").groupBy("person", "email", "repo").agg(F.count(F.lit(1)).alias("n"))
    told = mine.join(names, "person").groupBy("name")
    return told.agg(F.sum("n").alias("commits"), F.countDistinct(F.nullif("email", F.lit(""))).alias("emails"), F.countDistinct("repo").alias("repos"))
