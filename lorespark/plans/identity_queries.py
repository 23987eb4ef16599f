"""Queries of identities, with DuckDB twins. Customers and their orders stand in for the authors of commits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import identity
from .registry import query, t

#: Labels go from rows to keys and back; a row's label only falls, so the recursion ends with the smallest id of its component.
_SPREAD = """k AS (SELECT id, 'n:' || lower(name) AS k FROM p UNION ALL SELECT id, 'e:' || lower(email) FROM p),
edge AS (SELECT DISTINCT k.id AS a, m.b FROM k JOIN (SELECT k, min(id) AS b FROM k GROUP BY 1) m USING (k)),
two AS (SELECT a, b FROM edge UNION SELECT b, a FROM edge),
r AS (SELECT id, id AS x FROM (SELECT DISTINCT id FROM p) UNION SELECT r.id, two.b FROM r JOIN two ON two.a = r.x)"""


@query(f"""WITH RECURSIVE p AS (SELECT c_custkey AS id, (c_custkey // 24) || '.' || (c_custkey // 3) AS name, (c_custkey // 24) || '.' || ((c_custkey + 1) // 4) AS email FROM customer),
{_SPREAD} SELECT id, min(x) AS person FROM r GROUP BY 1""")
def identity_components(spark, sf_dir):
    i = F.col("c_custkey")
    block = F.floor(i / 24).cast("string")
    people = t(spark, sf_dir, "customer").select(i.alias("id"), F.concat_ws(".", block, F.floor(i / 3).cast("string")).alias("name"), F.concat_ws(".", block, F.floor((i + 1) / 4).cast("string")).alias("email"))
    return identity.identities(people)


def _commits(orders: DataFrame) -> DataFrame:
    """An order is a commit: one customer's orders share a full name, a handle or a bot's name, by turns, and an address
    that two customers share; those without a status of their own tell no address."""
    o, c = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    name = F.when(o % 11 == 0, F.concat(F.lit("build "), c, F.lit(" [bot]"))).when(o % 3 == 0, F.concat(F.lit("user"), c)).otherwise(F.concat(F.lit("Customer C"), c))
    email = F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("Mail"), F.floor(F.col("o_custkey") / 2).cast("string"), F.lit("@example.org"))).otherwise("")
    return orders.select(o.alias("id"), name.alias("name"), email.alias("email"), F.substring("o_orderdate", 1, 7).alias("repo"))


@query("""WITH RECURSIVE c AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'user' ELSE 'Customer C' END || o_custkey AS name, CASE WHEN o_orderstatus <> 'P' THEN 'Mail' || (o_custkey // 2) || '@example.org' END AS email, substr(CAST(o_orderdate AS VARCHAR), 1, 7) AS repo FROM orders WHERE o_orderkey % 11 <> 0),
e AS (SELECT DISTINCT lower(name) AS a, lower(email) AS b FROM c), two AS (SELECT a, b FROM e WHERE b IS NOT NULL UNION SELECT b, a FROM e WHERE b IS NOT NULL),
r AS (SELECT DISTINCT a, a AS x FROM e UNION SELECT r.a, two.b FROM r JOIN two ON two.a = r.x),
p AS (SELECT a, min(x) AS person FROM r GROUP BY 1), m AS (SELECT c.*, person FROM c JOIN p ON lower(name) = a),
n AS (SELECT person, name, count(*) AS n FROM m WHERE name LIKE 'Customer C%' GROUP BY 1, 2),
d AS (SELECT person, name FROM n QUALIFY row_number() OVER (PARTITION BY person ORDER BY n DESC, name) = 1)
SELECT d.name, count(*) AS commits, count(DISTINCT email) AS emails, count(DISTINCT repo) AS repos FROM m JOIN d USING (person) GROUP BY 1""")
def people_of_commits(spark, sf_dir):
    return identity.people_of_commits(_commits(t(spark, sf_dir, "orders")))
