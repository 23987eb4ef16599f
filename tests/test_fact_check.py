"""Claims and names in texts, worked out by hand."""

from pyspark.sql import functions as F

from lorespark.functions.text import entity_id
from lorespark.operators import fact_check


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, document string")


def test_claims_in_texts(spark):
    d = docs(spark, "Bob is Alice's brother. Alice's friend  is Carl, bob is Alice's boss", "Bob is Alice's ex", None, "", "Bob is Alice's brother. Bob is Alice's brother", "Zoë-Ann is Élan's aunt and Jo-Ann is Max's aunt")
    got = sorted(tuple(r) for r in fact_check.claims_in(d).collect())
    assert got == [(0, "Bob", "brother", "Alice"), (0, "Carl", "friend", "Alice"), (4, "Bob", "brother", "Alice"), (5, "Jo-Ann", "aunt", "Max")]


def test_contradicted(spark):
    rows = [("Bob", "husband", "Alice", None), ("Bob", "brother", "Alice", "2020-01-01"), ("Bob", "brother", "alice", "2030-01-01"), ("Carl", "friend", "Alice", None), ("Carl", "boss", "Alice", "2020-01-01")]
    t = spark.createDataFrame(rows, "subject string, predicate string, object string, valid_to string")
    t = t.select(entity_id(F.col("subject")).alias("subject"), "predicate", entity_id(F.col("object")).alias("object"), "valid_to")
    e = spark.createDataFrame([("bob", "Bob"), ("alice", "Alice"), ("carl", "Carl")], "id string, name string")
    d = docs(spark, "Bob is Alice's brother", "Alice's friend is Carl", "Dan is Alice's friend", "Carl is Alice's boss and Bob is Alice's husband")
    got = sorted(tuple(r) for r in fact_check.contradicted(d, t, e, "2025-01-01").collect())
    assert [(r[0], r[1], r[3], r[5], r[6]) for r in got] == [
        (0, "relationship_mismatch", "brother", "husband", None), (0, "stale_fact", "brother", "brother", "2020-01-01"),
        (3, "relationship_mismatch", "boss", "friend", None), (3, "stale_fact", "boss", "boss", "2020-01-01"),
    ]
    assert fact_check.contradicted(d, t.where("false"), e, "2025-01-01").isEmpty()


def test_mixed_up(spark):
    n = spark.createDataFrame([("Milla",), ("Mila",), ("Anna Lee",), ("Ana Lee",), ("Bob",), ("...",), (None,), ("Bob",)], "name string")
    d = docs(spark, "milla came", "Mila and Milla came", "Then Anna Lee, Bobby", None, "", "Bob", "lee")
    assert sorted(tuple(r) for r in fact_check.mentions(d, n.where("name is not null").distinct()).collect()) == [(0, "Milla"), (1, "Mila"), (1, "Milla"), (2, "Anna Lee"), (5, "Bob")]
    assert sorted(tuple(r) for r in fact_check.mixed_up(d, n).collect()) == [(0, "Milla", "Mila", 1), (2, "Anna Lee", "Ana Lee", 1)]
    assert fact_check.mixed_up(d, n.where("false")).isEmpty()


def test_mixed_up_by_bytes(spark):
    n = spark.createDataFrame([("menteó",), ("menten",), ("mentçñ",)], "name string")
    d = docs(spark, "menteó", "mentçñ", "menten")
    assert sorted(tuple(r) for r in fact_check.mixed_up(d, n).collect()) == [(0, "menteó", "menten", 1), (0, "menteó", "mentçñ", 2), (1, "mentçñ", "menten", 2), (1, "mentçñ", "menteó", 2), (2, "menten", "menteó", 1), (2, "menten", "mentçñ", 2)]
    assert sorted(tuple(r) for r in fact_check.mixed_up(d, n, by_bytes=True).collect()) == [(0, "menteó", "menten", 2), (2, "menten", "menteó", 2)]


def test_claims_are_made_distinct_before_they_meet_facts(spark):
    """Repeats were sought among all answers, in a hash table of each task; there are none if claims and facts have none."""
    t = spark.createDataFrame([("s7", "friend", "town", None), ("s7", "friend", "town", None), ("s8", "friend", "town", None)], "subject string, predicate string, object string, valid_to string")
    e = spark.createDataFrame([("town", "Town"), ("town", " town "), ("other", "Other")], "id string, name string")
    d = docs(spark, "S7 is Town's owner", "S8 is Town's friend")
    found = fact_check.contradicted(d.unionByName(d), t, e, "2025-01-01")
    assert [tuple(r) for r in found.collect()] == [(0, "relationship_mismatch", "S7", "owner", "Town", "friend", None)]
    assert found._jdf.queryExecution().optimizedPlan().getClass().getSimpleName() != "Aggregate"
