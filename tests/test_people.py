"""The registry: look-ups in context, people in queries, learning by versions."""

import re

from lorespark.operators import entities, people

TEXT = "Marta said hello. Marta laughed and she smiled.\nhey Marta, thanks Marta!\nMarta: yes\nMarta: no\nGrace: so\nGrace: hm\nGrace smiled, she did\nshipping Zephyr v2, building Zephyr, import Zephyr"


def tables(spark):
    known = people.registry(spark.createDataFrame([("Grace", ["Gracie"], "sister"), ("Max", None, None), ("Riley", ["Ry"], "friend")], "name string, aliases array<string>, relationship string"))
    return known, spark.createDataFrame([("Apollo",)], "name string"), spark.createDataFrame([("Paris", "place", 0.8)], "name string, type string, confidence double")


def test_context_decides_about_ambiguous_names(spark):
    known, projects, confirmed = tables(spark)
    rows = [(1, "grace", "I went with Grace, and Grace said no."), (2, "Grace", "the grace of god"), (3, "Grace", "Grace"), (4, "Grace", None), (5, "gracie", "the gracie of god"), (6, "Riley", "the riley of it"), (7, "APOLLO", "x"), (8, "paris", "x"), (9, "nobody", "x"), (10, "max", "Max's bike is not max"), (11, "grace", "grace in it; grace said it")]
    got = {r.id: (r.type, round(r.confidence, 3), r.source, r.name, r.disambiguated) for r in people.looked_up(spark.createDataFrame(rows, "id int, word string, context string"), known, projects, confirmed).collect()}
    assert got[1] == ("person", 0.9, "onboarding", "grace", True) and got[2] == ("concept", 0.8, "context_disambiguated", "Grace", True)
    assert got[3] == ("person", 1.0, "onboarding", "Grace", False) == got[4] and got[5][:4] == ("person", 1.0, "onboarding", "Grace") and got[6][0] == "person"
    assert got[7] == ("project", 1.0, "onboarding", "Apollo", False) and got[8] == ("place", 0.8, "wiki", "paris", False) and got[9] == ("unknown", 0.0, "none", "nobody", False)
    for i, word, context in rows:  # against Python's expressions
        if word.lower() in people.COMMON_WORDS and context:
            yes, no = (sum(bool(re.search(p.format(name=re.escape(word.lower())), context.lower())) for p in ps) for ps in (people.PERSON_CONTEXTS, people.CONCEPT_CONTEXTS))
            assert got[i][4] == (yes != no) and (got[i][0] == "concept") == (no > yes)


def test_people_named_in_queries(spark):
    known, _, _ = tables(spark)
    q = spark.createDataFrame([(1, "what did Ry say?"), (2, "by the grace of it"), (3, "I saw Grace and Max's dog"), (4, None), (5, "grace")], "query_id int, query string")
    assert {tuple(r) for r in people.people_named(q, known).collect()} == {(1, "Riley"), (3, "Grace"), (3, "Max")}


def test_learning_twice_adds_nothing(spark):
    known, projects, _ = tables(spark)
    docs = spark.createDataFrame([(1, TEXT, "en")], "id int, document string, lang string")
    once = people.learned(known.where("name <> 'Grace'"), projects, docs, 2)
    new = {r.name: r for r in once.where("version = 2").collect()}
    assert set(new) == {"Marta", "Grace"} and new["Grace"].ambiguous and not new["Marta"].ambiguous and new["Marta"].source == "learned" and new["Marta"].seen >= 5 and new["Marta"].confidence >= 0.75
    again = people.learned(once, projects, docs, 3)
    assert again.count() == once.count() and people.as_of(again, 1).count() == 2
    assert people.learned(known, projects, docs.limit(0), 2).count() == 3


def test_words_that_no_table_holds_are_dropped_first(spark):
    known = people.registry(spark.createDataFrame([("Will", []), ("Thea", ["Bo"])], "name string, aliases array<string>"))
    none = spark.createDataFrame([], "name string, type string, confidence double")
    rows = [(1, "will", "thanks will, will said it's will's"), (2, "bo", "not bo"), (3, "x", "x said"), (4, "Will", "will you? not will, more: will of iron")]
    words = spark.createDataFrame(rows, "id int, word string, context string")
    every, some = (people.looked_up(words, known, none.select("name"), none, unknown=x) for x in (True, False))
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, every.where("type <> 'unknown'").collect()))
    got = {r.id: (r.type, round(r.confidence, 3)) for r in some.collect()}
    assert got == {1: ("person", 0.95), 2: ("person", 1.0), 4: ("concept", 0.9)}
    assert "SortMergeJoin" not in some._jdf.queryExecution().toString()  # contexts are not shuffled
    for p in people.PERSON_CONTEXTS + people.CONCEPT_CONTEXTS:
        assert people.needed(p) in p and "name" not in people.needed(p)
    assert [people.needed(p) for p in (r"\bthanks?\s+{name}\b", r"\b{name}(?:'s|s')\b", r"^{name}[:\s]", r"\bdrop(?:ped)?\s+(?:off\s+)?{name}\b")] == ["thank", "", "", "drop"]


def test_context_lines_keep_lines_where_they_are(spark):
    d = spark.createDataFrame([(1, "The cat\n The cat \nno the"), (2, "A The\n\nUnd The"), (2, "other"), (3, None), (4, "The end\nThe last")], "id int, document string")
    out = entities.context_lines(d, spark.createDataFrame([("The",), ("Und",), ("The",)], "name string"))
    assert sorted(map(tuple, out.collect())) == [("The", 1, "The cat"), ("The", 2, "A The"), ("The", 3, "Und The"), ("Und", 1, "Und The")]
    assert "SortMergeJoin" not in out._jdf.queryExecution().toString()
