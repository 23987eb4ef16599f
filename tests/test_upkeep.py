"""Personas, contents, and the totals of a dedup run, worked out by hand."""

import pytest
from pyspark.sql import functions as F

from lorespark.functions import sanitize
from lorespark.operators import entities, neardup


def test_personas_apart(spark):
    found = spark.createDataFrame([("Ada", "person"), ("Bo", "uncertain"), ("Cy", "project"), ("Di", "person"), (None, "person")], "name string, type string")
    personas = spark.createDataFrame([("ADA",), ("bo",), ("cy",), ("bo",), (None,)], "name string")
    got = {r.name: r.type for r in entities.reclassified(found, personas).collect()}
    assert got == {"Ada": "persona", "Bo": "persona", "Cy": "project", "Di": "person", None: "person"}


def test_contents(spark):
    d = spark.createDataFrame([(0, "fine"), (1, " \n"), (2, None), (3, "x" * (sanitize.CONTENT_LENGTH + 1)), (4, "a\0b")], "id int, c string")
    got = {r.id: r.e for r in d.select("id", sanitize.content_error(F.col("c")).alias("e")).collect()}
    assert got == {0: None, 1: "content is empty", 2: "content is empty", 3: "content is too long", 4: "content holds a null byte"}
    names = spark.createDataFrame([(" Ann ",), ("a/b",)], "n string")
    assert spark.createDataFrame([(" Ann ",)], "n string").select(sanitize.checked_name(F.col("n")).alias("n")).first().n == "Ann"
    with pytest.raises(Exception, match="name holds a path"):
        names.select(sanitize.checked_name(F.col("n"))).collect()


def test_dedup_totals(spark):
    flags = spark.createDataFrame([(1, "a", True), (2, "a", False), (3, "a", True), (4, "b", False)], "id int, source_file string, kept boolean")
    assert sorted(tuple(r) for r in neardup.dedup_totals(flags).collect()) == [("a", 3, 2, 1), ("b", 1, 0, 1)]
