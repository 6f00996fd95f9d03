"""Phrase, domain and date search."""

import pytest

from pressmill.operators import search


@pytest.mark.parametrize("text, found", [
    ("In Kentucky today", True), ("KENTUCKY", True), ("kentuckys", False), ("a-kentucky.", True), ("xkentucky", False),
    ("ékentucky", False), ("", False),
])
def test_word(values, text, found):
    from pyspark.sql import functions as F
    assert values([(text,)], "t string", search.has_phrase(F.col("t"), "kentucky")) == [found]


def test_phrase_and_special_characters(values):
    from pyspark.sql import functions as F
    rows = [("the  U.S.\nHouse met",), ("the UxS. House",)]
    assert values(rows, "t string", search.has_phrase(F.col("t"), "u.s. house")) == [True, False]


def test_search_keeps_repeats_and_ignores_repeated_domains(spark):
    stories = spark.createDataFrame([
        ("a", "d1", "2022-02-09", "big news"), ("a", "d1", "2022-02-09", "big news"), ("b", "d2", "2022-02-12", "Big News!"),
        ("c", "d1", "2022-02-13", "big news"), ("d", "d3", "2022-02-10", "big news"), ("e", "d1", "2022-02-10", None),
    ], "url string, domain string, publication_date string, title string")
    sources = spark.createDataFrame([(1, "d1"), (1, "d1"), (1, "d2"), (2, "d3")], "collection_id long, name string")
    domains = search.collection_domains(sources, 1)
    assert domains.count() == 3
    found = search.search_stories(stories, domains, "big news", "2022-02-09", "2022-02-12")
    assert sorted(r["url"] for r in found.collect()) == ["a", "a", "b"]
    assert search.search_stories(stories, domains.limit(0), "big news", "2022-02-09", "2022-02-12").count() == 0
