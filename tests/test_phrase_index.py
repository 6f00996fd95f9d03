"""Phrase search by the stored index gives the rows of the scan."""

import pytest
from pyspark.sql import functions as F

from pressmill.operators.search import search_stories
from pressmill.sources.phrase_index import _postings, search_phrase_index, write_phrase_index

TEXTS = [
    "Big news of the day", "big  NEWS", "big, news", "bignews", "The U.S.\nHouse met", "UxS House", "the the the news big",
    "état-major: l'été", "ÉTÉ", None, "", "...", "news\tbig news", "big news", "a-big news!", "_big news_", "C++ & C#", "of the of the",
    "naïve big news 2024", "x" * 5000 + " big news " * 50,
]
PHRASES = ["big news", "Big", "u.s. house", "the the", "of the of", "été", "c++", "absent", "news big", "...", "2024", "big, news", "l'été"]


@pytest.fixture(scope="module")
def stories(spark):
    days = ["2024-01-01", "2024-01-02", "2024-01-05", "n/a", None]
    rows = [(i % 3, f"d{i % 4}", days[(i + j) % 5], t, TEXTS[(i * 7 + 3) % len(TEXTS)], "x")
            for j in range(5) for i, t in enumerate(TEXTS)]
    rows += rows[:20]
    return spark.createDataFrame(rows, "_row int, domain string, publication_date string, title string, `my text` string, word string").repartition(4)


@pytest.fixture(scope="module")
def domains(spark):
    return spark.createDataFrame([("d0",), ("d1",), ("d1",), ("d3",)], "name string")


@pytest.fixture(scope="module")
def path(stories, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index") / "words")
    write_phrase_index(stories, path, ("title", "my text"), buckets=8)
    return path


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("phrase", PHRASES)
@pytest.mark.parametrize("text", [("title",), ("title", "my text")])
def test_as_the_scan(spark, stories, domains, path, phrase, text):
    quoted = tuple(f"`{c}`" for c in text)
    want = search_stories(stories, domains, phrase, "2024-01-01", "2024-01-04", quoted)
    got = search_phrase_index(spark, path, domains, phrase, "2024-01-01", "2024-01-04", text)
    assert got.columns == stories.columns
    assert rows(got) == rows(want)


def test_texts_and_other_buckets_are_not_read(spark, domains, path):
    found = search_phrase_index(spark, path, domains, "big news", "2024-01-01", "2024-01-04").select("_row", "domain")
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
    scans = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    stored = [s for s in scans if "/stories" in s]
    assert stored and all("title" not in s.split("ReadSchema")[1] and "my text" not in s.split("ReadSchema")[1] for s in stored)
    assert all("PartitionFilters: [isnotnull(_day" in s for s in stored)
    postings = [s for s in scans if "/postings" in s]
    # two words, and once more where days are pruned by them
    assert len(postings) in (2, 4) and all("bucket" in s.split("PartitionFilters")[1].split("]")[0] for s in postings)
    assert all("EqualTo(word," in s for s in postings)


def test_places_are_moved_once(spark):
    texts = spark.createDataFrame([(None, 1, "title", "b a b, a"), (None, 2, "title", "..."), (None, 2, "text", "A\tc"), (None, 3, "text", None)],
                                  "_day date, _id long, _field string, _text string")
    postings = _postings(texts, 4)
    assert postings._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    got = sorted((r["word"], r["_id"], r["_field"], r["place"]) for r in postings.collect())
    assert got == [("a", 1, "title", 3), ("a", 1, "title", 6), ("a", 2, "text", 0), ("b", 1, "title", 0), ("b", 1, "title", 5), ("c", 2, "text", 3)]
    assert postings.groupBy("word").agg(F.countDistinct("bucket").alias("n")).where("n > 1").count() == 0


def test_nothing_stored(spark, stories, domains, tmp_path):
    path = str(tmp_path / "none")
    write_phrase_index(stories.limit(0), path, ("title",))
    for phrase in ("big news", "..."):
        assert search_phrase_index(spark, path, domains, phrase, "2024-01-01", "2024-01-04").count() == 0


def test_written_again(spark, stories, domains, tmp_path):
    path = str(tmp_path / "again")
    for part in ("domain = 'd0'", "domain <> 'd0'"):
        write_phrase_index(stories.where(part), path, ("title",), buckets=4)
    got = search_phrase_index(spark, path, domains, "big news", "2024-01-01", "2024-01-05")
    assert rows(got) == rows(search_stories(stories.where("domain <> 'd0'"), domains, "big news", "2024-01-01", "2024-01-05"))
