"""State updates, counts, and the article jobs from end to end."""

import json

import pytest
from pyspark.sql import functions as F

from pressmill.operators import state, stats
from pressmill.plans.articles import extract_batch, import_batch, scrape_batch
from pressmill.schemas import ARTICLE, RESPONSE
from pressmill.sources.content import get_content
from tests.test_imports import RECORD

SCHEMA = "article_id long, status string, tries int, scraping_result struct<target_url:string, content_text:string, status_code:int>"


def articles(spark):
    return spark.createDataFrame([(1, "UNPROCESSED", 0, None), (2, "UNPROCESSED", None, ("u2", None, 200)),
                                  (3, "FAILED", 4, ("u3", "t3", 404))], SCHEMA)


def test_scrape_replaces_the_result_and_counts_tries(spark):
    outcome = spark.createDataFrame([(1, "FAILED", ("n1", None, None), 1), (1, "CONTENT-FETCHED", ("n2", None, 200), 2),
                                     (2, "FAILED", ("n3", None, None), 1), (9, "FAILED", None, 1)],
                                    SCHEMA.replace("tries int, ", "") + ", t int")
    got = {r["article_id"]: r for r in state.apply_scrape(articles(spark), outcome, "t").collect()}
    assert len(got) == 3
    assert (got[1]["status"], got[1]["tries"], got[1]["scraping_result"]["target_url"]) == ("CONTENT-FETCHED", 2, "n2")
    assert (got[2]["status"], got[2]["tries"], got[2]["scraping_result"]["status_code"]) == ("FAILED", 1, None)
    assert (got[3]["status"], got[3]["tries"], got[3]["scraping_result"]["target_url"]) == ("FAILED", 4, "u3")


def test_extraction_changes_only_the_text_reference(spark):
    done = spark.createDataFrame([(2, True, "abs", "", "new")], "article_id long, text_extracted boolean, abstract string, parsing_error string, content_text string")
    once = state.apply_extraction(articles(spark), done)
    got = {r["article_id"]: r for r in once.collect()}
    assert (got[2]["status"], got[2]["tries"], got[2]["abstract"]) == ("UNPROCESSED", 1, "abs")
    assert tuple(got[2]["scraping_result"]) == ("u2", "new", 200)
    assert (got[3]["text_extracted"], got[3]["scraping_result"]["content_text"], got[3]["tries"]) == (None, "t3", 4)
    twice = {r["article_id"]: r["tries"] for r in state.apply_extraction(once, done).collect()}
    assert twice == {1: 0, 2: 2, 3: 4}


def test_counts_and_differences(spark):
    rows = [("a",)] * 3 + [("b",)] * 5 + [(None,)] * 2 + [("gone",)]
    old = stats.count_status(spark.createDataFrame(rows, "status string"))
    assert [tuple(r) for r in old.collect()] == [("b", 5), ("a", 3), (None, 2), ("gone", 1)]
    new = stats.count_status(spark.createDataFrame([("a",)] * 7 + [(None,)] + [("c",)], "status string"))
    assert {tuple(r) for r in stats.diff_counts(old, new).collect()} == {("a", 3, 7, 4), (None, 2, 1, -1), ("c", 0, 1, 1)}
    codes = stats.count_status_codes(articles(spark))
    assert {tuple(r) for r in codes.collect()} == {(None, 1), (200, 1), (404, 1)}


def test_snapshot_by_batch(spark, tmp_path):
    df = spark.createDataFrame([(1, 1), (2, 2)], "article_id long, batch_id long")
    state.write_snapshot(df, str(tmp_path / "v1"))
    assert sorted(p.name for p in (tmp_path / "v1").iterdir() if p.is_dir()) == ["batch_id=1", "batch_id=2"]


def test_replacing_batches_leaves_others(spark, tmp_path):
    path = str(tmp_path / "table")
    schema = "article_id long, v string, batch_id long"
    state.write_snapshot(spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "a", 2)], schema), path)
    table = lambda: spark.read.schema(schema).parquet(path)
    state.replace_batches(table().filter("batch_id = 2").withColumn("v", F.lit("b")), path)
    spark.catalog.refreshByPath(path)
    assert sorted(tuple(r) for r in table().collect()) == [(1, "a", 1), (2, "b", 2), (3, "b", 2)]


def test_half_a_batch_is_refused(spark, tmp_path):
    path, schema = str(tmp_path / "table"), "article_id long, v string, batch_id long"
    state.write_snapshot(spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "a", 2)], schema), path)
    with pytest.raises(ValueError, match=r"2 \(1 of 2 rows\)"):
        state.replace_batches(spark.createDataFrame([(2, "b", 2), (1, "b", 1)], schema), path)
    assert {r["v"] for r in spark.read.schema(schema).parquet(path).collect()} == {"a"}
    # a batch that is not there yet has no rows to lose
    state.replace_batches(spark.createDataFrame([(9, "b", 3)], schema), path)
    assert spark.read.schema(schema).parquet(path).count() == 4


def test_articles_from_file_to_text(spark, tmp_path):
    urls = {"http://a/ok": b"<p>caf\xe9</p>", "http://a/audio": b"x", "http://a/empty": b"", "http://a/denied": b"<p>Access denied</p>"}
    lines = [json.dumps({**RECORD, "url": url}) for url in [*urls, "http://a/none"]]
    (tmp_path / "in.json").write_text("\n".join(lines))
    responses = spark.createDataFrame(
        [(u, u, 200, {"Content-Type": "audio/x"} if "audio" in u else {}, "iso-8859-1", body, 1.0, None) for u, body in urls.items()], RESPONSE)
    step = import_batch(spark, spark.createDataFrame([], ARTICLE), str(tmp_path))
    scraped = scrape_batch(step.articles, responses, batch_id=1)
    done = extract_batch(scraped.articles, scraped.content)
    got = {r["url"][9:]: r for r in done.articles.collect()}
    assert {k: (r["status"], r["tries"], r["abstract"], r["parsing_error"]) for k, r in got.items()} == {
        "ok": ("CONTENT-FETCHED", 2, "café", ""), "denied": ("CONTENT-FETCHED", 2, "Access denied", "ERROR: Blocked from website"),
        "empty": ("CONTENT-FETCHED", 1, None, None), "audio": ("FAILED", 1, None, None), "none": ("FAILED", 1, None, None)}
    assert got["ok"]["scraping_result"]["encoding"] == "iso-8859-1"
    texts = get_content(done.articles.select("url", F.col("scraping_result.content_text").alias("content_id")), done.content)
    assert {r["url"][9:]: r["body"] for r in texts.collect() if r["body"]} == {"ok": "café", "denied": "Access denied"}
    # extracted rows keep their status, so they are taken again
    assert extract_batch(done.articles, scraped.content).articles.filter("tries = 3").count() == 2
    # failed ones are taken again until they were tried too often
    again = scrape_batch(done.articles, responses, status="FAILED", max_retries=5)
    assert again.articles.filter("status = 'FAILED'").select("tries").distinct().first()["tries"] == 2
