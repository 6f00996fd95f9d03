"""Plans that matter at scale."""

import re

from pyspark.sql import functions as F

from pressmill.operators import extract, search, state, stats, tasks
from pressmill.schemas import ARTICLE
from pressmill.sources import content


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stored(spark, tmp_path, schema=ARTICLE):
    path = str(tmp_path / "t")
    row = [F.lit(3 if f.name == "batch_id" else None).cast(f.dataType).alias(f.name) for f in schema]
    spark.range(1).select(*row).write.partitionBy("batch_id").parquet(path)
    return spark.read.schema(schema).parquet(path)


def test_selection_reaches_the_scan(spark, tmp_path):
    plan = plan_of(tasks.fetch_tasks(stored(spark, tmp_path), 3, "FAILED", 0, ["article_id", "url", "tries"]))
    assert "EqualTo(status,FAILED)" in plan and "batch_id" in re.search(r"PartitionFilters: \[(.*?)\]", plan)[1]
    read = re.search(r"ReadSchema: struct<(.*?)>", plan)[1]
    assert set(re.findall(r"(\w+):", read)) == {"article_id", "url", "status", "tries"}
    assert "Exchange" not in plan


def test_counts_read_one_column_and_combine_first(spark, tmp_path):
    plan = plan_of(stats.count_status_codes(stored(spark, tmp_path)))
    assert "ReadSchema: struct<scraping_result:struct<status_code:int>>" in plan
    assert "partial_count" in plan


def test_updates_are_shuffled_once(spark, tmp_path):
    articles = stored(spark, tmp_path)
    outcome = articles.select("article_id", "status", "scraping_result")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = plan_of(state.apply_scrape(articles, outcome))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(article_id") == 2  # articles and updates


def test_search_is_a_semi_join(spark):
    stories = spark.createDataFrame([], "title string, domain string, publication_date string")
    sources = spark.createDataFrame([], "collection_id long, name string")
    found = search.search_stories(stories, search.collection_domains(sources, 1), "a", "2024-01-01", "2024-01-02")
    assert "LeftSemi" in found._jdf.queryExecution().optimizedPlan().toString()


def test_extraction_has_no_shuffle_and_one_parse(spark):
    pages = spark.createDataFrame([("u", "<p>x</p>")], "url string, html string")
    plan = plan_of(extract.resolve_pair(pages))
    assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 1


def content_table(spark, tmp_path):
    path = str(tmp_path / "content")
    articles = spark.range(60).selectExpr("id AS article_id", "concat('u', id) AS url", "0 AS tries",
                                          "CASE WHEN id % 6 > 0 THEN id % 6 END AS batch_id", "concat('<p>', id) AS body")
    stored, refs = content.put_content(articles, "body", "html")
    content.append_content(stored, path)
    refs.write.parquet(str(tmp_path / "refs"))
    return path, spark.read.parquet(str(tmp_path / "refs"))


def test_bodies_of_other_batches_are_pruned_at_run_time(spark, tmp_path):
    path, refs = content_table(spark, tmp_path)
    some = refs.filter("batch_id = 3 AND tries = 0")
    found = content.stored_bodies(some, content.read_content(spark, path, "html"))
    plan = plan_of(found)
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "body" in line)
    filters = scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "dynamicpruning" in filters and "kind" in filters
    assert sorted(r["body"] for r in found.collect()) == sorted(f"<p>{i}" for i in range(60) if i % 6 == 3)
    # a body of an article without a batch is found as well
    alone = refs.filter("batch_id IS NULL")
    assert content.get_content(alone, content.read_content(spark, path, "html")).filter("body IS NOT NULL").count() == 10
    assert content.content_info(alone, content.read_content(spark, path, "html")).filter("stored_kind = 'html'").count() == 10


def test_one_batch_is_read_for_the_extraction_of_one(spark, tmp_path):
    path, _ = content_table(spark, tmp_path)
    for batches, folders in (([2], {"batch=2"}), ([None, 1], {"batch=-1", "batch=1"})):
        found = content.read_content(spark, path, "html", batches)
        read = {part for name in found.inputFiles() for part in name.split("/") if part.startswith("batch=")}
        plan = plan_of(found)
        assert "PartitionFilters: [" in plan and "batch" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
        assert found.count() == 10 * len(folders) and folders <= read
