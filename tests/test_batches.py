"""The versioned table of batches, and the jobs on it."""

import json
import pathlib

import pytest
from pyspark.sql import functions as F

from pressmill.plans.articles import run_extract, run_import, run_scrape
from pressmill.schemas import RESPONSE, table as schema_of
from pressmill.sources.batches import BatchRefused, BatchTable, VersionExists
from pressmill.sources.content import get_content, read_content
from pyspark.sql import types as T
from tests.test_imports import RECORD

SCHEMA = schema_of(article_id=T.LongType(), v=T.StringType(), batch_id=T.LongType())


@pytest.fixture
def table(spark, tmp_path):
    return BatchTable(spark, f"file:{tmp_path}/table", SCHEMA)


def rows(spark, *items):
    return spark.createDataFrame(items, SCHEMA)


def contents(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def files(tmp_path):
    return {str(p): (p.stat().st_mtime_ns, p.stat().st_size) for p in pathlib.Path(tmp_path).rglob("*.parquet")}


def test_other_batches_stay_untouched(spark, tmp_path, table):
    assert table.latest() == 0 and table.read().count() == 0
    assert table.append(rows(spark, (1, "a", 1), (2, "a", 2), (3, "a", 2), (4, "a", None))) == 1
    before = files(tmp_path)
    assert table.update(table.read([2]).withColumn("v", F.lit("b"))) == 2
    after = files(tmp_path)
    assert {f: after[f] for f in before} == before
    assert contents(table.read()) == [(1, "a", 1), (2, "b", 2), (3, "b", 2), (4, "a", None)]
    assert contents(table.read([None, 9])) == [(4, "a", None)]
    # a reader keeps the version it began with
    assert contents(table.read(version=1)) == [(1, "a", 1), (2, "a", 2), (3, "a", 2), (4, "a", None)]
    one, two = table.batches(1), table.batches(2)
    assert one[1] == two[1] and one[None] == two[None] and one[2] != two[2] and two[2].rows == 2


def test_only_the_folders_of_a_batch_are_read(spark, table):
    table.append(rows(spark, *[(i, "a", i % 5) for i in range(50)]))
    found = table.read([3])
    assert all("_batch=3" in name for name in found.inputFiles()) and found.count() == 10


def test_half_batches_and_unknown_ones_are_refused(spark, table):
    table.append(rows(spark, (1, "a", 1), (2, "a", 1), (3, "a", 2)))
    for wrong in ([(1, "b", 1)], [(1, "b", 1), (2, "b", 1), (2, "b", 1)], [(3, "b", 2), (9, "b", 7)], [(9, "b", None)]):
        with pytest.raises(BatchRefused):
            table.update(rows(spark, *wrong))
    with pytest.raises(BatchRefused):
        table.append(rows(spark, (5, "b", 2)))
    assert table.versions() == [1] and contents(table.read()) == [(1, "a", 1), (2, "a", 1), (3, "a", 2)]


def test_two_jobs_cannot_publish_one_version(spark, table):
    table.append(rows(spark, (1, "a", 1)))
    seen = table.latest()
    table.update(rows(spark, (1, "b", 1)), since=seen)
    with pytest.raises(VersionExists):
        table.update(rows(spark, (1, "c", 1)), since=seen)
    with pytest.raises(VersionExists):
        table._publish(2, {})
    assert contents(table.read()) == [(1, "b", 1)] and table.versions() == [1, 2]


def test_old_versions_are_forgotten(spark, tmp_path, table):
    table.append(rows(spark, (1, "a", 1), (2, "a", 2)))
    for v in "bcd":
        table.update(table.read([2]).withColumn("v", F.lit(v)))
    with pytest.raises(BatchRefused):
        table.append(rows(spark, (7, "x", 1)))
    table.append(rows(spark, (3, "a", 3)), replace=[1])
    table.forget(keep=2)
    assert table.versions() == [4, 5]
    assert contents(table.read()) == [(2, "d", 2), (3, "a", 3)]
    assert contents(table.read(version=4)) == [(1, "a", 1), (2, "d", 2)]
    table.forget(keep=1)
    assert contents(table.read()) == [(2, "d", 2), (3, "a", 3)]
    folders = {p.name for p in (tmp_path / "table/data").glob("*/*") if p.is_dir()}
    assert folders == {"_batch=2", "_batch=3"}


def test_jobs_from_files_to_text(spark, tmp_path):
    def put(name, urls):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "in.json").write_text("\n".join(json.dumps({**RECORD, "url": u}) for u in urls) + "\n[]")
        return str(folder)

    table, pages = BatchTable(spark, f"file:{tmp_path}/articles"), str(tmp_path / "pages")
    responses = spark.createDataFrame(
        [(u, u, 200, {}, "utf-8", f"<p>{u[-1]}{t}</p>".encode(), 1.0, None, t) for u in ("http://a/1", "http://a/2", "http://b/3") for t in (2, 1)],
        ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RESPONSE) + ", t int")
    version, rejected = run_import(table, put("one", ["http://a/1", "http://a/2"]))
    assert version == 1 and rejected.count() == 1
    assert run_import(table, put("two", ["http://b/9"]))[0] == 2
    assert run_import(table, put("three", ["http://b/3", "http://b/4"]), overwrite=True)[0] == 3
    assert sorted(table.batches()) == [1, 2] and table.batches()[2].rows == 2
    first = table.batches()[1]
    assert run_scrape(table, pages, responses, "last", newest="t") == 4
    assert table.batches()[1] == first
    assert run_scrape(table, pages, responses, newest="t") == 5
    second = table.batches()[2]
    assert run_extract(table, pages, 1) == 6
    assert table.batches()[2] == second
    assert run_extract(table, pages) == 7
    # nothing to do publishes nothing
    assert run_scrape(table, pages, responses) == 7
    got = {r["url"][-1]: r for r in table.read().collect()}
    assert {k: (r["batch_id"], r["status"], r["tries"], r["abstract"]) for k, r in got.items()} == {
        "1": (1, "CONTENT-FETCHED", 3, "12"), "2": (1, "CONTENT-FETCHED", 3, "22"),
        "3": (2, "CONTENT-FETCHED", 2, "32"), "4": (2, "FAILED", 1, None)}
    texts = get_content(table.read().select("url", F.col("scraping_result.content_text").alias("content_id")), read_content(spark, pages))
    assert {r["url"][-1]: r["body"] for r in texts.collect()} == {"1": "12", "2": "22", "3": "32", "4": None}
