"""Article jobs: each takes the article table to its next version.

``*_batch`` return DataFrames and leave writing to the caller, never over the version
being read.  ``run_*`` do the same on a `BatchTable`: only batches with work are read
and written, bodies are stored first, and then a version is published.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pressmill.operators.extract import extraction_update, resolve_pair
from pressmill.operators.fetch import (
    attach_newest, build_scraping_result, decode_body,
)
from pressmill.operators.imports import (
    append_articles, check_articles, delete_batch, first_open_batch_id, latest_batch_id,
    next_batch_id, split_checked, stamp_articles,
)
from pressmill.operators.state import apply_extraction, apply_scrape
from pressmill.operators.tasks import (
    assign_blocks, fetch_tasks, pause_plan, retry_filter, shuffle_tasks, stripe,
)
from pressmill.schemas import CONTENT_FETCHED, FAILED, UNPROCESSED
from pressmill.session import write_between
from pressmill.sources.batches import BatchTable
from pressmill.sources.content import append_content, put_content, read_content, stored_bodies
from pressmill.sources.records import read_lines

# Fixed value: default of the fetch job.  No limit is set unless the caller gives one.
MAX_RETRIES = 5


@dataclass
class Step:
    """Result of a job: the next version of the articles, and rows beside it."""
    articles: DataFrame
    content: DataFrame | None = None   # page bodies to append
    rejected: DataFrame | None = None  # records for quarantine


def import_batch(spark: SparkSession, articles: DataFrame, folder: str, overwrite: bool = False,
                 pattern: str = "*.json") -> Step:
    """Import JSON-lines files as a new batch; ``overwrite`` replaces the last one."""
    if overwrite:
        articles = delete_batch(articles, latest_batch_id(articles).scalar())
    checked = write_between(check_articles(read_lines(spark, folder, pattern)))
    accepted, rejected = split_checked(checked)
    new = write_between(stamp_articles(accepted, next_batch_id(articles).scalar()))
    return Step(append_articles(articles, new), rejected=rejected)


def choose_batch(articles: DataFrame, batch: int | str | None, status: str) -> Column | int | None:
    """Batch id of ``"all"``, ``"first"`` (with rows of the status), ``"last"`` or a number; None for all."""
    if batch in (None, "all", 0):
        return None
    if batch == "last":
        return latest_batch_id(articles).scalar()
    if batch == "first":
        return first_open_batch_id(articles, status).scalar()
    return int(batch)


def fetch_plan(articles: DataFrame, n: int, seed: int, batch: int | str | None = None,
               status: str = UNPROCESSED, limit: int = 0, max_retries: int = MAX_RETRIES,
               min_s: int = 1, max_s: int = 5) -> DataFrame:
    """Fetch work of ``n`` blocks: tasks in random order, each site in one block, with its pauses.

    Adds ``draw``, ``block``, ``pause`` and ``start_offset``.
    """
    chosen = fetch_tasks(articles, choose_batch(articles, batch, status), status, limit,
                         ["article_id", "url", "media_url", "tries"])
    dealt = assign_blocks(shuffle_tasks(retry_filter(chosen, max_retries), seed), n)
    return pause_plan(dealt, "draw", min_s, max_s, seed, domain="media_url", by="block")


def extract_plan(articles: DataFrame, n: int, batch: int | str | None = None,
                 status: str = CONTENT_FETCHED, limit: int = 0) -> DataFrame:
    """Extraction work dealt out to ``n`` blocks in turn."""
    chosen = fetch_tasks(articles, choose_batch(articles, batch, status), status, limit, ["article_id", "url"])
    return stripe(chosen, n)


def scrape_batch(articles: DataFrame, responses: DataFrame, batch_id: int | str | None = None,
                 status: str = UNPROCESSED, limit: int = 0,
                 max_retries: int = MAX_RETRIES, newest: str | None = None) -> Step:
    """Take the outcome of fetching from captured responses.

    Each task takes one response, the newest of its URL by the column ``newest``.
    Bodies over a limit are dropped with their row set to failed; the others are
    decoded, to be stored apart from the article.
    """
    chosen = fetch_tasks(articles, choose_batch(articles, batch_id, status), status, limit,
                         ["article_id", "url", "tries", "batch_id"])
    tasks = retry_filter(chosen, max_retries)
    got = attach_newest(tasks, responses, newest)
    part = lambda name: F.col(f"response.{name}")
    failed = (F.col("status") == FAILED) | part("capped").isNotNull()
    got = got.withColumns({
        "status": F.when(failed, FAILED).otherwise(CONTENT_FETCHED),
        "response": F.when(~failed, F.col("response")),
    })
    got = got.withColumns({"body": part("body"), "encoding": part("encoding")})
    # the body itself goes on as decoded text only, written once for both results
    slim = F.col("response").withField("encoding", F.col("used_encoding")).dropFields("body")
    decoded = write_between(decode_body(got).withColumn("response", slim).drop("body"))
    content, refs = put_content(decoded, "content", "html")
    outcome = build_scraping_result(refs).select("article_id", "status", "scraping_result")
    return Step(apply_scrape(articles, outcome), content)


def extract_batch(articles: DataFrame, content: DataFrame, batch_id: int | str | None = None,
                  status: str = CONTENT_FETCHED, limit: int = 0) -> Step:
    """Extract text from stored pages; articles without a stored page stay as they are."""
    tasks = fetch_tasks(articles, choose_batch(articles, batch_id, status), status, limit,
                        ["article_id", "url", "tries", "batch_id", "scraping_result"])
    refs = tasks.withColumn("content_html", F.col("scraping_result.content_html")).drop("scraping_result")
    refs = refs.filter(F.col("content_html").isNotNull())
    pages = stored_bodies(refs, content.filter(F.col("kind") == "html"), "content_html")
    resolved = extraction_update(resolve_pair(pages, html="body"))
    done = write_between(resolved.select(
        "article_id", "url", "tries", "batch_id", "text", "text_extracted", "abstract", "parsing_error"))
    texts, refs = put_content(done, "text", "text")
    extracted = refs.withColumnRenamed("content_id", "content_text")
    return Step(apply_extraction(articles, extracted), texts)


def run_import(table: BatchTable, folder: str, overwrite: bool = False, pattern: str = "*.json") -> tuple[int, DataFrame]:
    """Import files as a new batch; ``overwrite`` replaces the last one.  The version, and the refused records.

    No stored article is read: ids of batches are known from the manifest.
    """
    known = sorted(b for b in table.batches() if b is not None)
    replace = known[-1:] if overwrite else []
    number = max([b for b in known if b not in replace], default=0) + 1
    checked = write_between(check_articles(read_lines(table.spark, folder, pattern)))
    accepted, rejected = split_checked(checked)
    return table.append(stamp_articles(accepted, number), replace), rejected


def _with_work(table: BatchTable, version: int, batch: int | str | None, status: str, limit: int) -> list[int | None]:
    """Batches that the tasks of a job are in; a manifest's number of ids at most."""
    articles = table.read(version=version).select("article_id", "batch_id", "status")
    chosen = fetch_tasks(articles, choose_batch(articles, batch, status), status, limit, ["article_id", "batch_id"])
    return [row[0] for row in chosen.select("batch_id").distinct().collect()]


def run_scrape(table: BatchTable, content_path: str, responses: DataFrame, batch: int | str | None = None,
               status: str = UNPROCESSED, limit: int = 0, max_retries: int = MAX_RETRIES, newest: str | None = None) -> int:
    """`scrape_batch` on the batches with tasks; the published version."""
    return _run(table, content_path, batch, status, limit, lambda articles, _: scrape_batch(
        articles, responses, None, status, limit, max_retries, newest))


def run_extract(table: BatchTable, content_path: str, batch: int | str | None = None,
                status: str = CONTENT_FETCHED, limit: int = 0) -> int:
    """`extract_batch` on the batches with tasks; the published version."""
    return _run(table, content_path, batch, status, limit, lambda articles, batches: extract_batch(
        articles, read_content(table.spark, content_path, "html", batches), None, status, limit))


def _run(table: BatchTable, content_path: str, batch, status: str, limit: int, job) -> int:
    version = table.latest()
    touched = _with_work(table, version, batch, status, limit)
    if not touched:
        return version
    step = job(table.read(touched, version), touched)
    append_content(step.content, content_path)
    return table.update(step.articles, since=version)
