"""Article text and errors of a page."""

from pyspark.sql import Column, DataFrame, functions as F

from pressmill.functions.rules import (
    empty_page_result, last_resort_label, page_text_label, url_label,
)
from pressmill.functions.site_rules import (
    EMPTY_PAGE_SITES, P_TEXTS, SITES, by_site, fall_through, site_of_url, wanted_elements,
)
from pressmill.operators.fetch import fetch_error_label
from pressmill.operators.html import is_empty, page_parts, paragraph_text
from pressmill.operators.tasks import gate_label
from pressmill.session import settle

ABSTRACT_LENGTH = 250


def extract_parts(pages: DataFrame, url: str = "url", html: str = "html",
                  settled: Column | None = None) -> DataFrame:
    """Parse each page once and add what it yields; no shuffle.

    Adds the columns of `page_parts` and

    * ``page_label``     label of an error message in the page text (C2)
    * ``site_result``    text or label by the rules of its site (X1-X17)
    * ``empty_result``   text or label for a page without paragraph text
      (C3, X18-X20, C4), null for other pages
    * ``paragraphs``     joined paragraph text (H2)
    * ``site_failed``, ``empty_failed``  the site's data could not be read
    * ``extract_exception``  one of these, or the page itself, failed

    Pages whose outcome is ``settled`` already (not null) are not parsed.
    """
    settle(pages)
    body = F.col(html)
    if settled is not None:
        body = F.when(settled.isNull(), body)
    df = pages.withColumns({"_url": F.col(url), "_body": body}).withColumns({
        "_first_site": F.expr(site_of_url(SITES)),
        "_empty_site": F.expr(site_of_url(EMPTY_PAGE_SITES)),
    })
    df = page_parts(
        df, "_body", F.expr(wanted_elements()),
        F.expr(by_site("_first_site", SITES, "fragment_html", "NULL")),
    )
    df = df.withColumns({
        "_site": F.expr(fall_through("_first_site")),
        "_lower_text": F.lower("page_text"),
        "_empty": is_empty(P_TEXTS, "p_spans"),
    })
    df = df.withColumns({
        "page_label": page_text_label("_lower_text"),
        "site_result": F.expr(by_site("_site", SITES, "result", "NULL")),
        "site_failed": F.expr(f"coalesce({by_site('_site', SITES, 'failed', 'false')}, false)"),
        "paragraphs": paragraph_text(P_TEXTS),
        "_by_rules": F.when(F.col("_empty"), empty_page_result("_url", "page_text", "_lower_text")),
    })
    unexplained = F.col("_empty") & F.col("_by_rules").isNull()
    last = F.when(F.col("_empty_site").isNull(), last_resort_label("_url")).otherwise(
        F.expr(by_site("_empty_site", EMPTY_PAGE_SITES, "result", "NULL")))
    failed = F.expr(f"coalesce({by_site('_empty_site', EMPTY_PAGE_SITES, 'failed', 'false')}, false)")
    return df.withColumns({
        "empty_result": F.coalesce("_by_rules", F.when(unexplained, last)),
        "empty_failed": F.coalesce(unexplained & failed, F.lit(False)),
    }).withColumn(
        "extract_exception", F.col("parse_failed") | F.col("site_failed") | F.col("empty_failed")
    ).drop("_url", "_body", "_first_site", "_empty_site", "_site", "_lower_text", "_empty",
           "_by_rules")


def resolve_pair(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Add ``text`` and ``error`` of stored pages, and ``extract_exception``.

    ``text`` is always the paragraph text.  ``error`` is the last finding of:
    page text rules, site rules, rules for empty pages; a site rule that found
    article text puts it there too.  Empty string means no finding.
    """
    df = extract_parts(pages, url, html)
    error = F.coalesce("empty_result", "site_result", "page_label", F.lit(""))
    readable = ~F.col("extract_exception")
    return df.withColumns({
        "text": F.when(readable, F.col("paragraphs")),
        "error": F.when(readable & F.col("p_spans").isNotNull(), error),
    }).select(*pages.columns, "text", "error", "extract_exception")


def resolve_strict(stories: DataFrame, english_only: bool = True, url: str = "url",
                   content: str = "content", language: str = "language",
                   error_kind: str | None = "error_kind") -> DataFrame:
    """Add ``text``: article text, or the first error met on the way to it.

    In order: language, URL rules, fetch errors, page text rules, site rules,
    rules for empty pages, paragraphs.  Rows settled by the first three are never
    parsed.  ``extract_exception`` marks pages whose site data could not be read.
    """
    kind = F.col(error_kind) if error_kind else F.lit(None).cast("string")
    settled = F.coalesce(
        gate_label(english_only, language),
        url_label(url),
        fetch_error_label(kind, kind, F.col(content)),
    )
    df = extract_parts(stories.withColumn("_settled", settled), url, content, F.col("_settled"))
    # a failing site rule stops the row only if nothing before it settled it
    broken = F.col("parse_failed") | (F.col("page_label").isNull() & (
        F.col("site_failed") | (F.col("site_result").isNull() & F.col("empty_failed"))))
    found = F.coalesce("page_label", "site_result", "empty_result", "paragraphs")
    return df.withColumns({
        "extract_exception": broken,
        "text": F.coalesce("_settled", F.when(~broken, found)),
    }).select(*stories.columns, "text", "extract_exception")


def extraction_update(resolved: DataFrame, html_ref: str = "content_html") -> DataFrame:
    """Values to store for each extracted page, by article id.

    Rows without a reference, rows whose page is not in the content table (there is
    then nothing found, not even an empty ``error``) and rows whose extraction failed
    give no update.
    """
    done = F.col(html_ref).isNotNull() & F.col("error").isNotNull() & ~F.col("extract_exception")
    return resolved.filter(done).withColumns({
        "text_extracted": F.lit(True),
        "abstract": F.substring("text", 1, ABSTRACT_LENGTH),
        "parsing_error": F.col("error"),
    })
