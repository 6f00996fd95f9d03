"""From raw pages to page text, paragraphs and elements (H1-H3)."""

from pyspark.sql import Column, DataFrame, functions as F

from pressmill.functions.html_reader import read_pages
from pressmill.functions.site_rules import P_TEXTS
from pressmill.functions.text import join_stripped, strip

WANTED = "array<struct<tag: string, attr: string, value: string>>"

# A string holds 2**31 bytes, and a character takes up to four.
MOST_CHARS = (1 << 29) - 1


def page_parts(pages: DataFrame, html: str = "html", wanted: Column | None = None,
               fragment: Column | None = None) -> DataFrame:
    """Parse every page once and add its parts.

    Adds ``page_text``, ``p_spans`` (place of each paragraph in it), ``p_texts``
    (their texts), ``els`` (the elements asked for) and ``parse_failed``.
    ``wanted`` is an array of ``(tag, attr, value)``, usually an expression over the
    URL, and is null for pages that need no elements: only those then leave the
    Python worker.  A page whose paragraphs would not fit in one string has failed.
    ``fragment`` is HTML found inside a script; its text is added as
    ``fragment_text``.  A null ``html`` is not parsed.

    The parse is a scalar Arrow UDF: only the page body crosses to Python, all
    other columns wait in the JVM, and there is no shuffle.
    """
    wanted = F.lit(None) if wanted is None else wanted
    fragment = F.lit(None) if fragment is None else fragment
    return (
        pages.withColumn(
            "_page", read_pages(F.col(html), wanted.cast(WANTED), fragment.cast("string")))
        .withColumns({
            "page_text": F.col("_page.page_text"),
            "p_spans": F.col("_page.p_spans"),
            "els": F.col("_page.els"),
            "fragment_text": F.col("_page.fragment_text"),
            "parse_failed": F.coalesce("_page.failed", F.lit(False)) | F.coalesce(F.expr(
                f"aggregate(_page.p_spans, 0L, (n, s) -> n + s.end - s.start + 1) > {MOST_CHARS}"), F.lit(False)),
        })
        .withColumn("p_texts", F.expr(P_TEXTS))
        .drop("_page")
    )


def paragraph_text(p_texts: str = "p_texts") -> Column:
    """All paragraphs, stripped and joined with one space."""
    return F.expr(join_stripped(p_texts))


def is_empty(p_texts: str = "p_texts", items: str | None = None) -> Column:
    """No paragraph at all, or a single one without text; counted by ``items`` if given, which is cheaper."""
    items = items or p_texts
    return F.expr(f"size({items}) = 0 OR (size({items}) = 1 AND {strip(f'{p_texts}[0]')} = '')")
