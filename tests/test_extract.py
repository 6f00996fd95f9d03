"""How findings are combined."""

from pyspark.sql import functions as F

from pressmill.functions.rules import is_error
from pressmill.operators.extract import extraction_update, resolve_pair, resolve_strict

PAGES = [
    ("http://a/1", "<p> one </p><p></p><p>two</p>"),
    ("http://a/2", "<p>Access Denied</p>"),
    ("http://www.dailywire.com/3", "<p>Access denied</p><div id=post-body-text>site text</div>"),
    ("http://a/4", "<div>x</div>"),
    ("http://instagram.com/5", "<p>text</p>"),
    ("http://sbs.com.au/6", "<p>text</p>"),
    ("http://sbs.com.au/7", "<p>access denied</p>"),
    ("http://a/8", ""),
]


def test_pair_keeps_text_and_error_apart(spark):
    df = spark.createDataFrame(PAGES, "url string, html string")
    got = {r["url"]: (r["text"], r["error"], r["extract_exception"]) for r in resolve_pair(df).collect()}
    assert got == {
        "http://a/1": ("one  two", "", False),
        "http://a/2": ("Access Denied", "ERROR: Blocked from website", False),
        # a site result replaces the error, even if it is text
        "http://www.dailywire.com/3": ("Access denied", "site text", False),
        "http://a/4": ("", "ERROR: No text gathered", False),
        # URL rules are not asked
        "http://instagram.com/5": ("text", "", False),
        "http://sbs.com.au/6": (None, None, True),
        "http://sbs.com.au/7": (None, None, True),
        "http://a/8": ("", "ERROR: No text gathered", False),
    }


def test_strict_stops_at_the_first_error(spark):
    rows = [("en", url, page, None) for url, page in PAGES] + [
        ("de", "http://a/9", "<p>x</p>", None), (None, "http://a/10", "<p>x</p>", None),
        ("en", "http://a/11", None, "ReadTimeout"), ("en", "http://a/12.pdf", None, "ReadTimeout"),
    ]
    df = spark.createDataFrame(rows, "language string, url string, content string, error_kind string")
    got = {r["url"].split("/")[-1]: (r["text"], r["extract_exception"]) for r in resolve_strict(df).collect()}
    assert got == {
        "1": ("one  two", False), "2": ("ERROR: Blocked from website", False),
        "3": ("ERROR: Blocked from website", False), "4": ("ERROR: No text gathered", False),
        "5": ("ERROR: Video/ Image content only", False), "6": (None, True),
        "7": ("ERROR: Blocked from website", False), "8": ("ERROR: Article not found", False),
        "9": ("ERROR: Not in English", False), "10": ("ERROR: Not in English", False),
        "11": ("ERROR: requests.exceptions.ReadTimeout", False), "12.pdf": ("ERROR: Content is a pdf", False),
    }
    errors = {r["url"] for r in resolve_strict(df).filter(is_error(F.col("text"))).collect()}
    assert len(errors) == 10 and "http://a/1" not in errors
    anything = resolve_strict(df, english_only=False).filter(F.col("url") == "http://a/9").first()
    assert anything["text"] == "x"


def test_update_leaves_unstored_and_failed_pages_out(spark):
    df = spark.createDataFrame(
        [("http://a/1", "<p>" + "é" * 300 + "</p>", "c1"), ("http://a/2", "<p>x</p>", None),
         ("http://sbs.com.au/3", "<p>x</p>", "c3")], "url string, html string, content_html string")
    rows = extraction_update(resolve_pair(df)).collect()
    assert [(r["url"], r["abstract"], r["text_extracted"], r["parsing_error"]) for r in rows] == [
        ("http://a/1", "é" * 250, True, "")]
