"""One small page per site, with its missing, empty and broken cases."""

import json

import pytest

from pressmill.operators.extract import extract_parts

BODY = "<p>par</p>"
LD = '<script type="application/ld+json">{}</script>'
JS = '<script type="application/json">{}</script>'
NO_TEXT, FORBIDDEN = "ERROR: No text gathered", "ERROR: 403 Forbidden"
VIDEO = "ERROR: Video/ Image content only"
FAILED = object()


def nested(*keys, value):
    for key in reversed(keys):
        value = {key: value}
    return json.dumps(value)


LEAF = ("props", "pageProps", "data", "page", "leaf")
RENDERED = ("body", "queried_object", "content")
NR = "<script>nr.headless.preloadedData = {};\n</script>"

CASES = [
    # X1
    ("https://qz.com/1", LD.format('{"x": 1}') + LD.format('{"articleBody": "The text"}'), "The text"),
    ("https://www.newsweek.com/1", LD.format('{"x": "articleBody"}'), NO_TEXT),
    ("https://scmp.com/1", BODY + "<p> two </p>", "par two"),
    ("https://scmp.com/1", "<div>x</div>", NO_TEXT),
    ("https://scmp.com/1", BODY + "Forbidden", FORBIDDEN),
    ("https://scmp.com/1", LD.format('{"articleBody": bad'), FAILED),
    ("https://scmp.com/1", LD.format('[{"articleBody": "list"}]'), FAILED),
    ("https://scmp.com/1", LD.format('{"articleBody": "a"} more'), FAILED),
    ("https://scmp.com/1", LD.format("") + LD.format('{"articleBody": "a"}'), FAILED),
    ("https://scmp.com/1", BODY + LD.format('{"articleBody": null}'), None),
    ("https://scmp.com/1", BODY + JS.format('{"articleBody": "wrong type"}'), "par"),
    # X2, X3, X7, X14, X16
    ("http://miamiherald.typepad.com/a", "<div id='story-content'> a </div><div id='story-content'>b</div>", "a b"),
    ("http://miamiherald.typepad.com/a", BODY, ""),
    ("http://dailywire.com/a", "<div id=post-body-text>x</div>", "x"),
    ("http://blacknews.com/news/a", "<div class='post-body entry-content'>x</div>", "x"),
    ("http://blacknews.com/news/a", "<div class='post-body entry-content wide'>x</div>", ""),
    ("http://www.NewsMax.com/a", "<div id=mainArticleDiv>x</div>", "x"),
    ("http://f/NDTV-LatestNews/a", "<div id=ins_storybody>x</div>", "x"),
    # X4
    ("http://nationalreview.com/a", NR.format(nested("k", *RENDERED, "rendered", value="<b>x</b> &amp; y ")), "x & y"),
    ("http://nationalreview.com/a", BODY, "ERROR: No text fathered"),
    ("http://nationalreview.com/a", NR.format('{"k": 1}'), FAILED),
    ("http://nationalreview.com/a", NR.format("{broken"), FAILED),
    # X5
    ("http://columbiaspectator.com/a", "<script>Fusion.globalContent=" + json.dumps({"content_elements": [
        {"type": "text", "content": " one"}, {"type": "image", "content": "no"}, {"type": "text", "content": "two"}]})
     + ";Fusion.x={};</script>", " one two"),
    ("http://columbiaspectator.com/a", BODY, FAILED),
    ("http://columbiaspectator.com/a", "<script>Fusion.globalContent={\"a\": 1};</script>", FAILED),
    ("http://columbiaspectator.com/a", "<script>Fusion.globalContent={\"content_elements\": [{\"type\": \"text\"}]};</script>", FAILED),
    # X6
    ("http://toledoblade.com/a", '<script>pgStoryZeroJSON = {"articles": [\n{"body": "<i>x</i> y"}]}</script>', "x y"),
    ("http://toledoblade.com/a", '<script>pgStoryZeroJSON = {"body": "<i>x</i> y","z": 1};</script>', "x y,"),
    ("http://toledoblade.com/a", '<script>pgStoryZeroJSON = broken</script>', FAILED),
    ("http://toledoblade.com/a", '<script>pgStoryZeroJSON = {"articles": [{}]}</script>', FAILED),
    ("http://toledoblade.com/a", '<!-- <script>pgStoryZeroJSON = broken</script> -->' + BODY, None),
    ("http://toledoblade.com/tampabay.com", BODY, NO_TEXT),
    ("http://toledoblade.com/thepoliticalinsider/tampabay.com",
     '<script class="yoast-schema-graph">{"a": 1}</script>', NO_TEXT),
    # X8
    ("http://thepoliticalinsider.com/a", "<div class='text article-body font-default font-size-med'>x</div>", "x"),
    ("http://thepoliticalinsider.com/a", BODY, "ERROR: Scraping error during JSON conversion"),
    ("http://thepoliticalinsider.com/a", '<script class="yoast-schema-graph">{"a": 1}</script>', None),
    ("http://thepoliticalinsider.com/a", '<script class="yoast-schema-graph">{broken</script>', FAILED),
    # X9, X10, X12, X17
    ("http://ibtimes.co.uk/a", BODY, NO_TEXT),
    ("http://ibtimes.com/a", "Forbidden", FORBIDDEN),
    ("http://tampabay.com/a", BODY, NO_TEXT),
    ("http://timesofindia.com/videoshow/a", BODY, VIDEO),
    ("http://timesofindia.com/photostory", BODY, "ERROR: Video/ Image content only"),
    ("http://elsewhere.com/a", BODY, None),
    # X11
    ("http://newsday.com/a", JS.format(nested(*LEAF, "bodyText", value="text")), "text"),
    ("http://newsday.com/a", JS.format('{"bodyText": "elsewhere"}'), NO_TEXT),
    ("http://newsday.com/a", BODY, NO_TEXT),
    ("http://newsday.com/a", JS.format('bodyText'), FAILED),
    # X13
    ("http://timesofindia.com/a", "<div data-articlebody=1> x </div>", "x"),
    ("http://timesofindia.com/a", "<div class='main-content single-article-content'>y</div>", "y"),
    ("http://timesofindia.com/a", BODY, NO_TEXT),
    # X15
    ("http://sbs.com.au/a", JS.format("{}") + JS.format(
        nested("props", "pageProps", "pageContent", "parsedBody", value=["a", {"b": 1}, 2, "c"])), "a c"),
    ("http://sbs.com.au/a", BODY, FAILED),
    ("http://sbs.com.au/a", JS.format("{}"), FAILED),
]

EMPTY_CASES = [
    # X18-X20 and the last resort
    ("http://ynetnews.com/a", "<span data-text=true> a </span><span data-text='true'>b</span><span>c</span>", "a b"),
    ("http://refinery29.com/a", "<div class='x section-text'>a</div>", "a"),
    ("http://cnbctv18.com/a", '<script type="x application/ld+json">{"articleBody": "a"}</script>', "a"),
    ("http://cnbctv18.com/a", LD.format('{"articleBod": "a"}'), FAILED),
    ("http://cnbctv18.com/a", LD.format("") + LD.format('{"articleBody": "a"}'), FAILED),
    ("http://cnbctv18.com/a", "<div>x</div>", FAILED),
    ("http://wral.com/a", "<div>x</div>", "ERROR: 404 Page not found"),
    ("http://elsewhere.com/a", "<div>x</div>", NO_TEXT),
    ("http://chinadaily.com.cn/a", "<div>The Page</div>", "The Page"),
    # rules on empty pages come before the sites
    ("http://ynetnews.com/gallery/", "<span data-text=true>a</span>", VIDEO),
]


@pytest.fixture(scope="module")
def parts(spark):
    rows = [(i, url, page) for i, (url, page, _) in enumerate(CASES + EMPTY_CASES)]
    df = extract_parts(spark.createDataFrame(rows, "i int, url string, html string"))
    return {r["i"]: r for r in df.collect()}


@pytest.mark.parametrize("i", range(len(CASES)), ids=lambda i: f"{i}-{CASES[i][0]}")
def test_site(parts, i):
    want, got = CASES[i][2], parts[i]
    assert got["site_failed"] == (want is FAILED)
    if want is not FAILED:
        assert got["site_result"] == want


@pytest.mark.parametrize("i", range(len(EMPTY_CASES)), ids=lambda i: f"{i}-{EMPTY_CASES[i][0]}")
def test_empty_page(parts, i):
    want, got = EMPTY_CASES[i][2], parts[len(CASES) + i]
    assert got["empty_failed"] == (want is FAILED)
    if want is not FAILED:
        assert got["empty_result"] == want
