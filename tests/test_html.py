"""Page reading: hand-made pages with known parts."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pressmill.functions.html_reader import read_page
from pressmill.functions.text import WHITESPACE
from pressmill.operators import html


@pytest.mark.parametrize("page, text, paragraphs", [
    ("<p>a</p><p>b</p>", "ab", ["a", "b"]),
    # an unclosed paragraph holds those after it
    ("<div><p>a<p>b</p>c</div>d", "abcd", ["abc", "b"]),
    ("<p>a<p>b", "ab", ["ab", "b"]),
    ("<p>a</div>b</p>c", "abc", ["ab"]),
    ("<p>a<b>b</p>c</b>", "abc", ["ab"]),
    # scripts, styles, templates, ruby notes, comments and declarations are no text
    ("<!DOCTYPE html><style>s</style><p>a<script>x<p>y</p></script>b<!-- <p>n</p> --></p>", "ab", ["ab"]),
    ("<template><p>t</p></template><p>a<ruby>b<rt>c</rt></ruby></p>", "ab", ["", "ab"]),
    ("<?pi x?><p>a</p>", "a", ["a"]),
    ("<p>a<br>b<br/>c</br>d<img src=x>e</p>", "abcde", ["abcde"]),
    # character references
    ("<p>&amp;&lt;&#65;&#x42;&eacute;&nbsp;&unknown;&#150;&#xD800;</p>", "&<ABé\xa0&unknown–�",
     ["&<ABé\xa0&unknown–�"]),
    ("<p>a & b &c d</p>", "a & b &c d", ["a & b &c d"]),
    # a blank text node becomes one blank, or one newline
    ("<p>a</p>   <p>\n  </p>", "a \n", ["a", "\n"]),
    ("<pre>  \n </pre><p>x</p>", "  \n x", ["x"]),
    ("<P CLASS=x>upper</P>", "upper", ["upper"]),
    ("", "", []),
    ("no markup", "no markup", []),
    ("<p>cut <b", "cut <b", ["cut <b"]),
])
def test_text_and_paragraphs(page, text, paragraphs):
    parts = read_page(page)
    found = [parts["page_text"][s["start"]:s["end"]] for s in parts["p_spans"]]
    assert (parts["page_text"], found, parts["failed"]) == (text, paragraphs, False)


def test_unclosed_paragraphs(spark):
    """Every one holds all later ones, but only places leave the parser."""
    page = "<p>x" * 5_000
    assert len(read_page(page)["p_spans"]) == 5_000
    df = html.page_parts(spark.createDataFrame([(page,)], "html string"))
    row = df.select(F.size("p_spans").alias("n"), F.length(F.col("p_texts")[0]).alias("first"), html.is_empty(items="p_spans").alias("e")).first()
    assert (row["n"], row["first"], row["e"]) == (5_000, 5_000, False)


def want(tag, attr=None, value=None):
    return [{"tag": tag, "attr": attr, "value": value}]


@pytest.mark.parametrize("wanted, texts", [
    (want("div", "id", "x"), ["one"]),
    (want("div", "class", "b"), ["two", "three"]),
    (want("div", "class", "a b"), ["two"]),
    (want("div", "class", "b a"), []),
    (want("span"), ["s<"]),
    (want("script"), ['{"a": "&amp;</p>"}', None]),
    (None, []),
])
def test_wanted_elements(wanted, texts):
    page = """<div id=x>one</div><div class=" a  b ">two</div><div class="b c">three</div>
      <span>s&lt;</span><script type="application/json">{"a": "&amp;</p>"}</script><script></script>"""
    assert [e["text"] for e in read_page(page, wanted)["els"]] == texts


def test_nested_elements_keep_document_order():
    page = "<div class=k>a<div class=k>b</div>c</div>"
    assert [e["text"] for e in read_page(page, want("div", "class", "k"))["els"]] == ["abc", "b"]


def test_page_parts(spark):
    pages = spark.createDataFrame([(1, "<p> a </p>x<p></p>"), (2, None), (3, "<p>\xa0</p>")], "id int, html string")
    rows = html.page_parts(pages).select(
        "id", "page_text", html.paragraph_text().alias("text"), html.is_empty().alias("empty"),
        "parse_failed").orderBy("id").collect()
    assert [tuple(r) for r in rows] == [
        (1, " a x", "a ", False, False), (2, None, None, None, False), (3, "\xa0", "", True, False)]


def test_emptiness(values):
    cases = [([],), ([" \n"],), (["", ""],), (["x"],)]
    assert values(cases, "p_texts array<string>", html.is_empty()) == [True, True, False, False]


def test_strip_matches_python(values):
    assert set(WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}
    cases = [f"{w}a{w}b{w}{w}" for w in WHITESPACE]
    got = values([([c],) for c in cases], "p array<string>", html.paragraph_text("p"))
    assert got == [c.strip() for c in cases]


def test_page_is_parsed_once(spark):
    pages = spark.createDataFrame([(1, "<p>a</p>")], "id int, html string")
    used = html.page_parts(pages).filter(F.col("page_text") != "").select(
        html.paragraph_text(), "page_text", html.is_empty())
    plan = used._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


PIECES = """<p> <p class="a>b"> <P id=x data-k='"'> </p> </P > </p\xa0> <div> </div> <br> <br/> </br> <br /> <p/> <p\xa0x>
 <script>a<b&amp;</script> <style>x</style> <script> </script > <SCRIPT>z</sCript> <script/> <pre> </pre> <template> </template>
 <rt> </rt> <!--c--> <!-- a -- > <!--> --> <!doctype html> <!x> <?pi?> <![CDATA[x]]> < <3 </ </> </3> & &amp; &amp &amp-x &am
 &#65; &#65 &#65a &# &#x; &#x41; &#150; &nope; &. text é \n  \t <a href=x/> <a b=c d> <a b='<p>'> <a "> <p =x> <p a==b> <b/ > <img src=x>""".split(" ")


def test_both_ways_of_reading_agree():
    import random

    from pressmill.functions.html_reader import PageReader

    rng, ordinary = random.Random(11), 0
    for _ in range(20_000):
        # few odd pieces, so that many pages are read by pattern to the end
        page = "".join(rng.choice(PIECES) + rng.choice(["", "", " ", "x", "\n "]) for _ in range(rng.randrange(1, 7)))
        fast = PageReader(None)
        if not fast.read_ordinary(page):
            continue
        ordinary += 1
        slow = PageReader(None)
        slow.feed(page)
        slow.close()
        assert fast.parts() == slow.parts(), page
    assert ordinary > 3_000


def test_pages_leave_the_reader_in_pieces():
    """What is held at once does not grow with a batch of rows."""
    from pressmill.functions import html_reader

    html = [f"<p>{i} {'x' * 300_000}</p><div id='a'>{'y' * 300_000}</div>" for i in range(8)] + [None, "<p>z</p>"]
    want = [{"tag": "div", "attr": "id", "value": "a"}]
    types = (pa.string(), pa.list_(pa.struct([(c, pa.string()) for c in want[0]])), pa.string())
    batch = tuple(pa.array(v, t) for v, t in zip((html, [want] * 9 + [None], [None] * 10), types))
    pieces = list(html_reader._read_pages(iter([batch, tuple(a.slice(0, 0) for a in batch), batch])))
    assert max(p.nbytes for p in pieces) < 3 * html_reader.PIECE_CHARS and len(pieces) > 4
    assert [p["page_text"] for piece in pieces for p in piece.to_pylist()] == \
        2 * [(read_page(h, want) or {"page_text": None})["page_text"] for h in html]
