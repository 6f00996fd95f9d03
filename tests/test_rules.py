"""Rule tables against a plain reading of them."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from pressmill.functions import rule_values as tables, rules
from pressmill.functions.rule_values import LABEL_PREFIX


def holds(test, url, text):
    field, kind, needles = test
    value = url if field == "url" else text
    if kind == "any":
        return any(n in value for n in needles)
    if kind == "all":
        return all(n in value for n in needles)
    if kind == "equals":
        return value in needles
    return any(value.endswith(n) for n in needles)


def plain(table, url="", text="", page_text=None):
    """Results of all rules that match, in order."""
    return [page_text if name is None else LABEL_PREFIX + name
            for name, tests in table if all(holds(t, url, text) for t in tests)]


def last(table, **fields):
    found = plain(table, **fields)
    return found[-1] if found else None


def needles(table, field):
    return [n for _, tests in table for f, _, values in tests if f == field for n in values]


def joined(table, field):
    """Each needle alone, all needles of a rule, and every pair of neighbours."""
    found = needles(table, field)
    cases = [f"http://a/{n}" for n in found] + found
    cases += [f"http://a/{n}/{m}" for n, m in itertools.pairwise(found)]
    cases += [f"http://a/{m}/{n}" for n, m in itertools.pairwise(found)]
    cases += ["x".join(vs) for _, tests in table for f, _, vs in tests if f == field]
    return cases + ["", "nothing here", "http://a/x.jpg?y", "https://a/Kake"]


def test_url_rules(values):
    urls = joined(tables.URL_RULES, "url") + ["http://msnbc.x/watch", "http://watch.x"]
    got = values([(u,) for u in urls], "url string", rules.url_label("url"))
    assert got == [last(tables.URL_RULES, url=u) for u in urls]


def test_page_text_rules(values):
    texts = joined(tables.PAGE_TEXT_RULES, "text")
    got = values([(t,) for t in texts], "text string", rules.page_text_label("text"))
    assert got == [last(tables.PAGE_TEXT_RULES, text=t) for t in texts]


def test_first_test_of_page_texts_lets_every_needle_through(values):
    found = needles(tables.PAGE_TEXT_RULES, "text")
    rng = random.Random(5)
    texts = [f"a{n}b" for n in found] + [f"x x {n}{m} " for n, m in itertools.product(found[::5], found[::3])]
    # beginnings and ends of needles, which may or may not make up another
    for _ in range(2_000):
        n, m = rng.choice(found), rng.choice(found)
        texts.append(n[: rng.randrange(len(n) + 1)] + rng.choice(["", " ", "\n"]) + m[rng.randrange(len(m)):])
    got = values([(t,) for t in texts], "text string", rules.page_text_label("text"))
    assert got == [last(tables.PAGE_TEXT_RULES, text=t) for t in texts]
    assert any(got) and not all(got) and values([(None,)], "text string", rules.page_text_label("text")) == [None]


def test_first_test_of_other_tables(values):
    table = [("a", [("text", "any", ["one", "two ", "a.b c+d", " x y"])]), ("b", [("text", "all", ["p q", "r (s) t"])]),
             ("c", [("text", "equals", ["", "end"])])]
    texts = ["one", "someone", "two", "two ", "a.b c+d", "aab c+d", "x y", "z x y", "p q", "p qr (s) t", "r (s) t", "", "end", "ends"]
    got = values([(t,) for t in texts], "text string", F.expr(rules.may_match(table, "text")))
    assert all(g or not plain(table, text=t) for g, t in zip(got, texts)) and not all(got)
    with pytest.raises(ValueError):
        rules.may_match(tables.URL_RULES, "url")


def test_empty_page_rules(values):
    urls, texts = joined(tables.EMPTY_PAGE_RULES, "url"), joined(tables.EMPTY_PAGE_RULES, "text")
    cases = [(u, t) for u in urls for t in ("Some Text", "Epoch Video here", " ")]
    cases += [(u, t) for u in ("http://a/", "http://ranker.com", "http://chinadaily.com.cn") for t in texts]
    column = rules.empty_page_result("url", "text", "lower(text)")
    got = values(cases, "url string, text string", column)
    assert got == [last(tables.EMPTY_PAGE_RULES, url=u, text=t.lower(), page_text=t) for u, t in cases]


def test_last_resort_takes_the_first_match(values):
    urls = joined(tables.LAST_RESORT_RULES, "url")
    got = values([(u,) for u in urls], "url string", rules.last_resort_label("url"))
    want = [(plain(tables.LAST_RESORT_RULES, url=u) or [LABEL_PREFIX + tables.NO_TEXT])[0] for u in urls]
    assert got == want


@pytest.mark.parametrize("text, label", [
    ("403 forbidden ... please enable js", "Must enable cookies to access site"),
    ("please enable js ... 403 forbidden", "Must enable cookies to access site"),
    ("forbidden", "403 Forbidden"),
    ("forbidden.", None),
    ("too many requests", "Blocked from website"),
    ("error 503", None),
])
def test_page_text_examples(values, text, label):
    got = values([(text,)], "text string", rules.page_text_label("text"))
    assert got == [label and LABEL_PREFIX + label]



# Written out by hand, so that a wrong needle or label in the tables shows.
@pytest.mark.parametrize("url, label", [
    ("https://calciomercato.com/x", "ERROR: Must enable cookies to access site"),
    ("http://a.example/report.pdf", "ERROR: Content is a pdf"),
    ("http://a.example/x.jpg", "ERROR: Video/ Image content only"), ("http://a.example/x.jpg?y", None),
    ("http://www.msnbc.com/watch/1", "ERROR: Video/ Image content only"), ("http://www.msnbc.com/1", None),
    ("http://learnprogress.org/a", "ERROR: Website is no longer maintained"), ("http://a.example/story", None),
])
def test_urls_by_hand(values, url, label):
    assert values([(url,)], "url string", rules.url_label("url")) == [label]


def test_page_texts_by_hand(values):
    cases = {
        "x 410 deleted by author": "ERROR: 410 Deleted", "406 not acceptable!": "ERROR: 406 Not Acceptable",
        "not acceptable": "ERROR: 406 Not Acceptable", "not found": "ERROR: 404 Page not found", "not found.": None,
        "a this content has been removed b": "ERROR: Article has been archived",
        "we blocked your ip": "ERROR: Blocked from website", "too many requests": "ERROR: Blocked from website",
        "internal server error": "ERROR: Internal Server Error", "a client-side exception": "ERROR: Client-Side Exception",
        "x\nvia youtube": "ERROR: Video/ Image content only", "an ordinary article": None,
    }
    assert values([(t,) for t in cases], "text string", rules.page_text_label("text")) == list(cases.values())


def test_empty_pages_by_hand(values):
    cases = [("http://pantsonfirenews.com/a", "Some Text", "ERROR: 403 Forbidden"),
             ("http://ktla.com/news/a", "Some Text", "ERROR: 451 Unavailable for legal reasons"),
             ("http://a.example/", " ", "ERROR: 404 Page not found")]
    got = values([c[:2] for c in cases], "url string, text string", rules.empty_page_result("url", "text", "lower(text)"))
    assert got == [c[2] for c in cases]
