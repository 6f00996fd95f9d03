"""Compile the ordered rule tables into single column expressions.

Every table becomes one ``coalesce`` of ``CASE`` branches: no UDF, no join, no
shuffle, and the branches after the first hit are not evaluated.  Containment
is tested with ``contains``.  Page texts are long and most of them hold no needle,
so one pattern for the whole table is tried first, and the needles are told apart
only in texts that it matches; it tries something only behind blanks.

Fields are given as SQL expressions, usually column names.
"""

from pyspark.sql import Column, functions as F

from pressmill.functions import rule_values as values
from pressmill.functions.text import lit


def label_sql(name: str) -> str:
    return lit(values.LABEL_PREFIX + name)


def label(name: str) -> Column:
    """The error text for a label name."""
    return F.lit(values.LABEL_PREFIX + name)


def is_error(text: Column) -> Column:
    """True where a label-or-text result is a label."""
    return F.startswith(text, F.lit(values.LABEL_PREFIX))


def contains_any(field: str, needles: list[str]) -> str:
    """Test for any needle; one that holds another needle need not be looked for."""
    needles = [n for n in dict.fromkeys(needles) if not any(m in n for m in needles if m != n)]
    return "(" + " OR ".join(f"contains({field}, {lit(n)})" for n in needles) + ")"


def any_of_pattern(endings: list[str]) -> str:
    """Regular expression for any of the texts, by their common beginnings; one that begins with another is left out."""
    tree: dict = {}
    for ending in endings:
        at = tree
        for char in ending:
            at = at.setdefault(char, {})
        at[""] = {}

    def written(node: dict) -> str:
        if "" in node:
            return ""
        ways = [(c if c.isalnum() or ord(c) > 127 else "\\" + c) + written(below) for c, below in node.items()]
        return ways[0] if len(ways) == 1 else "(?:" + "|".join(ways) + ")"

    return written(tree)


def may_match(rules, field: str) -> str:
    """False only where no rule of a table of one field can match: a first test, in one pass for all its needles.

    A needle of several words is looked for from its first blank on, one of a single
    word with ``contains``, and a whole text by equality.
    """
    tests = [tests[0] for _, tests in rules]
    if any(len(tests) != 1 or kind == "ends" for _, tests in rules for _, kind, _ in tests):
        raise ValueError("only tables of single tests of a text")
    # a rule that needs all of its needles needs the longest
    needles = [n for _, kind, found in tests if kind != "equals" for n in (found if kind == "any" else [max(found, key=len)])]
    whole = [n for _, kind, found in tests if kind == "equals" for n in found]
    # a needle that ends at its first blank, or has none, has no words behind it
    behind = [n.partition(" ")[2] for n in needles]
    alone = [n for n, rest in zip(needles, behind) if not rest]
    ways = []
    if any(behind):
        ways.append(f"{field} RLIKE {lit(' ' + any_of_pattern([rest for rest in behind if rest]))}")
    if alone:
        ways.append(contains_any(field, alone))
    if whole:
        ways.append(_test(field, "equals", whole))
    return "(" + " OR ".join(ways) + ")"


def _test(field: str, kind: str, needles: list[str]) -> str:
    if kind == "any":
        return contains_any(field, needles)
    if kind == "all":
        return "(" + " AND ".join(f"contains({field}, {lit(n)})" for n in needles) + ")"
    if kind == "equals":
        return f"{field} IN (" + ", ".join(lit(n) for n in needles) + ")"
    if kind == "ends":
        return "(" + " OR ".join(f"endswith({field}, {lit(n)})" for n in needles) + ")"
    raise ValueError(f"unknown test kind {kind!r}")


def _branches(rules, fields: dict[str, str], page_text: str | None = None) -> list[str]:
    """One ``CASE`` per rule, in table order."""
    found = []
    for name, tests in rules:
        hit = " AND ".join(_test(fields[field], kind, needles) for field, kind, needles in tests)
        result = page_text if name is values.KEEP_PAGE_TEXT else label_sql(name)
        found.append(f"CASE WHEN {hit} THEN {result} END")
    return found


def last_match(rules, fields: dict[str, str], page_text: str | None = None) -> str:
    """Result of the last rule that matches, null if none does."""
    return "coalesce(" + ", ".join(reversed(_branches(rules, fields, page_text))) + ")"


def first_match(rules, fields: dict[str, str]) -> str:
    """Result of the first rule that matches, null if none does."""
    return "coalesce(" + ", ".join(_branches(rules, fields)) + ")"


def url_label(url: str) -> Column:
    """Label of a URL that can never give an article, else null."""
    return F.expr(last_match(values.URL_RULES, {"url": url}))


def page_text_label(lower_text: str) -> Column:
    """Label of an error message shown in the lower-cased page text, else null."""
    found = last_match(values.PAGE_TEXT_RULES, {"text": lower_text})
    return F.expr(f"CASE WHEN {may_match(values.PAGE_TEXT_RULES, lower_text)} THEN {found} END")


def empty_page_result(url: str, page_text: str, lower_text: str) -> Column:
    """Label, or the page text, for a page without paragraph text; else null."""
    fields = {"url": url, "text": lower_text}
    return F.expr(last_match(values.EMPTY_PAGE_RULES, fields, page_text))


def last_resort_label(url: str) -> Column:
    """Label for an empty page that no other rule explains; never null."""
    found = first_match(values.LAST_RESORT_RULES, {"url": url})
    return F.expr(f"coalesce({found}, {label_sql(values.NO_TEXT)})")
