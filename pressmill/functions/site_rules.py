"""Sites whose article text is not in paragraphs, as a rule table.

A site says which URLs it covers, which page elements it needs, and two SQL
expressions: its result (article text or error label; null means "use the
paragraphs") and when reading it fails.  They use the columns ``_url``,
``_body`` (the raw page), ``els``, ``p_spans`` and ``fragment_text`` (the text of
what ``fragment_html`` found in the raw page), and are evaluated on the site's
own pages only.
"""

from dataclasses import dataclass

from pressmill.functions.json_text import is_json, is_object, member, parse_whole, text_at
from pressmill.functions.rule_values import FORBIDDEN, NO_TEXT, VIDEO
from pressmill.functions.rules import contains_any, label_sql
from pressmill.functions.text import join_stripped, lit, strip

# Paragraphs are cut out of the page text where they are used: only their places
# come from the parse, as nested ones repeat the text over and over.
P_TEXTS = """CASE WHEN NOT parse_failed
    THEN transform(p_spans, s -> substring(page_text, s.start + 1, s.end - s.start)) END"""

NOTHING = label_sql(NO_TEXT)
BLOCKED = label_sql(FORBIDDEN)
IS_FORBIDDEN = "contains(_body, 'Forbidden')"


@dataclass(frozen=True)
class Site:
    id: str
    covers: str
    result: str
    failed: str = "false"
    falls_through: str | None = None  # later sites are asked instead
    wanted: tuple[tuple[str, str | None, str | None], ...] = ()
    fragment_html: str | None = None


def in_url(*names: str) -> str:
    return contains_any("_url", names)


def texts(els: str) -> str:
    return f"transform({els}, e -> e.text)"


# -- sites that keep the article in one kind of element -----------------------

def elements(tag: str, attr: str | None = None, value: str | None = None) -> str:
    """Requested elements of a kind; a class matches as one word or as a whole."""
    test = f"e.tag = {lit(tag)}"
    if attr == "class":
        words = f"regexp_replace({strip('e.attrs[' + lit(attr) + ']')}, '\\\\s+', ' ')"
        test += f" AND ({words} = {lit(value)} OR array_contains(split({words}, ' '), {lit(value)}))"
    elif attr is not None:
        test += f" AND e.attrs[{lit(attr)}] = {lit(value)}"
    return f"filter(els, e -> coalesce({test}, false))"


def element_site(id: str, covers: str, tag: str, attr: str, value: str) -> Site:
    return Site(id, covers, join_stripped(texts(elements(tag, attr, value))), wanted=((tag, attr, value),))


# -- sites that keep the article in JSON inside a script ----------------------

SCRIPTS = (("script", None, None),)
IS_LD_JSON = "e.attrs['type'] = 'application/ld+json'"
HAS_LD_JSON = "contains(e.attrs['type'], 'application/ld+json')"
HAS_JSON = "contains(e.attrs['type'], 'json')"


def scripts(test: str) -> str:
    """Texts of the scripts that pass a test; null for an empty one."""
    return texts(f"filter(els, e -> e.tag = 'script' AND coalesce({test}, false))")


def searched(test: str, needle: str) -> str:
    """Scripts with the needle, and empty ones, which cannot be searched."""
    return f"filter({scripts(test)}, s -> coalesce(contains(s, {lit(needle)}), true))"


def first_with(test: str, needle: str) -> str:
    """First script with the needle; null if an empty script comes before it."""
    return f"get({searched(test, needle)}, 0)"


def unreadable(test: str, needle: str) -> str:
    """An empty script comes first, or the script found is no JSON object."""
    hit = first_with(test, needle)
    return f"CASE WHEN {hit} IS NULL THEN size({searched(test, needle)}) > 0 ELSE NOT {is_object(hit)} END"


ARTICLE_BODY = f"""CASE WHEN {IS_FORBIDDEN} THEN {BLOCKED}
    WHEN {first_with(IS_LD_JSON, 'articleBody')} IS NOT NULL
        THEN {text_at(first_with(IS_LD_JSON, 'articleBody'), '.articleBody', NOTHING)}
    WHEN size(p_spans) > 0 THEN {join_stripped(P_TEXTS)} ELSE {NOTHING} END"""

BODY_TEXT = f"""CASE WHEN {first_with(HAS_JSON, 'bodyText')} IS NULL THEN {NOTHING}
    ELSE {text_at(first_with(HAS_JSON, 'bodyText'), '.props.pageProps.data.page.leaf.bodyText', NOTHING)} END"""

PARSED_ITEMS = f"""try_variant_get({parse_whole(f'try_element_at({scripts(HAS_JSON)}, -1)')},
    '$[0].props.pageProps.pageContent.parsedBody', 'array<variant>')"""
PARSED_BODY = f"""array_join(transform(filter({PARSED_ITEMS}, i -> schema_of_variant(i) = 'STRING'),
    i -> try_variant_get(i, '$', 'string')), ' ')"""

ANY_ARTICLE_BODY = first_with(HAS_LD_JSON, "articleBody")

# -- sites that keep the article in a script variable -------------------------
# (?d): only a newline ends a line for the dot.

PRELOADED = "nr.headless.preloadedData = "
PRELOADED_JSON = f"regexp_extract(_body, '(?d){PRELOADED}(.*);', 1)"
HAS_PRELOADED = f"_body RLIKE '(?d){PRELOADED}.*;'"
RENDERED = "body struct<queried_object: struct<content: struct<rendered: string>>>"
# of the first entry, whatever its key and whatever the others hold
PRELOADED_HTML = f"""CASE WHEN {is_json(PRELOADED_JSON)}
    THEN from_json(get(map_values(from_json({PRELOADED_JSON}, 'map<string, string>')), 0), '{RENDERED}')
        .body.queried_object.content.rendered END"""

FUSION_JSON = "regexp_extract(_body, '(?d)Fusion\\\\.globalContent=(.*?\\\\});', 1)"
FUSION_ITEMS = f"""CASE WHEN {is_json(FUSION_JSON)} THEN from_json({FUSION_JSON},
    'content_elements array<struct<type: string, content: string>>').content_elements END"""
FUSION_TEXT = f"array_join(transform(filter({FUSION_ITEMS}, i -> i.type = 'text'), i -> i.content), ' ')"
FUSION_FAILED = f"""coalesce(exists({FUSION_ITEMS},
    i -> i.type IS NULL OR (i.type = 'text' AND i.content IS NULL)), true)"""

# Scripts of the raw page; a comment outside a script is passed over whole.
RAW_SCRIPTS = "regexp_extract_all(_body, '(?is)<!--.*?-->|<script\\\\b[^>]*>(.*?)</script\\\\s*>', 1)"
STORY_SCRIPT = f"get(filter({RAW_SCRIPTS}, s -> contains(s, 'pgStoryZeroJSON')), 0)"
STORY_JSON = f"replace(replace({STORY_SCRIPT}, 'pgStoryZeroJSON = ', ''), '\\n', '')"
# Cut out as text where the JSON is broken; the comma after the value stays.
STORY_CUT = f"regexp_extract({STORY_JSON}, '(?d)body\": \"(.*?\",)', 1)"
STORY_HTML = f"""CASE WHEN {is_json(STORY_JSON)}
    THEN get(from_json({STORY_JSON}, 'articles array<struct<body: string>>').articles, 0).body
    WHEN {STORY_CUT} <> '' THEN replace({STORY_CUT}, '"', '') END"""

# -- remaining sites -----------------------------------------------------------

INSIDER = ("div", "class", "text article-body font-default font-size-med")
INSIDER_GRAPH = "'class=\"yoast-schema-graph\">([\\\\S\\\\s]*?)</script>'"
INSIDER_ONLY_GRAPH = f"(size({elements(*INSIDER)}) = 0 AND _body RLIKE {INSIDER_GRAPH})"
INSIDER_JSON = is_json(f"regexp_extract(_body, {INSIDER_GRAPH}, 1)")

TIMES_BODY = ("div", "data-articlebody", "1")
TIMES_BLOG = ("div", "class", "main-content single-article-content")

# Hosts and element names below.  The first site that covers a
# URL decides, unless it falls through.
SITES = [
    Site("X1", in_url("qz.com", "newtimes.com.rw", "newtimes.co.rw", "newsweek.com", "scmp.com"),
         ARTICLE_BODY, f"NOT {IS_FORBIDDEN} AND {unreadable(IS_LD_JSON, 'articleBody')}", wanted=SCRIPTS),
    element_site("X2", in_url("miamiherald.typepad.com"), "div", "id", "story-content"),
    element_site("X3", in_url("dailywire.com"), "div", "id", "post-body-text"),
    Site("X4", in_url("nationalreview.com"),
         f"CASE WHEN {HAS_PRELOADED} THEN {strip('fragment_text')} ELSE {label_sql('No text fathered')} END",
         f"{HAS_PRELOADED} AND fragment_text IS NULL", fragment_html=PRELOADED_HTML),
    Site("X5", in_url("columbiaspectator.com"), FUSION_TEXT, FUSION_FAILED),
    Site("X6", in_url("toledoblade"), strip("fragment_text"), "fragment_text IS NULL",
         f"{STORY_SCRIPT} IS NULL", fragment_html=STORY_HTML),
    element_site("X7", in_url("blacknews.com/news"), "div", "class", "post-body entry-content"),
    Site("X8", in_url("thepoliticalinsider"),
         f"""CASE WHEN size({elements(*INSIDER)}) > 0 THEN {join_stripped(texts(elements(*INSIDER)))}
             ELSE {label_sql('Scraping error during JSON conversion')} END""",
         f"{INSIDER_ONLY_GRAPH} AND NOT {INSIDER_JSON}",
         f"{INSIDER_ONLY_GRAPH} AND {INSIDER_JSON}", (INSIDER,)),
    Site("X9", in_url("ibtimes.com", "ibtimes.co"), f"CASE WHEN {IS_FORBIDDEN} THEN {BLOCKED} ELSE {NOTHING} END"),
    Site("X10", in_url("tampabay.com"), NOTHING),
    Site("X11", in_url("newsday.com"), BODY_TEXT, unreadable(HAS_JSON, "bodyText"), wanted=SCRIPTS),
    Site("X12", in_url("timesofindia") + " AND " + in_url("videoshow", "/photostory"), label_sql(VIDEO)),
    Site("X13", in_url("timesofindia"),
         f"""CASE WHEN size({elements(*TIMES_BODY)}) > 0 THEN {join_stripped(texts(elements(*TIMES_BODY)))}
             WHEN size({elements(*TIMES_BLOG)}) > 0 THEN {join_stripped(texts(elements(*TIMES_BLOG)))}
             ELSE {NOTHING} END""",
         wanted=(TIMES_BODY, TIMES_BLOG)),
    element_site("X14", contains_any("lower(_url)", ["newsmax.com"]), "div", "id", "mainArticleDiv"),
    Site("X15", in_url("sbs.com.au"), PARSED_BODY, f"{PARSED_ITEMS} IS NULL", wanted=SCRIPTS),
    element_site("X16", in_url("NDTV-LatestNews"), "div", "id", "ins_storybody"),
]

# Sites asked only about pages without paragraph text, before the last resort.
EMPTY_PAGE_SITES = [
    element_site("X18", in_url("ynetnews.com"), "span", "data-text", "true"),
    element_site("X19", in_url("refinery29"), "div", "class", "section-text"),
    Site("X20", in_url("cnbctv18.com"), text_at(ANY_ARTICLE_BODY, ".articleBody", "NULL"),
         f"""exists({scripts(HAS_LD_JSON)}, s -> s IS NULL) OR {ANY_ARTICLE_BODY} IS NULL
             OR {member(ANY_ARTICLE_BODY, '.articleBody')} IS NULL""", wanted=SCRIPTS),
]


def site_of_url(sites: list[Site]) -> str:
    """Id of the first site that covers ``_url``; null for most pages."""
    return "CASE " + " ".join(f"WHEN {s.covers} THEN '{s.id}'" for s in sites) + " END"


def fall_through(site: str) -> str:
    """The site that decides, given the column with the first one that covers the URL.

    Sites that fall through are followed from the last to the first, so that
    each may hand over to one that falls through itself.
    """
    decided = {}
    for position in reversed(range(len(SITES))):
        current = SITES[position]
        if current.falls_through is not None:
            later = site_of_url(SITES[position + 1:])
            for other, result in decided.items():
                later = f"CASE WHEN ({later}) = '{other}' THEN {result} ELSE {later} END"
            decided[current.id] = f"CASE WHEN {current.falls_through} THEN {later} ELSE '{current.id}' END"
    branches = " ".join(f"WHEN '{id}' THEN {result}" for id, result in decided.items())
    return f"CASE {site} {branches} ELSE {site} END"


def by_site(site: str, sites: list[Site], value: str, otherwise: str) -> str:
    """An expression of the site named in column ``site``."""
    branches = " ".join(
        f"WHEN '{s.id}' THEN {getattr(s, value)}" for s in sites if getattr(s, value) is not None)
    return f"CASE {site} {branches} ELSE {otherwise} END"


def wanted_elements() -> str:
    """Elements to collect from a page, by ``_url``; null for most pages.

    Sites may overlap, so the wishes of all that cover the URL are joined.
    """
    part = lambda text: "CAST(NULL AS STRING)" if text is None else lit(text)
    wishes, covered = [], []
    for site in SITES + EMPTY_PAGE_SITES:
        if site.wanted:
            wants = ", ".join(
                "named_struct('tag', {}, 'attr', {}, 'value', {})".format(*map(part, want))
                for want in site.wanted)
            wishes.append(f"CASE WHEN {site.covers} THEN array({wants}) ELSE array() END")
            covered.append(site.covers)
    return f"CASE WHEN {' OR '.join(covered)} THEN concat({', '.join(wishes)}) END"
