"""Reading one HTML page in one pass, as a small helper for Arrow UDFs.

The page text is built once.  Paragraphs and requested elements are kept as
spans of it, so nesting costs nothing while reading.  Tree rules: an end tag
closes everything up to the nearest open element of its name and is ignored if
there is none; an unclosed ``<p>`` therefore nests; void elements hold nothing;
the text of scripts, styles, templates and ruby notes is not page text.
"""

import re
import sys
from collections.abc import Iterator
from html.entities import html5
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

# The readers travel with the job, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Element names with special treatment.
VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input"
    " isindex keygen link menuitem meta nextid param source spacer track wbr".split()
)
HIDDEN = frozenset(["script", "style", "template", "rt", "rp"])
KEEPS_SPACE = frozenset(["pre", "textarea"])
BLANKS = " \n\t\f\r"

# One token of ordinary markup, for pages whose attributes are not needed.
TOKEN = re.compile(r"""
    (?P<text> [^<&]+ | &(?=[^a-zA-Z\#]) )
  | &\#(?P<number> [0-9]+ | [xX][0-9a-fA-F]+ ) (?=[^0-9a-fA-F]) ;?
  | &(?P<name> [a-zA-Z][-.a-zA-Z0-9]* ) (?=[^a-zA-Z0-9]) ;?
  | </(?P<end> [a-zA-Z][a-zA-Z0-9]* ) [ \t\n\r\f]* >
  | <(?P<start> [a-zA-Z][a-zA-Z0-9]* )
      (?: [ \t\n\r\f]+ [a-zA-Z_:][-a-zA-Z0-9_:.]* (?: = (?: "[^"]*" | '[^']*' | [^\s"'<>=`]+ ) )? )*
      [ \t\n\r\f]* (?P<closed>/)? >
  | (?P<other> <!-- .*? --\s*> | <![dD][oO][cC][tT][yY][pP][eE] [^>]* > )
""", re.VERBOSE | re.DOTALL)
RAW_END = {tag: re.compile(rf"</\s*{tag}\s*>", re.IGNORECASE) for tag in ("script", "style")}

ELEMENT = pa.struct([
    ("ord", pa.int32()),
    ("tag", pa.string()),
    ("attrs", pa.map_(pa.string(), pa.string())),
    ("text", pa.string()),
])
PAGE = pa.struct([
    ("page_text", pa.string()),
    ("p_spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    ("els", pa.list_(ELEMENT)),
    ("fragment_text", pa.string()),
    ("failed", pa.bool_()),
])
PAGE_TYPE = from_arrow_type(PAGE)


def character(reference: str) -> str:
    """Character for a numeric reference such as ``39`` or ``x27``."""
    number = int(reference[1:], 16) if reference[0] in "xX" else int(reference)
    if number < 256:
        try:
            return bytes([number]).decode("windows-1252")
        except UnicodeDecodeError:
            return chr(number)
    if number > sys.maxunicode or 0xD800 <= number <= 0xDFFF:
        return "\N{REPLACEMENT CHARACTER}"
    return chr(number)


class PageReader(HTMLParser):
    """Collects page text, paragraph spans and the wanted elements."""

    def __init__(self, wanted):
        super().__init__(convert_charrefs=False)
        self.wanted = wanted or ()
        self.pieces, self.length = [], 0      # page text so far
        self.pending = []                     # text since the last tag
        self.open, self.open_names = [], {}   # open elements, and how many per name
        self.hidden = []                      # open elements whose text is hidden
        self.space_kept = 0                   # open elements that keep blanks
        self.closed_void = []                 # void tags whose end tag is to be ignored
        self.paragraphs, self.elements = [], []

    def updatepos(self, start, end):
        return end  # line numbers are not needed, and counting them takes time

    # -- text ---------------------------------------------------------------
    def handle_data(self, data):
        self.pending.append(data)

    def handle_charref(self, name):
        self.pending.append(character(name))

    def handle_entityref(self, name):
        self.pending.append(html5.get(name + ";", "&" + name))

    def flush(self, visible=False):
        if not self.pending:
            return
        text = "".join(self.pending)
        self.pending.clear()
        if self.hidden and not visible:
            script = self.hidden[-1].get("script")
            if script is not None:
                script.append(text)
            return
        if not self.space_kept and text and not text.strip(BLANKS):
            text = "\n" if "\n" in text else " "
        self.pieces.append(text)
        self.length += len(text)

    # -- markup without text --------------------------------------------------
    def handle_comment(self, data):
        self.flush()

    handle_decl = handle_pi = handle_comment

    def unknown_decl(self, data):
        self.flush()
        if data.upper().startswith("CDATA["):
            self.pending.append(data[len("CDATA["):])
            self.flush(visible=True)

    # -- elements -------------------------------------------------------------
    def matches(self, tag, attrs):
        for want in self.wanted:
            if want["tag"] != tag:
                continue
            if want["attr"] is None:
                return True
            have = attrs.get(want["attr"])
            if have is None:
                continue
            if want["attr"] == "class":
                words = have.split()
                if want["value"] in words or want["value"] == " ".join(words):
                    return True
            elif have == want["value"]:
                return True
        return False

    def push(self, tag, attrs):
        self.flush()
        node = {"tag": tag}
        if tag == "p":
            node["span"] = [self.length, self.length]
            self.paragraphs.append(node["span"])
        if self.wanted:
            attrs = {key: value or "" for key, value in attrs}
            if self.matches(tag, attrs):
                span = node.setdefault("span", [self.length, self.length])
                if tag == "script":
                    node["script"] = []
                self.elements.append((tag, attrs, span, node.get("script")))
        if tag in HIDDEN:
            self.hidden.append(node)
        self.space_kept += tag in KEEPS_SPACE
        self.open.append(node)
        self.open_names[tag] = self.open_names.get(tag, 0) + 1

    def pop(self):
        node = self.open.pop()
        tag = node["tag"]
        self.open_names[tag] -= 1
        self.space_kept -= tag in KEEPS_SPACE
        if "span" in node:
            node["span"][1] = self.length
        if self.hidden and self.hidden[-1] is node:
            self.hidden.pop()
        return tag

    def close_tag(self, tag):
        self.flush()
        if self.open_names.get(tag):
            while self.pop() != tag:
                pass

    def handle_starttag(self, tag, attrs):
        self.push(tag, attrs)
        if tag in VOID:
            self.pop()
            self.closed_void.append(tag)

    def handle_endtag(self, tag):
        if tag in self.closed_void:
            self.closed_void.remove(tag)
        else:
            self.close_tag(tag)

    def handle_startendtag(self, tag, attrs):
        self.push(tag, attrs)
        self.handle_endtag(tag)

    # -- reading --------------------------------------------------------------
    def read_ordinary(self, html):
        """Read by pattern, about twice as fast as `feed`; False where it does not apply."""
        position = 0
        while position < len(html):
            token = TOKEN.match(html, position)
            if token is None:
                return False
            kind, position = token.lastgroup, token.end()
            if kind == "text":
                self.pending.append(token[0])
            elif kind == "end":
                self.handle_endtag(token["end"].lower())
            elif kind == "closed":
                self.handle_startendtag(token["start"].lower(), ())
            elif kind == "start":
                tag = token["start"].lower()
                self.handle_starttag(tag, ())
                if tag in RAW_END:
                    stop = RAW_END[tag].search(html, position)
                    if stop is None:
                        return False
                    self.pending.append(html[position:stop.start()])
                    self.handle_endtag(tag)
                    position = stop.end()
            elif kind == "name":
                self.handle_entityref(token["name"])
            elif kind == "number":
                self.handle_charref(token["number"])
            else:
                self.flush()
        return True

    def parts(self):
        self.flush()
        while self.open:
            self.pop()
        text = "".join(self.pieces)
        return {
            "page_text": text,
            # places in the page text: an unclosed paragraph holds all later ones
            "p_spans": [{"start": start, "end": end} for start, end in self.paragraphs],
            "els": [
                {
                    "ord": position,
                    "tag": tag,
                    "attrs": list(attrs.items()),
                    "text": text[start:end] if script is None else "".join(script) or None,
                }
                for position, (tag, attrs, (start, end), script) in enumerate(self.elements)
            ],
            "fragment_text": None,
            "failed": False,
        }


UNREADABLE = {"page_text": None, "p_spans": None, "els": None, "fragment_text": None, "failed": True}


def _parts(html, wanted=None):
    reader = PageReader(wanted)
    if wanted or not reader.read_ordinary(html):
        reader = PageReader(wanted)
        reader.feed(html)
        reader.close()
    return reader.parts()


def read_page(html, wanted=None, fragment=None):
    """Parts of one page, and the text of a fragment that goes with it.

    Null stays null; unreadable markup is marked.
    """
    if html is None:
        return None
    try:
        page = _parts(html, wanted)
        if fragment is not None:
            page["fragment_text"] = _parts(fragment)["page_text"]
        return page
    except (AssertionError, ValueError):
        return UNREADABLE


NO_PAGE = dict.fromkeys(PAGE.names)
# characters of parts that are sent at once; a larger page is a piece of its own
PIECE_CHARS = 1 << 20


def _column_wise(pages: list[dict]) -> pa.Array:
    # column by column, which Arrow builds much faster than a list of records
    columns = [pa.array([page[f.name] for page in pages], type=f.type) for f in PAGE]
    return pa.StructArray.from_arrays(columns, fields=list(PAGE))


def _read_batch(html: pa.Array, wanted: pa.Array, fragment: pa.Array) -> Iterator[pa.Array]:
    """Pages in pieces of about ``PIECE_CHARS``: what is read leaves before more is."""
    pages, held = [], 0
    for h, w, f in zip(html, wanted, fragment):
        page = read_page(h.as_py(), w.as_py(), f.as_py()) or NO_PAGE
        pages.append(page)
        held += len(page["page_text"] or "") + len(page["fragment_text"] or "") \
            + 16 * len(page["p_spans"] or ()) + sum(64 + len(e["text"] or "") for e in page["els"] or ())
        if held > PIECE_CHARS:
            yield _column_wise(pages)
            pages, held = [], 0
    if pages:
        yield _column_wise(pages)


def _read_pages(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for batch in batches:
        yield from _read_batch(*batch)
        # not held while the next one arrives
        del batch


# Marked non-deterministic so that the optimizer never repeats a page parse
# when it merges projections or moves filters.
read_pages = F.arrow_udf(_read_pages, PAGE_TYPE).asNondeterministic()
