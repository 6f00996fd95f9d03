"""JSON text: strict parsing and typed access, as SQL expressions.

Spark's parsers stop after the first value and ignore what follows.  Inside a
list closed by a known second item, anything extra is noticed.  A value used
twice is passed through a one-item array, so that it is parsed once.
"""


def _once(value: str, name: str, test: str) -> str:
    """The value as a list of one; empty if the test on it fails."""
    return f"filter(array({value}), {name} -> {test})"


def parse_whole(text: str) -> str:
    """Variant list holding the value at ``$[0]``; null if the text is not JSON."""
    wrapped = f"try_parse_json(concat('[', {text}, ',0]'))"
    alone = "try_variant_get(v, '$[1]', 'int') <=> 0 AND variant_get(v, '$[2]') IS NULL"
    return f"get({_once(wrapped, 'v', alone)}, 0)"


def is_json(text: str) -> str:
    return f"({parse_whole(text)}) IS NOT NULL"


def member(text: str, path: str) -> str:
    """Variant at a path of JSON text; SQL null where the path does not exist."""
    return f"variant_get({parse_whole(text)}, '$[0]{path}')"


def is_object(text: str) -> str:
    """The text is one JSON object."""
    return f"coalesce(startswith(schema_of_variant({member(text, '')}), 'OBJECT'), false)"


def text_at(text: str, path: str, if_absent: str) -> str:
    """Text at a path of JSON text; null for a JSON null."""
    choice = f"CASE WHEN m IS NULL THEN {if_absent} ELSE try_variant_get(m, '$', 'string') END"
    return f"get(transform(array({member(text, path)}), m -> {choice}), 0)"


def one_record(text: str, fields: str) -> str:
    """The JSON object in ``text`` as a list of one struct; empty if it is not just that."""
    wrapped = (
        f"from_json(concat('[', {text}, ',{{}}]'), 'array<struct<{fields}>>',"
        " map('allowSingleQuotes', 'false'))"
    )
    alone = _once(wrapped, "r", "size(r) = 2 AND r[0] IS NOT NULL")
    return f"transform({alone}, r -> r[0])"
