"""Small text expressions shared by the operators.

Expressions are SQL text wherever they are long: one call hands them to Spark
whole, while building them column by column costs a round trip per node.
"""

# The characters that count as white space when text is
# stripped.  Spark's plain trim removes blanks only.
WHITESPACE = "".join(
    chr(code) for code in [
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
        *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    ]
)


def lit(text: str) -> str:
    """SQL literal for a text."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")
    return f"'{escaped}'"


def strip(text: str) -> str:
    """Remove white space of any kind from both ends."""
    return f"btrim({text}, {lit(WHITESPACE)})"


def join_stripped(texts: str) -> str:
    """Strip every string of an array and join them with one space; empty ones stay."""
    return f"array_join(transform({texts}, t -> {strip('t')}), ' ')"


def regex_literal(text: str) -> str:
    """A Java regular expression that matches ``text`` itself."""
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"
