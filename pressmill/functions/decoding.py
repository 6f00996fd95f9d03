"""Decoding of bodies in encodings Spark does not know.

Encodings of one byte a character are decoded in the JVM, as Latin-1 whose upper half
is then translated; others in an Arrow UDF.
"""

import sys
from encodings.aliases import aliases

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# encodings of one byte a character, whose lower half is ASCII
SINGLE_BYTE = [
    "cp1250", "cp1251", "cp1252", "cp1253", "cp1254", "cp1255", "cp1256", "cp1257", "cp1258",
    "iso8859_2", "iso8859_3", "iso8859_4", "iso8859_5", "iso8859_6", "iso8859_7", "iso8859_8", "iso8859_9",
    "iso8859_10", "iso8859_13", "iso8859_14", "iso8859_15", "iso8859_16", "koi8_r", "koi8_u", "mac_roman",
]


def names_of(codec: str) -> list[str]:
    """All names of a codec, with hyphens."""
    found = {codec, *[a for a, c in aliases.items() if c == codec]}
    if codec.startswith("iso8859_"):
        found.add(codec.replace("iso8859", "iso_8859"))
    return sorted(n.replace("_", "-") for n in found)


ALL_NAMES = [n for c in SINGLE_BYTE for n in names_of(c)]


def decode_single_byte(latin1: Column, name: Column) -> Column:
    """Text of a body read as Latin-1, by the name of its encoding; null if it does not fit."""
    found = F.lit(None).cast("string")
    for codec in SINGLE_BYTE:
        upper = bytes(range(128, 256)).decode(codec, "replace")
        pairs = [(chr(128 + i), c) for i, c in enumerate(upper) if c != "\ufffd" and c != chr(128 + i)]
        absent = "".join(f"\\x{128 + i:02x}" for i, c in enumerate(upper) if c == "\ufffd")
        text = F.translate(latin1, "".join(a for a, _ in pairs), "".join(b for _, b in pairs))
        fits = ~latin1.rlike(f"[{absent}]") if absent else F.lit(True)
        found = F.when(name.isin(*names_of(codec)), F.when(fits, text)).otherwise(found)
    return found


def decode(raw: bytes | None, encoding: str | None) -> str | None:
    """The text, or null if the encoding is unknown or does not fit."""
    if raw is None or encoding is None:
        return None
    try:
        # lone surrogates cannot be stored
        return raw.decode(encoding).encode("utf-8", "replace").decode("utf-8")
    except (LookupError, ValueError):
        return None


def _decode_all(bodies: pa.Array, encodings: pa.Array) -> pa.Array:
    pairs = zip(bodies, encodings)
    return pa.array([decode(b.as_py(), e.as_py()) for b, e in pairs], type=pa.string())


decode_other = F.arrow_udf(_decode_all, StringType()).asNondeterministic()
