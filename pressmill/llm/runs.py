"""Documents in runs: groups of bounded size by a hash of the row, worked on in numpy.

A run is what one task sorts and names at a time.  What runs tell each other goes
through Spark as packed arrays, one row per run and part of the key space, so that
an exchange carries a few bytes per key and a key of many documents is one entry
per run.  A run is rebuilt alike whenever it is needed: its documents are put in
order of id and hash, whatever order they arrive in.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pressmill.llm.common import total_bytes

# texts of a run, on average
RUN_BYTES = 16 << 20
# bytes named at once inside a run
BLOCK_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


@dataclass
class Runs:
    """``docs`` has ``_id``, ``_text``, ``_hash`` and ``_run``, dealt out by ``_run``."""

    docs: DataFrame
    count: int

    @property
    def bits(self) -> int:
        """Leading bits of a key that name its part of the key space."""
        return max(3, min(20, math.ceil(math.log2(max(1, self.count))) + 1))


def in_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run_bytes: int = RUN_BYTES) -> Runs:
    """Runs of about ``run_bytes``; a null text is an empty one."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    count = max(1, math.ceil(total_bytes(docs, f"`{text_col}`") / run_bytes))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), text.alias("_text")) \
        .withColumn("_hash", F.xxhash64("_id", "_text")) \
        .withColumn("_run", F.pmod("_hash", F.lit(count)))
    parts = max(count, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return Runs(rows.repartition(parts, "_run"), count)


@dataclass
class Block:
    """Some documents of a run: their number in the run, and texts as UTF-8."""

    first: int
    texts: list[bytes]


def ordered(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, list]:
    """Ids (0 where null), whether an id is known, and texts of a run in its order."""
    column = rows["_id"].combine_chunks()
    known = np.asarray(column.is_valid())
    ids = np.asarray(column.fill_null(0))
    order = np.lexsort((rows["_hash"].to_numpy(), ids, ~known))
    texts = rows["_text"]
    return ids[order], known[order], texts.take(pa.array(order)).to_pylist()


def blocks(texts: Iterable[str], size: int = BLOCK_BYTES) -> Iterator[Block]:
    """Documents in blocks of about ``size`` bytes; a longer one is a block of its own."""
    first, held, total = 0, [], 0
    for number, text in enumerate(texts):
        data = text.encode("utf-8", "replace")
        if held and total + len(data) > size:
            yield Block(first, held)
            first, held, total = number, [], 0
        held.append(data)
        total += len(data)
    if held:
        yield Block(first, held)


def mix(values: np.ndarray, salt: int = 0) -> np.ndarray:
    """Scramble 64-bit words (the finalizer of a splitmix generator)."""
    z = values + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & (2**64 - 1))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def pair(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    """Name of two neighbours from their names."""
    return mix(a * np.uint64(0xD6E8FEB86659FD93) + b, salt)


# a space adds nothing to a name
_BYTES = [np.where(_SPACE, np.uint64(0), mix(np.arange(256, dtype=np.uint64), 101 + k)) for k in (0, 1)]


def word_bounds(block: Block, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of a block, and where its words ``[^\\x20\\x09-\\x0D]+`` begin and end; ``lower``: A-Z in lower case."""
    joined = b" ".join(block.texts) + b" "
    data = np.frombuffer(joined.lower() if lower else joined, dtype=np.uint8)
    space = np.empty(len(data) + 1, dtype=bool)
    space[0] = True
    np.take(_SPACE, data, out=space[1:])
    edges = np.flatnonzero(space[1:] != space[:-1])
    return data, edges[::2], edges[1::2]


def word_names(block: Block, lower: bool = False, seconds: bool = True, bounds=None):
    """Names of all words ``[^\\x20\\x09-\\x0D]+`` of a block; ``bounds``: its :func:`word_bounds`, if known.

    Returns the document of each word (number in the run), a 64-bit name, and a
    second independent one (None if not asked for).  A name is the scrambled sum of
    each byte's random number times that of its place.
    """
    sizes = np.fromiter(map(len, block.texts), np.int64, len(block.texts))
    data, starts, _ = bounds or word_bounds(block, lower)
    if not len(starts):
        empty = np.zeros(0, np.uint64)
        return np.zeros(0, np.int32), empty, empty if seconds else None
    doc_starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    doc = np.repeat(np.arange(len(sizes), dtype=np.int32) + np.int32(block.first),
                    np.diff(np.searchsorted(starts, np.append(doc_starts, len(data)))))
    # a word with the spaces after it
    text, first = data[starts[0]:], starts - starts[0]
    lengths = np.diff(first, append=len(text))
    place = np.arange(len(text)) - np.repeat(first, lengths)
    most = int(lengths.max())
    names = []
    for k in (0, 1)[: 1 + seconds]:
        weight = mix(np.arange(most, dtype=np.uint64), 7 + k) | np.uint64(1)
        total = _BYTES[k][text]
        total *= weight[place]
        names.append(mix(np.add.reduceat(total, first), 3 + k))
    return doc, names[0], names[1] if seconds else None


def last_letters(block: Block, lower: bool = False, bounds=None) -> np.ndarray:
    """The last two bytes of every word of a block as a number; ``bounds``: its :func:`word_bounds`, if known."""
    data, starts, ends = bounds or word_bounds(block, lower)
    before = np.where(ends - starts > 1, data[ends - 2], 0)
    return data[ends - 1].astype(np.uint64) * np.uint64(256) + before.astype(np.uint64)


def run_words(texts: list[str], lower: bool = False, seconds: bool = True):
    """:func:`word_names` of a whole run."""
    found = [word_names(b, lower, seconds) for b in blocks(texts)]
    doc = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int32)
    one = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.uint64)
    two = (np.concatenate([f[2] for f in found]) if found else np.zeros(0, np.uint64)) if seconds else None
    return doc, one, two


def planes(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of words, first bytes together; zeros compress away in a shuffle."""
    raw = np.ascontiguousarray(values).astype("<u8").view(np.uint8).reshape(-1, 8)
    return np.ascontiguousarray(raw[:, :width].T).tobytes()


def from_planes(data: bytes, count: int, width: int) -> np.ndarray:
    out = np.zeros((count, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(width, count).T
    return out.reshape(-1).view("<u8")


def parts_of(keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """(part, slice) of sorted keys by their leading bits."""
    part = (keys >> np.uint64(64 - bits)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip(np.concatenate(([0], cuts)), np.concatenate((cuts, [len(keys)]))):
        if b > a:
            yield int(part[a]), slice(int(a), int(b))


def to_bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def from_bits(data: bytes, count: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=count).astype(bool)


def groups(sorted_keys: np.ndarray) -> np.ndarray:
    """Where each group of equal neighbours begins."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64)
    return np.concatenate(([0], np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1))


def sorting(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stable order of 64-bit keys, and the keys in it.

    A key's number takes the place of its lowest bits, so that plain words are sorted, which is
    several times as fast as an argsort; keys that differ in these bits only are put right after.
    """
    count = len(keys)
    if not count:
        return np.zeros(0, np.int64), keys
    bits = np.uint64(max(1, (count - 1).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    fits = int(keys.max()).bit_length() + int(bits) <= 64
    held = keys << bits if fits else keys & ~low
    held |= np.arange(count, dtype=np.uint64)
    held.sort()
    found = held >> bits if fits else None
    held &= low
    order = held.view(np.int64)
    if fits:
        return order, found
    found = keys[order]
    wrong = np.flatnonzero(found[1:] < found[:-1])
    if len(wrong) > 1000:
        order = np.argsort(keys, kind="stable")
        return order, keys[order]
    if len(wrong):
        high = found & ~low
        for head in np.unique(high[wrong]):
            part = slice(np.searchsorted(high, head, "left"), np.searchsorted(high, head, "right"))
            order[part] = order[part][np.argsort(found[part], kind="stable")]
            found[part] = keys[order[part]]
    return order, found


# bytes of a key that travel beside the number of its part
PLACE_BYTES = 5
# what runs send to a part of the key space, and what they get back
BLOB = "part long, run long, count long, data binary"
ANSWER = "run long, kind int, part long, data binary"


def blobs(rows: list[tuple]) -> pa.Table:
    """Rows of :data:`BLOB`."""
    part, run, count, data = zip(*rows) if rows else ((), (), (), ())
    return pa.table({"part": pa.array(part, pa.int64()), "run": pa.array(run, pa.int64()),
                     "count": pa.array(count, pa.int64()), "data": pa.array(data, pa.binary())})


def answers_of(rows: pa.Table, kind: int) -> dict[int, bytes]:
    """Answers of one kind by part."""
    kinds, parts, data = rows["kind"].to_pylist(), rows["part"].to_pylist(), rows["data"].to_pylist()
    return {p: d for k, p, d in zip(kinds, parts, data) if k == kind}


def shared_keys(width: int):
    """For keys of many runs: whether a second document has the key, as bits in the run's order.

    A run sends its keys once each, with a flag for those of several documents.
    """
    def run(key, rows):
        numbers, counts, data = rows["run"].to_pylist(), rows["count"].to_pylist(), rows["data"].to_pylist()
        joined = np.concatenate([from_planes(d[: width * n], n, width) for n, d in zip(counts, data)])
        many = np.concatenate([from_bits(d[width * n:], n) for n, d in zip(counts, data)])
        order = np.argsort(joined, kind="stable")
        heads = groups(joined[order])
        sizes = np.diff(np.append(heads, len(order)))
        both = (sizes > 1) | np.logical_or.reduceat(many[order], heads)
        flags = np.empty(len(order), dtype=bool)
        flags[order] = np.repeat(both, sizes)
        return pa.table({
            "run": pa.array(numbers, pa.int64()), "kind": pa.array([0] * len(numbers), pa.int32()),
            "part": pa.array([key[0].as_py()] * len(numbers), pa.int64()),
            "data": pa.array([to_bits(f) for f in np.split(flags, np.cumsum(counts)[:-1])], pa.binary())})

    return run
