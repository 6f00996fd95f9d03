"""Best-fit packing of tokenised documents into sequences (operator 5).

Spark tokenises and cuts documents and counts the pieces of each length.  Lengths
are at most the capacity, so these counts are a table of bounded size, and packing
is decided on counts: first the dominance criterion of Martello and Toth fixes
sets of lengths that no packing can better, then best fit takes the rest, longest
first.  The decision is a list of patterns; a second Spark job numbers the pieces
of each length and deals them to the places of the patterns.
"""

from __future__ import annotations

import bisect
import re
import unicodedata
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F, Window

from pressmill.session import write_between

CAPACITY = 4096
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
# words a Python worker remembers the ids of
REMEMBERED_WORDS = 600_000
# numbering of one length is spread over so many groups at least, and over one more
# for so many pieces
NUMBER_GROUPS = 64
GROUP_PIECES = 1_000_000


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordIds(dict):
    """Ids of a word as little-endian bytes; words are what spaces and line ends part.

    The tokenizer parts text at white space, so that the ids of a text are those of
    its words in turn.  A text with other white space or separators goes whole.  A
    word of Latin letters goes to the tokenizer's vocabulary directly, any other
    through the whole tokenizer.
    """

    odd = re.compile(r"[^\S \n]|[\x1c-\x1f]")

    # fixed values: the parts that the tokenizer's file cuts lower-case text into
    parts = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in printed]
        self.as_text = {b: chr(b) for b in printed} | {b: chr(256 + i) for i, b in enumerate(rest)}

    def __missing__(self, word: str) -> bytes:
        if word.isprintable() and max(word) < "\u017f" and "<|" not in word and unicodedata.is_normalized("NFC", word):
            ids = np.array([
                token.id for part in self.parts.findall(word.lower())
                for token in self.model.tokenize(part.encode().decode("latin-1").translate(self.as_text))
            ], dtype="<u4").tobytes()
        else:
            ids = self.whole(word)
        if len(self) < REMEMBERED_WORDS:
            self[word] = ids
        return ids

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def ids(self, text: str) -> bytes:
        if self.odd.search(text):
            return self.whole(text)
        return b"".join(map(self.__getitem__, text.split()))


_loaded: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path]


def cut(length: int, capacity: int) -> Iterable[tuple[int, int]]:
    """(start, length) of the pieces of a document."""
    for start in range(0, length, capacity):
        yield start, min(capacity, length - start)


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           tokenizer: str | None = None, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents: id, ``row`` (a number of the input row), ``piece``,
    ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids``.

    A null text is an empty one, whose only token is the end.  Only documents over
    the capacity are cut.
    """
    path = tokenizer or tokenizer_path()
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = word_ids(path)
        for batch in batches:
            out = []
            for key, row, text in zip(batch["_id"], batch["_row"], batch["_text"]):
                data = known.ids(text or "") + end
                for number, (start, length) in enumerate(cut(len(data) // 4, capacity)):
                    part = data[4 * start: 4 * (start + length)]
                    ids = (np.frombuffer(part, "<u4").tolist(),) if keep_ids else ()
                    out.append((key, row, number, start, length, zlib.crc32(part), *ids))
            frame = pd.DataFrame(out, columns=["_id", "row", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids])
            frame["_id"] = pd.Series([x[0] for x in out], dtype=object)
            yield frame

    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("_id"), F.monotonically_increasing_id().alias("_row"), F.col(text_col).alias("_text"))
    schema = f"_id {kind}, row long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * keep_ids
    return rows.mapInPandas(run, schema)


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Patterns fixed by dominance, as (lengths, times), and the counts that are left.

    For the longest piece ``j``: if nothing fits beside it, it stays alone; if a
    piece fills the sequence exactly, or no three pieces fit beside it and no two
    that do beat the largest one, then ``j`` with that largest piece dominates every
    other set.
    """
    left = {k: n for k, n in counts.items() if n > 0}
    fixed = []
    lengths = sorted(left)

    def best_two(there: list[int], own: int, room: int) -> int:
        """Largest sum of two pieces of ``there`` that fit together into ``room``; 0 if no two do."""
        best, i, j = 0, 0, len(there) - 1
        while i < j:
            total = there[i] + there[j]
            if total > room:
                j -= 1
            else:
                best = max(best, total)
                i += 1
        if i == j and 2 * there[i] <= room and left[there[i]] - (there[i] == own) >= 2:
            best = max(best, 2 * there[i])
        return best

    def three_fit(there: list[int], own: int, room: int) -> bool:
        """Whether the three smallest pieces of ``there`` fit together into ``room``."""
        least = [x for x in there[:3] for _ in range(min(3, left[x] - (x == own)))][:3]
        return len(least) == 3 and sum(least) <= room

    for j in sorted(left, reverse=True):
        while left.get(j):
            room = capacity - j
            # lengths that fit and are there when one ``j`` is taken
            there = lengths[: bisect.bisect_right(lengths, room)]
            if j <= room and left[j] == 1:
                there.remove(j)
            k = there[-1] if there else None
            if k is None:
                fixed.append(((j,), left[j]))
                left[j] = 0
                break
            if j + k < capacity and (three_fit(there, j, room) or best_two(there, j, room) > k):
                break
            times = left[j] // 2 if j == k else min(left[j], left[k])
            # the criterion holds anew for each pair as long as k is there and no better piece comes
            fixed.append(((j, k), times))
            left[j] -= times
            left[k] -= times
            lengths = [x for x in lengths if left[x]]
        lengths = [x for x in lengths if left[x]]
    return fixed, {k: n for k, n in left.items() if n}


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of best-fit decreasing on counts, as (lengths, times).

    Equal lengths are placed together: each group of sequences with the least room
    that holds the length takes as many as it has sequences.
    """
    rooms: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    order: list[int] = []

    def add(room: int, pattern: tuple[int, ...], times: int) -> None:
        if room not in rooms:
            bisect.insort(order, room)
            rooms[room] = []
        rooms[room].append((pattern, times))

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            at = bisect.bisect_left(order, length)
            if at == len(order):
                each = capacity // length
                full, rest = divmod(n, each)
                if full:
                    add(capacity - each * length, (length,) * each, full)
                if rest:
                    add(capacity - rest * length, (length,) * rest, 1)
                break
            room = order[at]
            pattern, times = rooms[room].pop()
            if not rooms[room]:
                del rooms[room]
                order.pop(at)
            each = room // length
            if each * times <= n:
                add(room - each * length, pattern + (length,) * each, times)
                n -= each * times
                continue
            full, rest = divmod(n, each)
            if full:
                add(room - each * length, pattern + (length,) * each, full)
            if rest:
                add(room - rest * length, pattern + (length,) * rest, 1)
            if times - full - (rest > 0):
                add(room, pattern, times - full - (rest > 0))
            n = 0
    return [x for room in rooms.values() for x in room]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns for all pieces, those fixed by dominance first."""
    fixed, left = reduce_by_dominance(counts, capacity)
    return fixed + best_fit(left, capacity)


def places(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, last rank, first sequence, per sequence, offset) of each run of places.

    The pieces of a length are numbered from 0; a run takes ``per sequence``
    neighbours into each of its sequences, the first at ``offset``.
    """
    ranks: dict[int, int] = {}
    out, sequence = [], 0
    for pattern, times in patterns:
        offset, at = 0, 0
        while at < len(pattern):
            length, per = pattern[at], 1
            while at + per < len(pattern) and pattern[at + per] == length:
                per += 1
            first = ranks.get(length, 0)
            out.append((length, first, first + per * times - 1, sequence, per, offset))
            ranks[length] = first + per * times
            offset += per * length
            at += per
        sequence += times
    return out


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` (a written table with ``row``, ``piece`` and ``length``) with ``sequence_id`` and ``offset``.

    The runs of places sent to the tasks number at most a few per length, so their
    size is bounded by the capacity.
    """
    groups = max(NUMBER_GROUPS, parts.count() // GROUP_PIECES)
    grouped = parts.withColumn("_group", F.pmod(F.xxhash64("row", "piece"), F.lit(groups)).cast("int"))
    sizes = grouped.groupBy("length", "_group").agg(F.count("*").alias("n"))
    # at most a row for each length
    counts = dict(map(tuple, sizes.groupBy("length").agg(F.sum("n")).collect()))
    runs = pd.DataFrame(places(plan(counts, capacity)), columns=["length", "first", "last", "sequence", "per", "offset"])
    by_length = {k: g.sort_values("first") for k, g in runs.groupby("length")}
    earlier = Window.partitionBy("length").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("length", "_group", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))

    names = parts.columns

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rank = batch["_rank"].to_numpy(np.int64) + batch["_before"].to_numpy(np.int64)
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            lengths = batch["length"].to_numpy(np.int64)
            for length in np.unique(lengths):
                own = np.flatnonzero(lengths == length)
                table = by_length[length]
                at = np.searchsorted(table["first"].to_numpy(), rank[own], "right") - 1
                run = table.iloc[at]
                inside = rank[own] - run["first"].to_numpy()
                per = run["per"].to_numpy()
                sequence[own] = run["sequence"].to_numpy() + inside // per
                offset[own] = run["offset"].to_numpy() + inside % per * length
            yield batch[names].assign(sequence_id=sequence, offset=offset)

    ranked = grouped.withColumn(
        "_rank", F.row_number().over(Window.partitionBy("length", "_group").orderBy("row", "piece")) - 1)
    ranked = ranked.join(firsts, ["length", "_group"]).select(*names, "_rank", "_before")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema)
    return ranked.mapInPandas(place, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                   tokenizer: str | None = None, keep_ids: bool = False) -> DataFrame:
    """One row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    Repeated rows and null ids are documents of their own.  An empty table gives an
    empty one.  Columns beside id and text are not read.
    """
    parts = write_between(pieces(docs, id_col, text_col, capacity, tokenizer, keep_ids=keep_ids))
    packed = pack(parts, capacity)
    return packed.select(F.col("_id").alias(id_col), "piece", "start", "length", "ids_crc32",
                         *["ids"] * keep_ids, "sequence_id", "offset")
