"""Removal of repeated byte strings by merging sorted suffix runs (operator 1).

Every text is cut into overlapping strings of ``LENGTH`` bytes.  Each string picks
one place inside it, the least hashed ``ANCHOR``-byte string it holds; equal strings
pick the same place, so it is enough to sort the suffixes that begin at picked
places, with the bytes before them at their side.  Suffixes of one run of documents
are sorted, equal ones become one entry, and the entries travel front-coded: the
length of the prefix common with the entry before, and the rest.

The task of a part of the key space merges the runs of all documents with a loser
tree that knows how long a prefix each string shares with the last one taken and
compares bytes beyond it only, and only where two strings share equally much.  The
merged order comes with the common prefix lengths, that is, with the suffix array
and LCP array of the part; in it, strings that share ``LENGTH`` bytes are neighbours
and learn the smallest document among them.

Only suffixes that some other document may share are sorted: a first exchange sends
the hashes of picked places, a few bytes each, and drops places of one document.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from pressmill.llm import runs as R
from pressmill.llm.runs import ANSWER as _ANSWER, BLOB as _BLOB, PLACE_BYTES, answers_of as _answers, blobs as _blobs

LENGTH = 50
ANCHOR = 24
RUN_BYTES = 8 << 20
_PLACE_BITS = 20
_PLACES = (1 << _PLACE_BITS) - 1


def _stretches(texts: list[bytes], length: int, anchor: int):
    """All windows of a run, as stretches of neighbours that picked one place.

    Returns the offset of each text in the joined texts, these, and of each stretch
    its first and last window, place and key.  Long texts are worked through in
    pieces, which may part a stretch.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    reach = length - anchor + 1
    out = []
    whole = np.frombuffer(b"".join(texts) + bytes(anchor + 8), dtype=np.uint8)
    step = _PLACES - 2 * length
    for at in range(0, max(0, int(offsets[-1]) - length + 1), step):
        stop = min(at + step + reach - 1, int(offsets[-1]) - anchor + 1)
        wide = np.ndarray((stop - at + anchor - 8,), dtype="<u8", buffer=whole, offset=at, strides=(1,))
        total = np.zeros(stop - at, dtype=np.uint64)
        for k in range(0, anchor, 8):
            own = wide[k: k + stop - at] * np.uint64(0x9E3779B97F4A7C15 + 2 * k)
            total = (total ^ (own >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + own
        total ^= total >> np.uint64(31)
        total *= np.uint64(0x94D049BB133111EB)
        # of equal hashes, the last place counts
        value = (total & ~np.uint64(_PLACES)) | np.arange(_PLACES, _PLACES - len(total), -1, dtype=np.uint64)
        span = 1
        while span < reach:
            by = min(span, reach - span)
            value = np.minimum(value[: len(value) - by], value[by:])
            span += by
        inside = np.ones(len(value), dtype=bool)
        for end in offsets[np.searchsorted(offsets, at, "right"): np.searchsorted(offsets, at + len(value) + length, "right")].tolist():
            inside[max(0, end - length + 1 - at): max(0, end - at)] = False
        head = inside.copy()
        head[1:] &= (value[1:] != value[:-1]) | ~inside[:-1]
        tail = inside.copy()
        tail[:-1] &= (value[1:] != value[:-1]) | ~inside[1:]
        first = np.flatnonzero(head)
        value = value[first]
        out.append((first + at, np.flatnonzero(tail) + at,
                    at + _PLACES - (value & np.uint64(_PLACES)).astype(np.int64),
                    # least hashes crowd at one end of the key space; mixed ones fill its parts evenly
                    R.mix(value & ~np.uint64(_PLACES))))
    if not out:
        none = np.zeros(0, np.int64)
        return offsets, whole, none, none, none, none.astype(np.uint64)
    return offsets, whole, *(np.concatenate(x) for x in zip(*out))


class _Run:
    """Windows of a run, gathered by the place they picked."""

    def __init__(self, rows: pa.Table, length: int, anchor: int):
        self.ids, self.known, texts = R.ordered(rows)
        self.texts = [t.encode("utf-8", "replace") for t in texts]
        self.offsets, self.whole, self.first, self.last, self.pick, self.key = _stretches(self.texts, length, anchor)
        self.doc = np.searchsorted(self.offsets, self.first, "right") - 1
        if not self.known.all():
            ok = self.known[self.doc]
            self.first, self.last, self.pick, self.key, self.doc = (
                x[ok] for x in (self.first, self.last, self.pick, self.key, self.doc))
        self.order = np.argsort(self.key, kind="stable")
        self.heads = R.groups(self.key[self.order])
        self.names = self.key[self.order][self.heads]

    def shared(self, answers: dict[int, bytes], bits: int) -> np.ndarray:
        flags = np.zeros(len(self.names), dtype=bool)
        for part, at in R.parts_of(self.names, bits):
            flags[at] = R.from_bits(answers[part], at.stop - at.start)
        out = np.empty(len(self.order), dtype=bool)
        out[self.order] = np.repeat(flags, np.diff(np.append(self.heads, len(self.order))))
        return np.flatnonzero(out)


def _rows(whole: np.ndarray, at: np.ndarray, sizes: np.ndarray, width: int, step: int) -> np.ndarray:
    """Bytes from ``at`` on (or backwards), 0 beyond each one's size."""
    where = at[:, None] + step * np.arange(width)[None, :]
    out = whole[np.clip(where, 0, len(whole) - 1)]
    out[np.arange(width)[None, :] >= sizes[:, None]] = 0
    return out


class _Entries:
    """Distinct suffixes of a run in order, within each part of the key space."""

    def __init__(self, run: _Run, chosen: np.ndarray, length: int, anchor: int, bits: int):
        before = length - anchor
        part = (run.key[chosen] >> np.uint64(64 - bits)).astype(np.int64)
        pick = run.pick[chosen]
        right = (run.last[chosen] + length - pick).astype(np.uint8)
        left = (pick - run.first[chosen]).astype(np.uint8)
        n = len(chosen)
        rows = np.zeros((n, length + before + 2), dtype=np.uint8)
        for a in range(0, n, 1 << 16):
            b = min(n, a + (1 << 16))
            rows[a:b, :length] = _rows(run.whole, pick[a:b], right[a:b], length, 1)
            rows[a:b, length] = right[a:b]
            rows[a:b, length + 1] = left[a:b]
            rows[a:b, length + 2:] = _rows(run.whole, pick[a:b] - 1, left[a:b], before, -1)
        # right and left lengths stand inside the row: equal rows are equal entries
        order = np.argsort(rows.view(f"S{rows.shape[1]}").ravel(), kind="stable")
        order = order[np.argsort(part[order], kind="stable")]
        rows, part = rows[order], part[order]
        new = np.ones(n, dtype=bool)
        if n > 1:
            new[1:] = (rows[1:] != rows[:-1]).any(axis=1) | (part[1:] != part[:-1])
        self.heads = np.flatnonzero(new)
        self.rows, self.part = rows[self.heads], part[self.heads]
        self.stretch = chosen[order]
        owner = run.ids[run.doc[self.stretch]]
        self.least = np.minimum.reduceat(owner, self.heads) if n else owner
        self.entry = np.cumsum(new) - 1
        self.later = owner > self.least[self.entry] if n else np.zeros(0, bool)


def prefix_lengths(rows: np.ndarray, length: int) -> np.ndarray:
    """Bytes that each right part shares with the one before it."""
    common = np.zeros(len(rows), dtype=np.uint8)
    for a in range(1, len(rows), 1 << 16):
        b = min(len(rows), a + (1 << 16))
        differ = rows[a:b, :length] != rows[a - 1: b - 1, :length]
        at = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
        common[a:b] = np.minimum(at, np.minimum(rows[a:b, length], rows[a - 1: b - 1, length]))
    return common


def front_coded(rows: np.ndarray, length: int) -> bytes:
    """A sorted run: common prefix lengths, both lengths, remainders and left parts, compressed."""
    common = prefix_lengths(rows, length)
    right, left, place = rows[:, length], rows[:, length + 1], np.arange(rows.shape[1])
    rest = (place[None, :length] >= common[:, None]) & (place[None, :length] < right[:, None])
    beside = place[None, : rows.shape[1] - length - 2] < left[:, None]
    data = b"".join((common.tobytes(), right.tobytes(), left.tobytes(),
                     rows[:, :length][rest].tobytes(), rows[:, length + 2:][beside].tobytes()))
    return zstandard.ZstdCompressor(level=1).compress(data)


def decoded(data: bytes, count: int, length: int, before: int):
    """(right parts, common prefix lengths, left lengths, left parts as rows) of a run."""
    raw = zstandard.ZstdDecompressor().decompress(data)
    common, right, left = (np.frombuffer(raw, np.uint8, count, k * count) for k in range(3))
    at, last, out = 3 * count, b"", []
    for c, r in zip(common.tolist(), right.tolist()):
        stop = at + r - c
        last = last[:c] + raw[at:stop]
        out.append(last)
        at = stop
    rows = np.zeros((count, before), dtype=np.uint8)
    rows[np.arange(before)[None, :] < left[:, None]] = np.frombuffer(raw, np.uint8, offset=at)
    return out, common.tolist(), left, rows


def merge(strings: list[list[bytes]], commons: list[list[int]]) -> tuple[list[int], list[int]]:
    """Merge sorted runs with a loser tree; (run of each string taken, bytes it shares with the one before).

    Every player knows how many bytes its string shares with the last string taken
    from the tree at or above its node.  The one that shares more is the smaller;
    only where both share equally much are bytes compared, and from there on alone.
    ``commons`` says the same within a run, so no byte known to be equal is read again.
    """
    k = 1
    while k < len(strings):
        k *= 2
    heads = [s[0] if s else None for s in strings] + [None] * (k - len(strings))
    share = [0] * k
    losers = [0] * k
    at = [0] * k

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser then shares with the winner."""
        x, y = heads[a], heads[b]
        if x is None:
            return b, a
        if y is None:
            return a, b
        p, q = share[a], share[b]
        if p != q:
            return (a, b) if p > q else (b, a)
        if x == y:
            share[b] = len(x)
            return a, b
        most = min(len(x), len(y))
        while p < most and x[p] == y[p]:
            p += 1
        if p == most and len(x) < len(y) or p < most and x[p] < y[p]:
            share[b] = p
            return a, b
        share[a] = p
        return b, a

    winners = list(range(k))
    node = k // 2
    level = winners
    while len(level) > 1:
        above = []
        for i in range(0, len(level), 2):
            w, l = play(level[i], level[i + 1])
            losers[node + i // 2] = l
            above.append(w)
        level = above
        node //= 2
    winner = level[0]
    order, shared = [], []
    sizes = [len(s) for s in strings]
    while heads[winner] is not None:
        order.append(winner)
        shared.append(share[winner])
        i = at[winner] = at[winner] + 1
        if i < sizes[winner]:
            heads[winner] = strings[winner][i]
            share[winner] = commons[winner][i]
        else:
            heads[winner] = None
        node = (winner + k) // 2
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2
    return order, shared


def smallest_owner(shared: np.ndarray, right: np.ndarray, left: np.ndarray, beside: np.ndarray,
                   owner: np.ndarray, length: int) -> np.ndarray:
    """Bit ``t`` of each string: the window that begins ``t`` bytes before it has a smaller owner elsewhere."""
    out = np.zeros(len(owner), dtype=np.uint64)
    name = np.zeros(len(owner), dtype=np.uint64)
    for t in range(beside.shape[1] + 1):
        if t:
            name = R.pair(name, beside[:, t - 1].astype(np.uint64), t)
        group = np.cumsum(shared < length - t).astype(np.uint64)
        own = np.flatnonzero((left >= t) & (right >= length - t))
        if not len(own):
            continue
        key = R.pair(group[own], name[own], 90 + t)
        order = np.argsort(key, kind="stable")
        heads = R.groups(key[order])
        least = np.minimum.reduceat(owner[own][order], heads)
        smaller = owner[own][order] > np.repeat(least, np.diff(np.append(heads, len(order))))
        out[own[order[smaller]]] |= np.uint64(1 << t)
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   run_bytes: int = RUN_BYTES, keep_bytes: bool = False) -> DataFrame:
    """Per document: id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and, if asked for, ``kept`` (binary).

    A byte of the UTF-8 text goes if a string of ``length`` bytes over it also starts
    in a document of a smaller id.  Ids are integers; rows of one id do not remove
    from each other, and a row without an id neither removes nor loses.  A null text
    is empty.  ``length`` is from 32 to 112.
    """
    anchor = min(ANCHOR, length // 2 // 8 * 8)
    if not 32 <= length <= 112:
        raise ValueError("length must be from 32 to 112")
    before = length - anchor
    given = R.in_runs(docs, id_col, text_col, run_bytes)
    by_run = given.docs.groupBy("_run")
    bits = given.bits

    def places(key, rows):
        run = _Run(rows, length, anchor)
        owner = run.doc[run.order]
        many = np.zeros(len(run.names), dtype=bool)
        if len(run.names):
            many = np.minimum.reduceat(owner, run.heads) != np.maximum.reduceat(owner, run.heads)
        short = (run.names << np.uint64(bits)) >> np.uint64(64 - 8 * PLACE_BYTES)
        return _blobs([(part, key[0].as_py(), at.stop - at.start,
                        R.planes(short[at], PLACE_BYTES) + R.to_bits(many[at]))
                       for part, at in R.parts_of(run.names, bits)])

    def suffixes(key, rows, answers):
        run = _Run(rows, length, anchor)
        held = _Entries(run, run.shared(_answers(answers, 0), bits), length, anchor, bits)
        cuts = R.groups(held.part)
        return _blobs([(int(held.part[a]), key[0].as_py(), int(b - a),
                        held.least[a:b].astype("<i8").tobytes() + front_coded(held.rows[a:b], length))
                       for a, b in zip(cuts, np.append(cuts[1:], len(held.part)))])

    def merged(key, rows):
        numbers, counts, data = rows["run"].to_pylist(), rows["count"].to_pylist(), rows["data"].to_pylist()
        strings, commons, lefts, besides, owners = [], [], [], [], []
        for n, d in zip(counts, data):
            right, common, left, beside = decoded(d[8 * n:], n, length, before)
            strings.append(right)
            commons.append(common)
            lefts.append(left)
            besides.append(beside)
            owners.append(np.frombuffer(d, "<i8", n))
        order, shared = merge(strings, commons)
        order = np.array(order)
        # of one run, strings are taken in their order
        back = np.argsort(order, kind="stable")
        flat = np.empty(len(order), dtype=np.int64)
        flat[back] = np.arange(len(order))
        sizes = np.fromiter((len(s) for run in strings for s in run), np.int64, len(order))
        marks = smallest_owner(np.array(shared), sizes[flat], np.concatenate(lefts)[flat],
                               np.concatenate(besides)[flat], np.concatenate(owners)[flat], length)
        marks = marks[back]
        return pa.table({
            "run": pa.array(numbers, pa.int64()), "kind": pa.array([1] * len(numbers), pa.int32()),
            "part": pa.array([key[0].as_py()] * len(numbers), pa.int64()),
            "data": pa.array([R.planes(m, 8) for m in np.split(marks, np.cumsum(counts)[:-1])], pa.binary())})

    def assemble(key, rows, answers):
        run = _Run(rows, length, anchor)
        held = _Entries(run, run.shared(_answers(answers, 0), bits), length, anchor, bits)
        marks = np.zeros(len(held.part), dtype=np.uint64)
        cuts, found = R.groups(held.part), _answers(answers, 1)
        for a, b in zip(cuts, np.append(cuts[1:], len(held.part))):
            marks[a:b] = R.from_planes(found[int(held.part[a])], int(b - a), 8)
        own = marks[held.entry] if len(held.entry) else marks
        own = np.where(held.later, np.uint64(2**64 - 1), own)
        cover = np.zeros(len(run.whole) + 1, dtype=np.int32)
        pick = run.pick[held.stretch]
        for t in range(before + 1):
            start = pick - t
            hit = ((own >> np.uint64(t)) & np.uint64(1)).astype(bool)
            hit &= (start >= run.first[held.stretch]) & (start <= run.last[held.stretch])
            np.add.at(cover, start[hit], 1)
            np.add.at(cover, start[hit] + length, -1)
        gone = np.cumsum(cover[:-1], dtype=np.int32) > 0
        del cover
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        a, b = run.offsets[:-1], run.offsets[1:]
        begins[a[a < b]] = gone[a[a < b]]
        n_removed = np.bincount(np.searchsorted(run.offsets, np.flatnonzero(gone), "right") - 1, minlength=len(a))
        n_spans = np.bincount(np.searchsorted(run.offsets, np.flatnonzero(begins), "right") - 1, minlength=len(a))
        digests, kept = [], []
        for number, data in enumerate(run.texts):
            if n_removed[number]:
                own_bytes = run.whole[a[number]: b[number]]
                data = own_bytes[~gone[a[number]: b[number]]].tobytes()
            digests.append(hashlib.sha256(data).hexdigest())
            if keep_bytes:
                kept.append(data)
        out = {"_id": pa.array(run.ids, pa.int64(), mask=~run.known), "n_bytes": pa.array(b - a, pa.int64()),
               "n_removed": pa.array(n_removed, pa.int64()), "n_spans": pa.array(n_spans, pa.int64()),
               "kept_sha256": pa.array(digests, pa.string())}
        return pa.table(out | ({"kept": pa.array(kept, pa.binary())} if keep_bytes else {}))

    round_1 = by_run.applyInArrow(places, _BLOB).groupBy("part").applyInArrow(R.shared_keys(PLACE_BYTES), _ANSWER)
    round_2 = by_run.cogroup(round_1.groupBy("run")).applyInArrow(suffixes, _BLOB) \
        .groupBy("part").applyInArrow(merged, _ANSWER)
    schema = "_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_bytes
    result = by_run.cogroup(round_1.unionByName(round_2).groupBy("run")).applyInArrow(assemble, schema)
    return result.select(F.col("_id").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * keep_bytes)
