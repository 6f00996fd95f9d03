"""Removal of repeated word sequences by recompression (operator 3).

Words are symbols.  A round first names runs of one symbol by the symbol and its
number, and then pairs: a class bit of each name says left or right, and a left symbol
and the right one after it become one.  Rounds go on until no symbol fits into a window
of words any more.  A name is a hash of what it stands for, so that it is the same in
every task and round without a table of names.

Every symbol has a *context*: the words that decide that it begins and ends where it
does, whatever stands around them.  So wherever these words occur, the symbol does: it
is an interior symbol of every window that holds its context.  Of its interior symbols,
and of three of them in a row, each window takes the one that covers most words (by
name, of several) as its key.  A window inside a run has the run, and one where two
runs meet has their meeting.

The first exchange tells for each key whether a second document has it, which reveals
possible repeats.  The second verifies: windows of shared keys are named by doubling,
by two hashes of 104 bits together, and each learns the smallest document that holds
it.  Both send one entry per run of documents and name.  A run also sends itself which
windows are shared, so that keys are found twice and not for the removal again.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pressmill.llm import runs as R
from pressmill.llm.runs import ANSWER as _ANSWER, BLOB as _BLOB, PLACE_BYTES, answers_of as _answers, blobs as _blobs

WINDOW = 13
# a context that goes beyond the document is known nowhere else
_FAR = np.int64(1 << 40)
# numbers held at once for the keys of some documents
_CELLS = 2_000_000


class Level:
    """Symbols of some words after a round: name, words ``start`` to ``stop``, context ``lo`` to ``hi``, document."""

    def __init__(self, name, start, stop, lo, hi, doc):
        self.name, self.start, self.stop, self.lo, self.hi, self.doc = name, start, stop, lo, hi, doc
        self.joined = np.zeros(len(name), dtype=bool)  # to the symbol before, of the same document
        self.joined[1:] = doc[1:] == doc[:-1]

    @classmethod
    def of_words(cls, names: np.ndarray, doc: np.ndarray) -> Level:
        at = np.arange(len(names))
        return cls(names, at, at + 1, at, at + 1, doc)

    def before(self, values: np.ndarray) -> np.ndarray:
        """Each symbol's value of the one before it; far off at the document's edge."""
        out = np.full(len(values), -_FAR)
        out[1:] = np.where(self.joined[1:], values[:-1], -_FAR)
        return out

    def after(self, values: np.ndarray) -> np.ndarray:
        out = np.full(len(values), _FAR)
        out[:-1] = np.where(self.joined[1:], values[1:], _FAR)
        return out

    def _merged(self, first: np.ndarray, last: np.ndarray, name: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> Level:
        return Level(name, self.start[first], self.stop[last], lo, hi, self.doc[first])

    def runs(self) -> Level:
        """Neighbours of one name become one symbol; its ends are known where others stand beside it."""
        new = np.ones(len(self.name), dtype=bool)
        new[1:] = (self.name[1:] != self.name[:-1]) | ~self.joined[1:]
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(new)) - 1
        count = (last - first + 1).astype(np.uint64)
        name = self.name[first]
        name = np.where(count > 1, R.pair(name, count, 11), name)
        lo = np.minimum(self.lo[first], self.before(self.lo)[first])
        hi = np.maximum(self.hi[last], self.after(self.hi)[last])
        return self._merged(first, last, name, lo, hi)

    def pairs(self, salt: int) -> Level:
        """A left symbol and the right one after it become one; single ones are known by the other side."""
        left = (R.mix(self.name, salt) & np.uint64(1)) == 0
        second = np.zeros(len(left), dtype=bool)
        second[1:] = left[:-1] & ~left[1:] & self.joined[1:]
        first = np.flatnonzero(~second)
        paired = np.zeros(len(first), dtype=bool)
        inner = first + 1 < len(left)
        paired[inner] = second[first[inner] + 1]
        last = first + paired
        name = self.name[first].copy()
        name[paired] = R.pair(self.name[first[paired]], self.name[last[paired]], salt)
        lo, hi = self.lo[first], np.maximum(self.hi[first], self.hi[last])
        lo = np.where(paired, np.minimum(lo, self.lo[last]), lo)
        alone_left = ~paired & left[first]
        lo = np.where(paired | alone_left, lo, np.minimum(lo, self.before(self.lo)[first]))
        hi = np.where(alone_left, np.maximum(hi, self.after(self.hi)[first]), hi)
        return self._merged(first, last, name, lo, hi)


class _Keys:
    """Least key of every window of words, from keys offered with their contexts."""

    def __init__(self, words: int, window: int):
        self.window, self.words = window, words
        self.best = np.full((window + 1, words), ~np.uint64(0))
        self.flat = self.best.reshape(-1)

    def offer(self, lo: np.ndarray, hi: np.ndarray, covered, name) -> bool:
        """Offer what has a context that fits; ``covered`` and ``name`` tell words and name of some by number."""
        size = hi - lo
        ok = np.flatnonzero(size <= self.window)
        if not len(ok):
            return False
        key = (np.uint64(255) - np.minimum(covered(ok), 255).astype(np.uint64) << np.uint64(56)) | (name(ok) >> np.uint64(8))
        # one index is much faster than two
        at = size[ok] * self.words + lo[ok]
        while len(at):
            self.flat[at] = np.minimum(self.flat[at], key)
            # of several at one place another may have been kept
            lost = np.flatnonzero(self.flat[at] > key)
            at, key = at[lost], key[lost]
        return True

    def level(self, level: Level, salt: int) -> bool:
        """Offer symbols and threes of symbols; whether any symbol fits."""
        fits = self.offer(level.lo, level.hi, lambda ok: level.stop[ok] - level.start[ok], lambda ok: R.mix(level.name[ok], salt))
        if len(level.name) > 2:
            a = np.flatnonzero(level.joined[1:-1] & level.joined[2:])
            lo = np.minimum(np.minimum(level.lo[:-2], level.lo[1:-1]), level.lo[2:])[a]
            hi = np.maximum(np.maximum(level.hi[:-2], level.hi[1:-1]), level.hi[2:])[a]
            self.offer(lo, hi, lambda ok: level.stop[a[ok] + 2] - level.start[a[ok]], lambda ok: R.pair(
                R.pair(level.name[a[ok]], level.name[a[ok] + 1], salt), level.name[a[ok] + 2], salt + 1))
        return fits

    def least(self) -> np.ndarray:
        """A context lies in a window if it is the window, or in one shorter by a word at either end."""
        held = self.best[0]
        for size in range(1, self.window + 1):
            shorter = held
            held = np.minimum(self.best[size], shorter)
            held[:-1] = np.minimum(held[:-1], shorter[1:])
        return held


def symbol_keys(names: np.ndarray, doc: np.ndarray, window: int, rounds: int | None = None) -> np.ndarray:
    """Key of the window that begins at each word: all ones where no interior symbol is known.

    ``rounds`` ends recompression early.
    """
    keys, level = _Keys(len(names), window), Level.of_words(names, doc)
    number = 0
    while rounds is None or number < rounds:
        if not number:
            beside = np.flatnonzero(level.joined)
            other = names[beside] != names[beside - 1]
            meet, inside = beside[other], beside[~other]
            for own, words, salt in ((meet, 2, 12), (inside, 1, 13)):
                keys.offer(own - 1, own + 1, lambda ok: np.full(len(ok), words), lambda ok: R.pair(names[own[ok] - 1], names[own[ok]], salt))
        level = level.runs()
        fits = keys.level(level, 100 + 4 * number)
        level = level.pairs(20 + number)
        fits |= keys.level(level, 102 + 4 * number)
        number += 1
        if not fits:
            break
    return keys.least()


def window_places(names: np.ndarray, doc: np.ndarray, window: int, rounds: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """First words of all windows that have a key, and their keys, spread over the key space."""
    starts, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    ends = np.flatnonzero(np.append(doc[1:] != doc[:-1], True)) + 1 if len(doc) else np.zeros(0, np.int64)
    at = 0
    while at < len(names):
        # whole documents, as many as their numbers fit, or one
        some = np.searchsorted(ends, at + _CELLS // (window + 1), "right") - 1
        stop = int(ends[max(some, np.searchsorted(ends, at, "right"))])
        own = doc[at:stop]
        found = symbol_keys(names[at:stop], own, window, rounds)
        first = np.flatnonzero(own[: max(0, len(own) - window + 1)] == own[window - 1:])
        first = first[found[first] != ~np.uint64(0)]
        starts.append(first + at)
        keys.append(R.mix(found[first]))
        at = stop
    return np.concatenate(starts), np.concatenate(keys)


def window_names(one: np.ndarray, two: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two names of each window, by doubling: pairs, pairs of pairs, and the rest."""
    out = []
    for salt, names in ((40, one), (60, two)):
        total, at, size, level = None, 0, 1, names
        while size <= window:
            if window & size:
                own = level[starts + at]
                total = own if total is None else R.pair(total, own, salt + 9)
                at += size
            if size * 2 <= window:
                level = R.pair(level[: len(level) - size], level[size:], salt + size)
            size *= 2
        out.append(total)
    return out[0], out[1]


class _Words:
    """A run's words by name."""

    def __init__(self, rows: pa.Table, seconds: bool):
        self.ids, self.known, self.texts = R.ordered(rows)
        self.doc, self.one, self.two = R.run_words(self.texts, seconds=seconds)


class _Run(_Words):
    """A run's windows and the keys they took."""

    def __init__(self, rows: pa.Table, window: int, seconds: bool, rounds: int | None):
        super().__init__(rows, seconds)
        self.starts, self.place = window_places(self.one, self.doc, window, rounds)
        ok = self.known[self.doc[self.starts]]
        self.starts, self.place = self.starts[ok], self.place[ok]
        self.order = np.argsort(self.place, kind="stable")
        keys = self.place[self.order]
        self.heads = R.groups(keys)
        self.keys = keys[self.heads]

    def shared_windows(self, answers: dict[int, bytes], bits: int) -> np.ndarray:
        """First words of the windows whose place some other document has too."""
        flags = np.zeros(len(self.keys), dtype=bool)
        for part, at in R.parts_of(self.keys, bits):
            flags[at] = R.from_bits(answers[part], at.stop - at.start)
        per_window = np.empty(len(self.order), dtype=bool)
        per_window[self.order] = np.repeat(flags, np.diff(np.append(self.heads, len(self.order))))
        return self.starts[per_window]


class _Windows:
    """Distinct windows of a run at shared places, in order of their names."""

    def __init__(self, run: _Words, starts: np.ndarray, window: int):
        self.starts = starts
        one, two = window_names(run.one, run.two, starts, window)
        self.owner = run.ids[run.doc[starts]]
        self.order = np.lexsort((two, one))
        a, b = one[self.order], two[self.order]
        new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))) if len(a) else np.zeros(0, bool)
        self.heads = np.flatnonzero(new)
        self.one, self.two = a[self.heads], b[self.heads]
        owner = self.owner[self.order]
        self.least = np.minimum.reduceat(owner, self.heads) if len(self.heads) else owner

    def spread(self, per_name: np.ndarray) -> np.ndarray:
        """A value per distinct window, for each of ``starts``."""
        out = np.empty(len(self.order), dtype=per_name.dtype)
        out[self.order] = np.repeat(per_name, np.diff(np.append(self.heads, len(self.order))))
        return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   run_bytes: int = R.RUN_BYTES, keep_text: bool = False, rounds: int | None = None) -> DataFrame:
    """Per document: id, ``n_words``, ``n_removed``, ``kept_sha256`` and, if asked for, ``kept``.

    A word goes if a window of ``window`` words over it also starts in a document
    of a smaller id.  Ids are integers; rows of one id do not remove from each
    other, and a row without an id neither removes nor loses.  Null and wordless
    texts have no words; the kept text is then empty.  ``window`` is from 3 to 255.
    ``rounds`` ends recompression early, for tests: by default it goes on as long as
    symbols fit into windows.
    """
    given = R.in_runs(docs, id_col, text_col, run_bytes)
    by_run = given.docs.groupBy("_run")
    bits = given.bits

    def places(key, rows):
        run = _Run(rows, window, False, rounds)
        owner = run.doc[run.starts][run.order]
        many = np.zeros(len(run.keys), dtype=bool)
        if len(run.keys):
            many = np.minimum.reduceat(owner, run.heads) != np.maximum.reduceat(owner, run.heads)
        short = (run.keys << np.uint64(bits)) >> np.uint64(64 - 8 * PLACE_BYTES)
        return _blobs([(part, key[0].as_py(), at.stop - at.start,
                        R.planes(short[at], PLACE_BYTES) + R.to_bits(many[at]))
                       for part, at in R.parts_of(run.keys, bits)])

    def windows(key, rows, answers):
        run = _Run(rows, window, True, rounds)
        held = _Windows(run, run.shared_windows(_answers(answers, 0), bits), window)
        low = int(held.least.min()) if len(held.least) else 0
        short = (held.one << np.uint64(bits)) >> np.uint64(24)
        shared = np.zeros(len(run.one), dtype=bool)
        shared[held.starts] = True
        # for the run itself, past the parts
        own = [(-1 - key[0].as_py(), key[0].as_py(), len(shared), R.to_bits(shared))]
        return _blobs(own + [(part, key[0].as_py(), at.stop - at.start,
                        np.int64(low).tobytes() + R.planes(short[at], 5) + R.planes(held.two[at], 5)
                        + R.planes((held.least[at] - low).view(np.uint64), 8))
                       for part, at in R.parts_of(held.one, bits)])

    def foreign(key, rows):
        if key[0].as_py() < 0:
            return pa.table({"run": rows["run"], "kind": pa.array([2], pa.int32()), "part": rows["part"], "data": rows["data"]})
        numbers, counts, data = rows["run"].to_pylist(), rows["count"].to_pylist(), rows["data"].to_pylist()
        one = np.concatenate([R.from_planes(d[8: 8 + 5 * n], n, 5) for n, d in zip(counts, data)])
        two = np.concatenate([R.from_planes(d[8 + 5 * n: 8 + 10 * n], n, 5) for n, d in zip(counts, data)])
        least = np.concatenate([R.from_planes(d[8 + 10 * n:], n, 8).view(np.int64) + np.frombuffer(d[:8], np.int64)[0]
                                for n, d in zip(counts, data)])
        order = np.lexsort((two, one))
        a, b = one[order], two[order]
        heads = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
        best = np.minimum.reduceat(least[order], heads)
        flags = np.empty(len(order), dtype=bool)
        flags[order] = least[order] > np.repeat(best, np.diff(np.append(heads, len(order))))
        return pa.table({
            "run": pa.array(numbers, pa.int64()), "kind": pa.array([1] * len(numbers), pa.int32()),
            "part": pa.array([key[0].as_py()] * len(numbers), pa.int64()),
            "data": pa.array([R.to_bits(f) for f in np.split(flags, np.cumsum(counts)[:-1])], pa.binary())})

    def assemble(key, rows, answers):
        run = _Words(rows, True)
        shared, = _answers(answers, 2).values()
        held = _Windows(run, np.flatnonzero(R.from_bits(shared, len(run.one))), window)
        elsewhere = np.zeros(len(held.one), dtype=bool)
        found = _answers(answers, 1)
        for part, at in R.parts_of(held.one, bits):
            elsewhere[at] = R.from_bits(found[part], at.stop - at.start)
        gone = held.spread(elsewhere) | (held.owner > held.spread(held.least))
        cover = np.zeros(len(run.one) + 1, dtype=np.int32)
        np.add.at(cover, held.starts[gone], 1)
        np.add.at(cover, held.starts[gone] + window, -1)
        removed = np.cumsum(cover[:-1]) > 0
        n_words = np.bincount(run.doc, minlength=len(run.texts))
        n_removed = np.bincount(run.doc[removed], minlength=len(run.texts))
        first = np.concatenate(([0], np.cumsum(n_words)))
        digests, kept = [], []
        for number, text in enumerate(run.texts):
            words = text.encode("utf-8", "replace").split()
            if n_removed[number]:
                lost = removed[first[number]: first[number + 1]]
                words = [w for w, x in zip(words, lost.tolist()) if not x]
            whole = b" ".join(words)
            digests.append(hashlib.sha256(whole).hexdigest())
            if keep_text:
                kept.append(whole.decode("utf-8", "replace"))
        out = {"_id": pa.array(run.ids, pa.int64(), mask=~run.known), "n_words": pa.array(n_words, pa.int64()),
               "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(digests, pa.string())}
        return pa.table(out | ({"kept": pa.array(kept, pa.string())} if keep_text else {}))

    round_1 = by_run.applyInArrow(places, _BLOB).groupBy("part").applyInArrow(R.shared_keys(PLACE_BYTES), _ANSWER)
    round_2 = by_run.cogroup(round_1.groupBy("run")).applyInArrow(windows, _BLOB) \
        .groupBy("part").applyInArrow(foreign, _ANSWER)
    schema = "_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * keep_text
    result = by_run.cogroup(round_2.groupBy("run")).applyInArrow(assemble, schema)
    return result.select(F.col("_id").alias(id_col), "n_words", "n_removed", "kept_sha256", *["kept"] * keep_text)
