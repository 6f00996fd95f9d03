"""Phrase collocations by top-order marginalisation (operator 11).

Every word opens a window: itself and the words that follow it in its piece, as lead
columns, padded where the piece ends.  Only these longest windows are counted;
``ROLLUP`` then sums them over ever shorter prefixes, which are the counts of all
shorter phrases, as each occurrence of a phrase is the prefix of one window.

A phrase seen often has only words and pairs seen often, so windows are padded before
a pair that is not, and those of a word that is not are counted without it.  That is
exact, and leaves few windows that differ.  What is seen often is known from a first
pass that counts 64-bit hashes; it reaches the tasks as a bitmap of at most
``MOST_BITS`` bits.  Hashes or bits that fall together only let a window through that
the counts then settle, so results are the same for any bitmap.

Windows are made and counted in numpy, some megabytes of text at a time, and summed by
Spark.  A null text has no words, a null language is ``und``.  Texts and words may be
of any length.  Repeated rows count each.  Other columns are not read.  An empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from pressmill.session import write_between

MIN_COUNT = 100
LONGEST = 5
TOP = 2000
# a longer candidate with this share of a phrase's count, in hundredths, makes it redundant
ABSORBED = 100
# bits of the bitmap: for each frequent key, and at most
KEY_BITS, MOST_BITS = 32, 1 << 28
# text that a task turns into windows at once
CHUNK_BYTES = 2_000_000
# parts in which the best phrases of one language are found
RANK_PARTS = 64
BROADCAST_LANGUAGES = 10_000
EXACT = "decimal(38,0)"

# a break is a word of its own: no other word can hold a full stop
BREAK = b"."
MARKED = bytes.maketrans(
    b",;:!?\n\v\f\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ", b"." * 9 + b" abcdefghijklmnopqrstuvwxyz")


def _mixed(keys: np.ndarray) -> np.ndarray:
    keys = (keys ^ (keys >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return keys ^ (keys >> np.uint64(29))


class Chunk:
    """Coded words of some texts of one language.  Code 0 is a break; one stands at the end."""

    def __init__(self, lang: str, texts: list[bytes]):
        marked = b".".join([*texts, b""]).translate(MARKED).replace(BREAK, b" . ")
        tokens = pc.split_pattern(pa.array([marked], pa.large_binary()), " ").values.dictionary_encode()
        # the first token is empty, and so are those between two blanks
        words = [b"", BREAK, *(w for w in tokens.dictionary.to_pylist() if w not in (b"", BREAK))]
        code = {w: max(k - 1, -1) for k, w in enumerate(words)}
        recoded = np.array([code[w] for w in tokens.dictionary.to_pylist()], np.int64)[tokens.indices.to_numpy()]
        self.lang, self.words, self.codes = lang, words[1:], recoded[recoded >= 0]
        seed = xxhash.xxh64_intdigest(lang.encode("utf-8"))
        self.hashes = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in self.words), np.uint64, len(self.words))

    def lead(self, k: int) -> np.ndarray:
        """The word ``k`` places on, a break past the end."""
        return np.concatenate((self.codes[k:], np.zeros(min(k, len(self.codes)), np.int64)))

    def pair_keys(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return _mixed(self.hashes[a] * np.uint64(0x9E3779B97F4A7C15) + self.hashes[b])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    for batch in batches:
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            held.setdefault(lang, []).append(text.as_py() or b"")
            sizes[lang] = sizes.get(lang, 0) + len(held[lang][-1])
            if sizes[lang] >= CHUNK_BYTES:
                yield Chunk(lang, held.pop(lang))
                del sizes[lang]
        for lang, texts in held.items():
            yield Chunk(lang, texts)


def _texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).cast("binary").alias("text"))


def frequent_keys(texts: DataFrame, min_count: int) -> DataFrame:
    """Hashes of words and of pairs of words that are seen ``min_count`` times, with some others by chance."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            a, b = chunk.codes, chunk.lead(1)
            inside = (a > 0) & (b > 0)
            pairs, n = np.unique(a[inside] * len(chunk.words) + b[inside], return_counts=True)
            words = np.bincount(a, minlength=len(chunk.words))[1:]
            keys = np.concatenate((
                _mixed(chunk.hashes[1:]), chunk.pair_keys(pairs // len(chunk.words), pairs % len(chunk.words))))
            yield pa.record_batch([pa.array(keys.view(np.int64)), pa.array(np.concatenate((words, n)))], ["key", "n"])

    return texts.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")) \
        .where(F.col("n") >= min_count).select("key")


class Bitmap:
    """Which hashes may be frequent: a bit for each value of their leading bits."""

    def __init__(self, keys: DataFrame, key_bits: int, most_bits: int):
        bits = max(key_bits * keys.count(), 1 << 12)
        self.shift = 64 - min(bits.bit_length(), most_bits.bit_length() - 1)
        found = keys.groupBy((F.expr(f"shiftrightunsigned(key, {self.shift + 6})")).alias("word")).agg(
            F.bit_or(F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(key, {self.shift}) & 63 AS int))")).alias("bits")).toArrow()
        words = np.zeros(1 << (64 - self.shift - 6), np.uint64)
        words[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
        self.words = words

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        places = keys >> np.uint64(self.shift)
        return (self.words[places >> np.uint64(6)] >> (places & np.uint64(63)) & np.uint64(1)).astype(bool)


def _windows_of(chunk: Chunk, width: int, known: Bitmap) -> tuple[np.ndarray, np.ndarray]:
    """Distinct padded windows of a chunk and their counts; a window without a first word stands for rare words."""
    frequent = known.may_hold(_mixed(chunk.hashes))
    frequent[0] = False
    goes_on = frequent[chunk.codes] & frequent[chunk.lead(1)]
    at = np.flatnonzero(goes_on)
    goes_on[at] = known.may_hold(chunk.pair_keys(chunk.codes[at], chunk.codes[at + 1]))
    opened = np.flatnonzero(goes_on)
    columns, padded = [chunk.codes[opened]], np.ones(len(opened), bool)
    for k in range(1, width):
        padded = padded & np.concatenate((goes_on, np.zeros(k, bool)))[opened + k - 1]
        columns.append(np.where(padded, np.concatenate((chunk.codes, np.zeros(k, np.int64)))[opened + k], 0))
    windows = np.stack(columns, axis=1)
    order = np.lexsort(windows.T[::-1])
    windows = windows[order]
    first = np.ones(len(windows), bool)
    first[1:] = (windows[1:] != windows[:-1]).any(axis=1)
    starts = np.flatnonzero(first)
    counts = np.diff(np.append(starts, len(windows)))
    # a window that ends after its first word is that word
    alone = np.bincount(chunk.codes[(chunk.codes > 0) & ~goes_on], minlength=len(chunk.words))
    rare = alone[~frequent].sum()
    words = np.flatnonzero((alone > 0) & frequent)
    single = np.zeros((len(words) + 1, width), np.int64)
    single[1:, 0] = words
    return np.concatenate((windows[starts], single)), np.concatenate((counts, [rare], alone[words]))


def counted_windows(texts: DataFrame, width: int, known: Bitmap) -> DataFrame:
    """``(lang, w1 ... , f)``: padded longest windows and their counts."""
    names = [f"w{k}" for k in range(1, width + 1)]
    sent = texts.sparkSession.sparkContext.broadcast(known)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            windows, n = _windows_of(chunk, width, sent.value)
            words = pa.array([None, *chunk.words[1:]], pa.binary()).cast(pa.string())
            columns = [words.take(pa.array(np.ascontiguousarray(c))) for c in windows.T]
            yield pa.record_batch([pa.array([chunk.lang] * len(n), pa.string()), *columns, pa.array(n)], ["lang", *names, "f"])

    schema = ", ".join(["lang string", *[f"{w} string" for w in names], "f long"])
    return texts.mapInArrow(count, schema).groupBy("lang", *names).agg(F.sum("f").alias("f"))


def rolled_up(windows: DataFrame, width: int) -> DataFrame:
    """``(lang, words, f)``: counts of all phrases that windows begin with; no words is the language's total."""
    names = [f"w{k}" for k in range(1, width + 1)]
    sums = windows.rollup("lang", *names).agg(F.sum("f").alias("f"), F.grouping_id().alias("level"))
    length = F.lit(width) - F.bit_count("level").cast("int")
    # the last of a phrase's words is null where it is padding; the phrase is then counted under its real length
    last = F.coalesce(*[F.when(length == k, F.col(w)) for k, w in enumerate(names, 1)])
    words = F.slice(F.array(*names), F.lit(1), F.greatest(length, F.lit(0)))
    return sums.where((length == 0) | last.isNotNull()).select("lang", words.alias("words"), "f")


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT,
                  longest: int = LONGEST, most_bits: int = MOST_BITS) -> DataFrame:
    """``(lang, words, f)`` of all phrases of 1 to ``longest`` words seen ``min_count`` times; no words: all words."""
    texts = _texts(docs, text, lang)
    known = Bitmap(write_between(frequent_keys(texts, min_count)), KEY_BITS, most_bits)
    found = rolled_up(counted_windows(texts, longest, known), longest)
    return write_between(found.where((F.col("f") >= min_count) | (F.size("words") == 0)))


def _phrase(words: Column) -> Column:
    return F.array_join(words, " ")


def _parts(words: Column, size: Column) -> Column:
    """All shorter runs of at least two of the words."""
    starts = lambda n: F.sequence(F.lit(1), size - n + 1)
    return F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda n: F.transform(
        starts(n), lambda at: _phrase(F.slice(words, at, n)))))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT,
                 longest: int = LONGEST, top: int = TOP, absorbed: int = ABSORBED, most_bits: int = MOST_BITS) -> DataFrame:
    """The best phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase's score is that of its worst cut in two.  Scores are exact whole numbers
    of 38 digits, enough for 10 ** 17 words.
    """
    counts = phrase_counts(docs, text, lang, min_count, longest, most_bits)
    totals = counts.where(F.size("words") == 0).select("lang", F.col("f").alias("n"))
    if totals.count() <= BROADCAST_LANGUAGES:  # else Spark's join, by language
        totals = F.broadcast(totals)
    known = counts.where(F.size("words") > 0).select("lang", _phrase(F.col("words")).alias("phrase"), "words", "f")
    candidates = known.where(F.size("words") > 1)

    size, words = F.size("words"), F.col("words")
    cuts = candidates.select("lang", "phrase", F.col("f").alias("a"), words, F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", _phrase(F.slice(words, F.lit(1), F.col("k"))).alias("first"),
        _phrase(F.slice(words, F.col("k") + 1, size)).alias("rest"))
    count_of = lambda phrase, f: known.select("lang", F.col("phrase").alias(phrase), F.col("f").alias(f))
    cuts = cuts.join(count_of("first", "l"), ["lang", "first"]).join(count_of("rest", "r"), ["lang", "rest"]).join(totals, "lang")
    exact = lambda c: F.col(c).cast(EXACT)
    score = F.expr(f"(cast(1000 AS {EXACT}) * cast(a AS {EXACT}) * cast(n AS {EXACT})) div (cast(l AS {EXACT}) * cast(r AS {EXACT}))")
    worst = cuts.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    longer = candidates.where(size > 2).select("lang", F.explode(_parts(words, size)).alias("phrase"), "f") \
        .groupBy("lang", "phrase").agg(F.max("f").alias("over"))
    kept = worst.join(longer, ["lang", "phrase"], "left").where(
        F.coalesce(F.lit(100).cast(EXACT) * exact("over") < F.lit(absorbed).cast(EXACT) * exact("a"), F.lit(True)))
    rows = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score",
                       F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)).alias("part"))
    # the best of each part first, so that no task orders all phrases of a language
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long")
    best = rows.withColumn("rank", rank("lang", "part")).where(F.col("rank") <= top)
    return best.withColumn("rank", rank("lang")).where(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
