"""Language-model scores by a hashed maximum-entropy model (operator 4).

The probability of a word is that of its class given the words before it, times
that of the word in its class.  Classes are a few very frequent words each, the end
of a text, and groups of all other words by their last letters.  The class softmax
has hashed n-gram and skip features: the word before, the two before together, and
the words two and three places before.  The softmax inside a class has one weight
per word, whose maximum-entropy value is the logarithm of its count.  What results
is the lowest order of an interpolation with the counts of pairs and triples of
words, so that the words before tell of every word and not only of its class.  A
training text is scored without the occurrence in question in these counts.

Counts of all words, pairs and triples are gathered through runs, so their traffic grows with the
corpus.  The weights are trained on all training texts: in each round every task
takes gradient steps on its texts from the same weights, and the changes, averaged
row by row by Spark, are the round's update.  Texts are scored in sparse numpy
batches.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pressmill.llm import runs as R
from pressmill.llm.common import learned
from pressmill.session import write_between

FOLDS = 10
SMOOTHING = 0.1
# classes: frequent words, the end, and last letters
WORD_CLASSES = 31
LETTER_CLASSES = 32
CLASSES = WORD_CLASSES + 1 + LETTER_CLASSES
# rows of the weight table of each feature: before, two before, skips
BUCKET_BITS = (12, 13, 12, 12)
ROUNDS = 2
RATE = 0.5
BATCH = 16_384
# rows of all stretches that are summed at once, one of each
STEPS = 48
# occurrences that the lower order counts as beside the counts of a pair and of a triple
LOWER = (200.0, 50.0)
# weight rows of a message
MESSAGE_ROWS = 1024
# messages of a run that are sent at once
MESSAGES = 32
END = np.uint64(0x5E9D_0000_0000_0001)
# class of a word by its last two letters
_BY_LETTERS = (WORD_CLASSES + 1 + R.mix(np.arange(1 << 16, dtype=np.uint64), 77) % np.uint64(LETTER_CLASSES)).astype(np.uint8)

_COUNTS = R.ANSWER + ", name long, n long"


def _texts(rows: pa.Table):
    ids, known, texts = R.ordered(rows)
    # a row without an id is neither learned from nor held out
    fold = np.array([zlib.crc32(str(i).encode()) % FOLDS for i in ids.tolist()], dtype=np.int64)
    return ids, known, texts, known & (fold != 0)


def _tokens(block: R.Block):
    """(document in the block, name, class by last letters, end flag) of all tokens of a block."""
    bounds = R.word_bounds(block, lower=True)
    doc, name, _ = R.word_names(block, seconds=False, bounds=bounds)
    letters = R.last_letters(block, bounds=bounds)
    doc = doc - np.int32(block.first)
    count = np.bincount(doc, minlength=len(block.texts))
    place = np.arange(len(doc)) + doc
    total = len(doc) + len(block.texts)
    ends = np.cumsum(count + 1) - 1
    names, classes, owner = np.empty(total, np.uint64), np.empty(total, np.uint8), np.empty(total, np.int32)
    names[place], names[ends] = name, END
    classes[place] = _BY_LETTERS[letters.view(np.int64)]
    classes[ends] = WORD_CLASSES
    owner[place], owner[ends] = doc, np.arange(len(block.texts))
    return owner, names, classes


def _before(owner: np.ndarray, values: np.ndarray, k: int, first) -> np.ndarray:
    """Value of the token ``k`` places before every token; ``first`` where the text does not reach back."""
    past = np.full(len(values), first, values.dtype)
    if len(values) > k:
        past[k:] = np.where(owner[k:] == owner[:-k], values[:-k], past[k:])
    return past


def _ngrams(owner: np.ndarray, names: np.ndarray, number: int) -> np.ndarray:
    """Names of the pairs (1) or the triples (2) that end in every token; their last bit is 0."""
    one = _before(owner, names, 1, 0)
    found = R.pair(one, names, 8) if number == 1 else R.pair(R.pair(_before(owner, names, 2, 0), one, 5), names, 9)
    found &= ~np.uint64(1)
    return found


def _packed(counts: np.ndarray) -> bytes:
    """Counts in as many bytes each as the largest needs."""
    return R.planes(counts, max(1, (int(counts.max()).bit_length() + 7) // 8))


def _unpacked(data: bytes, n: int) -> np.ndarray:
    return R.from_planes(data, n, len(data) // n)


def _counts_of(names: np.ndarray, found: dict[int, bytes], bits: int, unpacked=_unpacked) -> np.ndarray:
    """Counts of the words or n-grams of a run from its answers, in as few bytes each as they need."""
    order, keys = R.sorting(names)
    del names
    heads = R.groups(keys)
    sizes, keys = np.diff(heads, append=len(keys)), keys[heads]
    del heads
    total = np.empty(len(keys), np.int64)
    for part, own in R.parts_of(keys, bits):
        total[own] = unpacked(found[part], own.stop - own.start)
    del keys
    total = total.astype(np.min_scalar_type(total.max()))
    out = np.empty(len(order), total.dtype)
    out[order] = np.repeat(total, sizes)
    return out


def _features(owner: np.ndarray, names: np.ndarray) -> list[np.ndarray]:
    """Weight row of each feature for every token."""
    back = [_before(owner, names, k, 0) for k in (1, 2, 3)]
    keys = (back[0], R.pair(back[0], back[1], 5), back[1], back[2])
    return [(R.mix(key, 50 + i) >> np.uint64(64 - bits)).astype(np.int64) for i, (key, bits) in enumerate(zip(keys, BUCKET_BITS))]


@dataclass
class Model:
    """Weights by feature, bias, names of the frequent words, and mass and size of each class."""

    weights: list[np.ndarray]
    bias: np.ndarray
    words: np.ndarray
    mass: np.ndarray
    size: np.ndarray

    def classes(self, names: np.ndarray, by_letters: np.ndarray) -> np.ndarray:
        out = by_letters.astype(np.int64)
        # only names that begin like a frequent word are looked up
        maybe = np.zeros(1 << 12, dtype=bool)
        maybe[self.words >> np.uint64(52)] = True
        which = np.flatnonzero(maybe[(names >> np.uint64(52)).view(np.int64)])
        if len(which):
            found = names[which]
            at = np.minimum(np.searchsorted(self.words, found), len(self.words) - 1)
            hit = self.words[at] == found
            out[which[hit]] = at[hit]
        return out

    def logits(self, rows: list[np.ndarray], out: np.ndarray, spare: np.ndarray) -> None:
        """Logits of all classes into ``out``; ``spare`` is room of the same shape."""
        np.take(self.weights[0], rows[0], axis=0, out=out, mode="clip")
        for table, own in zip(self.weights[1:], rows[1:]):
            np.take(table, own, axis=0, out=spare, mode="clip")
            out += spare
        out += self.bias


def segment_sums(rows: np.ndarray, order: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of stretches of ``rows[order]`` that begin at ``heads``, and the places of these in ``heads``.

    Longer stretches come first, so that those with a next row are always the first ones.
    A long one is its first eight rows and the sum of all others.
    """
    sizes = np.diff(heads, append=len(order))
    most = sizes.max()
    by = np.argsort((most - sizes).astype(np.uint16 if most < 1 << 16 else np.int64), kind="stable")
    heads, sizes = heads[by], sizes[by]
    # stretches with more rows than this
    over = (len(sizes) - np.searchsorted(sizes[::-1], np.arange(STEPS), "right")).tolist()

    def row(k: int) -> np.ndarray:
        return rows.take(order.take(heads[: over[k]] + k), axis=0)

    out = row(0)
    for k in range(1, 8):
        out[: over[k]] += row(k)
    rest = row(8)
    for k in range(9, STEPS):
        rest[: over[k]] += row(k)
    # beyond, one by one from the sum so far
    for i, (head, size) in enumerate(zip(heads[: over[-1]].tolist(), sizes.tolist())):
        if size > STEPS:
            more = rows.take(order[head + STEPS - 1: head + size], axis=0)
            more[0] = rest[i]
            rest[i] = np.add.reduce(more, axis=0)
    out[: over[8]] += rest
    return out, by


def take_steps(model: Model, table: np.ndarray, touched: np.ndarray, squares: np.ndarray, owner: np.ndarray, names: np.ndarray,
               letters: np.ndarray) -> None:
    """Gradient steps on the tokens of a block, with rates that fall as a row's gradients add up.

    ``table`` holds the weights of all features, of which those of the model are views.
    """
    classes = model.classes(names, letters)
    # small numbers are sorted by their digits
    kind = np.uint16 if len(table) <= 1 << 16 else np.int64
    rows = [r.astype(kind) for r in _features(owner, names)]
    firsts = np.cumsum([0, *map(len, model.weights[:-1])]).astype(kind)
    one = np.ones(CLASSES, np.float32)
    room, spare = np.empty((BATCH, CLASSES), np.float32), np.empty((BATCH, CLASSES), np.float32)
    for at in range(0, len(names), BATCH):
        own = [r[at: at + BATCH] for r in rows]
        slope, number = room[: len(own[0])], np.arange(len(own[0]))
        model.logits(own, slope, spare[: len(slope)])
        slope -= slope.max()
        np.exp(slope, out=slope)
        slope /= np.maximum(slope @ one, np.float32(1e-30))[:, None]
        slope[number, classes[at: at + BATCH]] -= 1
        model.bias -= np.float32(RATE) * slope.mean(axis=0)
        r = np.concatenate([r + first for r, first in zip(own, firsts)])
        order = np.argsort(r, kind="stable")
        r = r[order]
        heads = R.groups(r)
        total, by = segment_sums(slope, np.tile(number, len(own)).take(order), heads)
        which = r[heads[by]].astype(np.int64)
        squares[which] += np.einsum("ij,ij->i", total, total) / CLASSES
        total *= (np.float32(RATE) / np.sqrt(squares[which] + 1))[:, None]
        moved = table.take(which, axis=0)
        moved -= total
        table[which] = moved
        touched[which] = True


def count_words(given: R.Runs) -> DataFrame:
    """Counts over training texts of the words, pairs and triples of every run, in its order of them; totals by
    class; frequent words.

    Pairs and triples are orders 1 and 2; a part's number holds the order above its lower 32 bits.
    """
    bits = given.bits

    # in parts: neither the keys of all orders nor their messages are held at once
    def words(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, texts, train = _texts(pa.Table.from_batches(batches))
        names, letters, counted, ngrams = [], [], [], ([], [])
        for block in R.blocks(texts):
            owner, name, by_letters = _tokens(block)
            for number, known in enumerate(ngrams, 1):
                known.append(_ngrams(owner, name, number))
            names.append(name)
            letters.append(by_letters)
            counted.append(train[owner + block.first])
        if not names:
            return
        del texts
        name, letter, mine = map(np.concatenate, (names, letters, counted))
        order, keys = R.sorting(name)
        heads = R.groups(keys)
        keys, kinds = keys[heads], letter[order[heads]]
        counts = np.add.reduceat(mine[order].astype(np.int64), heads)
        out = [(part, key[0].as_py(), at.stop - at.start,
                keys[at].tobytes() + kinds[at].tobytes() + R.planes(counts[at], 6))
               for part, at in R.parts_of(keys, bits)]
        del names, letters, counted, name, letter, order, keys, kinds, counts
        yield from R.blobs(out).to_batches(MESSAGES)
        for number, found in enumerate(ngrams, 1):
            # the last bit tells whether the token counts
            coded = np.concatenate(found)
            found.clear()
            coded |= mine
            coded.sort()
            heads = R.groups(coded >> np.uint64(1))
            counts = np.add.reduceat((coded & np.uint64(1)).astype(np.int64), heads)
            keys = coded[heads]
            del coded, heads
            out = [(number << 32 | part, key[0].as_py(), at.stop - at.start,
                    R.planes(keys[at] >> np.uint64(1), R.PLACE_BYTES) + _packed(counts[at]))
                   for part, at in R.parts_of(keys, bits)]
            del keys, counts
            yield from R.blobs(out).to_batches(MESSAGES)

    def ngram_totals(part, numbers, counts, data):
        wide = R.PLACE_BYTES
        names = np.concatenate([R.from_planes(d[: wide * n], n, wide) for n, d in zip(counts, data)])
        own = np.concatenate([_unpacked(d[wide * n:], n) for n, d in zip(counts, data)]).astype(np.int64)
        order, names = R.sorting(names)
        heads = R.groups(names)
        every = np.empty(len(order), np.uint64)
        every[order] = np.repeat(np.add.reduceat(own[order], heads), np.diff(np.append(heads, len(order)))).astype(np.uint64)
        return [(n, 4 + (part >> 32), part & 0xFFFFFFFF, _packed(x), None, None)
                for n, x in zip(numbers, np.split(every, np.cumsum(counts)[:-1]))]

    def totals(key, rows):
        part = key[0].as_py()
        numbers, counts, data = rows["run"].to_pylist(), rows["count"].to_pylist(), rows["data"].to_pylist()
        if part >> 32:
            return answer(ngram_totals(part, numbers, counts, data))
        names = np.concatenate([np.frombuffer(d, np.uint64, n) for n, d in zip(counts, data)])
        kinds = np.concatenate([np.frombuffer(d, np.uint8, n, 8 * n) for n, d in zip(counts, data)])
        own = np.concatenate([R.from_planes(d[9 * n:], n, 6) for n, d in zip(counts, data)]).astype(np.int64)
        order, names = R.sorting(names)
        heads = R.groups(names)
        total = np.add.reduceat(own[order], heads)
        every = np.empty(len(order), np.uint64)
        every[order] = np.repeat(total, np.diff(np.append(heads, len(order)))).astype(np.uint64)
        out = [(n, 0, part, R.planes(x, 6), None, None)
               for n, x in zip(numbers, np.split(every, np.cumsum(counts)[:-1]))]
        word, kind = names[heads].view(np.int64), kinds[order[heads]]
        mass = np.bincount(kind, weights=total, minlength=CLASSES).astype(np.int64)
        size = np.bincount(kind[total > 0], minlength=CLASSES)
        out += [(-1, 3, part, None, k, int(m)) for k, m in enumerate(mass) if m]
        out += [(-1, 4, part, None, k, int(m)) for k, m in enumerate(size) if m]
        often = np.lexsort((word, -total))[: WORD_CLASSES + 1]
        out += [(-1, 2, part, bytes([int(kind[i])]), int(word[i]), int(total[i])) for i in often if total[i]]
        return answer(out)

    def answer(out):
        kinds_ = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
        return pa.table({c: pa.array(v, t) for c, v, t in zip(
            ("run", "kind", "part", "data", "name", "n"), zip(*out), kinds_)})

    return given.docs.groupBy("_run").applyInArrow(words, R.BLOB).groupBy("part").applyInArrow(totals, _COUNTS)


def start(counts: DataFrame) -> Model:
    """A model with its words and masses, and no weights yet."""
    sums = {(r[0], r[1]): r[2] for r in counts.where("kind IN (3, 4)").groupBy("kind", "name").agg(F.sum("n")).collect()}
    mass = np.array([sums.get((3, k), 0) for k in range(CLASSES)], dtype=np.float64)
    size = np.array([sums.get((4, k), 0) for k in range(CLASSES)], dtype=np.float64)
    often = counts.where("kind = 2").orderBy(F.desc("n"), "name").limit(WORD_CLASSES + 1).collect()
    often = [(np.int64(r["name"]).view(np.uint64), r["data"][0], r["n"]) for r in often]
    often = sorted([x for x in often if x[0] != END][:WORD_CLASSES], key=lambda x: int(x[0]))
    for at, (_, kind, n) in enumerate(often):
        mass[kind] -= n
        size[kind] -= 1
        mass[at], size[at] = n, 1
    weights = [np.zeros((1 << bits, CLASSES), np.float32) for bits in BUCKET_BITS]
    bias = np.log(np.maximum(mass, 0.5) / max(1.0, mass.sum())).astype(np.float32)
    return Model(weights, bias, np.array([x[0] for x in often], dtype=np.uint64), mass, size)


def update(docs: DataFrame, model: Model, id_col: str, text_col: str) -> Model:
    """One round over ``docs``: steps in every task, changes averaged by Spark."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        table = np.concatenate(known.weights)
        ends = np.cumsum([len(w) for w in known.weights])[:-1]
        own = Model(np.split(table, ends), known.bias.copy(), known.words, known.mass, known.size)
        touched, squares = np.zeros(len(table), bool), np.zeros(len(table), np.float32)
        tokens = 0
        for batch in batches:
            for block in R.blocks(text.as_py() for text in batch.column("_text")):
                parts = _tokens(block)
                tokens += len(parts[0])
                take_steps(own, table, touched, squares, *parts)
        if not tokens:
            return
        out = [(-1, np.ones(1, bool), (own.bias - known.bias)[None, :])]
        for number, (now, seen, was) in enumerate(zip(own.weights, np.split(touched, ends), known.weights)):
            for at in range(0, len(now), MESSAGE_ROWS):
                part = slice(at, at + MESSAGE_ROWS)
                if seen[part].any():
                    out.append((number << 32 | at, seen[part], (now[part] - was[part])[seen[part]]))
        yield pa.RecordBatch.from_pydict({
            "message": pa.array([o[0] for o in out], pa.int64()),
            "seen": pa.array([R.to_bits(o[1]) for o in out], pa.binary()),
            "data": pa.array([o[2].astype(np.float16).tobytes() for o in out], pa.binary())})

    # batch by batch: a task sees one message of every other task
    def average(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = count = None
        for batch in batches:
            for seen, data in zip(batch.column("seen").to_pylist(), batch.column("data").to_pylist()):
                rows = R.from_bits(seen, MESSAGE_ROWS if key[0].as_py() >= 0 else 1)
                if total is None:
                    total, count = np.zeros((len(rows), CLASSES)), np.zeros(len(rows))
                total[rows] += np.frombuffer(data, np.float16).reshape(-1, CLASSES)
                count[rows] += 1
        mean = (total / np.maximum(count, 1)[:, None]).astype(np.float32)
        yield pa.RecordBatch.from_pydict({"message": pa.array([key[0].as_py()], pa.int64()), "data": pa.array([mean.tobytes()], pa.binary())})

    # a null text is an empty one, whose end is learned from
    texts = docs.select(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    changes = texts.mapInArrow(steps, "message long, seen binary, data binary") \
        .groupBy("message").applyInArrow(average, "message long, data binary")
    # the whole model, whose size is fixed
    for message, data in changes.collect():
        change = np.frombuffer(data, np.float32).reshape(-1, CLASSES)
        if message < 0:
            model.bias = model.bias + change[0]
        else:
            at = message & 0xFFFFFFFF
            model.weights[message >> 32][at: at + len(change)] += change
    return model


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run_bytes: int = R.RUN_BYTES) -> DataFrame:
    """Per document: id, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``, ``left_out_score``.

    ``score`` is one model's log10 probability of the text, whether it was learned from
    or not.  ``left_out_score`` takes each occurrence of a learned text out of the counts
    of pairs and triples before it is scored; other texts have the same in both.

    Tokens are words of the text with A-Z in lower case, and one end.  Learns from
    texts whose id's crc32 is not divisible by ``FOLDS``; a row without an id is
    scored only.  A null text is empty and scores its end.  Repeated rows count each.
    Ids are integers.
    """
    given = R.in_runs(docs, id_col, text_col, run_bytes)
    bits = given.bits
    counts = write_between(count_words(given))
    model = start(counts)
    train = docs.where(learned(f"`{id_col}`", FOLDS))
    share = F.pmod(F.xxhash64(F.col(f"`{id_col}`"), F.lit(3)), F.lit(ROUNDS))
    for number in range(ROUNDS):
        model = update(train.where(share == number), model, id_col, text_col)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    tokens, distinct = model.mass.sum(), model.size.sum()

    def scored(key, rows, answers):
        known = sent.value
        ids, has_id, texts, train = _texts(rows)
        found = R.answers_of(answers, 0)
        # of the texts, only their number in each block is needed further
        parts = [(b.first, len(b.texts), *_tokens(b)) for b in R.blocks(texts)]
        del texts
        if not parts:
            return None
        total = _counts_of(np.concatenate([p[3] for p in parts]), found, bits, lambda data, n: R.from_planes(data, n, 6))
        n, n_known = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        base, full, alone = np.zeros(len(ids)), np.zeros(len(ids)), np.zeros(len(ids))
        one = np.ones(CLASSES, np.float32)
        room, spare = np.empty((BATCH, CLASSES), np.float32), np.empty((BATCH, CLASSES), np.float32)
        inner = known.mass + SMOOTHING * (known.size + 1)
        ngrams = [_counts_of(np.concatenate([_ngrams(p[2], p[3], i) for p in parts]), R.answers_of(answers, 4 + i), bits)
                  for i in (1, 2)]
        # as many texts begin as end
        begun, token = int(known.mass[WORD_CLASSES]), 0
        for first, size, owner, names, letters in parts:
            count, pairs, triples = (x[token: token + len(names)].astype(np.int64) for x in (total, *ngrams))
            token += len(names)
            classes, features = known.classes(names, letters), _features(owner, names)
            chance = np.empty(len(names))
            for at in range(0, len(names), BATCH):
                rows_ = [r[at: at + BATCH] for r in features]
                z, moved = room[: len(rows_[0])], spare[: len(rows_[0])]
                known.logits(rows_, z, moved)
                z -= z.max(axis=1)[:, None]
                own = z[np.arange(len(z)), classes[at: at + BATCH]].astype(np.float64)
                np.exp(z, out=z)
                chance[at: at + BATCH] = own - np.log(z @ one)
            inside = np.where(classes <= WORD_CLASSES, 1.0, (count + SMOOTHING) / inner[classes])
            own = train[owner + first].astype(np.int64)
            p = np.exp(chance) * inside
            out = p
            for times, before, lower in ((pairs, count, LOWER[0]), (triples, pairs, LOWER[1])):
                every = _before(owner, before, 1, begun)
                p = (times + lower * p) / (every + lower)
                out = (times - own + lower * out) / (every - own + lower)
            here = slice(first, first + size)
            n[here] = np.bincount(owner, minlength=size)
            n_known[here] = np.bincount(owner, weights=count > 0, minlength=size)
            base[here] = np.bincount(owner, np.log10((count + 0.1) / (tokens + 0.1 * (distinct + 1))), minlength=size)
            full[here] = np.bincount(owner, np.log10(np.maximum(p, 1e-300)), minlength=size)
            alone[here] = np.bincount(owner, np.log10(np.maximum(out, 1e-300)), minlength=size)
        return pa.table({
            "_id": pa.array(ids, pa.int64(), mask=~has_id), "n_tokens": pa.array(n), "n_known": pa.array(n_known),
            "train_tokens": pa.array(np.full(len(n), int(tokens))), "base_score": pa.array(base), "score": pa.array(full),
            "left_out_score": pa.array(alone)})

    schema = "_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double, left_out_score double"
    back = counts.where("kind IN (0, 5, 6)").select("run", "kind", "part", "data")
    out = given.docs.groupBy("_run").cogroup(back.groupBy("run")).applyInArrow(scored, schema)
    return out.withColumnRenamed("_id", id_col)
