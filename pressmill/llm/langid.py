"""Language identification (operator 2).

A text is the average of embeddings of its hashed byte n-grams (2 to 4 bytes of the
lower-cased text, runs of other characters as one space), and a linear softmax over
it names the language.  Both are trained by stochastic gradient descent in numpy on
a bounded sample of labelled rows.  As average and layer are linear, training ends
in one table of a few numbers per bucket, and scoring a text is one lookup per
n-gram.  A second share of the sample calibrates the softmax by a temperature and
sets the score below which a text is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from pressmill.llm.common import packed, unpacked

BUCKET_BITS = 16
DIMENSIONS = 16
ORDERS = (2, 3, 4)
# the bounded sample: rows of a language, characters of a row, rows of all languages
# where there are many, and rows that each has at least
SAMPLE_ROWS = 600
SAMPLE_CHARS = 20_000
ALL_ROWS = 12_800
LEAST_ROWS = 8
# share of the sample for calibration; share of it that may be rejected
CALIBRATION = 0.2
REJECTED = 0.002
NO_LANGUAGE = "und"

_MULTIPLIERS = {2: 0x9E3779B97F4A7C15, 3: 0xBF58476D1CE4E5B9, 4: 0x94D049BB133111EB}
_KEPT = np.full(256, 32, dtype=np.uint8)
_KEPT[97:123] = np.arange(97, 123)
_KEPT[128:] = np.arange(128, 256)


def ngram_buckets(text: str) -> list[np.ndarray]:
    """Buckets of all n-grams, an array per order."""
    raw = np.frombuffer((" " + text.lower() + " ").encode("utf-8", "replace"), dtype=np.uint8)
    data = _KEPT[raw]
    data = data[np.concatenate(([True], (data[1:] != 32) | (data[:-1] != 32)))]
    wide = np.zeros(len(data), dtype=np.uint32)
    out = []
    for k in range(max(ORDERS)):
        if len(data) <= k:
            break
        wide = (wide[: len(data) - k] << np.uint32(8)) | data[k:]
        if k + 1 in ORDERS:
            mixed = wide.astype(np.uint64) * np.uint64(_MULTIPLIERS[k + 1])
            out.append((mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
    return out


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, text: str) -> np.ndarray:
        grams = ngram_buckets(text)
        n = sum(map(len, grams))
        total = np.zeros(len(self.languages))
        # long texts in blocks, so that memory does not follow their length
        for part in grams:
            for at in range(0, len(part), 1 << 16):
                total += self.table[part[at: at + (1 << 16)]].sum(axis=0, dtype=np.float64)
        return total / max(n, 1) + self.bias

    def probabilities(self, text: str) -> np.ndarray:
        z = self.logits(text) / self.temperature
        p = np.exp(z - z.max())
        return p / p.sum()


def train(texts: list[str], langs: list[str], seed: int = 7, epochs: int = 6) -> Model:
    """Fit on labelled texts; the last share of a random order calibrates."""
    languages = sorted(set(langs))
    if not languages:
        return Model([], np.zeros((1 << BUCKET_BITS, 0)), np.zeros(0))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(texts))
    split = len(order) - int(CALIBRATION * len(order))
    index = {lang: i for i, lang in enumerate(languages)}
    rows = []
    for i in order:
        grams = np.concatenate(ngram_buckets(texts[i]) or [np.zeros(0, np.int64)])
        ids, counts = np.unique(grams, return_counts=True)
        rows.append((ids, counts / max(1, counts.sum()), index[langs[i]]))
    embedding = rng.normal(0, 0.1, (1 << BUCKET_BITS, DIMENSIONS))
    layer, bias = np.zeros((DIMENSIONS, len(languages))), np.zeros(len(languages))
    share = np.bincount([r[2] for r in rows[:split]], minlength=len(languages)).astype(float)
    weight = share.sum() / np.maximum(share, 1) / len(languages)
    for epoch in range(epochs):
        rate = 2.0 * (1 - epoch / epochs)
        for i in rng.permutation(split):
            ids, w, y = rows[i]
            if not len(ids):
                continue
            x = w @ embedding[ids]
            z = x @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            p *= weight[y]
            # the step of an n-gram follows its share of the text
            embedding[ids] -= rate * np.outer(w, layer @ p) * 10
            layer -= rate * np.outer(x, p)
            bias -= 0.01 * rate * p
    model = Model(languages, (embedding @ layer).astype(np.float32), bias)
    held = rows[split:] or rows
    scores = np.array([w @ model.table[ids] + bias for ids, w, _ in held])
    truth = np.array([y for _, _, y in held])

    def loss(t: float) -> float:
        z = scores / t
        z = z - z.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), truth]))

    model.temperature = min(np.geomspace(0.5, 20, 60), key=loss)
    z = scores / model.temperature
    best = np.exp(z - z.max(axis=1, keepdims=True))
    best = (best / best.sum(axis=1, keepdims=True)).max(axis=1)
    model.threshold = min(0.5, float(np.quantile(best, REJECTED)))
    return model


def fit(docs: DataFrame, learn_from: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Train on a bounded sample of the rows that ``learn_from`` allows.

    The sample takes rows of each language by a hash of their id, of 1 to
    ``SAMPLE_CHARS`` characters each: about ``SAMPLE_ROWS``, fewer where there are many languages,
    so that they come to about ``ALL_ROWS``, but at least about ``LEAST_ROWS``.  No language is left out.
    """
    rows = docs.where(learn_from & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()) \
        .select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col), F.lit(11)).alias("h")) \
        .where(F.length("text").between(1, SAMPLE_CHARS))
    counts = rows.groupBy("lang").count().collect()
    if not counts:
        return train([], [])
    each = min(SAMPLE_ROWS, max(4 * SAMPLE_ROWS // len(counts), min(50, max(LEAST_ROWS, ALL_ROWS // len(counts)))))
    # one row per language
    share = docs.sparkSession.createDataFrame([(r[0], min(1.0, each / r[1])) for r in counts], "lang string, share double")
    rows = rows.join(share, "lang")
    sample = rows.where(F.pmod("h", F.lit(1 << 20)) < F.col("share") * (1 << 20)) \
        .orderBy("h", "text").limit(2 * each * len(counts)).select("text", "lang").collect()
    return train([r[0] for r in sample], [r[1] for r in sample])


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``rejected``.

    A text that is null or has no letter is ``und`` with score 0, and so is every
    text if nothing was learned; these are rejected.  Whole texts are read, however
    long; repeated rows are judged each, other columns stay as they are, and nothing is
    shuffled.
    """
    return _judged(docs, model, text_col).select(*unpacked(docs), "lang_pred", "score", "rejected")


def keep_known(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected, as they were; columns may have any names."""
    return _judged(docs, model, text_col).where("NOT rejected").select(*unpacked(docs))


def _judged(docs: DataFrame, model: Model, text_col: str) -> DataFrame:
    """Rows packed, with the results beside."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = sent.value
        for texts in batches:
            out = []
            for text in texts:
                if not text or not known.languages:
                    out.append((NO_LANGUAGE, 0.0))
                    continue
                p = known.probabilities(text)
                best = int(p.argmax())
                out.append((known.languages[best], float(p[best])))
            yield pd.DataFrame(out, columns=["lang", "score"])

    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    found = run(F.when(letters, F.col(text_col)))
    rejected = (F.col("_found.lang") == NO_LANGUAGE) | (F.col("_found.score") < F.lit(model.threshold))
    return docs.select(packed(docs), found.alias("_found")).select(
        "_all", F.col("_found.lang").alias("lang_pred"), F.col("_found.score").alias("score"), rejected.alias("rejected"))
