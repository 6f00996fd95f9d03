"""Every stage of the pipeline, on what the last one kept, against brute force."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np

import pytest

import corpus_pipeline
from pressmill.llm import langid, merkle, mixing, packing, phrases, pii, quality, simhash, substring, suffix
from pressmill.llm.common import learned
from tests.llm.conftest import CLASHING, SF
from tests.llm.test_documents import PATTERNS, slow_components, slow_print, valid


def redacted(text):
    spans = sorted((m.start(), i, m.end(), k.upper()) for i, (k, p) in enumerate(PATTERNS.items())
                   for m in re.finditer(p, text) if valid(k, m[0]))
    out, at = [], 0
    for start, _, end, kind in spans:
        if start < at:
            at = max(at, end)
            continue
        out += [text[at:start], f"[{kind}]"]
        at = end
    return "".join(out) + text[at:]


def copies(doc, rate):
    u = int(hashlib.md5(f"{mixing.SEED}|{doc}".encode()).hexdigest()[:13], 16) / 2**52
    n, p = 0, math.exp(-rate)
    c = p
    while c <= u:
        n += 1
        p *= rate / n
        c += p
    return n


def test_stages(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, stages = docs.columns, [f for _, f in corpus_pipeline.STAGES]
    model = langid.fit(docs, learned("doc_id", 5))
    rows = {r["doc_id"]: r for r in docs.collect()}
    sure = lambda t: re.search(r"[^\W\d_]", t or "") and model.probabilities(t).max() >= model.threshold

    now = stages[0](spark, docs, SF)
    kept = sorted(i for i, r in rows.items() if sure(r["text"]))
    assert now.columns == columns and sorted(r["doc_id"] for r in now.collect()) == kept

    now = stages[1](spark, now, SF)
    roots = slow_components([slow_print(rows[i]["text"]) for i in kept], 4)
    kept = sorted({r: i for i, r in reversed(list(zip(kept, roots)))}.values())
    assert now.columns == columns and sorted(r["doc_id"] for r in now.collect()) == kept

    now = stages[2](spark, now, SF)
    texts = {i: redacted(rows[i]["text"]) for i in kept}
    assert now.columns == columns and {r["doc_id"]: r["text"] for r in now.collect()} == texts

    now = stages[3](spark, now, SF)
    sizes = collections.Counter(rows[i]["source"] for i in kept)
    total = sum(math.sqrt(n) for n in sizes.values())
    times = {i: copies(i, math.sqrt(sizes[s]) / total * len(kept) / sizes[s]) for i in kept for s in [rows[i]["source"]]}
    assert now.columns == columns
    assert collections.Counter(r["doc_id"] for r in now.collect()) == +collections.Counter(times)

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    want = collections.Counter()
    for i in kept:
        ids = tokenizer.encode(texts[i], add_special_tokens=False).ids + [1]
        for number, (start, length) in enumerate(packing.cut(len(ids), 4096)):
            part = np.array(ids[start: start + length], dtype="<u4").tobytes()
            want[i, number, start, length, zlib.crc32(part)] += times[i]
    packed = corpus_pipeline.run(spark, SF)
    found = packed.collect()
    assert collections.Counter(tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in found) == +want
    fill = collections.Counter()
    for r in found:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 4096 and len(fill) <= 1.03 * math.ceil(sum(fill.values()) / 4096) + 1


def test_stages_keep_columns_of_any_names(spark, clashing, documents):
    """Null, empty, wordless, very long and repeated rows, with columns named like the operators' own."""
    seen = clashing
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, seen = seen, stage(spark, seen, SF)
        assert seen.columns == clashing.columns, name
        rows = seen.collect()
        assert rows and all(r[c] == f"{c}-{r['doc_id']}" for r in rows for c in CLASHING), name
        if name in ("simhash_near_dedup", "language_id"):
            texts = {(r["doc_id"], r["text"]) for r in before.collect()}
            assert {(r["doc_id"], r["text"]) for r in rows} <= texts
        seen = spark.createDataFrame(rows, clashing.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, seen, SF).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in seen.collect()}


@pytest.mark.parametrize("run", [
    lambda d: langid.identify(d, langid.fit(d, learned("doc_id", 5))).select("doc_id"), simhash.near_duplicates,
    lambda d: pii.find(d.drop("_spans"), pii.fit(d)), lambda d: mixing.poisson_copies(d.drop("_copy", "_order")),
    packing.pack_documents, suffix.remove_repeats, substring.remove_repeats, merkle.manifest, quality.describe_texts,
    lambda d: phrases.collocations(d, min_count=5)],
    ids=["langid", "simhash", "pii", "mixing", "packing", "suffix", "substring", "merkle", "quality", "phrases"])
def test_operators_take_columns_of_any_names(spark, clashing, run):
    plain = clashing.select("doc_id", "text", "lang", "source", "n_chars")
    assert run(clashing).count() == run(plain).count() > 0


def test_stages_on_empty_tables(spark, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, SF).count() == 0, name
