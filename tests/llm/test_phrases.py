"""Operator 11 against brute force."""

import collections
import re

import numpy as np
import pytest

from pressmill.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def wanted(rows, min_count, longest, top):
    counts, totals = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                for s in range(len(words) - k + 1):
                    counts[lang, tuple(words[s: s + k])] += 1
    often = {key: f for key, f in counts.items() if f >= min_count}
    inside = collections.defaultdict(int)
    for (lang, words), f in often.items():
        for k in range(2, len(words)):
            for s in range(len(words) - k + 1):
                part = lang, words[s: s + k]
                inside[part] = max(inside[part], f)
    found = collections.defaultdict(list)
    for (lang, words), a in often.items():
        if len(words) < 2 or inside[lang, words] >= a:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        found[lang].append((-score, -a, " ".join(words).encode(), left, right))
    out = set()
    for lang, items in found.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(items)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return out


def got(df, **options):
    rows = phrases.collocations(df, **options).collect()
    found = {tuple(r) for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("most_bits", [1 << 28, 128])
def test_documents(docs, documents, no_docs, most_bits):
    rows = [(r[1], r[2]) for r in documents]
    want = wanted(rows, 5, 5, 50)
    assert max(len(w[2].split()) for w in want) >= 4 and len({w[0] for w in want}) >= 4
    assert got(docs, min_count=5, top=50, most_bits=most_bits) == want
    assert got(docs, min_count=5, top=50, longest=2, most_bits=most_bits) == wanted(rows, 5, 2, 50)
    assert got(no_docs) == set()


def test_ties_breaks_and_odd_words(spark, monkeypatch):
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 200)
    rng = np.random.default_rng(3)
    words = ["a", "b", "A", "ä", "Ä", "é é", "x" * 3000, " ", "&", "\x00", "a\x1cb"]
    breaks = [" ", "  ", "\t", ". ", "\n", ";", "\x0b", " ? "]
    rows = []
    for i in range(120):
        text = "".join(words[w] + breaks[b] for w, b in zip(rng.integers(0, len(words), 30), rng.choice(len(breaks), 30, p=[.6, .1, .1, .05, .05, .04, .03, .03])))
        rows.append((text, [None, "und", "en", ""][i % 4]))
    rows += [(None, "en"), ("", "fr"), (" . ,", "de")] + [rows[0]] * 5
    df = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    assert got(df, min_count=2, top=40) == wanted(rows, 2, 5, 40)
    assert got(df, min_count=100_000) == set()


def test_products_over_64_bits(spark, monkeypatch):
    # counts as large as those of 10 ** 13 words
    scale = 10 ** 12
    counts = spark.createDataFrame(
        [("en", [], 10 * scale), ("en", ["a"], 3 * scale), ("en", ["b"], 4 * scale + 1), ("en", ["a", "b"], 2 * scale)],
        "lang string, words array<string>, f long")
    monkeypatch.setattr(phrases, "phrase_counts", lambda *args: counts)
    found = phrases.collocations(counts).collect()
    assert [tuple(r)[2:] for r in found] == [
        ("a b", 2 * scale, 3 * scale, 4 * scale + 1, 10 * scale, 1000 * 2 * scale * 10 * scale // (3 * scale * (4 * scale + 1)))]
