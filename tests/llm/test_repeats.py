"""Operators 1 and 3 against brute force."""

import hashlib
import random

import numpy as np
import pytest

from pressmill.llm import runs as R, substring, suffix


def by_bytes(rows, length):
    seen, out = {}, []
    for key, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        data = (text or "").encode()
        for k in range(len(data) - length + 1):
            seen.setdefault(data[k: k + length], key)
    for key, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - length + 1 if key is not None else 0):
            if seen[data[k: k + length]] < key:
                gone[k: k + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((key, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def by_words(rows, window):
    seen, out = {}, []
    for key, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        words = (text or "").encode().split()
        for k in range(len(words) - window + 1):
            seen.setdefault(tuple(words[k: k + window]), key)
    for key, text in rows:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for k in range(len(words) - window + 1 if key is not None else 0):
            if seen[tuple(words[k: k + window])] < key:
                gone[k: k + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((key, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def same(found, want):
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, found), key=key) == sorted(want, key=key)


def tricky(seed):
    """Texts of few letters and words, so that repeats of all lengths and periods occur."""
    rng = random.Random(seed)
    parts = ["".join(rng.choices("ab", k=rng.randint(1, 90))) for _ in range(12)]
    parts += [" ".join(rng.choices(["x", "y", "zz"], k=rng.randint(1, 30))) for _ in range(12)]
    parts += ["q " * 40, "ab" * 60, "\0" * 70, "é" * 40]
    return [(i // 2 if i % 7 else i, rng.choice(["", " "]).join(rng.choices(parts, k=rng.randint(0, 6)))) for i in range(120)]


def test_suffixes(spark, docs, documents, no_docs):
    found = suffix.remove_repeats(docs, run_bytes=100_000).collect()
    same(found, by_bytes([r[:2] for r in documents], 50))
    assert suffix.remove_repeats(no_docs).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_tricky_bytes(spark, seed):
    rows = tricky(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    same(suffix.remove_repeats(df, run_bytes=2_000).collect(), by_bytes(rows, 50))


def test_words(spark, docs, documents, no_docs):
    found = substring.remove_repeats(docs, run_bytes=100_000).collect()
    same(found, by_words([r[:2] for r in documents], 13))
    assert substring.remove_repeats(no_docs).count() == 0


def test_repeats_are_found_by_the_rounds_alone(spark):
    # without naming there are no symbols, so nothing is revealed; later rounds only make keys rarer
    shared = " ".join(f"w{i}" for i in range(30))
    rows = [(1, shared), (2, f"a b {shared} c"), (3, "z " * 40), (4, "z " * 50), (5, "u v " * 30), (6, "v u " * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = by_words(rows, 13)
    removed = lambda found: {r["doc_id"]: r["n_removed"] for r in found.collect()}
    assert sum(removed(substring.remove_repeats(df, rounds=0)).values()) == 0
    for rounds in (1, 2, None):
        same(substring.remove_repeats(df, rounds=rounds).collect(), want)
    assert sum(w[2] for w in want) > 60


def brute_symbols(words, window, rounds):
    """Keys of windows recompressed each by itself, from interior symbols of the whole."""
    names = np.array(words, np.uint64)
    return substring.symbol_keys(R.mix(names), np.zeros(len(names), np.int32), window, rounds)


@pytest.mark.parametrize("letters, window", [(2, 13), (3, 13), (8, 13), (2, 5), (30, 20)])
def test_equal_windows_have_equal_keys(letters, window):
    rng = random.Random(letters * window)
    seen = {}
    for _ in range(60):
        words = rng.choices(range(letters), k=rng.randint(1, 120))
        if rng.random() < .3:
            words = (words[:3] * 60)[:90]
        keys = brute_symbols(words, window, None)
        for s in range(len(words) - window + 1):
            assert keys[s] != ~np.uint64(0)
            assert seen.setdefault(tuple(words[s: s + window]), keys[s]) == keys[s]
    assert len(set(seen.values())) > len(seen) / 40


def test_higher_rounds_cover_more_words():
    rng = np.random.default_rng(2)
    names, doc = R.mix(rng.integers(0, 5000, 20_000).astype(np.uint64)), np.zeros(20_000, np.int32)
    covered = lambda rounds: float((255 - (substring.symbol_keys(names, doc, 13, rounds)[:-12] >> np.uint64(56))).mean())
    one, two = covered(1), covered(2)
    assert 4 < one < two <= covered(None) <= 13


def test_parts_of_the_key_space_are_even():
    rng = np.random.default_rng(3)
    names, doc = R.mix(rng.integers(0, 3000, 100_000).astype(np.uint64)), np.arange(100_000, dtype=np.int32) // 300
    _, keys = substring.window_places(names, doc, 13)
    texts = [bytes(rng.integers(97, 110, 500, dtype=np.uint8)) for _ in range(200)]
    *_, places = suffix._stretches(texts, 50, 24)
    for found in (keys, places):
        sizes = np.bincount((np.unique(found) >> np.uint64(64 - 6)).astype(int), minlength=64)
        assert sizes.max() < 2 * sizes.mean()


@pytest.mark.parametrize("seed", [3, 4])
def test_tricky_words(spark, seed):
    rows = tricky(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    same(substring.remove_repeats(df, run_bytes=2_000).collect(), by_words(rows, 13))


def test_kept_text(spark):
    shared = " ".join(f"w{i}" for i in range(20))
    df = spark.createDataFrame([(1, shared), (2, f"mine {shared} end")], "doc_id long, text string")
    assert {r["doc_id"]: r["kept"] for r in substring.remove_repeats(df, keep_text=True).collect()} == {1: shared, 2: "mine end"}
    assert {r["doc_id"]: bytes(r["kept"]) for r in suffix.remove_repeats(df, keep_bytes=True).collect()} == {
        1: shared.encode(), 2: b"mine  end"}


def test_loser_tree():
    rng = random.Random(5)
    runs = [sorted(bytes(rng.choices(b"ab", k=rng.randint(0, 9))) for _ in range(rng.randint(0, 40))) for _ in range(5)]

    def common(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    shares = [[common(a, b) for a, b in zip([b""] + r, r)] for r in runs]
    order, shared = suffix.merge([list(r) for r in runs], shares)
    at = [0] * 5
    out = []
    for k in order:
        out.append(runs[k][at[k]])
        at[k] += 1
    assert out == sorted(x for r in runs for x in r)
    assert shared[1:] == [common(a, b) for a, b in zip(out, out[1:])]


def test_removal_takes_the_second_answers_only(spark):
    """Keys are found for the two exchanges; the removal is told which windows are shared."""
    rows = [(i, " ".join(f"w{(i % 3) * 5 + k}" for k in range(20))) for i in range(9)] + [(9, ""), (None, "w0 w1"), (10, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = substring.remove_repeats(df, run_bytes=200)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # no window was asked for by its key a third time
    assert "Union" not in plan and plan.count("FlatMapCoGroupsInArrow") == 2
    same(found.where("doc_id IS NOT NULL").collect(), by_words([r for r in rows if r[0] is not None], 13))
