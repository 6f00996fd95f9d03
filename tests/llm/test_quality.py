"""Operator 13: counts against brute force, rules against planted ones and held-out labels."""

import collections
import re

import numpy as np
from pyspark.sql import functions as F

from pressmill.llm import quality
from pressmill.llm.common import crc_mod
from tests.llm.conftest import SF


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = collections.defaultdict(list)
    for s in range(len(words) - 7):
        windows[tuple(words[s: s + 8])].append(s)
    covered = {s + k for starts in windows.values() if len(starts) > 1 for s in starts for k in range(8)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_counts(spark, docs, documents):
    odd = ["a b c d e f g h " * 3, "a " * 9, "a " * 8, "x\n\nx\n \nx ", "é ñ \x1cz " * 30, "|<>\n" * 40, "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8"]
    texts = spark.createDataFrame([(i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    for df, want in ((docs, [(r[0], r[1]) for r in documents]), (texts, list(enumerate(odd)))):
        rows = quality.describe_texts(df).collect()
        got = collections.Counter((r["id"], *r["counts"][:5]) for r in rows)
        assert got == collections.Counter((key, *brute(text)) for key, text in want)


def test_equal_hashes_are_compared(monkeypatch):
    words = [str(i % 50).encode() for i in range(49)] + [b"0"] * 3
    assert quality.repeated_words(words) == 0
    monkeypatch.setattr(quality.np, "isin", lambda a, b: np.ones(len(a), bool))
    assert quality.repeated_words([*words, *words[:8]]) == 16


def test_query(spark):
    from pressmill.llm.queries import op13_quality_rules

    rows = op13_quality_rules(spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        words, *_, repeated = found = brute(texts[r["doc_id"]])
        assert tuple(r)[1:6] == found
        assert r["base_failed"] == (words < 20 or 100 * repeated > 30 * words)
        assert r["kept"] == (not r["base_failed"] and r["rule"] is None)


def planted(spark, n=6000):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(n):
        words = int(rng.integers(30, 200))
        symbols, upper = int(words * rng.random()), float(rng.random())
        bad = symbols / words >= 0.7 or (upper >= 0.6 and words < 90)
        counts = dict.fromkeys(quality.COUNTS, 0) | {
            "n_words": words, "n_symbols": symbols, "word_chars": 1000, "n_upper": int(1000 * upper), "n_lines": 5, "n_distinct": words}
        rows.append((i, tuple(counts.values()), int(not bad)))
    schema = "id long, counts struct<" + ", ".join(f"{c}: long" for c in quality.COUNTS) + ">, quality int"
    df = spark.createDataFrame(rows, schema)
    measures = ", ".join(f"'{name}', {sql}" for name, sql in quality.MEASURES.items())
    return df.selectExpr("id", "counts", f"named_struct({measures}) AS measures", "quality")


def test_planted_rules_are_found(spark):
    rows = planted(spark).cache()
    labels = rows.select(F.col("id").alias("doc_id"), "quality")
    rules = quality.fit(rows, labels, learn=crc_mod("doc_id", 4) != 0)
    text = " ".join(map(quality.rule_sql, rules))
    assert "measures.symbols_per_word >= 0." in text and "measures.upper_letters >= 0." in text and "measures.words < " in text
    judged = quality.judge(rows, rules).where(crc_mod("id", 4) == 0)
    right = judged.select(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("double"))).first()[0]
    assert right > 0.97
    # the first rule that holds is named
    held = judged.where("rule IS NOT NULL").collect()
    assert {r["rule"] for r in held} <= set(range(1, len(rules) + 1)) and len({r["rule"] for r in held}) > 1


def test_pruning_cuts_what_the_other_part_does_not_bear_out(spark):
    rows = planted(spark).withColumn("bad", F.col("quality") == 0).cache()
    first = quality.Condition("symbols_per_word", False, 0.7)
    chance = quality.Condition("words", False, 150.0)
    assert quality._prune(rows, (first, chance))[0] == (first,)


def test_nothing_to_learn(spark, docs, no_docs):
    described = quality.describe_texts(docs)
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    assert quality.fit(described, labels) == []
    assert quality.fit(described, labels.where("false")) == []
    assert quality.fit(described, labels.select("doc_id", F.lit(None).cast("int").alias("quality"))) == []
    rows = quality.judge(described, []).collect()
    assert len(rows) == docs.count() and all(r["kept"] == (not r["base_failed"]) and r["rule"] is None for r in rows)
    empty = quality.describe_texts(no_docs)
    assert quality.judge(empty, quality.fit(empty, labels)).count() == 0


def test_labels_of_one_id_and_repeated_rows(spark):
    rows = planted(spark, 600)
    labels = rows.select(F.col("id").alias("doc_id"), "quality")
    doubled = labels.unionByName(labels).unionByName(labels.withColumn("quality", F.lit(None).cast("int")))
    assert quality.fit(rows, doubled) == quality.fit(rows, labels)
