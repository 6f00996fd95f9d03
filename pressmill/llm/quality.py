"""Quality rules as learned decision lists (operator 13).

A document is described by counts over its whole text and by their ratios.  Sequential
covering learns an ordered list of rules that name bad documents: a rule is *grown*,
one threshold at a time, where it gains most on the growing part of the labelled rows;
*pruned* to the beginning that does best on the other part; and kept if that part
bears it out.  The rows it covers then go, and the next rule is sought among the rest.
The statistics of every step are one Spark aggregate over all labelled rows: how many
good and bad ones fall between the cut points of every measure, which is a table of
bounded size.  The list becomes one ``CASE`` expression, tried in order.

A null text has no words.  Ids may repeat; each row is judged by itself, and of several
labels of an id the lowest counts, null labels none.  Texts may be of any length.
Other columns are not touched and may have any names.  Empty tables give no rows;
without labels of both kinds there are no rules and all that passes the base is kept.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pressmill.llm.common import crc_mod
from pressmill.session import write_between

# What the base rejects.
LEAST_WORDS, MOST_REPEATED = 20, 30
REPEAT_WORDS = 8
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\v\f\r"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_distinct", "n_upper", "n_digits", "n_marks", "n_ended_lines"]
CUTS = 64
# a third of the labelled rows prunes what the others grew
PRUNING_PARTS = 3
MOST_RULES, MOST_CONDITIONS = 12, 4
# bad among the pruning rows that a rule covers, at least, and how many it must cover
PRECISION, LEAST_COVERED = 0.9, 5


def _without(raw: bytes, chars: bytes) -> int:
    return len(raw) - len(raw.translate(None, chars))


def repeated_words(words: list[bytes], width: int = REPEAT_WORDS) -> int:
    """Words in windows of ``width`` words that are found twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    names = {w: i for i, w in enumerate(dict.fromkeys(words))}
    if len(names) == len(words):
        return 0
    codes = np.fromiter(map(names.__getitem__, words), np.int64, len(words))
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    hashes = np.zeros(n, np.uint64)
    for j in range(width):
        hashes = hashes * np.uint64(0xBF58476D1CE4E5B9) + mixed[j: j + n]
    ordered = np.sort(hashes)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    # equal hashes are only a hint: these windows are compared word by word
    starts = np.flatnonzero(np.isin(hashes, twice))
    windows = codes[starts[:, None] + np.arange(width)]
    order = np.lexsort(windows.T)
    same = (windows[order][1:] == windows[order][:-1]).all(axis=1)
    found = np.zeros(len(starts), bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    steps = np.zeros(len(words) + 1, np.int64)
    steps[starts[found]] += 1
    steps[starts[found] + width] -= 1
    return int(np.count_nonzero(np.cumsum(steps)))


def text_counts(raw: bytes | None) -> tuple[int, ...]:
    """The numbers of ``COUNTS`` for the UTF-8 of a whole text."""
    raw = raw or b""
    words = raw.split()
    packed = np.frombuffer(raw.translate(None, BLANKS), np.uint8)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (
        len(words), int(np.count_nonzero(packed & 0xC0 != 0x80)), _without(raw, SYMBOLS), len(lines) - len(set(lines)),
        repeated_words(words), len(lines), len(set(words)), _without(raw, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        _without(raw, b"0123456789"), _without(raw, b"!?"), sum(line.rstrip()[-1:] in (b".", b"!", b"?") for line in lines))


def counted(text: Column) -> Column:
    """Struct of ``COUNTS`` for a text column."""
    @F.arrow_udf(", ".join(f"{c} long" for c in COUNTS))
    def run(texts: pa.Array) -> pa.Array:
        rows = [text_counts(t) for t in texts.cast(pa.binary()).to_pylist()]
        columns = np.array(rows, np.int64).reshape(-1, len(COUNTS)).T
        return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], COUNTS)

    return run(text)


def _share(part: str, whole: str) -> str:
    return f"coalesce(try_divide(CAST(counts.{part} AS double), CAST(counts.{whole} AS double)), 0.0D)"


# What rules may look at, as SQL over the struct of counts.
MEASURES = {
    "words": "CAST(counts.n_words AS double)", "chars_per_word": _share("word_chars", "n_words"),
    "symbols_per_word": _share("n_symbols", "n_words"), "repeated_lines": _share("n_dup_lines", "n_lines"),
    "repeated_words": _share("n_repeat_words", "n_words"), "words_per_line": _share("n_words", "n_lines"),
    "distinct_words": _share("n_distinct", "n_words"), "upper_letters": _share("n_upper", "word_chars"),
    "digits": _share("n_digits", "word_chars"), "marks_per_word": _share("n_marks", "n_words"),
    "ended_lines": _share("n_ended_lines", "n_lines"),
}

BASE_FAILED = f"(counts.n_words < {LEAST_WORDS} OR 100 * counts.n_repeat_words > {MOST_REPEATED} * counts.n_words)"


@dataclass(frozen=True)
class Condition:
    """``measure >= cut`` or, ``below``, ``measure < cut``."""

    measure: str
    below: bool
    cut: float

    def sql(self) -> str:
        return f"measures.{self.measure} {'<' if self.below else '>='} {self.cut!r}D"


Rule = tuple[Condition, ...]


def rule_sql(rule: Rule) -> str:
    return " AND ".join(c.sql() for c in rule) or "true"


def list_sql(rules: list[Rule]) -> str:
    """Number, from 1, of the first rule that holds; null if none does."""
    cases = " ".join(f"WHEN {rule_sql(rule)} THEN {number}" for number, rule in enumerate(rules, 1))
    return f"CASE {cases} END" if rules else "CAST(NULL AS int)"


def _cut_points(rows: DataFrame, cuts: int) -> dict[str, list[float]]:
    """Values that part a measure into shares of about equal size, each once."""
    shares = [k / cuts for k in range(1, cuts)]
    found = rows.select("measures.*").approxQuantile(list(MEASURES), shares, 1 / (4 * cuts))
    return {name: sorted(set(points)) for name, points in zip(MEASURES, found)}


def _bins_sql(cuts: dict[str, list[float]]) -> str:
    """How many cut points each measure reaches."""
    points = lambda name: f"array({', '.join(f'{c!r}D' for c in cuts[name])})"
    return f"array({', '.join(f'size(filter({points(name)}, c -> c <= measures.{name}))' for name in cuts)})"


def _gain(bad: np.ndarray, good: np.ndarray, all_bad: float, all_good: float) -> np.ndarray:
    """What a condition adds: bits saved per bad row that stays, times such rows."""
    before = math.log2((all_bad + 1) / (all_bad + all_good + 2))
    return bad * (np.log2((bad + 1) / (bad + good + 2)) - before)


def _grow(rows: DataFrame, cuts: dict[str, list[float]], most: int) -> Rule:
    rule: Rule = ()
    while len(rule) < most:
        table = rows.where(rule_sql(rule)).select("bad", F.posexplode("bins").alias("m", "bin")).groupBy("m", "bin").agg(
            F.count_if("bad").alias("bad"), F.count("*").alias("n")).collect()
        best, chosen = 0.0, None
        for m, (name, points) in enumerate(cuts.items()):
            counts = np.zeros((2, len(points) + 1))
            for r in table:
                if r["m"] == m:
                    counts[:, r["bin"]] = r["bad"], r["n"] - r["bad"]
            all_bad, all_good = counts.sum(axis=1)
            under = np.cumsum(counts, axis=1)[:, :-1]
            for below, (bad, good) in ((True, under), (False, counts.sum(axis=1, keepdims=True) - under)):
                gains = _gain(bad, good, all_bad, all_good)
                if len(gains) and gains.max() > best + 1e-9:
                    best, chosen = gains.max(), Condition(name, below, points[int(gains.argmax())])
        if chosen is None:
            break
        rule = (*rule, chosen)
    return rule


def _prune(rows: DataFrame, rule: Rule) -> tuple[Rule, int, int]:
    """The beginning of a rule with the best balance of bad over good, and how many of each it covers."""
    begins = [rule[:k] for k in range(1, len(rule) + 1)]
    found = rows.selectExpr(*[
        f"count_if({rule_sql(part)} AND {kind})" for part in begins for kind in ("bad", "NOT bad")]).first()
    pairs = [(found[2 * k], found[2 * k + 1]) for k in range(len(rule))]
    best = max(range(len(rule)), key=lambda k: ((pairs[k][0] - pairs[k][1]) / (sum(pairs[k]) + 1), -k))
    return begins[best], *pairs[best]


def describe_texts(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, counts, measures)`` of whole texts, written once."""
    found = docs.select(F.col(id_col).alias("id"), counted(F.col(text)).alias("counts"))
    measures = ", ".join(f"'{name}', {sql}" for name, sql in MEASURES.items())
    return write_between(found.selectExpr("id", "counts", f"named_struct({measures}) AS measures"))


def fit(described: DataFrame, labels: DataFrame, id_col: str = "doc_id", label: str = "quality",
        learn: Column | None = None, cuts: int = CUTS, most_rules: int = MOST_RULES, most_conditions: int = MOST_CONDITIONS,
        precision: float = PRECISION, least_covered: int = LEAST_COVERED) -> list[Rule]:
    """Rules that name the rows labelled 0 among those the base lets through.

    ``learn`` says of a row of ``labels`` whether it may be used.
    """
    known = labels.where(learn) if learn is not None else labels
    known = known.groupBy(F.col(id_col).alias("id")).agg((F.min(label) == 0).alias("bad")).where("bad IS NOT NULL")
    rows = write_between(described.where(f"NOT {BASE_FAILED}").join(known, "id").select(
        "bad", (crc_mod("id", PRUNING_PARTS) == 0).alias("pruning"), "measures"))
    if not min(rows.selectExpr("count_if(bad)", "count_if(NOT bad)").first()):
        return []
    points = _cut_points(rows, cuts)
    rows = write_between(rows.selectExpr("*", f"{_bins_sql(points)} AS bins"))
    rules: list[Rule] = []
    while len(rules) < most_rules:
        left = rows.where(f"{list_sql(rules)} IS NULL")
        rule = _grow(left.where("NOT pruning"), points, most_conditions)
        if not rule:
            break
        rule, bad, good = _prune(left.where("pruning"), rule)
        if bad + good < least_covered or bad < precision * (bad + good):
            break
        rules.append(rule)
    return rules


def judge(described: DataFrame, rules: list[Rule]) -> DataFrame:
    """``described`` with ``base_failed``, ``rule`` (the first that holds, from 1) and ``kept``."""
    return described.selectExpr("*", f"{BASE_FAILED} AS base_failed", f"{list_sql(rules)} AS rule") \
        .selectExpr("*", "NOT base_failed AND rule IS NULL AS kept")
