"""Personal data by weak supervision (operator 9), in DataFrame operations alone.

Candidates are spans of four kinds.  Those of the strict patterns are certain and
stay.  Looser patterns give further candidates; regular expression, gazetteer,
context and shape labelers vote on all of them, expectation-maximisation over the
counted vote patterns estimates how reliable each labeler is, and the posterior
trains a logistic span classifier on votes and features, which decides about the
looser candidates.  Votes and features have few values, so the counts that are
collected are a table of bounded size however many texts there are.
"""

from __future__ import annotations

import math
from collections import defaultdict
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from pressmill.llm.common import packed, unpacked

KINDS = ("email", "ip", "card", "phone")

# Patterns of the contract.  A look-behind keeps a failed start from being tried
# again inside the same run of characters, and possessive repeats keep Java from
# recursing on long runs; neither changes a match.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Strict matches other than of email, and looser ones of card and phone, lie inside
# one maximal run of these characters and look at no other one; such runs of some
# length with a digit are found once and the patterns are tried on them alone.
CHUNK = r"(?<![0-9\x20().+-])(?=[0-9\x20().+-]{7})[\x20().+-]*+[0-9][0-9\x20().+-]*+"

# Looser candidates.  Most are doubtful: spelled-out addresses and words that read like
# them; spelled-out and four-part numbers that no address can have; grouped, dotted and
# long numbers, with or without a right check digit; numbers in groups of any country.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?: ?(?:\(at\)|\[at\]|\(AT\)|\[AT\]) ?[A-Za-z0-9-]++"
             r"(?: ?(?:\(dot\)|\[dot\]|\(DOT\)|\[DOT\]|(?<= )dot(?= )) ?[A-Za-z0-9-]++|\.[A-Za-z0-9-]++)++"
             r"| at [A-Za-z0-9-]++(?: dot [A-Za-z0-9-]++)++| AT [A-Za-z0-9-]++(?: DOT [A-Za-z0-9-]++)++)",
    "ip": r"(?<![0-9.\])])[0-9]{1,3}(?:(?:\[\.\]|\(\.\))[0-9]{1,3}){3}(?![0-9\[(])",
    "card": r"(?<![0-9.+-])(?:[0-9]{13,19}|[0-9]{4}(?:([\x20-])[0-9]{4}\1[0-9]{4}\1|\.[0-9]{4}\.[0-9]{4}\.)[0-9]{4})(?![0-9-])",
    "phone": r"(?<![0-9+().-])(?<![+(] )(?:\([0-9]{2,5}\) ?|00[0-9]{1,3}[\x20-][0-9]{2,4}[\x20-]|[0-9]{3}[-.\x20])[0-9]{3,4}[-.\x20][0-9]{3,4}(?![0-9-])",
}

# Gazetteers, fixed values: ends of host names, mailboxes by role, and first names.
HOST_ENDS = """com org net edu gov mil int info biz io co ai app dev eu de fr es uk it nl be ch at pl pt se no dk fi
    cz ie us ca mx br ar cl au nz jp cn kr in ru tr gr ro hu""".split()
ROLES = "info contact support sales office admin help press editor news hello mail service team jobs billing webmaster".split()
FIRST_NAMES = """james john robert michael william david richard joseph thomas charles mary patricia jennifer linda
    elizabeth barbara susan jessica sarah karen peter paul mark george anna maria emma laura julia jane joe alice bob carol
    dave eve hans karl klaus petra sabine ursula wolfgang juergen stefan andreas monika claudia jean pierre michel marie
    jacques nathalie sophie claire francois jose juan antonio manuel carmen ana pilar dolores isabel luis carlos jorge
    pedro miguel rosa lucia elena pablo sofia diego""".split()
# what such numbers commonly begin with: networks in use, issuers, calling codes and area codes
GAZETTEER = {
    "email": r"(?i)(?:\.|dot[\])]? ?)(?:" + "|".join(HOST_ENDS) + r")$",
    "ip": r"^(?!0|127\.|2[4-5][0-9])",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)",
    "phone": r"^(?:(?:\+|00)(?:1|2[0-9]|3[0-9]|4[0-9]|5[0-9]|6[0-6]|7|8[1246]|9[0-58])|\(?[2-9][0-9]{2}[).\x20-]|\(0[1-9])",
}
# words before a span that speak for it and, unless one of those is there, against it
CONTEXT = {
    "email": r"(?i)(?:e-?mail|mailto|contact|write|reach|kontakt|correo|courriel|adresse)[^\n]{0,24}$",
    "ip": r"(?i)(?:\bip\b|host|server|address|client|login|adresse|servidor)[^\n]{0,24}$",
    "card": r"(?i)(?:card|visa|master|amex|credit|payment|paid|karte|carte|tarjeta)[^\n]{0,24}$",
    "phone": r"(?i)(?:phone|\btel|call|fax|mobile|cell|handy|t[eé]l[eé]f|reach)[^\n]{0,24}$",
}
AGAINST = {
    "email": r"(?i)(?:meet|met|look(?:s|ed)?|arrived?|start(?:s|ed)?|stay(?:s|ed)?|was|were|is|sold|dinner|lunch)(?: [a-z]+)?\W*$",
    "ip": r"(?i)(?:version|release|build|firmware|section|chapter|\bv)\W{0,3}$",
    "card": r"(?i)(?:order|invoice|serial|tracking|isbn|part|batch|account|number|sku|ticket|code)[^\n]{0,16}$",
    "phone": r"(?i)(?:order|invoice|serial|tracking|isbn|part|batch|sku|ticket|code|pages?|lot|ref)[^\n]{0,16}$",
}
SHAPE = {
    "email": r"(?i)^(?:[^@]{2,64}@[^@]{4,}|[a-z0-9._%+-]{2,64} ?[\[(][^@]+[\])][^@]+|[a-z0-9]*[._0-9][a-z0-9._]* at .+)$",
    "ip": r"^(?:0|[1-9][0-9]*)(?:[\[(]?\.[\])]?(?:0|[1-9][0-9]*)){3}$",
    "card": r"^(?:[0-9]{13,16}|(?:[0-9]{4}[ .-]){3}[0-9]{4})$",
    "phone": r"^(?:\+|00|\(0?[1-9])|^[2-9][0-9]{2}([-.])[2-9][0-9]{2}\1[0-9]{4}$",
}
CONTEXT_CHARS = 40
ACCEPT = 0.9
LABELERS = ("regex", "gazetteer", "context", "shape", "name")
# a vote against a span counts at least this much against it, in log odds; a failed check
# as if true spans failed it one time in 45 as often as others, say by a slip
LEAST_AGAINST = {"regex": math.log(45), "gazetteer": 1.0, "context": 1.0, "shape": 1.0, "name": 1.0}
# votes for a span beyond those against it at which it is as likely true as not at first
START_VOTES = 1.5

Votes = tuple[int, ...]


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a right check digit."""
    n = F.length(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), n), F.lit(0),
        lambda s, i: s + F.element_at(
            F.array(*[F.lit(x) for x in (0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]),
            F.when((n - i) % 2 == 1, 10).otherwise(0) + F.substring(digits, i, F.lit(1)).cast("int") + 1))
    return total % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return match.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?:\.|$)){4}$")
    digits = F.regexp_replace(match, r"[^0-9]", "")
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


_NO_SPANS = "array<struct<start:long,end:long,match:string>>"


def _found(text: Column, pattern: str) -> Column:
    """All matches as ``(start, end, match)`` in code points, from the parts between them."""
    empty = F.array().cast(_NO_SPANS)

    def placed(matches: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))
        pairs = F.arrays_zip(matches.alias("m"), gaps.alias("g"))
        return F.aggregate(
            pairs, F.struct(F.lit(0).cast("long").alias("at"), empty.alias("out")),
            lambda s, p: F.struct(
                (s["at"] + F.length(p["g"]) + F.length(p["m"])).cast("long").alias("at"),
                F.concat(s["out"], F.array(F.struct(
                    (s["at"] + F.length(p["g"])).cast("long").alias("start"),
                    (s["at"] + F.length(p["g"]) + F.length(p["m"])).cast("long").alias("end"),
                    p["m"].alias("match")))).alias("out")))["out"]

    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                lambda m: F.when(F.size(m) > 0, placed(m)).otherwise(empty))


def _inside(chunks: Column, pattern: str) -> Column:
    """Matches inside the chunks of a text, with places in the text."""
    return F.flatten(F.transform(chunks, lambda c: F.transform(_found(c["match"], pattern), lambda m: F.struct(
        (c["start"] + m["start"]).alias("start"), (c["start"] + m["end"]).alias("end"), m["match"].alias("match")))))


def _vote(good: Column, bad: Column | None = None) -> Column:
    """1 for, 0 no opinion, -1 against."""
    vote = F.when(good, 1)
    return (vote.when(bad, -1) if bad is not None else vote).otherwise(0)


def _checked(kind: str, match: Column) -> Column:
    """Vote on a looser candidate by the check that a strict one of its kind passes; an address has none."""
    if kind == "email":
        return F.lit(0)
    plain = F.regexp_replace(match, r"[\[\]()]", "") if kind == "ip" else match
    return F.when(_valid(kind, plain), 0).otherwise(-1)


def _has_word(text: Column, words: list[str]) -> Column:
    """Whether one of the words is in a short text."""
    return F.arrays_overlap(F.split(F.lower(text), "[^a-z]+"), F.array(*[F.lit(w) for w in words]))


def _judged(kind: str, span: Column, text: Column, strict: bool) -> Column:
    """A candidate with its votes and features."""
    before = F.substring(text, F.greatest(F.lit(1), span["start"] + 1 - CONTEXT_CHARS).cast("int"),
                         F.least(F.lit(CONTEXT_CHARS).cast("long"), span["start"]).cast("int"))
    match = span["match"]
    size = F.least(F.lit(4), F.floor(F.length(match) / 8)).cast("int")
    return F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), span["start"].alias("start"), span["end"].alias("end"),
        F.lit(strict).alias("base"),
        (F.lit(1) if strict else _checked(kind, match)).alias("regex"),
        _vote(match.rlike(GAZETTEER[kind]), ~match.rlike(GAZETTEER[kind])).alias("gazetteer"),
        _vote(before.rlike(CONTEXT[kind]), before.rlike(AGAINST[kind])).alias("context"),
        _vote(match.rlike(SHAPE[kind]), ~match.rlike(SHAPE[kind])).alias("shape"),
        _vote(_has_word(match if kind == "email" else before, FIRST_NAMES + (ROLES if kind == "email" else []))).alias("name"),
        size.alias("size"))


def with_candidates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_candidates``; looser ones only where they touch no strict one of any kind."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))

    none = F.array().cast(_NO_SPANS)
    addresses = F.when(text.contains("@"), _found(text, STRICT["email"])).otherwise(none)
    # few texts have what every spelled-out span holds
    marks = {"email": ("(at)", "[at]", "(AT)", "[AT]", " dot ", " DOT "), "ip": ("[.]", "(.)")}
    spelled = {k: F.when(reduce(or_, [text.contains(m) for m in own]), _found(text, LOOSE[k])).otherwise(none)
               for k, own in marks.items()}

    def strict(kind: str, chunks: Column) -> Column:
        found = addresses if kind == "email" else _inside(chunks, STRICT[kind])
        return F.transform(F.filter(found, lambda s: _valid(kind, s["match"])), lambda s: _judged(kind, s, text, True))

    def loose(kind: str, chunks: Column) -> Column:
        found = spelled[kind] if kind in spelled else _inside(chunks, LOOSE[kind])
        return F.transform(found, lambda s: _judged(kind, s, text, False))

    def judged(chunks: Column) -> Column:
        def with_free(base: Column) -> Column:
            apart = F.filter(F.concat(*[loose(k, chunks) for k in LOOSE]), lambda s: ~F.exists(
                base, lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"])))
            return F.concat(base, apart)

        return _let(F.concat(*[strict(k, chunks) for k in KINDS]), with_free)

    return docs.withColumn("_candidates", _let(_found(text, CHUNK), judged))


def expectation_maximisation(counts: dict[Votes, float], base: set[Votes], rounds: int = 50) -> dict[Votes, float]:
    """Probability that a span with given votes is personal data.

    Each labeler's vote depends on the truth alone; its chances of every vote are
    estimated together with the share of true spans.  Votes of strict spans are
    known to be true.  A labeler is never worse than chance: a vote for a span does not
    count against it, and one against it counts at least ``LEAST_AGAINST``.
    """
    least = [LEAST_AGAINST[k] for k in LABELERS]

    def odds_of(k: int, x: int, true: float, false: float) -> float:
        found = math.log(true / false)
        return max(0.0, found) if x > 0 else min(-least[k], found) if x < 0 else found

    if not counts:
        return {}
    belief = {v: 1.0 if v in base else 1 / (1 + math.exp(-(sum(v) - START_VOTES))) for v in counts}
    for _ in range(rounds):
        chance = [[{x: 1.0 for x in (-1, 0, 1)} for _ in LABELERS] for _ in (0, 1)]
        share = 1.0
        total = 2.0 + sum(counts.values())
        for votes, n in counts.items():
            share += n * belief[votes]
            for k, x in enumerate(votes):
                chance[1][k][x] += n * belief[votes]
                chance[0][k][x] += n * (1 - belief[votes])
        for side in chance:
            for table in side:
                norm = sum(table.values())
                for x in table:
                    table[x] /= norm
        share /= total
        for votes in belief:
            if votes not in base:
                odds = math.log(share / (1 - share)) if 0 < share < 1 else 0.0
                odds += sum(odds_of(k, x, chance[1][k][x], chance[0][k][x]) for k, x in enumerate(votes))
                belief[votes] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return belief


def _features(kind: int, votes: Votes, size: int) -> list[tuple]:
    return [("bias",), ("kind", kind), ("size", kind, size), *[("vote", k, x) for k, x in enumerate(votes)]]


def train(rows: list[tuple[int, bool, Votes, int, int]], steps: int = 300) -> dict[tuple, float]:
    """Weights of the span classifier from (kind, base, votes, size, count)."""
    belief = {}
    for kind in range(len(KINDS)):
        counts, base = defaultdict(float), set()
        for k, strict, votes, _, n in rows:
            if k == kind:
                counts[votes] += n
                if strict:
                    base.add(votes)
        belief |= {(kind, v): p for v, p in expectation_maximisation(counts, base).items()}
    weights: dict[tuple, float] = defaultdict(float)
    total = sum(r[4] for r in rows) or 1
    for _ in range(steps):
        slope: dict[tuple, float] = defaultdict(float)
        for kind, _, votes, size, n in rows:
            names = _features(kind, votes, size)
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(weights[f] for f in names)))))
            for f in names:
                slope[f] += n * (p - belief[kind, votes]) / total
        for f, g in slope.items():
            weights[f] -= 1.0 * (g + 1e-4 * weights[f])
    return dict(weights)


def fit(docs: DataFrame, text_col: str = "text") -> dict[tuple, float]:
    """Weights from the candidates of all texts, counted by kind, votes and size."""
    counted = with_candidates(docs.select(F.col(f"`{text_col}`").alias("text"))).select(F.explode("_candidates").alias("c")) \
        .groupBy("c.kind", "c.base", *[f"c.{k}" for k in LABELERS], "c.size").count()
    return train([(r[0], r[1], tuple(r[2: 2 + len(LABELERS)]), r["size"], r["count"]) for r in counted.collect()])


def _score(span: Column, weights: dict[tuple, float]) -> Column:
    """Log odds of a candidate."""
    total = F.lit(weights.get(("bias",), 0.0))
    for kind in range(len(KINDS)):
        own = F.lit(weights.get(("kind", kind), 0.0))
        for size in range(5):
            own = own + F.when(span["size"] == size, weights.get(("size", kind, size), 0.0)).otherwise(0.0)
        total = total + F.when(span["kind"] == kind, own).otherwise(0.0)
    for k, name in enumerate(LABELERS):
        for x in (-1, 0, 1):
            total = total + F.when(span[name] == x, weights.get(("vote", k, x), 0.0)).otherwise(0.0)
    return total


def find(docs: DataFrame, weights: dict[tuple, float], text_col: str = "text") -> DataFrame:
    """``docs`` with ``_spans``: (start, kind number, end, base), in order of start and kind.

    A null text has no spans; texts may be of any length, and repeated rows are each
    searched.  Other columns may have any names.  Nothing is shuffled.
    """
    return _with_spans(docs, weights, text_col).select(*unpacked(docs), "_spans")


def _with_spans(docs: DataFrame, weights: dict[tuple, float], text_col: str) -> DataFrame:
    """Rows packed, with ``text`` and ``_spans``, so that columns may have any names."""
    odds = math.log(ACCEPT / (1 - ACCEPT))
    kept = F.filter("_candidates", lambda s: s["base"] | (_score(s, weights) >= odds))
    rows = docs.select(packed(docs), F.col(f"`{text_col}`").alias("text"))
    return with_candidates(rows, "text").withColumn("_spans", F.array_sort(F.transform(
        kept, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["base"].alias("base"))))) \
        .drop("_candidates")


def joined(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, weights: dict[tuple, float], text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; of spans that overlap, the first counts.

    Null texts stay null and texts without spans stay as they are.
    """
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    text = F.col("text")
    done = F.aggregate(
        "_spans", F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out")),
        lambda s, x: F.when(x["start"] < s["at"], F.struct(F.greatest(s["at"], x["end"]).alias("at"), s["out"].alias("out")))
        .otherwise(F.struct(x["end"].alias("at"), F.concat(s["out"], F.array(
            F.substring(text, (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int")),
            F.element_at(names, x["kind"] + 1))).alias("out"))))
    # the end of the last span written is where the rest begins
    marked = _with_spans(docs, weights, text_col).withColumn("_done", F.when(F.size("_spans") > 0, done))
    rest = F.substring(text, (F.col("_done.at") + 1).cast("int"), F.length(text))
    out = F.when(F.col("_done").isNull(), text).otherwise(F.concat(F.array_join("_done.out", ""), rest))
    return marked.select(*[out.alias(c) if c == text_col else own for c, own in zip(docs.columns, unpacked(docs))])
