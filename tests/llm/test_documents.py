"""Operators 2, 4, 5, 6, 8 and 9 against brute force, round trips or held-out accuracy."""

import collections
import hashlib
import math
import re
import sys
import zlib

import numpy as np
import xxhash
from pyspark.sql import functions as F

from pressmill.llm import langid, lm, mixing, packing, pii, runs as R, simhash
from pressmill.llm.common import held_out, learned


def fold(key, n):
    return zlib.crc32(str(key).encode()) % n


# -- language ------------------------------------------------------------------

def test_language(docs, no_docs):
    model = langid.fit(docs, learned("doc_id", 5))
    rows = langid.identify(docs, model).withColumn("held", held_out("doc_id", 5)).collect()
    judged = [r for r in rows if r["held"] and r["lang"] and r["text"] and re.search(r"[^\W\d_]", r["text"])]
    assert len(judged) > 20
    assert sum(r["lang"] == r["lang_pred"] for r in judged) / len(judged) > 0.95
    assert all(r["lang_pred"] == "und" and r["rejected"] for r in rows if not re.search(r"[^\W\d_]", r["text"] or ""))
    assert all(0 <= r[langid_score] <= 1 for r in rows for langid_score in [len(docs.columns) + 1])
    nothing = langid.fit(no_docs, learned("doc_id", 5))
    assert langid.identify(no_docs, nothing).count() == 0
    assert {r["lang_pred"] for r in langid.identify(docs, nothing).collect()} == {"und"}


def test_many_languages(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(300 * k + i, f"{letters[i % 26]}{letters[i // 26]}q word{k}", f"l{i}") for i in range(300) for k in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert set(langid.fit(docs, F.lit(True)).languages) == {r[2] for r in rows}


# -- language model ------------------------------------------------------------

def test_scores(docs, documents, no_docs):
    rows = lm.score(docs.select("doc_id", "text"), run_bytes=100_000).collect()
    tokens = [(r[0], [*(r[1] or "").encode().lower().split(), None]) for r in documents]
    counts = collections.Counter(w for key, ws in tokens if key is not None and fold(key, 10) for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    want = sorted((key is None, key, len(ws), sum(counts[w] > 0 for w in ws),
                   sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in ws)) for key, ws in tokens)
    got = sorted((r["doc_id"] is None, r["doc_id"], r["n_tokens"], r["n_known"], r["base_score"]) for r in rows)
    assert [w[:4] for w in want] == [g[:4] for g in got]
    assert np.allclose([w[4] for w in want], [g[4] for g in got], rtol=1e-9)
    assert {r["train_tokens"] for r in rows} == {total}
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    held = [r for r in rows if r["doc_id"] is not None and not fold(r["doc_id"], 10)]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert lm.score(no_docs).count() == 0


def test_null_texts_teach_their_end(spark):
    texts = spark.createDataFrame([(i, None) for i in range(50)], "doc_id long, text string")
    model = lm.Model([np.zeros((1 << b, lm.CLASSES), np.float32) for b in lm.BUCKET_BITS], np.zeros(lm.CLASSES, np.float32),
                     np.zeros(0, np.uint64), np.zeros(lm.CLASSES), np.zeros(lm.CLASSES))
    assert lm.update(texts, model, "doc_id", "text").bias.argmax() == lm.WORD_CLASSES


def test_words_before_tell_of_words_of_one_class(spark):
    # all words end alike; only their pairs tell a text from a shuffled one
    rng = np.random.default_rng(4)
    follow = dict(zip(range(200), rng.permutation(200).tolist()))

    def text(fluent):
        words = []
        for w in rng.integers(0, 200, 40).tolist():
            words += [f"a{w}xx", f"b{follow[w] if fluent else rng.integers(0, 200)}xx"]
        return " ".join(words)

    held = [i for i in range(3000) if not fold(i, 10)]
    shuffled = set(held[::2])
    rows = [(i, text(i not in shuffled)) for i in range(3000)]
    # a learned and a held-out document with one text
    copy_of, copy = next(i for i in range(3000) if fold(i, 10)), next(i for i in range(3000, 4000) if not fold(i, 10))
    rows.append((copy, rows[copy_of][1]))
    found = {r["doc_id"]: r for r in lm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    scores = {i: r["score"] for i, r in found.items()}
    assert min(scores[i] for i in held[1::2]) > max(scores[i] for i in held[::2]) + 20
    # one model scores both
    assert abs(scores[copy] - scores[copy_of]) < 1e-6
    assert all(r["left_out_score"] == r["score"] for i, r in found.items() if not fold(i, 10))
    # a text may also be scored without its own occurrences
    learned_from = [found[i]["left_out_score"] for i in range(3000) if fold(i, 10)]
    assert max(learned_from) < 0 and np.mean(learned_from) < np.mean([scores[i] for i in range(3000) if fold(i, 10)])
    assert abs(np.mean(learned_from) - np.mean([scores[i] for i in held[1::2]])) < 3


def test_words_are_counted_by_plain_sorts():
    rng = np.random.default_rng(6)
    names = np.sort(rng.integers(0, 1 << 62, 500).astype(np.uint64) << np.uint64(1))
    counts = rng.integers(1, 300, len(names))
    found = {part: lm._packed(counts[at].astype(np.uint64)) for part, at in R.parts_of(names, 3)}
    picked = np.concatenate((np.arange(len(names)), rng.integers(0, len(names), 5_000)))
    calls = collections.Counter()

    def watch(frame, event, arg):
        if event == "c_call":
            calls[arg.__name__] += 1

    sys.setprofile(watch)
    try:
        got = lm._counts_of(names[picked], found, 3)
    finally:
        sys.setprofile(None)
    assert (got == counts[picked]).all()
    assert calls["sort"] and not calls["argsort"]


def test_sorting():
    rng = np.random.default_rng(7)
    far = rng.integers(0, 1 << 63, 3_000).astype(np.uint64)
    near = np.uint64(1 << 63) + rng.integers(0, 40, 500).astype(np.uint64)  # differ in their last bits only
    top = np.uint64(2**64 - 1) - rng.integers(0, 5_000, 5_000).astype(np.uint64)
    for keys in (far, rng.permutation(np.concatenate((far, far, near))), top, far >> np.uint64(40), far[:1], far[:0],
                 np.zeros(9, np.uint64), np.array([2**64 - 1, 0, 2**64 - 1, 2**64 - 2], np.uint64)):
        order, found = R.sorting(keys)
        assert (order == np.argsort(keys, kind="stable")).all() and (found == np.sort(keys)).all()


def test_gradients_are_summed_by_stretches():
    rng = np.random.default_rng(8)
    rows = rng.standard_normal((3_000, lm.CLASSES)).astype(np.float32)
    sizes = [1, 8, 9, 1, lm.STEPS - 1, lm.STEPS, lm.STEPS + 1, 400, 2, 1, 10]
    heads, order = np.cumsum([0, *sizes[:-1]]), rng.integers(0, len(rows), sum(sizes))
    for number in (len(sizes), 1):
        heads, order = heads[:number], order[: sum(sizes[:number])]
        total, by = lm.segment_sums(rows, order, heads)
        assert sorted(by.tolist()) == list(range(number))
        for sums, i in zip(total, by.tolist()):
            own = rows[order[heads[i]: heads[i] + sizes[i]]]
            want = sum(own[1:8], own[0].copy())
            if sizes[i] > 8:
                want += own[8:].sum(axis=0)
            assert (sums == want).all()


def test_names_of_words_do_not_depend_on_the_spaces_around_them():
    plain, spaced = R.Block(3, [b"ab c", b"", b"ab", b"d"]), R.Block(3, [b" \t AB  c\n", b"\x0b", b"\r\rAb", b"D" + b" " * 300])
    (doc, one, two), (doc_, one_, two_) = R.word_names(plain), R.word_names(spaced, lower=True)
    assert doc.tolist() == doc_.tolist() == [3, 3, 5, 6]
    assert (one == one_).all() and (two == two_).all() and len(set(one.tolist())) == 3
    assert R.last_letters(plain).tolist() == R.last_letters(spaced, lower=True).tolist() == [256 * 98 + 97, 256 * 99, 256 * 98 + 97, 256 * 100]


# -- packing -------------------------------------------------------------------

def test_packing(docs, documents, no_docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    rows = packing.pack_documents(docs, keep_ids=True).collect()
    want = collections.Counter()
    for key, text, *_ in documents:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for number, (start, length) in enumerate(packing.cut(len(ids), 4096)):
            part = np.array(ids[start: start + length], dtype="<u4").tobytes()
            want[key, number, start, length, zlib.crc32(part)] += 1
    assert want == collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    held = collections.defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(held) <= 1.03 * math.ceil(sum(r["length"] for r in rows) / 4096) + 1
    assert packing.pack_documents(no_docs).count() == 0


def test_dominance():
    fixed, left = packing.reduce_by_dominance({60: 2, 40: 1, 39: 1, 30: 1, 95: 1}, 100)
    assert ((95,), 1) in fixed and ((60, 40), 1) in fixed
    counts = {60: 2, 40: 1, 39: 1, 30: 1, 95: 1}
    total = collections.Counter()
    for pattern, times in packing.plan(counts, 100):
        assert sum(pattern) <= 100
        for x in pattern:
            total[x] += times
    assert total == counts


def fewest(pieces, capacity):
    """Fewest sequences of a few pieces, by trying all."""
    def place(at, rooms, best):
        if len(rooms) >= best:
            return best
        if at == len(pieces):
            return len(rooms)
        for i in range(len(rooms)):
            if rooms[i] >= pieces[at] and rooms[i] not in rooms[:i]:
                best = place(at + 1, [*rooms[:i], rooms[i] - pieces[at], *rooms[i + 1:]], best)
        return place(at + 1, [*rooms, capacity - pieces[at]], best)

    return place(0, [], len(pieces) + 1)


def test_fixed_sets_cost_no_sequence():
    assert packing.reduce_by_dominance({10: 1, 7: 1, 3: 7}, 19)[0] == []
    rng = np.random.default_rng(5)
    for _ in range(300):
        capacity = int(rng.integers(10, 40))
        pieces = sorted(rng.integers(1, capacity + 1, int(rng.integers(2, 10))).tolist(), reverse=True)
        fixed, left = packing.reduce_by_dominance(collections.Counter(pieces), capacity)
        rest = sorted((x for x, n in left.items() for _ in range(n)), reverse=True)
        assert sum(n for _, n in fixed) + fewest(rest, capacity) == fewest(pieces, capacity)


def test_odd_texts_tokenise_alike():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    known = packing.word_ids(packing.tokenizer_path())
    for text in ("It's I'LL don't 12½ x²", "é é Å İstanbul ΣΑΣ", "a\x1cb c\td\r\ne", "<|endoftext|> x<|startoftext|>y", "日本 語😀"):
        assert np.frombuffer(known.ids(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


# -- mixing --------------------------------------------------------------------

def test_mixing(docs, documents, no_docs):
    sizes = collections.Counter(r[3] for r in documents)
    weight = {s: math.sqrt(n) for s, n in sizes.items()}
    rate = {s: weight[s] / sum(weight.values()) * len(documents) / n for s, n in sizes.items()}
    want = collections.Counter()
    for key, _, _, source, _ in documents:
        u = int(hashlib.md5(f"{mixing.SEED}|{'' if key is None else key}".encode()).hexdigest()[:13], 16) / 2**52
        n, p = 0, math.exp(-rate[source])
        c = p
        while c <= u and n < 200:
            n += 1
            p *= rate[source] / n
            c += p
        want.update({(key, source, i + 1): 1 for i in range(n)})
    rows = mixing.poisson_copies(docs).collect()
    assert set(want) == {(r["doc_id"], r["source"], r["_copy"]) for r in rows}
    assert mixing.mix(docs).columns == docs.columns and mixing.mix(no_docs).count() == 0
    only = mixing.mix(docs, weights={"src1": 1.0}).select("source").distinct().collect()
    assert [r[0] for r in only] == ["src1"]


def test_mixing_of_high_rates(spark):
    rows = spark.range(300).select(F.col("id").alias("doc_id"), F.when(F.col("id") >= 100, "big").alias("source"))
    # the 100 rows without a source are repeated 2,000 times on average, the others 3 times
    total = 200_600
    weights = {None: 200_000.0, "big": 600.0}
    given = mixing.source_rates(rows, weights=weights, total=total).collect()
    assert {r["__mix_source"]: round(r["rate"]) for r in given} == {None: 2000, "big": 3}

    def numbers(df):
        copies = mixing.poisson_copies(df, weights=weights, total=total).groupBy("doc_id")
        found = copies.agg(F.count("*"), F.max("_copy"), F.countDistinct("_copy")).collect()
        assert all(n == last == different for _, n, last, different in found)
        return {r[0]: r[1] for r in found}

    drawn = numbers(rows)
    high = np.array([drawn[i] for i in range(100)])
    assert abs(high.mean() - 2000) < 4 * math.sqrt(2000 / 100) and 0.5 < high.var(ddof=1) / 2000 < 1.7
    assert drawn == numbers(rows.repartition(7))



# -- SimHash -------------------------------------------------------------------

def slow_print(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    shingles = [b" ".join(words[i: i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, bits):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_simhash(docs, documents, no_docs):
    keyed = [(r[0], slow_print(r[1])) for r in documents]
    roots = slow_components([p for _, p in keyed], 4)
    least = {}
    for (key, _), r in zip(keyed, roots):
        if key is not None:
            least[r] = min(key, least.get(r, key))
    want = collections.Counter((key, f"{p:016x}", least.get(r)) for (key, p), r in zip(keyed, roots))
    rows = simhash.near_duplicates(docs).withColumn("fingerprint", simhash.hex16(F.col("fingerprint"))).collect()
    assert want == collections.Counter(map(tuple, rows))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(set(least.values()))
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.keep_one(no_docs).count() == 0


def test_chain_of_fingerprints(spark, monkeypatch):
    """A chain links through, whatever the leading bits and however few variants fit at once."""
    rng = np.random.default_rng(2)
    prints, at = [], 0
    for i in range(60):
        at ^= sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        prints.append(at)
    prints += [int(x) for x in rng.integers(0, 2**63, 40)]
    df = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fingerprint long").distinct()
    for size in (1024, 8):
        monkeypatch.setattr(simhash, "GROUP_FINGERPRINTS", size)
        monkeypatch.setattr(simhash, "VARIANTS_AT_ONCE", 50_000)
        rows = simhash.fingerprint_classes(df).collect()
        roots = slow_components(prints, 4)
        assert len({r["class"] for r in rows}) == len(set(roots))


# -- personal data -------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return True


ODD = [
    "x a@b.c_d@e.f-g.h @ a@@b.co ü@x.de.", "1.2.3.4.5.6.7.8 001.2.3.255 1.2.3.256 999.1.1.1.1", "😀 +1 (555) 010-9999 +1234 +12 34 56 78 9",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111 0000000000000", "+1.2.3.4.5.6.7.8.9 mail: joe(at)site.org, tel (212) 555-0199",
    "9" * 50_000, " " * 50_000, "+" * 3_000 + "1", "1 2 " * 5_000, "a" * 40_000 + "@b.c", None, "",
]


def test_personal_data(spark, docs, documents, no_docs):
    extra = spark.createDataFrame([(20_000 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(extra)
    weights = pii.fit(both)
    found = pii.find(both, weights)
    base = pii.joined(F.filter("_spans", lambda s: s["base"])).alias("base")
    rows = found.select("doc_id", "text", base, pii.joined(F.col("_spans")).alias("spans")).collect()
    for r in rows:
        spans = sorted((m.start(), list(PATTERNS).index(k), m.end(), k) for k, p in PATTERNS.items()
                       for m in re.finditer(p, r["text"] or "") if valid(k, m[0]))
        assert r["base"] == ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans), (r["doc_id"], (r["text"] or "")[:60])
        assert set(filter(None, r["base"].split(","))) <= set(filter(None, r["spans"].split(",")))
    clean = pii.redact(docs, weights)
    assert clean.columns == docs.columns
    for r in clean.filter("text IS NOT NULL").collect():
        assert not any(valid(k, m[0]) for k in ("email", "ip") for m in re.finditer(PATTERNS[k], r["text"]))
    assert pii.find(no_docs, pii.fit(no_docs)).count() == 0


def test_redaction(spark):
    df = spark.createDataFrame([(1, "é mail a@b.co, ip 1.2.3.4 end"), (2, None), (3, "clean")], "doc_id long, text string")
    assert {r[0]: r[1] for r in pii.redact(df, pii.fit(df)).collect()} == {
        1: "é mail [EMAIL], ip [IP] end", 2: None, 3: "clean"}


def test_reliability():
    """A labeler that contradicts the others is found out."""
    counts = {(0, 1, 1, 1): 50, (0, -1, 0, -1): 50, (0, -1, 1, 1): 3, (0, 1, 0, -1): 3}
    belief = pii.expectation_maximisation(counts, set())
    assert belief[0, 1, 1, 1] > 0.9 > 0.1 > belief[0, -1, 0, -1]


# looser spans that are personal data, and ones that only look like it
TRUE_SPANS = [
    ("email", "please contact {}", "maria.lopez(at)example(dot)org"), ("email", "write to {}", "info [at] press.example.com"),
    ("email", "e-mail: {}", "j.smith at mail dot example dot net"), ("email", "kontakt {}", "hans_klaus (at) zeitung dot de"),
    ("ip", "server address {}", "10[.]20[.]30[.]40"), ("ip", "login from host {}", "81(.)2(.)69(.)142"),
    ("card", "paid by card {}", "4111.1111.1111.1111"), ("card", "visa {}", "4012.8888.8888.1881"),
    ("email", "see {}", "joe.park at mail dot example dot net"), ("phone", "then {}", "212-555-0199"),
    ("phone", "call {}", "(212) 555-0199"), ("phone", "phone {}", "415-555-0132"), ("phone", "tel {}", "0049 30 2345 6789"),
]
FALSE_SPANS = [
    ("email", "they met {}", "guests at noon dot the"), ("email", "it was {}", "sold at auction dot then"),
    ("email", "she looked {}", "around at every dot on"), ("card", "tracking number {}", "9400110898825022"),
    ("card", "order {}", "8123456789012345"), ("card", "serial code {}", "1234 5678 9012 3456"),
    ("card", "james kept {}", "4000123412341234"), ("card", "mary wrote {}", "5100 1111 2222 3333"),
    ("phone", "maria counted {}", "300 400 500"), ("phone", "and anna saw {}", "212 300 4500"),
    ("phone", "pages {}", "100 200 300"), ("phone", "lot {}", "123 456 7890"), ("phone", "part ref {}", "145 0000 111"),
]


def loose_texts(kinds, copies=12):
    """Texts with a planted span each, its place, and whether it is personal data."""
    rows, filler = [], ["the paper came late", "rain fell on the town", "we read the news"]
    for true, planted in ((True, TRUE_SPANS), (False, FALSE_SPANS)):
        for i, (kind, frame, span) in enumerate(p for p in planted if p[0] in kinds):
            for copy in range(copies):
                start = f"{filler[(i + copy) % 3]} {copy}x. "
                text = start + frame.format(span) + ", " + filler[copy % 3]
                at = len(start) + frame.index("{}")
                rows.append((len(rows), text, f"{kind}:{at}:{at + len(span)}", true))
    strict = [("e-mail", "anna.meyer@example.org"), ("contact", "press@site.com"), ("host", "81.2.69.142"), ("ip", "10.1.2.3"),
              ("card", "4111 1111 1111 1111"), ("visa", "4012888888881881"), ("call", "+49 30 2345 6789"), ("phone", "+1 (212) 555-0199")]
    rows += [(len(rows) + i, f"{word} {span} here {i}", None, None) for i, (word, span) in enumerate(strict * 5)]
    return rows


def test_loose_spans(spark):
    """Precision and recall on planted spans: by the method, by the sum of the votes, and with every candidate kept."""
    rows = loose_texts(pii.KINDS)
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    weights = pii.fit(df)
    plain = weights_of_votes()

    def found(weights):
        spans = pii.joined(F.filter("_spans", lambda s: ~s["base"])).alias("spans")
        return {r["doc_id"]: set(filter(None, r["spans"].split(","))) for r in pii.find(df, weights).select("doc_id", spans).collect()}

    def judged(got):
        hits = sum(want in got[i] for i, _, want, true in rows if true)
        wrong = sum(len(got[i] - ({want} if true else set())) for i, _, want, true in rows)
        return hits / sum(bool(r[3]) for r in rows), hits / max(1, hits + wrong)

    everything = judged(found({("bias",): 100.0}))
    votes = judged(found(plain))
    method = judged(found(weights))
    print("recall and precision: all", everything, "votes", votes, "method", method)
    assert everything[0] == 1.0 and everything[1] < 0.7
    assert method[0] >= 0.9 and method[1] >= 0.95
    assert method[0] * method[1] > votes[0] * votes[1]


def weights_of_votes():
    """Weights that let the sum of the votes decide: over a half, which passes the threshold."""
    return {("bias",): -5.0 + math.log(pii.ACCEPT / (1 - pii.ACCEPT)),
            **{("vote", k, x): 10.0 * x for k in range(len(pii.LABELERS)) for x in (-1, 0, 1)}}


def test_long_spelled_addresses(spark):
    long = "a" * 300 + " (at) " + "b" * 200 + " (dot) org"
    df = spark.createDataFrame([(1, "mail " + long + " end"), (2, "x at " * 20_000 + " dot "), (3, " dot " * 20_000 + "(at)")], "doc_id long, text string")
    got = pii.with_candidates(df).select("doc_id", F.transform("_candidates", lambda c: c["end"] - c["start"]).alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in got} == {1: [len(long)], 2: [], 3: []}


def test_labelers_are_no_worse_than_chance():
    """A failed check counts against a span, however much the other votes look like certain ones."""
    certain, failed = (1, 1, 1, 1, 0), (-1, 1, 0, 1, 0)
    belief = pii.expectation_maximisation({certain: 1000, failed: 300, (0, -1, -1, -1, 0): 300}, {certain})
    assert belief[failed] < pii.ACCEPT
