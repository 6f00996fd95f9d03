"""One query per operator over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pressmill.llm import ann, forest, langid, lm, merkle, mixing, packing, phrases, pii, quality, simhash, substring, suffix
from pressmill.llm.common import crc_mod, held_out, learned, table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs, learned("doc_id", 5))
    return langid.identify(docs, model).select(
        "doc_id", held_out("doc_id", 5).alias("held_out"), "lang_pred", "score", "rejected")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents")).select(
        "doc_id", held_out("doc_id", lm.FOLDS).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score",
        "left_out_score")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    copies = mixing.poisson_copies(docs)
    return copies.orderBy("_order").select(
        "doc_id", "text", "lang", "source", "n_chars", F.col("_copy").cast("int").alias("copy"), F.col("_order").alias("mix_order"))


def op7_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return ann.search(rows, rows.where("vec_id % 50 = 0"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex16(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs))
    base = F.filter("_spans", lambda s: s["base"])

    def count(number: int) -> Column:
        own = F.filter("_spans", lambda s: s["base"] & (s["kind"] == number))
        return F.size(own).cast("long").alias(f"n_{pii.KINDS[number]}")

    return found.select(
        "doc_id", *map(count, range(len(pii.KINDS))), F.sha2(pii.joined(base).cast("binary"), 256).alias("base_sha256"),
        pii.joined(F.col("_spans")).alias("spans"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    changed = merkle.leaf_digest([more if f == "n_chars" else F.col(f) for f in merkle.FIELDS])
    own = merkle.leaf_digest([F.col(f) for f in merkle.FIELDS])
    found = merkle.manifest(docs, carry={"shown": F.when(crc_mod("doc_id", 7) == 0, changed).otherwise(own)})
    return merkle.verify(found, F.col("shown")).select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof_text(F.col("path")).cast("binary"), 256).alias("proof_sha256"),
        "folded_root", "verified")


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = quality.describe_texts(table(spark, sf_dir, "documents"))
    rules = quality.fit(described, table(spark, sf_dir, "labels"))
    return quality.judge(described, rules).select(
        F.col("id").alias("doc_id"), *[F.col(f"counts.{c}") for c in quality.COUNTS[:5]], "base_failed", "kept", "rule")


QUERIES = {
    f.__name__: f for f in (
        op1_suffix_dedup, op2_language_id, op3_substring_dedup, op4_lm_scoring, op5_best_fit_packing,
        op6_source_mixing, op7_ann_search, op8_simhash, op9_pii, op10_embedding_dedup, op11_phrases,
        op12_merkle_manifest, op13_quality_rules)
}

MIXING_SQL = """
WITH sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
weights AS (SELECT source, n, pow(CAST(n AS DOUBLE), 0.5) AS w FROM sizes),
rates AS (
  SELECT source, w / (SELECT sum(w) FROM weights) * CAST((SELECT sum(n) FROM sizes) AS DOUBLE) / n AS rate
  FROM weights),
terms AS (
  SELECT source, list_sum(list_transform(range(0, j + 1), lambda i: exp(i * ln(rate) - rate - lgamma(i + 1)))) AS c
  FROM rates, range(0, 80) AS t(j)),
draws AS (
  SELECT *, CAST('0x' || substr(md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT)
            / 4503599627370496.0 AS u
  FROM documents),
copies AS (
  SELECT d.*, (SELECT count(*) FROM terms t WHERE t.source IS NOT DISTINCT FROM d.source AND t.c <= d.u) AS k
  FROM draws d)
SELECT doc_id, text, lang, source, n_chars, CAST(c.copy AS INTEGER) AS copy,
  md5('mix-1|order|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || CAST(c.copy AS VARCHAR)) AS mix_order
FROM copies, unnest(range(1, k + 1)) AS c(copy)
"""

WORDS_SQL = r"""
WITH docs AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
windows AS (SELECT doc_id, s, array_to_string(w[s:s + 12], ' ') AS g FROM docs, unnest(range(1, len(w) - 11)) AS t(s)),
firsts AS (SELECT g, min(doc_id) AS m FROM windows GROUP BY g),
gone AS (SELECT DISTINCT doc_id, s + k AS p FROM windows JOIN firsts USING (g), range(0, 13) AS r(k) WHERE m < doc_id),
removed AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
  sha256(array_to_string(list_filter(w, lambda x, i: NOT coalesce(list_contains(ps, i), false)), ' ')) AS kept_sha256
FROM docs LEFT JOIN removed USING (doc_id)
"""

BYTES_SQL = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
pieces AS (SELECT doc_id, 256 * c AS start, substr(h, 512 * c + 1, 610) AS piece FROM docs, unnest(range(0, length(h) // 512 + 1)) AS t(c)),
windows AS (
  SELECT doc_id, start + j AS s, md5_number(substr(piece, 2 * j + 1, 100)) AS g
  FROM pieces, unnest(range(0, least(256, length(piece) // 2 - 49))) AS t(j)),
firsts AS (SELECT g, min(doc_id) AS m FROM windows GROUP BY g),
hits AS (SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS before FROM windows JOIN firsts USING (g) WHERE m < doc_id),
marked AS (SELECT doc_id, s, sum(CASE WHEN before >= s - 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY s) AS span FROM hits),
spans AS (SELECT doc_id, min(s) AS a, max(s) + 50 AS b FROM marked GROUP BY doc_id, span),
kept AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM spans
  UNION ALL SELECT doc_id, max(b), NULL FROM spans GROUP BY doc_id),
texts AS (
  SELECT doc_id, string_agg(CASE WHEN kept.b IS NULL THEN substr(h, 2 * kept.a + 1) ELSE substr(h, 2 * kept.a + 1, 2 * (kept.b - kept.a)) END,
    '' ORDER BY kept.a, kept.b NULLS LAST) AS k
  FROM kept JOIN docs USING (doc_id) GROUP BY doc_id),
sums AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM docs LEFT JOIN texts USING (doc_id) LEFT JOIN sums USING (doc_id)
"""

LINKS_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
found AS (SELECT a, min(b) AS least FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(found.least, vec_id)) AS component_id,
  vec_id <= coalesce(found.least, vec_id) AS kept
FROM v LEFT JOIN counts ON counts.a = vec_id LEFT JOIN found ON found.a = vec_id
"""

PHRASES_SQL = r"""
WITH parts AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
  FROM documents),
pieces AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM parts),
grams AS (
  SELECT lang, array_to_string(w[s:s + k - 1], ' ') AS phrase, k
  FROM pieces, unnest(range(1, len(w) + 1)) AS t(s), range(1, 6) AS u(k) WHERE s + k - 1 <= len(w)),
totals AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang),
counts AS (SELECT lang, phrase, k, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
cands AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, t.n, j,
    CAST(1000 AS HUGEINT) * c.a * t.n // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM cands c, range(1, 5) AS q(j), counts x, counts y, totals t
  WHERE j < c.k AND x.lang = c.lang AND y.lang = c.lang AND t.lang = c.lang
    AND x.phrase = array_to_string(c.w[1:j], ' ') AND y.phrase = array_to_string(c.w[j + 1:], ' ')),
worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inner_parts AS (
  SELECT lang, array_to_string(w[s:s + m - 1], ' ') AS phrase, max(a) AS over
  FROM cands, range(1, 5) AS t(s), range(2, 5) AS u(m) WHERE m < k AND s + m - 1 <= k GROUP BY ALL),
kept AS (SELECT worst.* FROM worst LEFT JOIN inner_parts p USING (lang, phrase) WHERE p.over IS NULL OR 100 * p.over < 100 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR) END"
_CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST({0} AS VARCHAR), ''),
    lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda x, e: CASE WHEN e >= 0 THEN xor(x, e) WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))"""
_LEAF = "sha256(" + " || ".join(_FIELD.format(f) for f in merkle.FIELDS) + ")"

MERKLE_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {_LEAF} AS leaf,
    {_LEAF.replace("n_chars", "(n_chars + 1)")} AS changed,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, {_LEAF}) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS n
  FROM documents),
nodes(lang, lvl, pos, n, h) AS (
  SELECT lang, 0, pos, n, leaf FROM leaves
  UNION ALL
  SELECT lang, lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY lang, lvl, pos // 2, n),
subroots AS (
  SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops(lvl, pos, n, h) AS (
  SELECT 0, pos, n, h FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY lvl, pos // 2, n),
steps AS (
  SELECT a.lang, a.pos, b.lvl, CASE WHEN (a.pos >> b.lvl) % 2 = 1 THEN 'L' ELSE 'R' END || coalesce(s.h, '') AS step
  FROM leaves a JOIN nodes b ON b.lang IS NOT DISTINCT FROM a.lang AND b.n > 1 AND b.pos = a.pos >> b.lvl
  LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM a.lang AND s.lvl = b.lvl AND s.pos = xor(a.pos >> b.lvl, 1)),
lower_paths AS (SELECT lang, pos, list(step ORDER BY lvl) AS path FROM steps GROUP BY lang, pos),
upper_paths AS (
  SELECT a.lang, list(CASE WHEN (a.pos >> b.lvl) % 2 = 1 THEN 'L' ELSE 'R' END || coalesce(s.h, '') ORDER BY b.lvl) AS path
  FROM subroots a JOIN tops b ON b.n > 1 AND b.pos = a.pos >> b.lvl
  LEFT JOIN tops s ON s.lvl = b.lvl AND s.pos = xor(a.pos >> b.lvl, 1) GROUP BY a.lang),
paths AS (
  SELECT l.*, s.h AS subroot, (SELECT h FROM tops WHERE n = 1) AS root, list_concat(coalesce(p.path, []), coalesce(u.path, [])) AS path,
    CASE WHEN {_CRC32.format("l.doc_id")} % 7 = 0 THEN l.changed ELSE l.leaf END AS shown
  FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang
  LEFT JOIN lower_paths p ON p.lang IS NOT DISTINCT FROM l.lang AND p.pos = l.pos
  LEFT JOIN upper_paths u ON u.lang IS NOT DISTINCT FROM l.lang),
folds AS (
  SELECT *, list_reduce(list_concat([shown], path),
    lambda x, y: CASE WHEN y[1] = 'L' THEN sha256(y[2:] || x) ELSE sha256(x || y[2:]) END) AS folded_root FROM paths)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda p: p[2:]), '')) AS proof_sha256,
  folded_root, folded_root = root AS verified
FROM folds
"""

SQL = {
    "op1_suffix_dedup": BYTES_SQL, "op3_substring_dedup": WORDS_SQL, "op6_source_mixing": MIXING_SQL,
    "op10_embedding_dedup": LINKS_SQL, "op11_phrases": PHRASES_SQL, "op12_merkle_manifest": MERKLE_SQL,
}
