"""SimHash near-duplicates by meet-in-the-middle ball hashing (operator 8).

Two fingerprints that differ in at most ``2 r`` bits have a word between them that
differs from either in at most ``r`` bits.  So every distinct fingerprint emits all
words within ``r`` bits (2,081 for 64 bits and ``r = 2``), and fingerprints that
emit a common word are pairs.  Variants are shuffled by their leading bits: the
variants of one fingerprint with the same leading bits travel as one row and are
spelled out in the task that compares them, so about 40 rows cross the network in
place of 2,081.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from pressmill.llm.common import packed, unpacked
from pressmill.llm.components import components
from pressmill.session import write_between

SEED = 42
SHINGLE_WORDS = 4
MAX_BITS = 4
# fingerprints that share their leading bits, on average
GROUP_FINGERPRINTS = 1024
# variants held by a task at once
VARIANTS_AT_ONCE = 4_000_000


def fingerprint_of(text: str | None, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """SimHash of a text: bit set where over half the shingle hashes have it; 0 without words."""
    tokens = (text or "").encode("utf-8", "replace").lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(tokens) < words:
        pairs = [(0, len(joined))]
    else:
        pairs = zip(starts[: len(tokens) - words + 1].tolist(), ends[words - 1:].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in pairs], dtype=np.uint64)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at: at + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.flatnonzero(2 * counts > len(hashes))
    return int(sum(1 << int(i) for i in bits))


def fingerprint(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """Fingerprint of a text column as a signed long."""
    @F.pandas_udf("long")
    def run(texts):
        import pandas as pd

        values = np.array([fingerprint_of(t, words) for t in texts], dtype=np.uint64)
        return pd.Series(values.view(np.int64))

    return run(text)


def hex16(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def _masks(bits: int, most: int) -> np.ndarray:
    """All words of ``bits`` bits with at most ``most`` bits set."""
    masks = [sum(1 << i for i in c) for k in range(most + 1) for c in combinations(range(bits), k)]
    return np.array(masks, dtype=np.uint64)


def _collide(prefix_bits: int, radius: int):
    """For fingerprints with a variant of one prefix: links to the smallest of each local group."""
    low_bits = 64 - prefix_bits
    shift = np.uint64(low_bits)
    masks = [_masks(low_bits, k) for k in range(radius + 1)]

    def run(key, rows):
        prints = np.unique(rows["fingerprint"].to_numpy().view(np.uint64))
        prefix = np.uint64(key[0].as_py())
        top = prints >> shift if prefix_bits else np.zeros_like(prints)
        left = radius - np.bitwise_count(top ^ prefix).astype(int)
        low = prints & np.uint64((1 << low_bits) - 1)
        slices = 1 + int(sum(len(masks[x]) for x in left)) // VARIANTS_AT_ONCE
        parent = list(range(len(prints)))

        def root(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for part in range(slices):
            words, owners = [], []
            for k in range(radius + 1):
                own = np.flatnonzero(left == k)
                for at in range(0, len(own), 512):
                    ids = own[at: at + 512]
                    variants = (low[ids][:, None] ^ masks[k][None, :]).ravel()
                    who = np.repeat(ids, len(masks[k]))
                    if slices > 1:
                        keep = (variants * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(slices) == part
                        variants, who = variants[keep], who[keep]
                    words.append(variants)
                    owners.append(who)
            if not words:
                continue
            words, owners = np.concatenate(words), np.concatenate(owners)
            order = np.argsort(words, kind="stable")
            words, owners = words[order], owners[order]
            same = np.flatnonzero(words[1:] == words[:-1])
            links = np.unique(np.stack([owners[same], owners[same + 1]], axis=1), axis=0)
            near = np.bitwise_count(prints[links[:, 0]] ^ prints[links[:, 1]]) <= 2 * radius
            for a, b in links[near].tolist():
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        roots = np.array([root(i) for i in range(len(prints))], dtype=np.int64)
        moved = np.flatnonzero(roots != np.arange(len(prints)))
        return pa.table({"a": prints[moved].view(np.int64), "b": prints[roots[moved]].view(np.int64)})

    return run


def fingerprint_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links ``(a, b)`` whose components are those of all pairs within ``max_bits`` bits.

    ``prints`` has one column ``fingerprint`` of distinct longs; ``max_bits`` is even.
    """
    radius = max_bits // 2
    prefix_bits = max(0, min(24, int(np.log2(max(1, prints.count()) / GROUP_FINGERPRINTS)) if prints.head(1) else 0))
    nearby = [int(m) for m in _masks(prefix_bits, radius)] if prefix_bits else [0]
    prefix = F.shiftrightunsigned("fingerprint", 64 - prefix_bits) if prefix_bits else F.lit(0).cast("long")
    rows = prints.select(
        F.explode(F.transform(F.array(*[F.lit(m).cast("long") for m in nearby]), lambda m: prefix.bitwiseXOR(m)))
        .alias("prefix"), "fingerprint")
    return rows.groupBy("prefix").applyInArrow(_collide(prefix_bits, radius), "a long, b long").distinct()


def fingerprint_classes(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(fingerprint, class)`` for distinct fingerprints; ``class`` names the component."""
    roots = components(fingerprint_links(prints, max_bits))
    return prints.join(roots, prints["fingerprint"] == roots["node"], "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("class"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: ``id_col``, ``fingerprint`` (long) and ``component_id``.

    ``component_id`` is the smallest id reachable over links of at most ``max_bits``
    differing bits, the document's own included; null if no id of the component is
    known.  A null or wordless text has fingerprint 0, which links like any other.
    Repeated rows stay repeated; an empty table gives an empty one.  Other columns
    of ``docs`` are not read.
    """
    own = write_between(docs.select(F.col(id_col).alias("_id"), fingerprint(F.col(text_col), words).alias("fingerprint")))
    prints = own.groupBy("fingerprint").agg(F.min("_id").alias("first"))
    classes = fingerprint_classes(prints.select("fingerprint"), max_bits)
    named = prints.join(classes, "fingerprint")
    least = named.groupBy("class").agg(F.min("first").alias("component_id"))
    by_print = named.join(least, "class").select("fingerprint", "component_id")
    return own.join(by_print, "fingerprint").select(F.col("_id").alias(id_col), "fingerprint", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each component: that of the smallest id, nulls last.

    Rows alike in every column count as one.  All columns come back as they were,
    whatever their names.
    """
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    narrow = write_between(docs.select(
        F.col(id_col).alias("_id"), whole.alias("_row"), fingerprint(F.col(text_col), words).alias("fingerprint")))
    key = F.struct(F.col("_id").isNull().alias("n"), F.col("_id").alias("i"), F.col("_row").alias("r"))
    prints = narrow.groupBy("fingerprint").agg(F.min(key).alias("first"))
    classes = fingerprint_classes(prints.select("fingerprint"), max_bits)
    kept = prints.join(classes, "fingerprint").groupBy("class").agg(F.min("first").alias("first"))
    kept = kept.select(F.col("first.r").alias("_kept"), F.col("first.i").alias("_kept_id"))
    chosen = (F.col("_row") == F.col("_kept")) & F.col("_id").eqNullSafe(F.col("_kept_id"))
    rows = docs.select(packed(docs), whole.alias("_row"), F.col(f"`{id_col}`").alias("_id"))
    return rows.join(kept, chosen, "left_semi").dropDuplicates(["_row", "_id"]).select(*unpacked(docs))
