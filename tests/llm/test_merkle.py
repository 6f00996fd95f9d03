"""Operator 12 against a tree built by hand."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from pressmill.llm import merkle


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(level, fanout):
    """Root, and for every leaf its (left, right) siblings from the bottom up."""
    paths, owners = [[] for _ in level], [[i] for i in range(len(level))]
    while len(level) > 1:
        runs = [range(s, min(s + fanout, len(level))) for s in range(0, len(level), fanout)]
        for run in runs:
            for i in run:
                step = ("".join(level[j] for j in run if j < i), "".join(level[j] for j in run if j > i))
                for own in owners[i]:
                    paths[own].append(step)
        owners = [[o for i in run for o in owners[i]] for run in runs]
        level = [digest(*(level[i] for i in run)) for run in runs]
    return level[0], paths


def wanted(rows, fanout):
    """Sorted (id, leaf, subroot, root, path) of rows (doc_id, text, lang, source, n_chars)."""
    groups = {}
    for key, text, lang, source, n in rows:
        groups.setdefault(lang, []).append((key is not None, key, leaf(key, source, lang, n, text)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    built = {g: tree([x[2] for x in sorted(groups[g])], fanout) for g in names}
    root, above = tree([built[g][0] for g in names], fanout)
    return sorted((
        (x[1] is not None, x[1], x[2], built[g][0], root, tuple(path + above[k]))
        for k, g in enumerate(names) for x, path in zip(sorted(groups[g]), built[g][1])), key=repr)


@pytest.mark.parametrize("fanout,height,rows", [(2, 4, None), (2, 1, 37), (3, 2, None), (2, 4, 1), (4, 1, 100)])
def test_manifest(spark, documents, fanout, height, rows):
    # by default with all odd rows: nulls, repeated rows and ids, very long texts, a group of one
    some = [*documents, (10_000, "x", None, None, None), (1, "own", "zz", None, 1)] if rows is None else documents[:rows]
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in some],
                                 "doc_id long, text string, lang string, source string, n_chars long, node string, tree int, `group` string")
    found = merkle.manifest(docs.repartition(3), fanout=fanout, height=height, carry={"shown": F.lit("f00")})
    got = sorted(((r["doc_id"] is not None, r["doc_id"], r["leaf"], r["subroot"], r["root"],
                   tuple((s["left"], s["right"]) for s in r["path"])) for r in found.collect()), key=repr)
    assert got == wanted(some, fanout)
    assert merkle.verify(found, F.col("leaf")).where("NOT verified").count() == 0
    assert merkle.verify(found, F.col("shown")).where("verified").count() == 0


def test_values_cannot_be_moved_between_fields(spark):
    rows = spark.createDataFrame([(1, "a", "b"), (1, "ab", ""), (1, "", "ab"), (1, None, "ab"), (1, "-", "ab")], "id int, x string, y string")
    leaves = rows.select(merkle.leaf_digest([F.col("id"), F.col("x"), F.col("y")]).alias("leaf")).distinct()
    assert leaves.count() == 5


def test_empty(no_docs):
    assert merkle.manifest(no_docs).count() == 0


def test_tampered_rows_are_found(spark):
    from pressmill.llm.queries import op12_merkle_manifest
    from tests.llm.conftest import SF

    rows = op12_merkle_manifest(spark, SF).collect()
    assert len(rows) == 200
    assert all(r["verified"] == bool(zlib.crc32(str(r["doc_id"]).encode()) % 7) for r in rows)
    assert 0 < sum(not r["verified"] for r in rows) < 60
