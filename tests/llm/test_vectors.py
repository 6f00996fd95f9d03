"""Operators 7 and 10 against brute force."""

import math

import numpy as np
import pytest

from pressmill.llm import ann, forest
from pressmill.llm.components import components

ODD = [(900, None), (901, [0.0] * 16), (902, [float("nan")] + [1.0] * 15), (903, [None] + [1.0] * 15),
       (904, [float("inf")] + [1.0] * 15), (905, [1.0] * 3), (906, []), (None, [1.0] * 16)]


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(300, 16))
    rows[100:160] = rows[100] + 0.02 * rng.normal(size=(60, 16))
    rows[200:215] = rows[200]
    for i in range(230, 250):
        # a chain of neighbours of about 0.93, whose ends are far apart
        step = rng.normal(size=16)
        step -= step @ rows[i - 1] / (rows[i - 1] @ rows[i - 1]) * rows[i - 1]
        rows[i] = rows[i - 1] + 0.4 * step / np.linalg.norm(step) * np.linalg.norm(rows[i - 1])
    return rows.astype(np.float32).astype(float)


@pytest.fixture(scope="module")
def table(spark, vectors):
    rows = [(i, v.tolist(), 0, 1.0) for i, v in enumerate(vectors)] + [(i, v, 0, 1.0) for i, v in ODD]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, leaf int, score double").repartition(3)


def test_search(table, vectors):
    x = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    queries = table.where("vec_id % 20 = 0")
    for share, least in ((1.0, 1.0), (ann.SHARE, 0.9)):
        rows = ann.search(table, queries, share=share).collect()
        found = {}
        for r in rows:
            found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
        assert sorted(found) == list(range(0, 300, 20))
        hits = 0
        for q, got in found.items():
            like = x @ x[q]
            like[q] = -9
            # copies have one score
            want = sorted(range(300), key=lambda i: (-round(like[i], 12), i))[:5]
            got.sort()
            assert [g[0] for g in got] == [1, 2, 3, 4, 5]
            assert np.allclose([g[2] for g in got], [like[g[1]] for g in got], atol=1e-14)
            hits += len(set(want) & {g[1] for g in got})
            if share == 1.0:
                assert [g[1] for g in got] == want
        assert hits / (5 * len(found)) >= least


def test_search_in_blocks(table, vectors, monkeypatch):
    """Rows and queries in many blocks give the same; cells out of reach are left out without loss."""
    queries = table.where("vec_id % 3 = 0")
    want = sorted(map(tuple, ann.search(table, queries, share=1.0).collect()))
    monkeypatch.setattr(ann, "BLOCK_ROWS", 20)
    monkeypatch.setattr(ann, "CELL_ROWS", 5)
    got = sorted(map(tuple, ann.search(table, queries, share=1.0).collect()))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], atol=1e-14)
    # a tiny share still finds as many rows as wanted
    few = ann.search(table, queries, share=0.01).groupBy("query_id").count().collect()
    assert {r["count"] for r in few} == {5} and len(few) == 100


def test_nothing_to_search(spark, table):
    assert ann.search(table.limit(0), table).count() == 0
    one = table.where("vec_id = 7")
    assert ann.search(one, one).count() == 0


def test_forest(table, vectors):
    x = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    linked = x @ x.T >= 0.9
    label = np.arange(300)
    for _ in range(300):
        label = np.where(linked, label[None, :], 999).min(axis=1)
    rows = {r["vec_id"]: r for r in forest.near_duplicates(table, trees=8, leaf_rows=64).collect()}
    assert len(rows) == 308
    for i in range(300):
        assert (rows[i]["n_links"], rows[i]["component_id"], rows[i]["kept"]) == (linked[i].sum() - 1, label[i], label[i] == i)
    for key, _ in ODD:
        assert (rows[key]["n_links"], rows[key]["component_id"], rows[key]["kept"]) == (0, key, key is not None)
    assert forest.near_duplicates(table.limit(0)).count() == 0


def planted(rng, n, width=24):
    """Vectors of which a third are copies of others at cosines of 0.85 to 0.95, some in chains and one hot cluster."""
    x = rng.normal(size=(n, width))
    x /= np.linalg.norm(x, axis=1)[:, None]

    def beside(of, cosine):
        step = rng.normal(size=of.shape)
        step -= (step * of).sum(-1, keepdims=True) * of
        return cosine * of + math.sqrt(1 - cosine ** 2) * step / np.linalg.norm(step, axis=-1, keepdims=True)

    third = n // 3
    for i in range(third):
        # a fifth go on from the one before
        x[i] = beside(x[i - 1] if i % 5 == 0 and i else x[third + i], rng.uniform(0.85, 0.95))
    hot = n - n // 20
    x[hot:] = beside(np.repeat(x[hot: hot + 1], n - hot, axis=0), 0.97)
    return x[rng.permutation(n)]


def exact(x, least=0.9):
    """Links and smallest number of each row's component, by brute force."""
    near = [np.flatnonzero(x @ row >= least) for row in x]
    label, old = np.arange(len(x)), None
    while old is None or (label != old).any():
        old = label
        label = np.array([label[n].min() for n in near])
        label = label[label]
    return np.array([len(n) - 1 for n in near]), label


def of_forest(spark, x, **kw):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    rows = sorted(forest.near_duplicates(df.repartition(8), **kw).collect())
    return np.array([r["n_links"] for r in rows]), np.array([r["component_id"] for r in rows])


def test_forest_with_production_values(spark):
    """12,000 rows: trees of depth 6, as the query uses them."""
    x = planted(np.random.default_rng(7), 12_000)
    links, label = exact(x)
    got, component = of_forest(spark, x)
    assert links.sum() > 12_000 and (got <= links).all()
    assert got.sum() >= 0.999 * links.sum()
    assert (component == label).mean() >= 0.99


@pytest.mark.parametrize("rounds", [forest.ROUNDS, 0])
def test_leaves_beyond_the_sample(spark, monkeypatch, rounds):
    """Leaves that a small sample cannot split are split further, or else compared in blocks."""
    monkeypatch.setattr(forest, "SAMPLE_ROWS", 100)
    monkeypatch.setattr(forest, "ROUNDS", rounds)
    monkeypatch.setattr(forest, "BLOCK_ROWS", 64)
    x = planted(np.random.default_rng(8), 3_000)
    links, label = exact(x)
    got, component = of_forest(spark, x, leaf_rows=32)
    assert (got <= links).all() and got.sum() >= 0.97 * links.sum()
    assert (component == label).mean() >= 0.97


def test_no_leaf_stays_large(spark, monkeypatch):
    x = planted(np.random.default_rng(9), 6_000)
    df = spark.createDataFrame([(0, 1, i, v.tolist()) for i, v in enumerate(x)], forest.PLANTED).repartition(8)
    rows = forest._split_further(df, 64)
    sizes = [r["count"] for r in rows.groupBy("tree", "leaf", "i", "j").count().collect()]
    assert max(sizes) <= 4 * 64 and rows.select("_first").distinct().count() == 6_000


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (5, 5), (None, 3), (300, 301), (301, 302), (300, 302)]
    df = spark.createDataFrame(chain, "a long, b long")
    got = {r["node"]: r["root"] for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 100: 0, 201: 200, 301: 300, 302: 300}
    assert components(df.limit(0)).count() == 0
