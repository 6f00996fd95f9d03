"""Work selection against plain Python, on one and on many partitions."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from pressmill.operators import tasks
from pressmill.operators.numbering import number_rows


def task_rows(n=400, seed=1):
    rng = random.Random(seed)
    sites = [f"s{i}" for i in range(25)]
    # one site holds a third of all rows
    return [(i, None if rng.random() < .03 else "" if rng.random() < .03 else
             "s0" if rng.random() < .33 else rng.choice(sites), rng.choice(["a", "b", None])) for i in range(n)]


@pytest.fixture(params=[1, 8])
def frame(spark, request):
    def make(rows, schema):
        rows = list(rows)
        random.Random(3).shuffle(rows)
        return spark.createDataFrame(rows, schema).repartition(request.param)
    return make


@pytest.mark.parametrize("n", [4, 7, 3, 60])
def test_blocks(frame, n):
    rows = task_rows()
    sizes = {}
    for _, site, _ in rows:
        if site:
            sizes[site] = sizes.get(site, 0) + 1
    df = frame(rows, "article_id long, media_url string, domain string")
    got = tasks.assign_blocks(df, n).collect()
    order = sorted(sizes, key=lambda s: (-sizes[s], s))
    want = {s: min(i % (2 * n), 2 * n - 1 - i % (2 * n)) for i, s in enumerate(order)}
    assert len(got) == sum(sizes.values()) and all(r["block"] == want[r["media_url"]] for r in got)
    loads = [sum(sizes[s] for s in sizes if want[s] == b) for b in range(n)]
    assert max(loads) - min(loads) <= max(sizes.values())


def by_site(rows):
    sizes, blocks = {}, {}
    for row in rows:
        sizes[row["media_url"]] = sizes.get(row["media_url"], 0) + 1
        blocks.setdefault(row["media_url"], set()).add(row["block"])
    assert all(len(b) == 1 for b in blocks.values())
    return sizes, {s: b.pop() for s, b in blocks.items()}


def site_rows(sizes):
    return [(f"{s}{i}", f"s{s:03}") for s, size in enumerate(sizes) for i in range(size)]


@pytest.mark.parametrize("n, sizes", [
    (3, [40] + [5] * 30), (4, [50, 49, 48, 30, 20, 9] + [1] * 90), (2, [100]), (5, [7] * 23), (6, [200] + [3] * 10),
    (8, [int(900 / (i + 1)) + 1 for i in range(300)])])
def test_even_blocks(frame, n, sizes):
    rows = site_rows(sizes)
    df = frame(rows + [("x", None), ("y", "")], "article_id string, media_url string")
    found, blocks = by_site(tasks.assign_blocks(df, n, even=True).collect())
    assert sorted(found.values()) == sorted(sizes) and set(blocks.values()) <= set(range(n))
    total = sum(sizes)
    heavy = sorted((s for s in found if found[s] * n * tasks.HEAVY_PARTS >= total), key=lambda s: (-found[s], s))
    loads = [0] * n
    for s in heavy:
        assert blocks[s] == loads.index(min(loads))
        loads[blocks[s]] += found[s]
    level = next(x for x in range(total + 1) if sum(max(0, x - y) for y in loads) >= total - sum(loads))
    most = max(loads)
    for s in found:
        if s not in heavy:
            loads[blocks[s]] += found[s]
    light = max([found[s] for s in found if s not in heavy], default=0)
    assert max(loads) <= max(most, level + light)


@pytest.mark.parametrize("seed", range(4))
def test_even_blocks_come_near_the_best(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 4, 9, 15, 28]) for _ in range(8)]
    best = min(max(sum(s for s, b in zip(sizes, way) if b == k) for k in range(3))
               for way in itertools.product(range(3), repeat=8))
    df = spark.createDataFrame(site_rows(sizes), "article_id string, media_url string")
    found, blocks = by_site(tasks.assign_blocks(df, 3, even=True).collect())
    most = max(sum(found[s] for s in found if blocks[s] == b) for b in range(3))
    # light sites can add one of them to the bound of longest-first
    assert most <= best * 4 / 3 + max([s for s in sizes if s * 24 < sum(sizes)], default=0)


def test_even_blocks_of_nothing(frame):
    df = frame([(1, None), (2, "")], "article_id long, media_url string")
    assert tasks.assign_blocks(df, 4, even=True).count() == 0


@pytest.mark.parametrize("small", [5_000, 0])
def test_limits_are_exact(frame, monkeypatch, small):
    monkeypatch.setattr(tasks, "SMALL_LIMIT", small)
    df = frame([(None,), (1,), (2,), (2,), (2,), (3,)], "article_id long")
    got = [sorted((r[0] for r in tasks.fetch_tasks(df, limit=k).collect()), key=lambda x: -1 if x is None else x)
           for k in (1, 3, 5, 9)]
    assert got == [[None], [None, 1, 2], [None, 1, 2, 2, 2], [None, 1, 2, 2, 2, 3]]


@pytest.mark.parametrize("kind", ["long", "string", "date"])
def test_large_limits(frame, kind):
    """Every cut through nulls, a hot value, ties and single values, with columns of any kind along."""
    rng = random.Random(2)
    keys = [None] * 40 + [7] * 130 + [rng.randrange(3, 60) for _ in range(200)]
    cast = {"long": "k", "string": "lpad(CAST(k AS STRING), 3, '0')", "date": "date_add(DATE'2024-01-01', k)"}[kind]
    df = frame([(k, i, {"m": i}) for i, k in enumerate(keys)], "k int, i int, m map<string, int>").selectExpr(f"{cast} AS key", "i", "m")
    ordered = sorted(keys, key=lambda k: (k is not None, k))
    for limit in (1, 40, 41, 100, 170, 171, 250, 369, 370, 371):
        got = tasks.lowest_rows(df, "key", limit).collect()
        want = ordered[:limit]
        assert len({r["i"] for r in got}) == len(got) == len(want)
        assert sorted((keys[r["i"]] for r in got), key=lambda k: (k is not None, k)) == want
        assert all(r["m"] == {"m": r["i"]} for r in got)


def test_large_limits_are_not_sorted_in_one_task(spark):
    df = spark.range(0, 200_000, 1, 16).selectExpr("id * 7919 % 200000 AS article_id", "id")
    found = tasks.fetch_tasks(df, limit=150_000)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Limit" not in plan and "Exchange" not in plan
    assert found.agg(F.count("*"), F.max("article_id")).first()[:] == (150_000, 149_999)


def test_one_block_takes_everything(frame):
    df = frame(task_rows(), "article_id long, media_url string, domain string")
    assert tasks.assign_blocks(df, 1).groupBy("block").count().collect()[0]["count"] == 400


def test_no_sites(frame):
    df = frame([(1, None, "a"), (2, "", "a")], "article_id long, media_url string, domain string")
    assert tasks.assign_blocks(df, 4).count() == 0


def test_numbers_and_stripes(frame):
    rows = [(i * 3 - 50, i % 4) for i in range(301)]
    df = frame(rows, "article_id long, k long")
    got = {r["article_id"]: r["position"] for r in number_rows(df, "article_id").collect()}
    assert got == {i * 3 - 50: i for i in range(301)}
    by_key = {r["article_id"]: r["position"] for r in number_rows(df, F.desc("k"), "article_id").collect()}
    assert by_key == {r[0]: p for p, r in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])))}
    striped = tasks.stripe(df, 7).collect()
    assert {r["article_id"]: r["block"] for r in striped} == {i * 3 - 50: i % 7 for i in range(301)}


def test_shuffle_is_repeatable(frame):
    df = frame([(i,) for i in range(200)], "article_id long")
    order = [r["article_id"] for r in tasks.shuffle_tasks(df, 5).collect()]
    other = [r["article_id"] for r in tasks.shuffle_tasks(df.repartition(3), 5).collect()]
    assert order == other and sorted(order) == list(range(200)) and order != sorted(order)
    assert order != [r["article_id"] for r in tasks.shuffle_tasks(df, 6).collect()]


def plan(rows, gated, draws):
    out, total = {}, 0
    for position, (key, domain) in enumerate(rows):
        wait = 0 if gated(domain, key) or domain != rows[position - 1][1] else draws[key]
        total += wait
        out[key] = (wait, total)
    return out


@pytest.mark.parametrize("rows", [
    [(i, random.Random(i).choice(["a", "b", None])) for i in range(150)],
    [(1, "a")], [(1, "a"), (2, "a")], [(1, "a"), (2, "b")], [],
])
def test_pauses(frame, rows):
    df = frame(rows, "k long, domain string")
    draws = {r["k"]: 1 + r["d"] % 5 for r in df.select("k", tasks.draw(F.col("k"), 9).alias("d")).collect()}
    assert all(1 <= d <= 5 for d in draws.values())
    got = tasks.pause_plan(df, "k", seed=9, gated=F.col("k") % 7 == 0).collect()
    want = plan(rows, lambda d, k: k % 7 == 0, draws)
    assert {r["k"]: (r["pause"], r["start_offset"]) for r in got} == want


def test_pauses_per_block(frame):
    rows = [(i, random.Random(i).choice(["a", "b"]), i % 3) for i in range(120)]
    df = frame(rows, "k long, domain string, block int")
    draws = {r["k"]: 2 for r in df.collect()}
    got = tasks.pause_plan(df, "k", 2, 2, by="block").collect()
    want = {}
    for b in range(3):
        want.update(plan([(k, d) for k, d, block in rows if block == b], lambda d, k: False, draws))
    assert {r["k"]: (r["pause"], r["start_offset"]) for r in got} == want


def test_selection(frame):
    rows = [(i, i % 3, ["UNPROCESSED", "FAILED"][i % 2], None if i % 5 == 0 else i % 8) for i in range(100)]
    df = frame(rows, "article_id long, batch_id long, status string, tries int")
    ids = lambda d: sorted(r["article_id"] for r in d.collect())
    assert ids(tasks.fetch_tasks(df)) == list(range(100))
    assert ids(tasks.fetch_tasks(df, 1, "FAILED")) == [i for i, b, s, _ in rows if b == 1 and s == "FAILED"]
    assert ids(tasks.fetch_tasks(df, 0, "")) == list(range(100))
    assert ids(tasks.fetch_tasks(df, 2, None, 4)) == [2, 5, 8, 11]
    first = tasks.fetch_tasks(df, None, "FAILED", 20, ["article_id", "tries"])
    assert ids(tasks.fetch_tasks(df, None, "FAILED", 20, ["tries"])) == ids(first) == list(range(1, 41, 2))
    kept = ids(tasks.retry_filter(first, 5))
    assert kept == [i for i in range(1, 41, 2) if (rows[i][3] or 0) <= 5]
    assert ids(tasks.retry_filter(first, 0)) == ids(first)


def test_language_gate(spark):
    df = spark.createDataFrame([("en",), ("EN",), (None,)], "language string")
    refused = "ERROR: Not in English"
    assert [r["text"] for r in tasks.language_gate(df).collect()] == [None, refused, refused]
    assert [r["text"] for r in tasks.language_gate(df, False).collect()] == [None] * 3
