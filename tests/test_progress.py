"""The stream of counts against counting everything at once."""

import random

from pressmill.operators.stats import count_status
from pressmill.schemas import STATUS_CHANGE
from pressmill.streaming import progress
from pressmill.streaming.progress import ProgressState, changes_between, progress_stream, read_changes


def drop(spark, path, rows):
    rows = [(str(key), version, status) for key, version, status in rows]
    spark.createDataFrame(rows, STATUS_CHANGE).coalesce(1).write.mode("append").parquet(path)


def run(spark, log, folder, **options):
    diffs = []
    progress_stream(read_changes(spark, log), folder, lambda d, n: diffs.append((n, d.collect())), seconds=None, **options).awaitTermination()
    return diffs


def latest_counts(spark, rows):
    latest = {}
    for key, version, status in rows:
        if version > latest.get(key, (-1,))[0]:
            latest[key] = (version, status)
    return {tuple(r) for r in count_status(spark.createDataFrame([(s,) for _, s in latest.values()], "status string")).collect()}


def test_refreshes(spark, tmp_path):
    log, folder = str(tmp_path / "log"), str(tmp_path / "state")
    rng, rows, counts = random.Random(4), [], {}
    for drop_number in range(5):
        # article 0 holds a third of all changes; versions arrive in any order, some twice
        new = [(0 if rng.random() < .33 else rng.randrange(1, 12), rng.randrange(1000), rng.choice(["a", "b", None])) for _ in range(60)]
        new = [r for r in new if (r[0], r[1]) not in {(k, v) for k, v, _ in rows}]
        unique = list({(k, v): (k, v, s) for k, v, s in new}.values())
        rows += unique
        drop(spark, log, unique + rng.sample(rows, 5))
        # every run restarts from what the last one kept
        diffs = run(spark, log, folder, buckets=4, base_every=2)
        assert [n for n, _ in diffs] == [drop_number]
        got = {(r["status"], r["new_count"]) for r in diffs[0][1]}
        assert got == latest_counts(spark, rows)
        for r in diffs[0][1]:
            assert (r["previous_count"], r["diff"]) == (counts.get(r["status"], 0), r["new_count"] - counts.get(r["status"], 0))
        counts = {r["status"]: r["new_count"] for r in diffs[0][1]}


def test_vanished_status_is_not_shown(spark, tmp_path):
    log, folder = str(tmp_path / "log"), str(tmp_path / "state")
    drop(spark, log, [(1, 1, "a"), (2, 1, "b")])
    run(spark, log, folder)
    drop(spark, log, [(1, 2, "b"), (2, 0, "late")])
    (_, rows), = run(spark, log, folder)
    assert [tuple(r) for r in rows] == [("b", 1, 2, 1)]


def test_changes_between_versions(spark):
    kind = "article_id string, status string"
    before = spark.createDataFrame([("a", "x"), ("b", None), ("c", "x"), ("e", None)], kind)
    after = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", None), ("d", None), ("e", None)], kind)
    got = {(r["article_id"], r["version"], r["status"]) for r in changes_between(before, after, 2).collect()}
    assert got == {("b", 2, "x"), ("c", 2, None), ("d", 2, None)}
    assert changes_between(None, after, 1).count() == 5


def changes(spark, rows):
    return spark.createDataFrame([(None if k is None else str(k), v, s) for k, v, s in rows], STATUS_CHANGE)


def table(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_repeated_refreshes_give_the_same_and_old_tables_go(spark, tmp_path):
    state = ProgressState(spark, str(tmp_path), buckets=3, base_every=3)
    rng, rows = random.Random(8), []
    for n in range(8):
        new = [(rng.choice([None, 0, 0, 1, 2, 3, 4, 5]), n * 100 + k, rng.choice(["a", "b", None])) for k in range(10)]
        rows += new
        first = table(state.refresh(changes(spark, new), n))
        # as after a failure between the refresh and its commit
        assert table(state.refresh(changes(spark, new), n)) == first
        assert {(s, c) for s, _, c, _ in first} == latest_counts(spark, rows)
    left = lambda kind: sorted(int(p.name) for p in (tmp_path / kind).iterdir())
    assert (left("base"), left("delta"), left("counts")) == ([5], [6, 7], [6, 7])


def test_refreshes_stay_in_the_jvm_and_read_touched_buckets(spark, tmp_path):
    state = ProgressState(spark, str(tmp_path), buckets=8, base_every=100)
    state.refresh(changes(spark, [(k, 1, "a") for k in range(100)]), 0)
    newest = progress.newest_status(changes(spark, [(1, 2, "b")]), 8)
    bucket = newest.first()["bucket"]
    plan = progress.count_changes(progress.advance(newest, state.known(1, newest, [bucket])))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "MapIn" not in plan
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert f"bucket#" in scan.split("PartitionFilters")[1].split("PushedFilters")[0] and str(bucket) in scan
