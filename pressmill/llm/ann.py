"""Nearest neighbours by an inverted multi-index (operator 7).

Vectors are scaled to length 1 and cut in two halves, and each half is quantised by
its own centroids, so that ``K`` centroids a half make ``K x K`` cells.  A query
visits cells in order of the sum of its two halves' distances to the centroids, by
a heap over the two sorted lists, until they hold a share of all rows, and ranks
the rows of these cells by exact cosine.

The cells of one centroid of the first half are worked on together: a query is sent
once to each such centroid, with a bit for every second one, and gets back one list
of its best rows there.  Rows and queries of a centroid are both dealt into blocks, so
that no task holds more than one block of each.

Cells that cannot hold a better row are left out: the ``k``-th best cosine among some
rows of the sample is a lower bound, and a query's distance to a centroid less that
centroid's radius tells how near any row of it can be.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, Window

from pressmill.llm.vectors import matrix, packed, unit
from pressmill.session import write_between

# centroids are fitted on at most so many rows
SAMPLE_ROWS = 20_000
# rows of a cell, on average; centroids of a half at most
CELL_ROWS = 200
MOST_CENTROIDS = 256
# share of all rows that a query's cells hold; of it depends the recall
SHARE = 0.85
# rows, and queries, of a first centroid compared in one task
BLOCK_ROWS = 4096
# rows of the sample that bound a query's k-th best from below
PROBE_ROWS = 200


def kmeans(rows: np.ndarray, k: int, seed: int, rounds: int = 10) -> np.ndarray:
    """Centroids of rows; an empty one stays where it was."""
    rng = np.random.default_rng(seed)
    centres = rows[rng.choice(len(rows), size=min(k, len(rows)), replace=False)].copy()
    for _ in range(rounds):
        own = nearest(rows, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, rows)
        sizes = np.bincount(own, minlength=len(centres))
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


def distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (rows ** 2).sum(1)[:, None] - 2 * rows @ centres.T + (centres ** 2).sum(1)[None, :]


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([distances(rows[a: a + 4096], centres).argmin(1) for a in range(0, len(rows), 4096)]
                          or [np.zeros(0, np.int64)])


def visit(one: np.ndarray, two: np.ndarray, sizes: dict[int, int], wanted: float) -> list[int]:
    """Cells by summed distance until they hold ``wanted`` rows: the multi-sequence algorithm."""
    a, b = np.argsort(one, kind="stable"), np.argsort(two, kind="stable")
    k, out, held = len(b), [], 0
    heap, seen = [(one[a[0]] + two[b[0]], 0, 0)], {(0, 0)}
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        cell = int(a[i]) * k + int(b[j])
        if sizes.get(cell):
            out.append(cell)
            held += sizes[cell]
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < k and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (one[a[x]] + two[b[y]], x, y))
    return out


def reach(own: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """Least squared distance of queries to any row of each centroid, from those to the centroids."""
    return np.maximum(np.sqrt(np.maximum(own, 0)) - radii[None, :] - 1e-7, 0) ** 2


def best(query: np.ndarray, rows: np.ndarray, ids: np.ndarray, own: np.ndarray, asked: np.ndarray, k: int):
    """Exact ``k`` best of the ``asked`` ones of ``rows`` for each query, as (query number, id, cosine)."""
    like = query @ rows.T
    like[~asked | (own[:, None] == ids[None, :])] = -np.inf
    out = []
    for number, line in enumerate(like):
        # a little more than needed, as products of blocks round differently
        least = np.partition(line, -k)[-k] if len(line) > k else -np.inf
        at = np.flatnonzero((line >= least - 1e-12) & (line > -np.inf))
        score = np.einsum("ij,j->i", rows[at], query[number])
        take = np.lexsort((ids[at], -score))[:k]
        out += [(number, int(ids[at[i]]), float(score[i])) for i in take]
    return out


def search(table: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           k: int = 5, share: float = SHARE) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` nearest rows of each query.

    A row is not its own neighbour.  Vectors that are null, zero or hold null or
    non-finite components take no part, nor do rows without an id.  Vectors of
    different lengths are not compared: those of the most frequent length are
    searched.  Of exact copies the ``k + 1`` smallest ids are kept, as no more can be
    among the ``k`` nearest.  The order is by cosine, then by id.
    """
    spark = table.sparkSession
    rows = packed(table, id_col, vector_col)
    sizes = rows.groupBy(F.size("_vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("_vector") == sizes["n"])
    asked = packed(queries, id_col, vector_col).where(F.size("_vector") == sizes["n"])
    copies = Window.partitionBy("_vector").orderBy("_id")
    rows = rows.withColumn("_copy", F.row_number().over(copies)).where(F.col("_copy") <= k + 1).select("_id", "_vector")
    sampled = rows.orderBy(F.xxhash64("_id")).limit(SAMPLE_ROWS).toPandas()
    sample = matrix(sampled["_vector"])
    half = sample.shape[1] // 2
    number = max(1, min(MOST_CENTROIDS, math.ceil(math.sqrt(sizes["count"] / CELL_ROWS))))
    sample = unit(sample)
    books = [kmeans(sample[:, :half], number, 1), kmeans(sample[:, half:], number, 2)] if half else \
        [np.zeros((1, 0)), kmeans(sample, number, 2)]
    probes, probe_ids = sample[:PROBE_ROWS], sampled["_id"].to_numpy()[:PROBE_ROWS]
    sent = spark.sparkContext.broadcast(books)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one, two = sent.value
        for batch in batches:
            if len(batch):
                x = unit(matrix(batch["_vector"]))
                a, b = nearest(x[:, :half], one), nearest(x[:, half:], two)
                yield batch.assign(first=a, second=b, away_one=np.linalg.norm(x[:, :half] - one[a], axis=1),
                                   away_two=np.linalg.norm(x[:, half:] - two[b], axis=1))

    entries = write_between(rows.mapInPandas(
        assign, "_id long, _vector array<double>, first int, second int, away_one double, away_two double"))
    second = len(books[1])
    # at most MOST_CENTROIDS squared cells
    cells = entries.groupBy("first", "second").agg(F.count("*"), F.max("away_one"), F.max("away_two")).collect()
    held = {r[0] * second + r[1]: r[2] for r in cells}
    radii = np.zeros(len(books[0])), np.zeros(second)
    for a, b, _, away_one, away_two in cells:
        radii[0][a], radii[1][b] = max(radii[0][a], away_one), max(radii[1][b], away_two)
    probe_cells = nearest(probes[:, :half], books[0]) * second + nearest(probes[:, half:], books[1])
    known = spark.sparkContext.broadcast((probes, probe_ids, probe_cells, radii))
    wanted = share * sum(held.values())
    of_first: dict[int, int] = {}
    for cell, n in held.items():
        of_first[cell // second] = of_first.get(cell // second, 0) + n

    def traverse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        (one, two), (probe, ids, cells_of, (radius_one, radius_two)) = sent.value, known.value
        for whole in batches:
            for at in range(0, len(whole), 1024):
                batch = whole.iloc[at: at + 1024]
                x = unit(matrix(batch["_vector"]))
                first, second_ = distances(x[:, :half], one), distances(x[:, half:], two)
                like = x @ probe.T
                like[batch["_id"].to_numpy()[:, None] == ids[None, :]] = -1
                # no row farther than the k-th best of these rows is wanted; their cells are visited
                top = np.argpartition(like, -min(k, len(ids)), axis=1)[:, -min(k, len(ids)):]
                far = 2 - 2 * np.take_along_axis(like, top, axis=1).min(axis=1) + 1e-9 if len(ids) > k else np.full(len(x), 5.0)
                near_one, near_two = reach(first, radius_one), reach(second_, radius_two)
                visits = []
                for i in range(len(x)):
                    chosen = np.zeros((len(one), second), dtype=bool)
                    chosen.ravel()[visit(first[i], second_[i], held, wanted)] = True
                    chosen.ravel()[cells_of[top[i]]] = True
                    chosen &= near_one[i][:, None] + near_two[i][None, :] <= far[i]
                    visits.append([(int(c), np.packbits(chosen[c]).tobytes()) for c in np.flatnonzero(chosen.any(axis=1))])
                yield batch.assign(visits=visits)

    going = write_between(asked.mapInPandas(
        traverse, "_id long, _vector array<double>, visits array<struct<first: int, asked: binary>>"))
    visits = going.select("_id", "_vector", F.explode("visits").alias("_v")).select("_id", "_vector", "_v.*")
    # at most MOST_CENTROIDS numbers
    asking = {r[0]: r[1] for r in visits.groupBy("first").count().collect()}

    def blocks(of: dict[int, int]) -> Column:
        """Number of blocks of a first centroid."""
        pairs = [x for c in of_first for x in (F.lit(c), F.lit(max(1, math.ceil(of.get(c, 0) / BLOCK_ROWS))))]
        return F.create_map(*pairs)[F.col("first")]

    def dealt(to: DataFrame, own: dict[int, int], other: dict[int, int], names: tuple[str, str]) -> DataFrame:
        """Rows with a block of their own side, for each block of the other."""
        block = F.pmod(F.xxhash64("_id"), blocks(own)).cast("int")
        return to.withColumn(names[0], block).withColumn(names[1], F.explode(F.sequence(F.lit(0), blocks(other) - 1)))

    visits = dealt(visits, asking, of_first, ("query_block", "block"))
    visited = dealt(entries.drop("away_one", "away_two"), of_first, asking, ("block", "query_block"))

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        ids, own, cells = right["_id"].to_numpy(), left["_id"].to_numpy(), right["second"].to_numpy()
        x, y = unit(matrix(left["_vector"])), unit(matrix(right["_vector"]))
        wanted_here = np.stack([np.unpackbits(np.frombuffer(b, np.uint8), count=second) for b in left["asked"]]).astype(bool)
        found = []
        for at in range(0, len(x), 256):
            part = slice(at, at + 256)
            found += [(own[at + q], v, s) for q, v, s in best(x[part], y, ids, own[part], wanted_here[part][:, cells], k)]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    near = visits.groupBy("first", "block", "query_block").cogroup(visited.groupBy("first", "block", "query_block")) \
        .applyInPandas(compare, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
