"""Embedding near-duplicates by a forest of random-projection trees (operator 10).

A tree splits the vectors at the median of a random projection, and the halves
again, until leaves are small; vectors near a split go to both sides.  The rows of a
leaf are compared with each other, pairs of at least the threshold are joined, and
the leaves of all trees together give the components.  Directions and split points
are fitted on a bounded sample; every row is put into leaves.  Leaves that are still
too large are split further, by points fitted on a bounded sample of each, until none
is; one that no split makes smaller is compared in pairs of blocks.

A component's links are then counted exactly without listing pairs: two vectors
within half the threshold's angle of a third are linked for certain, so the rows
that close to the component's first vector are counted by their number, and only
the others are compared, in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from pressmill.llm.components import components
from pressmill.llm.vectors import matrix, packed, unit
from pressmill.session import write_between

# trees up to a depth of DEPTH, and one more for each further level
TREES, DEPTH = 6, 6
LEAF_ROWS = 256
# share of the rows, on either side of a split, that goes to both sides
SPILL = 0.05
SAMPLE_ROWS = 20_000
# rows of the sample in a leaf at least
LEAF_SAMPLE = 24
BLOCK_ROWS = 1024
# rows of a leaf, over ``leaf_rows``, that is split further; rows it is fitted on, levels and rounds
TOO_LARGE, FIT_ROWS, LEVELS, ROUNDS = 4, 512, 4, 8


PLANTED = "tree int, leaf long, _first long, _vector array<double>"


class Tree:
    """Split points of one tree; directions follow from seed, tree (and round) and level."""

    def __init__(self, sample: np.ndarray, number: int | tuple[int, int], depth: int):
        self.directions = np.random.default_rng([11, *np.atleast_1d(number)]).normal(size=(depth, sample.shape[1]))
        self.splits: dict[int, tuple[float, float, float]] = {}
        self._fit(sample @ self.directions.T, 1, 0)

    def _fit(self, shadows: np.ndarray, node: int, level: int) -> None:
        if level == shadows.shape[1] or len(shadows) < 2 * LEAF_SAMPLE:
            return
        low, middle, high = np.quantile(shadows[:, level], [0.5 - SPILL, 0.5, 0.5 + SPILL])
        self.splits[node] = (low, middle, high)
        self._fit(shadows[shadows[:, level] <= high], 2 * node, level + 1)
        self._fit(shadows[shadows[:, level] >= low], 2 * node + 1, level + 1)

    def leaves(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf), with a row in several leaves where it is near a split."""
        shadows = rows @ self.directions.T
        out, todo = [], [(1, 0, np.arange(len(rows)))]
        while todo:
            node, level, own = todo.pop()
            if not len(own):
                continue
            if node not in self.splits:
                out.append((own, np.full(len(own), node, np.int64)))
                continue
            low, _, high = self.splits[node]
            here = shadows[own, level]
            todo += [(2 * node, level + 1, own[here <= high]), (2 * node + 1, level + 1, own[here >= low])]
        return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])


def groups_within(rows: np.ndarray, least: float) -> np.ndarray:
    """For each row the first row of its component under cosine ``least``."""
    label = np.arange(len(rows))
    while True:
        new = label.copy()
        for a in range(0, len(rows), 512):
            near = rows[a: a + 512] @ rows.T >= least
            new[a: a + 512] = np.minimum(new[a: a + 512], np.where(near, label[None, :], len(rows)).min(axis=1))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def near_duplicates(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.9,
                    trees: int | None = None, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Per row: id, ``n_links`` (other rows linked directly), ``component_id`` and ``kept``.

    Links are pairs of cosine at least ``least``; a component's id is its smallest,
    and ``kept`` tells whether the row has it.  A vector that is null, zero or holds
    null or non-finite components, one of another length than most, and one without
    an id link with nothing.  Repeated rows are rows of their own that link.
    """
    spark = table.sparkSession
    given = table.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("_raw"))
    rows = packed(table, id_col, vector_col)
    size = rows.groupBy(F.size("_vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if size is None:
        return given.select(F.col("_id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
                            F.col("_id").alias("component_id"), F.col("_id").isNotNull().alias("kept"))
    distinct = write_between(rows.where(F.size("_vector") == size["n"]).groupBy("_vector")
                             .agg(F.min("_id").alias("_first"), F.count("*").alias("_n")))
    total = distinct.count()
    sample = unit(matrix(distinct.orderBy(F.xxhash64("_first")).limit(SAMPLE_ROWS).toPandas()["_vector"]))
    depth = max(0, math.ceil(math.log2(max(1, total / leaf_rows))))
    trees = TREES + max(0, depth - DEPTH) if trees is None else trees
    forest = spark.sparkContext.broadcast([Tree(sample, t, depth) for t in range(trees)])

    def plant(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x = unit(matrix(batch["_vector"]))
            for number, tree in enumerate(forest.value):
                at, leaf = tree.leaves(x)
                yield pd.DataFrame({"tree": number, "leaf": leaf, "_first": batch["_first"].to_numpy()[at],
                                    "_vector": batch["_vector"].to_numpy()[at]})

    def compare(leaf: pd.DataFrame) -> pd.DataFrame:
        leaf = leaf.sort_values("_first")
        label = groups_within(unit(matrix(leaf["_vector"])), least)
        own = leaf["_first"].to_numpy()
        moved = np.flatnonzero(label != np.arange(len(label)))
        return pd.DataFrame({"a": own[moved], "b": own[label[moved]]})

    planted = _split_further(distinct.select("_first", "_vector").mapInPandas(plant, PLANTED), leaf_rows)
    links = planted.groupBy("tree", "leaf", "i", "j").applyInPandas(compare, "a long, b long").distinct()
    roots = components(links).select(F.col("node").alias("_first"), "root")
    members = distinct.join(roots, "_first", "left").withColumn("root", F.coalesce("root", "_first"))
    counted = write_between(_with_links(members, least))
    named = given.join(counted, given["_raw"] == counted["_vector"], "left")
    known = F.col("_links").isNotNull() & F.col("_id").isNotNull()
    return named.select(
        F.col("_id").alias(id_col), F.when(known, F.col("_links")).otherwise(0).cast("long").alias("n_links"),
        F.when(known, F.col("root")).otherwise(F.col("_id")).alias("component_id"),
        F.coalesce(F.col("_id") == F.when(known, F.col("root")).otherwise(F.col("_id")), F.lit(False)).alias("kept"))


def _split_further(planted: DataFrame, leaf_rows: int) -> DataFrame:
    """Rows in leaves of bounded size, with the pair of blocks ``i``, ``j`` to be compared in."""
    most = TOO_LARGE * leaf_rows

    def large(rows: DataFrame) -> DataFrame:
        return write_between(rows.groupBy("tree", "leaf").agg(F.count("*").alias("_rows")).where(F.col("_rows") > most))

    sizes = large(planted)
    for number in range(1, ROUNDS + 1):
        if sizes.isEmpty():
            break

        def fit(rows: pd.DataFrame) -> pd.DataFrame:
            levels = min(LEVELS, math.ceil(math.log2(rows["_rows"].iat[0] / leaf_rows)))
            tree = Tree(unit(matrix(rows.sort_values("_first")["_vector"])), (int(rows["tree"].iat[0]), number), levels)
            return pd.DataFrame({"tree": rows["tree"].iloc[:1], "leaf": rows["leaf"].iloc[:1], "_nodes": [list(tree.splits)],
                                 "_low": [[x[0] for x in tree.splits.values()]], "_high": [[x[2] for x in tree.splits.values()]]})

        def descend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for (own, leaf), rows in batch.groupby(["tree", "leaf"], sort=False):
                    nodes = rows["_nodes"].iat[0]
                    if nodes is None or not len(nodes):
                        yield rows[["tree", "leaf", "_first", "_vector"]]
                        continue
                    x = unit(matrix(rows["_vector"]))
                    tree = Tree(x[:0], (int(own), number), LEVELS)
                    tree.splits = {int(n): (a, a, b) for n, a, b in zip(nodes, rows["_low"].iat[0], rows["_high"].iat[0])}
                    at, node = tree.leaves(x)
                    yield pd.DataFrame({"tree": own, "leaf": (int(leaf) << (LEVELS + 1)) + node,
                                        "_first": rows["_first"].to_numpy()[at], "_vector": rows["_vector"].to_numpy()[at]})

        taken = F.pmod(F.xxhash64("_first", "tree", F.lit(number)), F.col("_rows")) < FIT_ROWS
        points = write_between(planted.join(sizes, ["tree", "leaf"]).where(taken).groupBy("tree", "leaf").applyInPandas(
            fit, "tree int, leaf long, _nodes array<long>, _low array<double>, _high array<double>"))
        planted = write_between(planted.join(points, ["tree", "leaf"], "left").mapInPandas(descend, PLANTED))
        sizes = large(planted)
    blocks = F.ceil(F.coalesce("_rows", F.lit(1)) / F.lit(max(BLOCK_ROWS, most))).cast("int")
    own = F.pmod(F.xxhash64("_first"), blocks).cast("int")
    dealt = planted.join(sizes, ["tree", "leaf"], "left").withColumn("_own", own) \
        .withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return dealt.select("tree", "leaf", "_first", "_vector",
                        F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"))


def _with_links(members: DataFrame, least: float) -> DataFrame:
    """``(_vector, root, _links)`` of distinct vectors: links of each of their rows."""
    sure = math.sqrt((1 + least) / 2) + 1e-9
    centre = members.where("_first = root").select(F.col("root"), F.col("_vector").alias("_centre"))
    joined = members.join(centre, "root")

    def aim(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                near = np.einsum("ij,ij->i", unit(matrix(batch["_vector"])), unit(matrix(batch["_centre"])))
                yield batch.drop(columns="_centre").assign(_sure=near >= sure)

    aimed = write_between(joined.select("root", "_first", "_n", "_vector", "_centre").mapInPandas(
        aim, "root long, _first long, _n long, _vector array<double>, _sure boolean"))
    sums = aimed.groupBy("root").agg(F.sum(F.when(F.col("_sure"), F.col("_n")).otherwise(0)).alias("_ball"),
                                     F.count("*").alias("_size"), F.sum((~F.col("_sure")).cast("long")).alias("_far"))
    with_sums = aimed.join(sums, "root")
    certain = with_sums.select("_first", F.when(F.col("_sure"), F.col("_ball")).otherwise(0).alias("_count"))
    open_ones = with_sums.where("_far > 0")
    blocks = F.ceil(F.col("_size") / BLOCK_ROWS).cast("int")
    far_blocks = F.ceil(F.col("_far") / BLOCK_ROWS).cast("int")
    block, far_block = F.pmod(F.xxhash64("_first"), blocks).cast("int"), F.pmod(F.xxhash64("_first"), far_blocks).cast("int")
    left = open_ones.select("root", "_first", "_n", "_vector", "_sure", block.alias("i"), F.explode(F.sequence(F.lit(0), far_blocks - 1)).alias("j"))
    right = open_ones.where("NOT _sure").select(
        F.col("root").alias("far_root"), F.col("_first").alias("far_first"), F.col("_n").alias("far_n"),
        F.col("_vector").alias("far_vector"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("far_i"), far_block.alias("far_j"))

    def count(all_rows: pd.DataFrame, far: pd.DataFrame) -> pd.DataFrame:
        if not len(all_rows) or not len(far):
            return pd.DataFrame({"_first": [], "_count": []})
        linked = unit(matrix(all_rows["_vector"])) @ unit(matrix(far["far_vector"])).T >= least
        linked |= all_rows["_first"].to_numpy()[:, None] == far["far_first"].to_numpy()[None, :]
        of_all = linked @ far["far_n"].to_numpy()
        near = all_rows["_sure"].to_numpy()
        of_far = all_rows["_n"].to_numpy()[near] @ linked[near]
        return pd.DataFrame({"_first": np.concatenate((all_rows["_first"], far["far_first"])),
                             "_count": np.concatenate((of_all, of_far)).astype(np.int64)})

    counted = left.groupBy("root", "i", "j").cogroup(right.groupBy("far_root", "far_i", "far_j")) \
        .applyInPandas(count, "_first long, _count long")
    links = certain.unionByName(counted).groupBy("_first").agg((F.sum("_count") - 1).alias("_links"))
    return aimed.join(links, "_first").select("_vector", "root", "_links")
