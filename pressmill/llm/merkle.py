"""Merkle manifest of a table by slot pivot (operator 12).

Rows are leaves, in one tree per group; the trees' roots are the leaves of a last
tree.  Conditional aggregates spread the children of a parent into one column per
slot: concatenating the columns and hashing gives the parent, concatenating all but
the own column gives a child's siblings.  A pivot holds several levels at once
(``fanout ** height`` slots), so a tree of N leaves takes ``log(N) / (height *
log(fanout))`` shuffles, each of a ``slots``-th of the rows of the one before.  What
travels is one row per parent with its children's digests; texts stay where they are
read, and proofs are spelled out only in the last step, beside the leaves.

Leaves of a group are numbered by one range shuffle of digests, so a group may hold
any share of the rows.  A group without a name is a group.  Rows with one id are told
apart by their digests, and equal rows are leaves of their own; a null id comes first.
Null values and empty ones have different digests; texts may be of any length.  Other
columns are neither read nor named.  An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pressmill.operators.numbering import number_rows
from pressmill.session import write_between

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 2
# levels that one pivot holds
HEIGHT = 4


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts' texts, one after another."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_digest(values: list[Column]) -> Column:
    """Digest of a row: each value with its length in bytes before it, ``-`` for null."""
    texts = [v.cast("string") for v in values]
    return digest(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest and its siblings lead to."""
    return F.aggregate(path, leaf, lambda own, step: digest(step["left"], own, step["right"]))


def proof_text(path: Column) -> Column:
    """Digests of all siblings, level by level, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def _run(columns: list[str]) -> str:
    return "concat('', " + ", ".join(f"coalesce({c}, '')" for c in columns) + ")"


class _Pivot:
    """Columns of one round: ``height`` levels of the trees, their nodes dealt into slots.

    ``n`` counts the nodes of a row's tree on the round's lowest level.  Where one is
    left the tree has ended, and its root passes through the levels above.  Columns are
    written as SQL text, as there are many of them.
    """

    def __init__(self, fanout: int, height: int):
        self.fanout, self.height, self.slots = fanout, height, fanout ** height

    def nodes_at(self, level: int) -> str:
        return f"((n + {self.fanout ** level - 1}) div {self.fanout ** level})"

    def names(self, level: int) -> list[str]:
        return [f"digest_{level}_{i}" for i in range(self.fanout ** (self.height - level))]

    def spread(self, nodes: DataFrame) -> DataFrame:
        """``nodes`` (tree, n, pos, node) to one row per parent with a column per node of every level."""
        columns = [F.expr(f"max(CASE WHEN pos % {self.slots} = {i} THEN node END) AS node_{i}") for i in range(self.slots)]
        rows = nodes.groupBy("tree", "n", F.expr(f"pos div {self.slots} AS pos")).agg(*columns)
        rows = rows.selectExpr("*", *[f"node_{i}.digest AS {name}" for i, name in enumerate(self.names(0))])
        for level in range(1, self.height + 1):
            rows = rows.selectExpr("*", *[f"{self._parent(level, i)} AS {name}" for i, name in enumerate(self.names(level))])
        return rows

    def _children(self, level: int, i: int) -> list[str]:
        return self.names(level - 1)[i * self.fanout: (i + 1) * self.fanout]

    def _parent(self, level: int, i: int) -> str:
        children = self._children(level, i)
        return (f"CASE WHEN {self.nodes_at(level - 1)} <= 1 THEN {children[0]} "
                f"WHEN {children[0]} IS NOT NULL THEN sha2({_run(children)}, 256) END")

    def top(self) -> str:
        return self.names(self.height)[0]

    def _steps(self, slot: int) -> str:
        """Siblings of a slot's node and of its parents within the round, lowest first; null where a tree has ended."""
        steps = []
        for level in range(self.height):
            own = slot // self.fanout ** level
            run, at = self._children(level + 1, own // self.fanout), own % self.fanout
            left, right = (_run(side) if side else "''" for side in (run[:at], run[at + 1:]))
            steps.append(f"CASE WHEN {self.nodes_at(level)} > 1 THEN named_struct('left', {left}, 'right', {right}) END")
        return f"array({', '.join(steps)})"

    def unfold(self, rows: DataFrame, above: DataFrame) -> DataFrame:
        """One row per node with its whole ``path``; ``above`` has (tree, pos, path, roots) of the parents."""
        slots = ", ".join(
            f"CASE WHEN node_{i} IS NOT NULL THEN named_struct('slot', {i}, 'node', node_{i}, 'steps', {self._steps(i)}) END"
            for i in range(self.slots))
        return rows.join(above, ["tree", "pos"]).selectExpr("tree", "pos", "path", "roots", f"explode(array_compact(array({slots}))) AS one") \
            .selectExpr("tree", f"pos * {self.slots} + one.slot AS pos", "one.node AS node",
                        "concat(array_compact(one.steps), path) AS path", "roots")


def _grow(nodes: DataFrame, pivot: _Pivot) -> list[DataFrame]:
    """Tables of the rounds of all trees, lowest first, each written."""
    left = nodes.agg(F.max("n")).first()[0] or 0
    rounds = []
    while not rounds or left > 1:
        rounds.append(write_between(pivot.spread(nodes)))
        nodes = rounds[-1].selectExpr(
            "tree", f"{pivot.nodes_at(pivot.height)} AS n", "pos", f"named_struct('digest', {pivot.top()}) AS node")
        left = -(-left // pivot.slots)
    return rounds


def _descend(rounds: list[DataFrame], pivot: _Pivot, above: DataFrame) -> DataFrame:
    """Paths of the lowest nodes, from those of the roots."""
    step = lambda paths, rows: pivot.unfold(rows, paths.select("tree", "pos", "path", "roots"))
    return reduce(step, reversed(rounds), above)


def manifest(docs: DataFrame, id_col: str = "doc_id", group: str = "lang", fields: tuple[str, ...] = FIELDS,
             carry: dict[str, Column] | None = None, fanout: int = FANOUT, height: int = HEIGHT) -> DataFrame:
    """One row per document: its id, ``leaf``, ``subroot`` of its group, ``root`` and ``path``.

    ``path`` lists for each level the digests left and right of the own node's.
    ``carry`` names further columns, of rows of ``docs``, that travel with the leaf.
    """
    extra = list((carry or {}).items())
    leaves = write_between(docs.select(
        F.col(group).alias("group"), F.col(id_col).alias("id"), leaf_digest([F.col(f) for f in fields]).alias("digest"),
        *[c.alias(f"carry_{k}") for k, (_, c) in enumerate(extra)], F.monotonically_increasing_id().alias("row")))
    # the row's own number only cuts ranges between equal rows
    numbered = number_rows(
        leaves, F.col("group").asc_nulls_first(), F.col("id").asc_nulls_first(), "digest", "row", name="at")
    groups = write_between(number_rows(
        numbered.groupBy("group").agg(F.min("at").alias("start"), F.count("*").alias("n")), "start", name="tree"))
    own = groups.select(F.col("group").alias("of"), "start", "n", "tree")
    carried = [f"carry_{k}" for k in range(len(extra))]
    nodes = numbered.join(own, F.col("group").eqNullSafe(F.col("of"))).select(
        "tree", "n", (F.col("at") - F.col("start")).alias("pos"), F.struct("digest", "id", *carried).alias("node"))

    pivot = _Pivot(fanout, height)
    lower = _grow(nodes, pivot)
    subroots = lower[-1].selectExpr("tree", f"{pivot.top()} AS digest")
    count = groups.count()
    upper = _grow(subroots.select(
        F.lit(0).cast("long").alias("tree"), F.lit(count).cast("long").alias("n"), F.col("tree").alias("pos"),
        F.struct("digest").alias("node")), pivot)
    none = F.array().cast("array<struct<left:string,right:string>>")
    roots = upper[-1].select("tree", "pos", none.alias("path"), F.struct(F.col(pivot.top()).alias("root")).alias("roots"))
    tops = write_between(_descend(upper, pivot, roots).select(
        F.col("pos").alias("tree"), F.lit(0).cast("long").alias("pos"), "path",
        F.struct(F.col("node.digest").alias("subroot"), F.col("roots.root").alias("root")).alias("roots")))
    return _descend(lower, pivot, tops).select(
        F.col("node.id").alias(id_col), F.col("node.digest").alias("leaf"), "roots.subroot", "roots.root", "path",
        *[F.col(f"node.carry_{k}").alias(name) for k, (name, _) in enumerate(extra)])


def verify(found: DataFrame, leaf: Column) -> DataFrame:
    """``found`` (of ``manifest``) with ``folded_root``, what ``leaf`` leads to, and whether it is the root."""
    return found.withColumn("folded_root", folded(leaf, F.col("path"))) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))
