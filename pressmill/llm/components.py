"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pressmill.session import write_between


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """One row ``(node, root)`` for every node of ``edges`` but the roots themselves.

    ``root`` is the smallest node of the component.  Alternates large-star and
    small-star steps, so the number of rounds grows with the logarithm of the
    component's size and a hub never has to meet all its neighbours in one task:
    the smallest neighbour is a partial aggregate and goes back by a join that
    Spark can split.  Edges with a null end and loops are ignored.  Each round is
    written to the shared folder, which also cuts the lineage.
    """
    edges = write_between(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where("u > v").where(F.col(a).isNotNull() & F.col(b).isNotNull()).distinct()
    )
    seen = _signature(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        edges = write_between(
            joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        )
        now = _signature(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
