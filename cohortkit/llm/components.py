"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import written


def _state(edges: DataFrame):
    row = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).collect()[0]
    return row.n, row.x


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges`` of integer columns ``u``, ``v`` to (node, root): the smallest node
    of each component, for every node that has an edge.

    Each round is two joins on a node with its smallest neighbour, written to
    the shared folder; stars converge in two rounds, paths in a logarithmic
    number.
    """
    edges = written(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .distinct(), "edges")
    state = _state(edges)
    for _ in range(max_rounds):
        if not state[0]:
            break
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        new = _state(edges)
        if new == state:
            break
        state = new
    else:
        raise RuntimeError("components did not converge")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")) \
        .union(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
