"""Connected components of an undirected graph given as edges, by alternating large and small stars.

Each round joins edges with the smallest neighbour of their ends; no node's neighbours are gathered in one place. The
written table of a round is the next one's input, so lost executors cost one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).withColumnRenamed("a", "u")
    return both.join(least, both["a"] == least["u"]).filter("b > a and b <> m").select(F.col("m").alias("a"), "b")


def _small_star(edges: DataFrame) -> DataFrame:
    # an edge is (a, b) with a < b
    least = edges.groupBy("b").agg(F.min("a").alias("m")).withColumnRenamed("b", "u")
    joined = edges.join(least, edges["b"] == least["u"])
    kept = joined.select(F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("b").alias("b")), F.struct(F.col("m").alias("a"), F.col("a").alias("b")))).alias("e"))
    return kept.select("e.a", "e.b").filter("a < b").distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that has an edge and is not its component's root, from long pairs (a, b) with a < b.

    The root is the component's smallest node. Repeated edges are welcome; an empty table gives an empty result.
    """
    edges = materialize(edges.select("a", "b").filter("a < b").distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        edges = materialize(_small_star(_large_star(edges)), "edges")
        last, mark = mark, _mark(edges)
        if last == mark:
            break
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
