"""Connected components of a graph given as a table of edges.

Large-star and small-star steps in turn: each points the neighbours of a node to the smallest node among them, until no edge changes.
Every step is a minimum per node, combined inside each task before the shuffle, and a join back on the node, which adaptive execution
splits where a node has very many edges. Edges are written to the shared folder after each round, and the table before is deleted; the
driver sees two numbers a round.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.shared import delete, write_table


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Point neighbours to the smallest: the larger neighbours of a node (large star), or the smaller ones and itself (small star)."""
    both = edges.select("a", "b")
    if large:
        both = both.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = both.join(least, "a")
    if large:
        return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    pointed = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return pointed.unionAll(least.where("a <> m").select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of an edge (a, b) between different nodes; the component is its smallest node.

    Loops and repeated edges do no harm; edges with a null end are ignored. No edges give no rows.
    """
    spark = edges.sparkSession
    current = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    path = write_table(current, "edges")
    before = None
    while True:
        table = spark.read.schema(current.schema).parquet(path)
        # all edges point to the smallest of their component when a round changes none
        state = table.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == before:
            return table.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
                table.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = state
        after = write_table(_star(_star(table, large=True), large=False), "edges")
        delete(spark, path)
        path = after


def forest(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    """Those of the links (a, b) that join what the links before do not."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    left, right = [], []
    for x, y in zip(a.tolist(), b.tolist()):
        one, other = root(x), root(y)
        if one != other:
            parent[max(one, other)] = min(one, other)
            left.append(x)
            right.append(y)
    return left, right
