"""Connected components over an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_saved, save


def components(edges: DataFrame) -> DataFrame:
    """edges (a BIGINT, b BIGINT) -> (node, component): the smallest node reachable, for every node that has an edge.

    Each round hooks every neighbour of a node to the smallest one (large star), then does so among the smaller
    neighbours alone (small star); the graph becomes one star a component after a number of rounds logarithmic in
    its size. A round is two minima by key, pre-aggregated before the shuffle, and two equi-joins whose hot
    keys Spark may split; no neighbour list is ever gathered. Every round is written to the shared folder.
    """

    def star(pairs: DataFrame) -> DataFrame:
        """pairs (u, v) -> (u, v, m): m the smallest of u and its v."""
        least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        return pairs.join(least, pairs.u == least.k).select("u", "v", "m")

    now = save(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    print_of = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    mark = print_of(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = star(both).where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = save(large)
        found = star(large)
        small = found.select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e")).select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
        after = save(small.where("u <> v").distinct())
        drop_saved(large)
        drop_saved(now)
        now, before, mark = after, mark, print_of(after)
        if mark == before:
            break
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


class Roots(dict):
    """Which nodes are in one component already."""

    def find(self, i: int) -> int:
        while (up := self.setdefault(i, i)) != i:
            self[i] = self[up]
            i = self[i]
        return i
