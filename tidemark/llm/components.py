"""Distributed connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spent, written


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component): component is the smallest node that is reachable. edges: two long columns, in any order.

    Alternating large and small stars: each round hangs every node on the smallest neighbour known, which halves long chains.
    Rows never exceed the number of edges, except that the hot centre of a star is only ever the smallest id of its rows, so
    every grouping by a centre is a minimum that is combined before the shuffle. Nodes whose edges are all loops, and null
    ends, give no row. Rounds are written tables; no edge is gathered at one place.
    """
    a, b = edges.columns[:2]
    now = (
        edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
        .where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    now = written(now, "cc")
    for _ in range(most_rounds):
        # Large star: u's larger neighbours, and u's parents, move to the smallest of u's neighbourhood.
        both = now.union(now.select("v", "u").toDF("u", "v"))
        # Written, so that the join has two plain inputs and the rows of a large star's centre can be split among tasks.
        low = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc")
        large = (
            now.select(F.col("v").alias("u"), F.col("u").alias("w"))
            .join(low, "u")
            .where("w <> m")
            .select(F.col("w").alias("u"), F.col("m").alias("v"))
            .union(low.where("u <> m").select("u", F.col("m").alias("v")))
            .distinct()
        )
        # Small star: all parents of u, and u, move to u's smallest parent.
        parent = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(parent, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        then = written(parent.select("u", F.col("m").alias("v")).union(small).distinct(), "cc")
        # Done when no parent has a parent and each node has one parent. Both are needed: a node that has just got two roots
        # as parents joins their components only in the next round.
        open_ = then.select("v").distinct().join(then.select(F.col("u").alias("v")), "v", "left_semi")
        spent(now, low)
        now = then
        if open_.isEmpty() and then.groupBy("u").count().where("count > 1").isEmpty():
            break
    else:
        raise RuntimeError("connected components didn't settle")
    out = now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
    # The last round's table holds the result; who has written what came of it may delete it.
    out.stored_at = now.stored_at
    return out
