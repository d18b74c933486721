"""Connected components by repeated contraction of the graph.

Each round gives every vertex a representative from its closed neighbourhood and merges the
vertices of one representative. Rounds take turns: by the smallest id, which swallows a star
around its smallest member at once, and by the smallest hash, which shrinks any graph by a
constant share. A round is two joins and one grouping with partial sums, so a vertex with
very many links is never one group in memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) of all nodes with a link.

    `edges` has two long columns u, v; loops, repeated links and both directions may occur,
    links with a null end are dropped. No edges give no rows.
    """
    links = edges.filter("u <> v").select("u", "v")
    links = written(links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "links")
    chosen, turn = [], 0
    while not links.isEmpty():
        order = F.col("v") if turn % 2 == 0 else F.xxhash64(F.lit(turn), "v")
        own = F.col("u") if turn % 2 == 0 else F.xxhash64(F.lit(turn), "u")
        heads = written(
            links.groupBy("u").agg(F.min(F.struct(order.alias("o"), F.col("v").alias("head"))).alias("best"))
            .select("u", F.least("best", F.struct(own.alias("o"), F.col("u").alias("head")))["head"].alias("head")),
            "heads")
        chosen.append(heads)
        links = written(
            links.join(heads.select("u", F.col("head").alias("hu")), "u")
            .join(heads.select(F.col("u").alias("v"), F.col("head").alias("hv")), "v")
            .filter("hu <> hv").select(F.col("hu").alias("u"), F.col("hv").alias("v")).distinct(), "links")
        turn += 1
    if not chosen:
        return links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    final = None
    for heads in reversed(chosen):
        if final is None:
            final = heads
        else:
            later = final.select(F.col("u").alias("head"), F.col("head").alias("last"))
            final = heads.join(later, "head", "left").select("u", F.coalesce("last", "head").alias("head"))
    final = written(final, "roots")
    smallest = final.groupBy("head").agg(F.min("u").alias("component"))
    return final.join(smallest, "head").select(F.col("u").alias("node"), "component")
