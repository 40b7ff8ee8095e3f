"""Connected components of a large graph of links."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import saved


def components(links: DataFrame, saved: Callable[[DataFrame, str], DataFrame] = saved) -> DataFrame:
    """`node, label` for every node of `links(a, b)`; the label is the component's least node.

    Alternates two steps that keep the components: every node's larger neighbours move to its least
    neighbour, then its smaller ones do. The links end as stars around the least nodes, after a number
    of rounds that grows with the logarithm of the graph, also for long chains. A hub's links are never
    gathered; its least neighbour is an aggregate. `saved` saves the links of each round, the last of which the result reads.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    done = False
    while not done:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = saved(large.distinct(), "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = saved(small.unionByName(least.select("u", F.col("m").alias("v"))), "links")
        # Stars around their least nodes: no node is both inside and outside.
        done = links.join(links.select(F.col("v").alias("u")), "u", "left_semi").isEmpty()
    roots = links.select(F.col("v").alias("node")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("label")).distinct().unionByName(
        roots.select("node", F.col("node").alias("label"))
    )
