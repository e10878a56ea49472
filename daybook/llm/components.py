"""Connected components of a graph given as links, by large-star and small-star steps.

Each step links nodes to the smallest node among their neighbours. A hot node costs one
partial minimum per task and a join that adaptive execution can split; nothing is gathered
per node. Lineage is cut after each round, so a lost executor repeats one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators.joins import lookup
from daybook.session import materialise


def _star(links: DataFrame, both_ways: bool) -> DataFrame:
    """Links of each node's neighbours to the smallest of them and the node: larger neighbours (or smaller ones)."""
    turned = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    near = links.unionByName(turned) if both_ways else links.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = lookup(near, least, ["a"], "inner")
    if both_ways:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return out.where("a <> b")


def components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node that it is linked to, itself left out) for every node with a link.

    ``links`` has columns a and b of one comparable type.
    """
    links = materialise(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        links = materialise(_star(_star(links, True), False).distinct())
