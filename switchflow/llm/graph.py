"""Connected components of links that stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchflow.session import materialize

ROUNDS = 60  # the alternating stars need about log2 of the longest chain


def connected_components(links: DataFrame) -> DataFrame:
    """(node, label) for the nodes of links (u, v); label is the smallest node of the component.

    Alternating large and small stars. Every round is written to the shared folder,
    so a lost executor costs a read, and only two numbers per round reach the driver.
    """
    edges = materialize(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    seen = _digest(edges)
    for _ in range(ROUNDS):
        if not seen[0]:
            break
        both = edges.select(F.col("u").alias("a"), F.col("v").alias("b")).union(edges.select(F.col("v"), F.col("u")))
        least = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "star")
        large = materialize(both.filter("b > a").join(least, "a").select(F.col("b").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct(), "star")
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "star")
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = _digest(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))


def _digest(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.sum(h.bitwiseAND(0xFFFFFFFF)), F.sum(F.shiftrightunsigned(h, 32))).first())
