"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.session import materialise


def _smallest(links: DataFrame) -> DataFrame:
    """For every node u of (u, v): the smallest of u and its neighbours."""
    return links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _state(links: DataFrame):
    row = links.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component): the smallest node that links reach from each linked node.

    Alternating large-star and small-star steps. A step is one partial aggregate and one join,
    so a node with very many links is combined on the map side and its join partition is cut
    by adaptive execution. Every round is written to the shared folder. Null ends are ignored,
    repeated links and self links do no harm, no links give no rows.
    """
    u, v = F.col(left), F.col(right)
    now = links.where(u.isNotNull() & v.isNotNull() & (u != v)).select(
        F.greatest(u, v).alias("u"), F.least(u, v).alias("v")
    )
    now = materialise(now.distinct(), "links")
    before = _state(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_smallest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        small = _smallest(large)
        joined = large.join(small, "u")
        now = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v")))
        now = materialise(now.where("u != v").distinct(), "links")
        after = _state(now)
        if after == before:
            break
        before = after
    stars = now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    heads = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.unionByName(heads)
